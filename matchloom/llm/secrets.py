"""Secret scans: three strong patterns, and weak parts of credentials that are linked when complementary parts stand close together.

Native: DataFrame functions only. Spans are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize

# The patterns of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex")
#: Weak parts, each too common to report alone: an identifier, a secret, an endpoint. An endpoint ends before a query, so that a key among the
#: parameters is a part of its own, and where a URL holds a user it is the host behind the @. Every repetition is of one class and takes all it
#: can or is anchored at one place, so that no text, however long, is scanned more than a few times.
WEAK_ID = r"(?<![A-Za-z0-9])(?:A[A-Z]{3}[A-Z0-9]{12,}|(?i:client|user|account|access|key|app)[_-]?(?i:id|name|key)[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9._-]{6,})"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])"
_SCHEME = r"\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://"
WEAK_ENDPOINT = (
    rf"(?i){_SCHEME}(?![^\s/?#\x22'<>@]{{1,256}}@)[^\s?#\x22'<>]{{4,}}+"
    r"|(?<=@)(?<=://[^\s/?#\x22'<>@]{1,256}@)[a-z0-9][^\s?#\x22'<>]{3,}+"
    r"|\b(?:host|endpoint|server|url)[\x22']?\x20*[:=]\x20*[\x22']?[a-z0-9][a-z0-9.-]*\.[a-z]{2,}"
)
#: Code points within which complementary parts belong together.
SCOPE = 200
_MARK = "\x01"
#: Parts of a text that are summed together: an even number, so that every block begins beside a match.
_BLOCK = 256


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it stands in there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(body: Column, pattern: str, keep=None) -> Column:
    """start and end of each leftmost match that does not overlap the one before it; ``keep`` judges the matched string.

    Matches are marked, the text is cut at the marks, and the lengths of the parts are summed: every other part is a match. They are
    summed in blocks, then block by block, so that no array grows by more than a block, or a number for each block, one by one.
    """
    parts = F.split(F.regexp_replace(body, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK)
    spans = "array<struct<s:int,e:int>>"
    empty = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast(spans).alias("out"))

    def step(a: Column, n: Column) -> Column:
        end = a["at"] + n
        grown = F.when(a["i"] % 2 == 1, F.concat(a["out"], F.array(F.struct(a["at"].alias("s"), end.alias("e"))))).otherwise(a["out"])
        return F.struct(end.alias("at"), (a["i"] + 1).alias("i"), grown.alias("out"))

    def summed(lengths: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(lengths), F.lit(_BLOCK))
        return F.transform(starts, lambda i: F.aggregate(F.slice(lengths, i, F.lit(_BLOCK)), empty, step))

    def joined(blocks: Column) -> Column:
        before = F.aggregate(blocks, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + b["at"])))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda b, at: F.transform(b["out"], lambda x: F.struct((x["s"] + at).alias("s"), (x["e"] + at).alias("e")))))

    def found(parts: Column) -> Column:
        at = _once(_once(F.transform(parts, lambda x: F.length(x)), summed), joined)
        if keep is None:
            return at
        odd = F.filter(parts, lambda x, i: i % 2 == 1)
        kept = F.filter(F.arrays_zip(at.alias("at"), odd.alias("text")), lambda x: keep(x["text"]))
        return F.transform(kept, lambda x: x["at"])

    return _once(parts, found)


def _where(body: Column, hint: str, spans: Column) -> Column:
    """The spans of the texts that hold the hint; the others are not taken apart."""
    return F.when(body.rlike(hint), spans).otherwise(F.array().cast("array<struct<s:int,e:int>>"))


def find_parts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the arrays of spans assign, access, hex (strong) and weak_id, weak_secret, weak_endpoint to the rows."""
    body = F.col("_body")
    strong = {
        "assign": _where(body, ASSIGN, _spans(body, ASSIGN, lambda x: F.length(F.regexp_extract(x, ASSIGN, 2)) >= 6)),
        "access": _where(body, "AKIA[A-Z0-9]{16}", _spans(body, "AKIA[A-Z0-9]{16,}+")),
        "hex": _where(body, "[0-9a-f]{24}", _spans(body, "(?<![0-9a-f])[0-9a-f]{24,}+")),
    }
    weak = {
        "weak_id": _where(body, WEAK_ID, _spans(body, WEAK_ID)),
        "weak_secret": _where(body, WEAK_SECRET, _spans(body, WEAK_SECRET)),
        "weak_endpoint": _where(body, WEAK_ENDPOINT, _spans(body, WEAK_ENDPOINT)),
    }
    # one code point for another, so that a mark in the text is no mark
    out = docs.withColumn("_body", F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), _MARK, "\x02"))
    return out.withColumns(strong | weak).drop("_body")


def link_parts(parts: DataFrame, row: str, scope: int = SCOPE) -> DataFrame:
    """``row`` and ``linked``: the weak spans (kind, s, e) near a complementary part.

    An interval join: the text is dealt into scopes of ``scope`` code points, each part enters those at its ends and one beyond, whatever its
    length, parts meet by row and scope, and a weak secret stays if an identifier or endpoint stands at most ``scope`` code points away, a weak identifier or endpoint if a
    secret (weak or strong) does. The two parts are disjoint: a span is never its own complement, nor that of one inside it. A weak part
    meets one row for each other role and scope, never each part of it, and the parts of a scope are bounded by its length.
    """
    roles = {"weak_id": "id", "access": "id", "weak_secret": "secret", "assign": "secret", "hex": "secret", "weak_endpoint": "endpoint"}

    def tag(kind: str, role: str) -> Column:
        return F.transform(kind, lambda x: F.struct(F.lit(kind).alias("kind"), F.lit(role).alias("role"), x["s"].alias("s"), x["e"].alias("e")))

    tagged = F.concat(*[tag(*x) for x in roles.items()])
    some = parts.where(F.size("weak_id") + F.size("weak_secret") + F.size("weak_endpoint") > 0)
    one = some.select(row, F.explode(tagged).alias("p")).select(row, "p.*")
    # where one part ends, or up to a scope beyond, the other begins: both ends of the weak part meet both reaches of its complement
    enter = lambda *places: one.withColumn("cell", F.explode(F.array_distinct(F.array(*[F.floor(x / scope) for x in places]))))
    s, e = F.col("s"), F.col("e")
    each = enter(s, e)
    cells = enter(s - scope, s, e, e + scope).groupBy(row, "cell", "role").agg(F.collect_set(F.struct("s", "e")).alias("all"))
    weak = each.where(F.col("kind").startswith("weak_"))
    other = cells.withColumnRenamed("role", "other")
    meet = weak.join(other, [row, "cell"]).where(
        ((F.col("role") == "secret") != (F.col("other") == "secret"))
        & F.exists("all", lambda x: (x["s"] <= F.col("e") + scope) & (x["e"] >= F.col("s") - scope) & ((x["s"] >= F.col("e")) | (x["e"] <= F.col("s"))))
    )
    return meet.groupBy(row).agg(F.collect_set(F.struct("kind", "s", "e")).alias("linked"))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, base (array of kind, s, e: the strong spans by start, then kind) and spans (those and the linked weak ones).

    Null and empty texts have no spans. Texts of any length are taken whole, in one row. Repeated rows each get their own result; weak parts
    link only within a row. A host behind a user and a key is found where these have 256 characters at most. An empty table gives an empty result. Other columns, whatever their names, are left out. Only the span arrays
    are written and shuffled, never the texts.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    parts = materialize(find_parts(rows).drop("text").withColumn("_row", F.monotonically_increasing_id()), "secret-parts")
    linked = link_parts(parts, "_row", scope)
    kinds = "array<struct<s:int,e:int,rank:int,kind:string>>"

    def tag(column: Column, kind: str, rank: int) -> Column:
        return F.transform(column, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind")))

    base = F.array_sort(F.concat(*[tag(F.col(k), k, i) for i, k in enumerate(KINDS)]))
    weak = F.transform(F.coalesce("linked", F.array().cast("array<struct<kind:string,s:int,e:int>>")), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(9).alias("rank"), x["kind"].alias("kind")))
    # a weak span inside a strong one says nothing new
    new = F.filter(weak, lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    out = parts.join(linked, "_row", "left").withColumn("base", base.cast(kinds))
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], "base", F.array_sort(F.concat("base", new.cast(kinds))).alias("spans"))


def _written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def op6_credential_links(spark, sf_dir: str) -> DataFrame:
    """The query: every document's secrets."""
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(_written("base").cast("binary"), 256).alias("base_sha256"), _written("spans").alias("spans"))
