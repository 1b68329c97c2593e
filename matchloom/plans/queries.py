"""The registered queries over the driver's tables, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.config import Adjudication, Config, Thresholds, Weights
from matchloom.functions import similarity as sim
from matchloom.functions.clients import CharacterCounts, HashedNgrams, OfflineModel
from matchloom.functions.text import evidence, is_ascii_text, normalize
from matchloom.operators import adjudicate as adj
from matchloom.operators import detector, language, pairs, profile, quality, rowmatch, select, transforms
from matchloom.plans import pipeline
from matchloom.sources.intermediate import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _datasets(spark: SparkSession, sf_dir: str, columns: dict[str, dict[str, str]]) -> dict[str, DataFrame]:
    return {t: _read(spark, sf_dir, t).select(*[F.expr(e).alias(c) for c, e in cs.items()]) for t, cs in columns.items()}


# Columns that are profiled; some get nulls, which the tables lack.
PROFILED = {
    "customer": {"c_name": "c_name", "c_nationkey": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END", "c_mktsegment": "c_mktsegment", "c_none": "CAST(NULL AS STRING)"},
    "supplier": {"s_name": "s_name", "s_nationkey": "s_nationkey"},
    "part": {"p_name": "p_name", "p_brand": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END", "p_type": "p_type", "p_size": "p_size"},
    "orders": {"o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus", "o_orderpriority": "o_orderpriority"},
}
SHARED = {
    "customer": {"c_name": "c_name", "c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment", "c_custkey": "c_custkey"},
    "supplier": {"s_name": "s_name", "s_nationkey": "s_nationkey", "s_suppkey": "s_suppkey"},
    "nation": {"n_name": "n_name", "n_nationkey": "n_nationkey", "n_regionkey": "n_regionkey"},
}
TYPED = {
    "part": {"p_name": "p_name", "p_size": "p_size", "p_partkey": "p_partkey", "p_none": "CAST(NULL AS STRING)"},
    "events": {"event_type": "event_type", "user_id": "user_id", "day": "substring(CAST(ts AS STRING), 1, 10)", "mixed": "CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS STRING) ELSE event_type END"},
}


def _long_sql(columns: dict[str, dict[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS dataset, '{c}' AS column_name, CAST(({e}) AS VARCHAR) AS value FROM {t}" for t, cs in columns.items() for c, e in cs.items()).replace("STRING", "VARCHAR")


def _counts_sql(columns: dict[str, dict[str, str]]) -> str:
    return f"WITH counts AS (SELECT dataset, column_name, value, count(*) AS n FROM ({_long_sql(columns)}) GROUP BY ALL)"


def _stats(spark: SparkSession, sf_dir: str, columns: dict[str, dict[str, str]] = PROFILED) -> DataFrame:
    return profile.column_stats(profile.value_counts(_datasets(spark, sf_dir, columns), digests=True))


@_query(_counts_sql(PROFILED) + " SELECT dataset, column_name, round(sum(CASE WHEN value IS NULL THEN 0 ELSE n END)::DOUBLE / sum(n), 6) AS fill_rate FROM counts GROUP BY ALL")
def profile_fill_rate(spark, sf_dir):
    return _stats(spark, sf_dir).select("dataset", "column_name", F.round("fill_rate", 6).alias("fill_rate"))


@_query(f"SELECT dataset, column_name, CASE WHEN count(value) > 0 THEN round(entropy(value), 6) END AS entropy FROM ({_long_sql(PROFILED)}) GROUP BY ALL")
def profile_entropy(spark, sf_dir):
    return _stats(spark, sf_dir).select("dataset", "column_name", F.round("entropy", 6).alias("entropy"))


@_query(_counts_sql(PROFILED) + " SELECT dataset, column_name, count(value) AS n_distinct FROM counts GROUP BY ALL")
def profile_distinct_count(spark, sf_dir):
    return _stats(spark, sf_dir).select("dataset", "column_name", "n_distinct")


@_query(_counts_sql(PROFILED) + " SELECT dataset, column_name, round(avg(length(value)), 6) AS avg_length FROM counts GROUP BY ALL")
def profile_avg_len(spark, sf_dir):
    return _stats(spark, sf_dir).select("dataset", "column_name", F.round("avg_length", 6).alias("avg_length"))


@_query(
    f"""WITH v AS ({_long_sql(TYPED)}),
t AS (SELECT dataset, column_name, count(value) AS n,
  count(CASE WHEN regexp_full_match(trim(value), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(value AS DOUBLE) END) AS d,
  count(CASE WHEN regexp_full_match(trim(value), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]+)?)?)?') THEN try_cast(value AS TIMESTAMP) END) AS ts
  FROM v GROUP BY ALL)
SELECT dataset, column_name, CASE WHEN n = 0 THEN 'unknown' WHEN d = n THEN 'numerical' WHEN ts = n THEN 'datetime' ELSE 'text' END AS data_type FROM t"""
)
def detect_type(spark, sf_dir):
    return profile.detect_types(profile.value_counts(_datasets(spark, sf_dir, TYPED))).select("dataset", "column_name", "data_type")


def _top_sql(k: int) -> str:
    return _counts_sql(PROFILED) + f""", r AS (SELECT *, row_number() OVER (PARTITION BY dataset, column_name ORDER BY n DESC, value) AS rank FROM counts WHERE value IS NOT NULL)
SELECT dataset, column_name, value, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {k}"""


@_query(_top_sql(10))
def topk_values(spark, sf_dir):
    return profile.top_values(profile.value_counts(_datasets(spark, sf_dir, PROFILED)), 10)


@_query(_top_sql(50))
def top50_values(spark, sf_dir):
    return profile.top_values(profile.value_counts(_datasets(spark, sf_dir, PROFILED)), 50)


_CATALOG_SQL = "(VALUES " + ", ".join(f"('{t}', '{c}')" for t, cs in SHARED.items() for c in cs) + ") AS c(dataset, column_name)"


@_query(f"SELECT 'customer' AS master_dataset, m.column_name AS master_column, e.dataset AS enrichment_dataset, e.column_name AS enrichment_column FROM {_CATALOG_SQL.replace(' AS c(', ' AS m(')}, {_CATALOG_SQL.replace(' AS c(', ' AS e(')} WHERE m.dataset = 'customer'")
def column_pairs(spark, sf_dir):
    return pairs.column_pairs(profile.catalog(spark, _datasets(spark, sf_dir, SHARED)), "customer")


_OVERLAP_SQL = f"""WITH v AS (SELECT DISTINCT dataset, column_name, value FROM ({_long_sql(SHARED)}) WHERE value IS NOT NULL),
sizes AS (SELECT dataset, column_name, count(*) AS n FROM v GROUP BY ALL),
shared AS (SELECT m.column_name AS master_column, e.dataset AS enrichment_dataset, e.column_name AS enrichment_column, count(*) AS n_both
  FROM v m JOIN v e ON m.value = e.value WHERE m.dataset = 'customer' GROUP BY ALL),
o AS (SELECT a.column_name AS master_column, b.dataset AS enrichment_dataset, b.column_name AS enrichment_column, coalesce(n_both, 0) AS n_both, a.n AS n_master, b.n AS n_enrichment
  FROM sizes a CROSS JOIN sizes b LEFT JOIN shared s ON s.master_column = a.column_name AND s.enrichment_dataset = b.dataset AND s.enrichment_column = b.column_name WHERE a.dataset = 'customer')
"""


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _datasets(spark, sf_dir, SHARED)
    return pairs.overlap(materialize(profile.value_counts(data, digests=True), "value-counts"), "customer", pairs.column_pairs(profile.catalog(spark, data), "customer"))


@_query(_OVERLAP_SQL + "SELECT master_column, enrichment_dataset, enrichment_column, n_both, round(n_both::DOUBLE / n_master, 6) AS overlap_master, round(n_both::DOUBLE / n_enrichment, 6) AS overlap_enrichment, round(n_both::DOUBLE / (n_master + n_enrichment - n_both), 6) AS overlap_jaccard FROM o")
def overlap_ratios(spark, sf_dir):
    return _overlaps(spark, sf_dir).select("master_column", "enrichment_dataset", "enrichment_column", "n_both", *[F.round(c, 6).alias(c) for c in ("overlap_master", "overlap_enrichment", "overlap_jaccard")])


@_query(
    f"""WITH s AS (SELECT dataset, column_name, avg(length(value)) AS len FROM (SELECT DISTINCT dataset, column_name, value FROM ({_long_sql(SHARED)})) GROUP BY ALL),
h AS (SELECT dataset, column_name, entropy(value) AS ent FROM ({_long_sql(SHARED)}) GROUP BY ALL),
a AS (SELECT * FROM s JOIN h USING (dataset, column_name))
SELECT m.column_name AS master_column, e.dataset AS enrichment_dataset, e.column_name AS enrichment_column, round(abs(m.len - e.len), 5) AS avg_length_diff, round(abs(m.ent - e.ent), 5) AS entropy_gap
FROM a m, a e WHERE m.dataset = 'customer'"""
)
def length_diff_entropy_gap(spark, sf_dir):
    data = _datasets(spark, sf_dir, SHARED)
    every = pairs.column_pairs(profile.catalog(spark, data), "customer")
    out = pairs.gaps(every, profile.column_stats(profile.value_counts(data, digests=True)), "customer")
    return out.select("master_column", "enrichment_dataset", "enrichment_column", F.round("avg_length_diff", 5).alias("avg_length_diff"), F.round("entropy_gap", 5).alias("entropy_gap"))


@_query(_OVERLAP_SQL + "SELECT master_column, enrichment_dataset, enrichment_column, round(100.0 * n_both / n_master, 6) AS percent_master_in_enrichment, round(100.0 * n_both / n_enrichment, 6) AS percent_enrichment_in_master, (100 * n_both >= 75 * n_master OR 100 * n_both >= 75 * n_enrichment) AS is_filter FROM o")
def filter_field_split(spark, sf_dir):
    found = _overlaps(spark, sf_dir)
    every = select.overlap_percent(found.select("master_column", "enrichment_dataset", "enrichment_column"), found)
    out = select.split_filters(every, Thresholds().overlap_percent)
    return out.withColumns({c: F.round(c, 6) for c in ("percent_master_in_enrichment", "percent_enrichment_in_master")})


# Columns under several names, so that pairs tie, are reduced and form synonyms; one has no value, one is of another type.
ALIASED = {
    "customer": {"name": "c_name", "title": "c_name", "nation": "c_nationkey", "area": "c_nationkey", "segment": "c_mktsegment", "code": "c_custkey"},
    "supplier": {"company": "s_name", "nation": "s_nationkey", "place": "s_nationkey", "number": "s_suppkey", "none": "CAST(NULL AS STRING)"},
    "orders": {"buyer": "o_custkey", "payer": "CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END", "zone": "o_custkey % 30", "priority": "o_orderpriority"},
    "part": {"size": "p_size", "width": "p_size", "label": "CASE WHEN p_partkey % 3 = 0 THEN 'BUILDING' WHEN p_partkey % 3 = 1 THEN 'none' END", "brand": "p_brand"},
}
#: A dataset without lengths: not a number stands for a feature that couldn't be worked out.
_ODD = "zone"


def _features_sql() -> str:
    """CTEs after which ``f`` has the features of all pairs of the columns of ALIASED; the share of common values stands for the similarity of descriptions."""
    return f"""v AS ({_long_sql(ALIASED)}),
d AS (SELECT DISTINCT dataset, column_name, value FROM v),
z AS (SELECT dataset, column_name, count(value)::DOUBLE / count(*) AS fill, CASE WHEN count(value) > 0 THEN entropy(value) END AS ent,
  CASE WHEN count(value) = 0 THEN 'unknown' WHEN count(try_cast(value AS DOUBLE)) = count(value) THEN 'numerical' ELSE 'text' END AS kind FROM v GROUP BY ALL),
n AS (SELECT dataset, column_name, avg(length(value)) AS len, count(value) AS n FROM d GROUP BY ALL),
a AS (SELECT * FROM z JOIN n USING (dataset, column_name)),
b AS (SELECT x.column_name AS mc, y.dataset AS ed, y.column_name AS ec, count(*) AS n FROM d x JOIN d y ON x.value = y.value WHERE x.dataset = 'customer' GROUP BY ALL),
g AS (SELECT 'customer' AS master_dataset, y.dataset AS enrichment_dataset, x.column_name AS master_column, y.column_name AS enrichment_column, x.kind AS master_data_type, y.kind AS enrichment_data_type,
  CASE WHEN y.column_name = '{_ODD}' THEN 'NaN'::DOUBLE ELSE round(abs(x.len - y.len), 6) END AS avg_length_diff, round(x.fill, 6) AS master_fill_rate, round(y.fill, 6) AS enrichment_fill_rate, round(abs(x.ent - y.ent), 6) AS entropy_gap,
  coalesce(b.n, 0) AS n_both, x.n AS n_m, y.n AS n_e FROM a x CROSS JOIN a y LEFT JOIN b ON mc = x.column_name AND ed = y.dataset AND ec = y.column_name WHERE x.dataset = 'customer'),
f AS (SELECT * EXCLUDE (n_both, n_m, n_e), round(coalesce(n_both::DOUBLE / nullif(n_m + n_e - n_both, 0), 0), 6) AS overlap_jaccard, round(coalesce(n_both::DOUBLE / nullif(n_m + n_e - n_both, 0), 0), 6) AS description_similarity,
  round(coalesce(100.0 * n_both / nullif(n_m, 0), 0), 6) AS fuzzy_ratio, CASE WHEN n_both > 0 THEN 'Yes' ELSE 'No' END AS decision FROM g)"""


_FEATURES_SQL = _features_sql()


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _datasets(spark, sf_dir, ALIASED)
    columns, counts = profile.catalog(spark, data), materialize(profile.value_counts(data), "value-counts")
    found = pairs.gaps(pairs.overlap(counts, "customer", pairs.column_pairs(columns, "customer")), profile.column_stats(counts, columns), "customer")
    kinds = profile.detect_types(counts).select("dataset", "column_name", "data_type")
    m = kinds.where("dataset = 'customer'").select(F.col("column_name").alias("master_column"), F.col("data_type").alias("master_data_type"))
    e = kinds.select(F.col("dataset").alias("enrichment_dataset"), F.col("column_name").alias("enrichment_column"), F.col("data_type").alias("enrichment_data_type"))
    found = found.join(m, "master_column").join(e, ["enrichment_dataset", "enrichment_column"])
    six = {c: F.round(c, 6) for c in ("master_fill_rate", "enrichment_fill_rate", "entropy_gap", "overlap_jaccard")}
    more = {"avg_length_diff": F.when(F.col("enrichment_column") == _ODD, F.lit(float("nan"))).otherwise(F.round("avg_length_diff", 6)), "description_similarity": F.round("overlap_jaccard", 6), "fuzzy_ratio": F.round(100 * F.col("overlap_master"), 6), "decision": F.when(F.col("n_both") > 0, "Yes").otherwise("No")}
    return materialize(found.withColumns(six | more), "pair-features")


@_query(
    f"""WITH {_FEATURES_SQL}
SELECT master_dataset, enrichment_dataset, master_column, enrichment_column FROM f
WHERE NOT isnan(avg_length_diff) AND avg_length_diff < 12 AND master_fill_rate >= 0.25 AND enrichment_fill_rate >= 0.25 AND description_similarity >= 0.3
AND (master_data_type = enrichment_data_type OR description_similarity > 0.8) AND entropy_gap <= 2 AND master_column <> enrichment_column"""
)
def pair_filter(spark, sf_dir):
    return select.filter_pairs(_features(spark, sf_dir)).select("master_dataset", "enrichment_dataset", "master_column", "enrichment_column")


def _mean_sql(name: str, weight: float) -> str:
    return f"coalesce(avg(CASE WHEN NOT isnan({name}) THEN {name} END) OVER w * {weight}, 0)"


_SCORE_SQL = f"""WITH {_FEATURES_SQL}, y AS (SELECT * FROM f WHERE decision = 'Yes'),
s AS (SELECT *, {" + ".join(_mean_sql(n, w) for n, w in (("fuzzy_ratio", 25), ("overlap_jaccard", 100), ("avg_length_diff", 50), ("entropy_gap", 10), ("master_fill_rate", 100), ("enrichment_fill_rate", 100)))} AS weighted_score
  FROM y WINDOW w AS (PARTITION BY master_column, enrichment_dataset))
"""


@_query(_SCORE_SQL + "SELECT master_column, enrichment_dataset, enrichment_column, round(weighted_score, 6) AS weighted_score FROM s")
def weighted_score(spark, sf_dir):
    return select.weighted_score(_features(spark, sf_dir).where("decision = 'Yes'"), Weights()).select("master_column", "enrichment_dataset", "enrichment_column", F.round("weighted_score", 6).alias("weighted_score"))


_BEST_SQL = """, b1 AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY master_column, enrichment_dataset ORDER BY weighted_score DESC NULLS LAST, enrichment_column) = 1),
b2 AS (SELECT * FROM b1 QUALIFY row_number() OVER (PARTITION BY enrichment_dataset, enrichment_column ORDER BY weighted_score DESC NULLS LAST, master_column) = 1)
"""


@_query(_SCORE_SQL + _BEST_SQL + "SELECT master_column, enrichment_dataset, enrichment_column, round(weighted_score, 6) AS weighted_score FROM b2")
def best_match_reductions(spark, sf_dir):
    out = select.reduce_matches(select.weighted_score(_features(spark, sf_dir).where("decision = 'Yes'")))
    return out.select("master_column", "enrichment_dataset", "enrichment_column", F.round("weighted_score", 6).alias("weighted_score"))


_CLUSTER_SQL = """, r AS (SELECT master_column, list(enrichment_column) AS l FROM b2 WHERE enrichment_dataset = 'customer' GROUP BY ALL),
c AS (SELECT b2.*, array_to_string(list_sort(list_distinct(list_append(coalesce(l, []), b2.master_column))), ', ') AS enrichment_candidates FROM b2 LEFT JOIN r USING (master_column))
"""


@_query(_SCORE_SQL + _BEST_SQL + _CLUSTER_SQL + "SELECT master_column, enrichment_dataset, enrichment_column, enrichment_candidates FROM c")
def synonym_clusters(spark, sf_dir):
    best = select.reduce_matches(select.weighted_score(_features(spark, sf_dir).where("decision = 'Yes'")))
    return select.synonym_clusters(best, "customer").select("master_column", "enrichment_dataset", "enrichment_column", "enrichment_candidates")


@_query(
    _SCORE_SQL + _BEST_SQL + _CLUSTER_SQL + """SELECT master_column, enrichment_dataset, enrichment_column, enrichment_candidates, round(weighted_score, 6) AS weighted_score FROM c WHERE enrichment_dataset <> 'customer'
QUALIFY row_number() OVER (PARTITION BY enrichment_dataset, enrichment_candidates ORDER BY weighted_score DESC NULLS LAST, master_column, enrichment_column) = 1"""
)
def final_column_matches(spark, sf_dir):
    none = spark.createDataFrame([], "master_column string, enrichment_dataset string, enrichment_column string, overlap_master double, overlap_enrichment double")
    out = select.column_matches(_features(spark, sf_dir), none, master="customer")
    return out.select("master_column", "enrichment_dataset", "enrichment_column", "enrichment_candidates", F.round("weighted_score", 6).alias("weighted_score"))


def _norm_sql(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(trim(coalesce({x}, ''))), '[^\\w\\s]', '', 'g'), '\\s+', ' ', 'g'))"


@_query(f"SELECT p_partkey, {_norm_sql("p_name || '-- ' || p_type")} AS norm FROM part")
def normalize_text(spark, sf_dir):
    return _read(spark, sf_dir, "part").select("p_partkey", normalize(F.concat("p_name", F.lit("-- "), "p_type")).alias("norm"))


@_query("SELECT doc_id, coalesce(regexp_full_match(text, '[\\x20-\\x7E\\t\\r\\n]*'), true) AS is_english FROM documents")
def is_english_fast(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", is_ascii_text(F.col("text")).alias("is_english"))


@_query(
    f"""WITH l AS (SELECT lang, ('0x' || left(md5(doc_id::VARCHAR), 8))::BIGINT AS place, floor(least(0.5, {detector.SAMPLE}::DOUBLE / (SELECT count(lang) FROM documents)) * 4294967296) AS limit_ FROM documents WHERE lang IS NOT NULL)
SELECT lang, count(*) AS n_rows, true AS accurate FROM l WHERE place >= limit_ GROUP BY lang"""
)
def language_accuracy(spark, sf_dir):
    """Of each language's documents that the detector wasn't fitted on: how many there are, and whether it knows at least 95 in 100."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    share = detector.sample_share(docs, "lang")
    fitted = detector.load_languages(materialize(detector.fit_languages(docs, "text", "lang", "doc_id", share), "languages"))
    others = docs.where(F.col("lang").isNotNull() & ~detector.drawn(F.col("doc_id"), share))
    right = F.count_if(F.col("lang") == detector.language_of(F.col("text"), fitted))
    return others.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), right.alias("n_right")).select("lang", "n_rows", (F.col("n_right") >= 0.95 * F.col("n_rows")).alias("accurate"))


_DICTIONARY = {"de": "German", "fr": "French", "es": "Spanish"}


@_query("SELECT doc_id, CASE lang WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish' ELSE lang END AS lang FROM documents")
def translate_join(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang")
    client = OfflineModel(_DICTIONARY)
    out = language.on_distinct(docs, "lang", lambda v: language._batched(v, "string", client.translate), F.col("value") != "en")
    return out.select("doc_id", F.coalesce("result", "lang").alias("lang"))


def _lcs_sql(pairs: str) -> str:
    """CTEs (of a WITH RECURSIVE) after which ``lcs`` has a, b and n, the length of their longest common subsequence, for the relation ``pairs``."""
    return f"""step(a, b, i, r) AS (SELECT DISTINCT a, b, 0, list_transform(range(1, length(b) + 2), lambda x: 0) FROM {pairs}
  UNION ALL SELECT a, b, i + 1, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT a, b, i, list_transform(range(1, length(b) + 2), lambda j: CASE WHEN j = 1 THEN 0 ELSE greatest(r[j], r[j - 1] + CASE WHEN b[j - 1] = a[i + 1] THEN 1 ELSE 0 END) END) AS c FROM step WHERE i < length(a))),
lcs AS (SELECT a, b, r[len(r)] AS n FROM step WHERE i = length(a))"""


def _set_sql(pairs: str) -> str:
    """CTEs after which ``token_set`` has x, y and score for the relation ``pairs`` of x and y, texts with single spaces."""
    tokens = lambda x: f"list_sort(list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> '')))"
    return f"""sides AS (SELECT DISTINCT x, y, {tokens("x")} AS l, {tokens("y")} AS r FROM {pairs}),
joined AS (SELECT x, y, len(l) AS nl, len(r) AS nr, list_filter(l, lambda t: list_contains(r, t)) AS c, list_filter(l, lambda t: NOT list_contains(r, t)) AS ol, list_filter(r, lambda t: NOT list_contains(l, t)) AS o_r FROM sides),
whole AS (SELECT *, array_to_string(c, ' ') AS both_, array_to_string(list_concat(c, ol), ' ') AS a, array_to_string(list_concat(c, o_r), ' ') AS b FROM joined),
{_lcs_sql("whole")},
token_set AS (SELECT x, y, CASE WHEN nl = 0 OR nr = 0 THEN 0::DOUBLE WHEN len(c) > 0 AND (len(ol) = 0 OR len(o_r) = 0) THEN 100::DOUBLE ELSE greatest(200::DOUBLE * n / (length(a) + length(b)),
    CASE WHEN len(c) > 0 THEN 200::DOUBLE * length(both_) / (length(both_) + length(a)) ELSE 0 END, CASE WHEN len(c) > 0 THEN 200::DOUBLE * length(both_) / (length(both_) + length(b)) ELSE 0 END) END AS score FROM whole JOIN lcs USING (a, b))"""


_NEXT_SQL = """texts AS (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS t FROM part),
named AS (SELECT x.p_partkey, x.t AS x, y.t AS y FROM texts x JOIN texts y ON y.p_partkey = x.p_partkey + 1)"""
_SORTED = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"
_RATIO = "round(200::DOUBLE * n / (length(a) + length(b)), 4) AS score"


def _next_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's text with that of the next part."""
    t = _read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("t"))
    return t.withColumnRenamed("t", "a").join(t.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("t").alias("b")), "p_partkey")


@_query(f"WITH RECURSIVE {_NEXT_SQL}, pairs AS (SELECT p_partkey, x AS a, y AS b FROM named), {_lcs_sql('pairs')} SELECT p_partkey, {_RATIO} FROM pairs JOIN lcs USING (a, b)")
def fuzzy_ratio(spark, sf_dir):
    return _next_parts(spark, sf_dir).select("p_partkey", F.round(sim.fuzzy_ratio("a", "b"), 4).alias("score"))


@_query(f"WITH RECURSIVE {_NEXT_SQL}, pairs AS (SELECT p_partkey, {_SORTED.format('x')} AS a, {_SORTED.format('y')} AS b FROM named), {_lcs_sql('pairs')} SELECT p_partkey, {_RATIO} FROM pairs JOIN lcs USING (a, b)")
def token_sort_ratio(spark, sf_dir):
    return _next_parts(spark, sf_dir).select("p_partkey", F.round(sim.fuzzy_token_sort_ratio("a", "b"), 4).alias("score"))


@_query(f"WITH RECURSIVE {_NEXT_SQL}, {_set_sql('named')} SELECT p_partkey, round(score, 4) AS score FROM named JOIN token_set USING (x, y)")
def token_set_ratio(spark, sf_dir):
    return _next_parts(spark, sf_dir).select("p_partkey", F.round(sim.fuzzy_token_set_ratio("a", "b"), 4).alias("score"))


def _parties(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as enrichment, customers as master, with a second field that is sometimes missing."""
    e = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("enrichment_row_index"), "s_name", F.col("s_nationkey").cast("string").alias("nation"), F.expr("CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat(' Zone ', CAST(s_suppkey % 4 AS STRING)) END").alias("zone"))
    m = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("master_row_index"), "c_name", F.col("c_nationkey").cast("string").alias("nation"), F.expr("CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('zone ', CAST(c_custkey % 4 AS STRING)) END").alias("zone"))
    return e, m


_PARTIES_SQL = """WITH e AS (SELECT s_suppkey AS enrichment_row_index, s_name, s_nationkey::VARCHAR AS nation, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE ' Zone ' || (s_suppkey % 4) END AS zone FROM supplier),
m AS (SELECT c_custkey AS master_row_index, c_name, c_nationkey::VARCHAR AS nation, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'zone ' || (c_custkey % 4) END AS zone FROM customer)
"""
_MAPPING = [("nation", "nation", True), ("zone", "zone", True), ("s_name", "c_name", False)]


def _blocked(spark: SparkSession, sf_dir: str, filters: list[int]) -> DataFrame:
    return rowmatch.block_pairs(*rowmatch._sides(*_parties(spark, sf_dir), _MAPPING), filters)


@_query(_PARTIES_SQL + "SELECT enrichment_row_index, master_row_index FROM e JOIN m USING (nation)")
def blocking_join(spark, sf_dir):
    return _blocked(spark, sf_dir, [0]).select("enrichment_row_index", "master_row_index")


@_query(_PARTIES_SQL + "SELECT enrichment_row_index, master_row_index FROM e JOIN m USING (nation) WHERE e.zone IS NULL OR m.zone IS NULL OR lower(trim(e.zone)) = lower(trim(m.zone))")
def contradiction_filter(spark, sf_dir):
    return _blocked(spark, sf_dir, [0, 1]).select("enrichment_row_index", "master_row_index")


@_query("SELECT s_suppkey AS enrichment_row_index, n_nationkey::BIGINT AS master_row_index FROM supplier, nation")
def cross_pairs(spark, sf_dir):
    e = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("enrichment_row_index"), F.array("s_name").alias("e"))
    m = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("master_row_index"), F.array("n_name").alias("m"))
    return rowmatch.block_pairs(e, m, []).select("enrichment_row_index", "master_row_index")


@_query(_PARTIES_SQL + "SELECT master_row_index, 'nation: ' || coalesce(nation, 'nan') || '; zone: ' || coalesce(zone, 'nan') || '; c_name: ' || coalesce(c_name, 'nan') AS master_evidence FROM m")
def evidence_strings(spark, sf_dir):
    m = _parties(spark, sf_dir)[1]
    return m.select("master_row_index", evidence([(c, F.col(c)) for c in ("nation", "zone", "c_name")]).alias("master_evidence"))


def _evidence_sql(x: str, name: str) -> str:
    return f"'nation: ' || coalesce({x}.nation, 'nan') || '; zone: ' || coalesce({x}.zone, 'nan') || '; c_name: ' || coalesce({x}.{name}, 'nan')"


_BLOCKED_SQL = _PARTIES_SQL.replace("WITH e", "WITH RECURSIVE e") + f""", blocked AS (SELECT enrichment_row_index, master_row_index, {_norm_sql("s_name")} AS x, {_norm_sql("c_name")} AS y, {_evidence_sql("e", "s_name")} AS enrichment_evidence, {_evidence_sql("m", "c_name")} AS master_evidence
  FROM e JOIN m USING (nation) WHERE e.zone IS NULL OR m.zone IS NULL OR lower(trim(e.zone)) = lower(trim(m.zone)))"""
_FUZZY_SQL = f"""{_BLOCKED_SQL}, {_set_sql("blocked")},
f AS (SELECT enrichment_row_index, master_row_index, 'customer' AS master_dataset, 'supplier' AS enrichment_dataset, enrichment_evidence, master_evidence, round(score, 4) AS avg_similarity FROM blocked JOIN token_set USING (x, y) WHERE score >= 60)"""


@_query(f"{_FUZZY_SQL} SELECT * FROM f")
def fuzzy_match_rows(spark, sf_dir):
    e, m = _parties(spark, sf_dir)
    return rowmatch.match_fuzzy(e, m, _MAPPING, "supplier", 60, "customer").withColumn("avg_similarity", F.round("avg_similarity", 4)).drop("similarity")


_NAMES_SQL = f"""WITH RECURSIVE e AS (SELECT vendor_id AS enrichment_row_index, name, CASE WHEN vendor_id % 7 <> 0 THEN nation_id::VARCHAR END AS nation FROM vendors),
m AS (SELECT row_number() OVER (ORDER BY client_id, source, updated_at, name) AS master_row_index, name, nation_id::VARCHAR AS nation FROM clients),
p AS (SELECT enrichment_row_index, master_row_index, e.name AS en, m.name AS mn, e.nation AS ea, m.nation AS ma FROM e, m),
named AS (SELECT *, CASE WHEN en IS NOT NULL THEN {_norm_sql("en")} END AS x, CASE WHEN mn IS NOT NULL THEN {_norm_sql("mn")} END AS y FROM p),
asked AS (SELECT DISTINCT x, y FROM named WHERE x IS NOT NULL AND y IS NOT NULL UNION SELECT DISTINCT ea, ma FROM named WHERE ea IS NOT NULL AND ma IS NOT NULL),
{_set_sql("asked")}
SELECT enrichment_row_index, master_row_index, round(CASE WHEN s.score IS NULL THEN t.score WHEN t.score IS NULL THEN s.score ELSE (s.score + t.score) / 2 END, 4) AS avg_similarity
FROM named n LEFT JOIN token_set s ON s.x = n.x AND s.y = n.y LEFT JOIN token_set t ON t.x = ea AND t.y = ma
WHERE coalesce(s.score, 100) >= 75 AND coalesce(t.score, 100) >= 75 AND (s.score IS NOT NULL OR t.score IS NOT NULL)"""


@_query(_NAMES_SQL)
def fuzzy_match_unfiltered(spark, sf_dir):
    """Vendors against clients by name and nation, without a filter column."""
    e = _read(spark, sf_dir, "vendors").select(F.col("vendor_id").alias("enrichment_row_index"), "name", F.when(F.col("vendor_id") % 7 != 0, F.col("nation_id")).alias("nation"))
    m = rowmatch.row_index(_read(spark, sf_dir, "clients").select("client_id", "source", "updated_at", "name", F.col("nation_id").alias("nation")), "master_row_index", ["client_id", "source", "updated_at", "name"])
    found = rowmatch.match_fuzzy(e, m, [("name", "name", False), ("nation", "nation", False)], "vendors", 75, "clients", index=True)
    return found.select("enrichment_row_index", "master_row_index", F.round("avg_similarity", 4).alias("avg_similarity"))


_COSINE_SQL = """WITH p AS (SELECT e.vec_id AS enrichment_row_index, m.vec_id AS master_row_index, list_cosine_similarity(e.embedding::DOUBLE[], m.embedding::DOUBLE[]) AS c
  FROM embeddings e JOIN embeddings m ON e.label = m.label AND e.vec_id <> m.vec_id),
top AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY enrichment_row_index ORDER BY round(c, 9) DESC NULLS LAST, master_row_index) <= 3)
"""


def _top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest others of each vector with its label; avg_similarity to nine places, as it is ranked, and cosine as it is."""
    v = _read(spark, sf_dir, "embeddings").where("label IS NOT NULL")
    e = v.select(F.col("vec_id").alias("enrichment_row_index"), F.array(F.col("label").cast("string")).alias("e"), F.col("embedding").alias("e_v0"))
    m = v.select(F.col("vec_id").alias("master_row_index"), F.array(F.col("label").cast("string")).alias("m"), F.col("embedding").alias("m_v0"))
    others = rowmatch.nearest_rows(e, m, [0], 1, 4).where("enrichment_row_index != master_row_index")  # itself may be among the four
    scored = others.select("enrichment_row_index", "master_row_index", F.lit("vectors").alias("enrichment_dataset"), F.col("scores")[0].alias("cosine")).withColumn("avg_similarity", F.round("cosine", 9))
    return rowmatch.top_matches(scored, 3, ["enrichment_row_index"], ["master_row_index"])


@_query(_COSINE_SQL + "SELECT enrichment_row_index, master_row_index, round(c, 6) AS avg_similarity FROM top")
def embed_cosine_topn(spark, sf_dir):
    return _top_vectors(spark, sf_dir).select("enrichment_row_index", "master_row_index", F.round("cosine", 6).alias("avg_similarity"))


_SCORES = "CASE WHEN s_suppkey % {k} = 0 THEN NULL ELSE CAST((s_suppkey * {k}) % 101 AS DOUBLE) END"


@_query(
    f"""WITH s AS (SELECT s_suppkey AS id, [{", ".join(_SCORES.format(k=k) for k in (2, 3, 5))}] AS l FROM supplier),
x AS (SELECT id, unnest(l) AS v, generate_subscripts(l, 1) AS i FROM s)
SELECT id, array_to_string(list(v::INTEGER ORDER BY i), ',') AS similarity, round(avg(v), 6) AS avg_similarity, count(*) AS similarity_count FROM x WHERE v IS NOT NULL GROUP BY id"""
)
def score_flatten_regroup(spark, sf_dir):
    scores = F.array(*[F.expr(_SCORES.format(k=k)) for k in (2, 3, 5)])
    out = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), scores.alias("scores"))
    some = F.filter("scores", lambda x: x.isNotNull())
    out = out.select("id", F.array_join(some.cast("array<int>"), ",").alias("similarity"), F.round(sim.mean_score(F.col("scores")), 6).alias("avg_similarity"), F.size(some).cast("long").alias("similarity_count"))
    return out.where("similarity_count > 0")


@_query(
    f"""SELECT id, CAST(i - 1 AS INTEGER) AS index, v::INTEGER AS value FROM (SELECT s_suppkey AS id, unnest(l) AS v, generate_subscripts(l, 1) AS i FROM (SELECT s_suppkey, [{", ".join(_SCORES.format(k=k) for k in (2, 3, 5))}] AS l FROM supplier)) WHERE v IS NOT NULL"""
)
def flatten_scores(spark, sf_dir):
    scores = F.array(*[F.expr(_SCORES.format(k=k)) for k in (2, 3, 5)])
    out = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.posexplode(scores).alias("index", "value"))
    return out.where("value IS NOT NULL").withColumn("value", F.col("value").cast("int"))


@_query(_COSINE_SQL + "SELECT enrichment_row_index, master_row_index, CASE WHEN round(c, 9) >= 0.9 THEN 'Yes' ELSE 'No' END AS final_llm_decision, 'LLM not called; backup threshold used' AS final_llm_justification FROM top")
def adjudicate_threshold(spark, sf_dir):
    out = adj.adjudicate(_top_vectors(spark, sf_dir), OfflineModel(), Adjudication(ask_top_n=0))
    return out.select("enrichment_row_index", "master_row_index", "final_llm_decision", "final_llm_justification")


@_query(_COSINE_SQL + "SELECT enrichment_row_index, master_row_index, CASE WHEN row_number() OVER (PARTITION BY master_row_index ORDER BY round(c, 9) DESC NULLS LAST, enrichment_row_index) <= 1 THEN 'llm' ELSE 'low' END AS route FROM top")
def adjudicate_topn_route(spark, sf_dir):
    return adj.route(_top_vectors(spark, sf_dir), Adjudication(ask_top_n=1), 3).select("enrichment_row_index", "master_row_index", "route")


@_query(_COSINE_SQL + "SELECT CASE WHEN round(c, 9) >= 0.9 THEN 'Yes' ELSE 'No' END AS final_llm_decision, count(*) AS n FROM top GROUP BY ALL")
def decision_tally(spark, sf_dir):
    return adj.tally(adj.by_threshold(_top_vectors(spark, sf_dir)))


@_query("SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS row_index FROM customer")
def row_index(spark, sf_dir):
    return rowmatch.row_index(_read(spark, sf_dir, "customer"), "row_index", ["c_name", "c_custkey"]).select("c_custkey", "row_index")


@_query("SELECT * FROM customer ORDER BY md5(concat_ws('|', '42', c_custkey::VARCHAR, coalesce(c_name, ''), coalesce(c_nationkey::VARCHAR, ''), coalesce(c_acctbal::VARCHAR, ''), coalesce(c_mktsegment, ''))) LIMIT 1000")
def sample_hash(spark, sf_dir):
    return profile.sample_rows(_read(spark, sf_dir, "customer"), 1000)


@_query("SELECT CAST(s_nationkey AS VARCHAR) AS value FROM supplier INTERSECT SELECT CAST(c_nationkey AS VARCHAR) FROM customer")
def values_intersect(spark, sf_dir):
    a, b = (_read(spark, sf_dir, t).select(F.col(c).cast("string").alias("value")) for t, c in (("supplier", "s_nationkey"), ("customer", "c_nationkey")))
    return a.intersect(b)


@_query("SELECT CAST(s_nationkey AS VARCHAR) AS value FROM supplier UNION SELECT c_mktsegment FROM customer")
def values_union(spark, sf_dir):
    a, b = _read(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("value")), _read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("value"))
    return a.union(b).distinct()


@_query("SELECT 'supplier' AS dataset, s_suppkey AS row_index FROM supplier UNION ALL SELECT 'customer', c_custkey FROM customer")
def union_matches(spark, sf_dir):
    parts = [_read(spark, sf_dir, t).select(F.lit(t).alias("dataset"), F.col(k).alias("row_index")) for t, k in (("supplier", "s_suppkey"), ("customer", "c_custkey"))]
    return rowmatch.union_matches(parts, spark)


@_query("SELECT 0::BIGINT AS enrichment_row_index, ''::VARCHAR AS enrichment_dataset WHERE false")
def empty_match(spark, sf_dir):
    e, m = _parties(spark, sf_dir)
    return rowmatch.match_fuzzy(e, m, [("nation", "nation", True)], "supplier").select("enrichment_row_index", "enrichment_dataset")


@_query("SELECT c_custkey, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal <= 0")
def quality_positive(spark, sf_dir):
    return quality.not_positive(_read(spark, sf_dir, "customer"), "c_acctbal").select("c_custkey", F.round("c_acctbal", 2).alias("c_acctbal"))


@_query("SELECT event_type, count(*) AS n, count(CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 1 END) AS n_missing FROM events GROUP BY ALL")
def json_path(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return _read(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(k.isNull(), 1)).alias("n_missing"))


@_query("SELECT n_nationkey, n_name, coalesce(r_name, 'none') AS region FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey")
def left_join_default(spark, sf_dir):
    r = _read(spark, sf_dir, "region").where("r_regionkey < 3")
    n = _read(spark, sf_dir, "nation")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select("n_nationkey", "n_name", F.coalesce("r_name", F.lit("none")).alias("region"))


@_query("SELECT page_id, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:www\\.)?([^/:?#\\s]+)', 1)) AS domain FROM pages")
def transform_domain(spark, sf_dir):
    return language.transform_column(_read(spark, sf_dir, "pages").select("page_id", "url"), "url", "domain").select("page_id", F.col("url__TRANSFORMED").alias("domain"))


# Pairs of columns that a transform relates, and in SQL the transform that is to be found: its program, and its expression over x.
_RELATED = {
    "clients": {"client_id": "client_id", "email": "email", "surname": "lower(split_part(name, ' ', -1))"},
    "customer": {"c_name": "c_name"},
    "documents": {"lang": "lang"},
    "items": {"brand": "brand"},
    "orders": {"o_custkey": "o_custkey"},
    "pages": {"url": "url"},
    "part": {"p_brand": "p_brand"},
    "supplier": {"s_name": "s_name"},
    "vendors": {"vendor_id": "vendor_id"},
}
_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
_PADDED = "CASE WHEN length(x) < 9 THEN lpad(x, 9, '0') ELSE x END"
_PROGRAMS = {
    ("customer.c_name", "orders.o_custkey"): ("digits|no_leading_zeros", f"regexp_replace({_DIGITS}, '^0+(.)', '\\1')"),
    ("supplier.s_name", "vendors.vendor_id"): ("digits|no_leading_zeros", f"regexp_replace({_DIGITS}, '^0+(.)', '\\1')"),
    ("clients.client_id", "customer.c_name"): ("pad:9|prefix:Customer#", f"'Customer#' || {_PADDED}"),
    ("vendors.vendor_id", "supplier.s_name"): ("pad:9|prefix:Supplier#", f"'Supplier#' || {_PADDED}"),
    ("items.brand", "part.p_brand"): ("digits|prefix:Brand#", f"CASE WHEN {_DIGITS} = '' THEN '' ELSE 'Brand#' || {_DIGITS} END"),
    ("part.p_brand", "items.brand"): ("digits|prefix:B", f"CASE WHEN {_DIGITS} = '' THEN '' ELSE 'B' || {_DIGITS} END"),
    ("clients.email", "clients.surname"): ("first_by_at|letters", "regexp_replace(trim(split_part(x, '@', 1)), '[^\\p{L}]', '', 'g')"),
    ("pages.url", "documents.lang"): ("fourth_by_slash", "trim(split_part(x, '/', 4))"),
}


def _programs_sql() -> str:
    each = []
    for (e, m), (program, expression) in _PROGRAMS.items():
        values = {k: f"SELECT value AS x FROM v WHERE dataset = '{k.split('.')[0]}' AND column_name = '{k.split('.')[1]}' AND value IS NOT NULL" for k in (e, m)}
        each.append(f"SELECT '{e}' AS enrichment_column, '{m}' AS master_column, '{program}' AS program, count(*) AS n_rows, count(CASE WHEN t IN ({values[m]}) THEN 1 END) AS n_found, count(DISTINCT t) AS n_values FROM (SELECT {expression} AS t FROM ({values[e]}))")
    return f"WITH v AS ({_long_sql(_RELATED)}) " + " UNION ALL ".join(each)


@_query(_programs_sql())
def found_transforms(spark, sf_dir):
    """The transforms that relate columns of the tables, found from frequent values, and over all rows how many values they turn into one of the master's."""
    counts = materialize(profile.value_counts(_datasets(spark, sf_dir, _RELATED)), "value-counts")
    name = F.concat_ws(".", "dataset", "column_name")
    both = F.explode(F.array(F.lit("e"), F.lit("m")))
    known = counts.where("value IS NOT NULL").select(name.alias("column_name"), "value", "n")
    found = transforms.find_transforms(profile.top_values(counts, 50).select(both.alias("dataset"), name.alias("column_name"), "value"), known, list(_PROGRAMS))
    parts = []
    for r in found.collect():  # one for each pair
        rows = known.where(F.col("column_name") == r.e_column).select("n", transforms.run(r.program, F.col("value")).alias("value"))
        there = known.where(F.col("column_name") == r.m_column).select("value", F.lit(True).alias("there"))
        counted = rows.join(there, "value", "left").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("there"), F.col("n"))), F.lit(0)).alias("n_found"), F.count_distinct("value").alias("n_values"))
        parts.append(counted.select(F.lit(r.e_column).alias("enrichment_column"), F.lit(r.m_column).alias("master_column"), F.lit("|".join(r.program)).alias("program"), "*"))
    if not parts:
        return spark.createDataFrame([], "enrichment_column string, master_column string, program string, n_rows long, n_found long, n_values long")
    return reduce(DataFrame.unionByName, parts)


_DESCRIBED_SQL = f"""{_counts_sql(SHARED)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset, column_name ORDER BY n DESC, value) AS rank FROM counts WHERE value IS NOT NULL),
examples AS (SELECT dataset, column_name, list(value ORDER BY rank) AS l FROM ranked WHERE rank <= 10 GROUP BY ALL),
typed AS (SELECT dataset, column_name, sum(n) FILTER (WHERE value IS NOT NULL) AS n, sum(n) FILTER (WHERE regexp_full_match(trim(value), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')) AS d FROM counts GROUP BY ALL),
described AS (SELECT dataset, column_name, CASE WHEN n IS NULL THEN 'unknown' WHEN d = n THEN 'numerical' ELSE 'text' END AS data_type, l FROM typed LEFT JOIN examples USING (dataset, column_name)),
told AS (SELECT *, column_name || ': ' || data_type || ', e.g. ' || coalesce(nullif(array_to_string(l, ', '), ''), 'no values') AS description FROM described)"""


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and examples of all rows, with descriptions."""
    return language.describe_columns(profile.metadata(_datasets(spark, sf_dir, SHARED), sample=None), OfflineModel())


@_query(f"{_DESCRIBED_SQL} SELECT dataset, column_name, data_type, array_to_string(l, '|') AS examples, description FROM told")
def describe_columns(spark, sf_dir):
    return _metadata(spark, sf_dir).select("dataset", "column_name", "data_type", F.array_join("example_values", "|").alias("examples"), "description")


def _described(spark: SparkSession, sf_dir: str, embedder=None) -> DataFrame:
    found = embedder or HashedNgrams()
    return language.on_distinct(_metadata(spark, sf_dir), "description", lambda v: language.embed_values(v, found)).withColumnRenamed("result", "vector")


@_query()
def pair_features(spark, sf_dir):
    return pairs.pair_features(_datasets(spark, sf_dir, SHARED), _described(spark, sf_dir), "customer")


_SPACED = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
_JUDGED_SQL = f"""{_OVERLAP_SQL.replace("WITH v", "WITH RECURSIVE v")}, columns_ AS (SELECT *, {_SPACED.format("master_column")} AS x, {_SPACED.format("enrichment_column")} AS y, coalesce(n_both::DOUBLE / nullif(n_master + n_enrichment - n_both, 0), 0) AS overlap_jaccard FROM o),
{_set_sql("columns_")},
j AS (SELECT master_column, enrichment_dataset, enrichment_column, overlap_jaccard, CASE WHEN score >= 80 OR overlap_jaccard >= 0.25 THEN 'Yes' ELSE 'No' END AS decision, format('names {{:.0f}}, shared values {{:.2f}}', score, overlap_jaccard) AS justification FROM columns_ JOIN token_set USING (x, y))"""


@_query(f"{_JUDGED_SQL} SELECT master_column, enrichment_dataset, enrichment_column, decision, justification FROM j")
def judge_pairs(spark, sf_dir):
    return language.judge_column_pairs(pair_features(spark, sf_dir), OfflineModel()).select("master_column", "enrichment_dataset", "enrichment_column", "decision", "justification")


def _characters_sql(x: str) -> str:
    """The vector of CharacterCounts."""
    return f"list_transform(string_split('{CharacterCounts().characters}', ''), lambda c: length({x}) - length(replace({x}, c, '')))"


@_query(f"SELECT n_name AS value, array_to_string({_characters_sql('lower(n_name)')}, ',') AS vector FROM (SELECT DISTINCT n_name FROM nation)")
def embed_text(spark, sf_dir):
    values = _read(spark, sf_dir, "nation").select("n_name", F.lower("n_name").alias("value"))
    found = rowmatch.embedding_lookup(values, CharacterCounts())
    return values.join(found, F.col("value") == F.col("norm")).select(F.col("n_name").alias("value"), F.array_join(F.col("emb").cast("array<int>"), ",").alias("vector")).distinct()


@_query(
    f"""{_BLOCKED_SQL}, scored AS (SELECT enrichment_row_index, master_row_index, list_cosine_similarity({_characters_sql("x")}::DOUBLE[], {_characters_sql("y")}::DOUBLE[]) AS c FROM blocked)
SELECT enrichment_row_index, master_row_index, round(c, 4) AS avg_similarity FROM scored QUALIFY row_number() OVER (PARTITION BY enrichment_row_index ORDER BY round(c, 9) DESC, master_row_index) <= 3"""
)
def embedding_match_rows(spark, sf_dir):
    e, m = _parties(spark, sf_dir)
    return rowmatch.match_embedded(e, m, _MAPPING, "supplier", CharacterCounts(), 3, "customer").select("enrichment_row_index", "master_row_index", F.round("avg_similarity", 4).alias("avg_similarity"))


@_query(
    f"""{_FUZZY_SQL.replace("token_set AS", "names_set AS").replace("JOIN token_set", "JOIN names_set").replace("step", "names_step").replace("lcs", "names_lcs").replace("sides AS", "names_sides AS").replace("FROM sides", "FROM names_sides").replace("joined", "names_joined").replace("whole", "names_whole")},
texts AS (SELECT enrichment_row_index, master_row_index, lower(enrichment_evidence) AS x, lower(master_evidence) AS y FROM f), {_set_sql("texts")}
SELECT enrichment_row_index, master_row_index, CASE WHEN score >= 80 THEN 'Yes' WHEN score >= 60 THEN 'Maybe' ELSE 'No' END AS final_llm_decision, format('evidence {{:.0f}}', score) AS final_llm_justification FROM texts JOIN token_set USING (x, y)"""
)
def judge_rows(spark, sf_dir):
    return adj.judge(fuzzy_match_rows(spark, sf_dir), OfflineModel()).select("enrichment_row_index", "master_row_index", "final_llm_decision", "final_llm_justification")


@_query(_COSINE_SQL + """SELECT enrichment_row_index, master_row_index, '{"decision":"' || CASE WHEN round(c, 9) >= 0.9 THEN 'Yes' ELSE 'No' END || '","justification":"LLM not called; backup threshold used"}' AS final_llm_json FROM top""")
def judgement_object(spark, sf_dir):
    return adj.as_object(adj.by_threshold(_top_vectors(spark, sf_dir))).select("enrichment_row_index", "master_row_index", "final_llm_json")


@_query("SELECT p_partkey, upper(p_name) AS name, length(p_type) AS n FROM part")
def functions_by_name(spark, sf_dir):
    return _read(spark, sf_dir, "part").select("p_partkey", language.call_by_name("upper", "p_name").alias("name"), language.call_by_name("length", "p_type").cast("long").alias("n"))


# The features of the pairs of the tables' own columns, for the queries that select.
_REAL_SQL = f"""{_JUDGED_SQL.replace("SELECT master_column, enrichment_dataset, enrichment_column, overlap_jaccard,", "SELECT master_column, enrichment_dataset, enrichment_column, overlap_jaccard, n_both, n_master, n_enrichment,")},
{_DESCRIBED_SQL.removeprefix("WITH ").replace("counts", "cell_counts").replace("typed", "kinds").replace("ranked", "cell_ranks")},
lengths AS (SELECT dataset, column_name, avg(length(value)) AS len, sum(CASE WHEN value IS NULL THEN 0 ELSE n END)::DOUBLE / sum(n) AS fill FROM cell_counts GROUP BY ALL),
entropies AS (SELECT dataset, column_name, entropy(value) AS ent FROM ({_long_sql(SHARED)}) GROUP BY ALL),
known AS (SELECT dataset, column_name, data_type, len, fill, ent, {_characters_sql("description")}::DOUBLE[] AS vec FROM told JOIN lengths USING (dataset, column_name) JOIN entropies USING (dataset, column_name)),
names_ AS (SELECT DISTINCT master_column AS a, enrichment_column AS b FROM j), {_lcs_sql("names_").replace("step", "name_step").replace("lcs", "name_lcs")},
f AS (SELECT 'customer' AS master_dataset, j.*, m.data_type AS master_data_type, e.data_type AS enrichment_data_type, abs(m.len - e.len) AS avg_length_diff, m.fill AS master_fill_rate, e.fill AS enrichment_fill_rate,
    list_cosine_similarity(m.vec, e.vec) AS description_similarity, abs(m.ent - e.ent) AS entropy_gap, 200::DOUBLE * name_lcs.n / (length(a) + length(b)) AS fuzzy_ratio
  FROM j JOIN known m ON m.dataset = 'customer' AND m.column_name = master_column JOIN known e ON e.dataset = enrichment_dataset AND e.column_name = enrichment_column JOIN name_lcs ON a = master_column AND b = enrichment_column
  WHERE abs(m.len - e.len) < 12 AND m.fill >= 0.25 AND e.fill >= 0.25 AND list_cosine_similarity(m.vec, e.vec) >= 0.3
    AND (m.data_type = e.data_type OR list_cosine_similarity(m.vec, e.vec) > 0.8) AND abs(m.ent - e.ent) <= 2 AND master_column <> enrichment_column)"""
_REAL_SCORE_SQL = _SCORE_SQL.replace(f"WITH {_FEATURES_SQL}", _REAL_SQL)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = pairs.pair_features(_datasets(spark, sf_dir, SHARED), _described(spark, sf_dir, CharacterCounts()), "customer")
    return language.judge_column_pairs(select.filter_pairs(features), OfflineModel())


@_query(_REAL_SQL + " SELECT master_column, enrichment_dataset, enrichment_column, decision, round(description_similarity, 5) AS description_similarity, round(fuzzy_ratio, 5) AS fuzzy_ratio FROM f")
def filtered_pairs(spark, sf_dir):
    return _classified(spark, sf_dir).select("master_column", "enrichment_dataset", "enrichment_column", "decision", F.round("description_similarity", 5).alias("description_similarity"), F.round("fuzzy_ratio", 5).alias("fuzzy_ratio"))


@_query(_REAL_SCORE_SQL + "SELECT master_column, enrichment_dataset, enrichment_column, round(weighted_score, 4) AS weighted_score FROM s")
def scored_pairs(spark, sf_dir):
    return select.weighted_score(_classified(spark, sf_dir).where("decision = 'Yes'")).select("master_column", "enrichment_dataset", "enrichment_column", F.round("weighted_score", 4).alias("weighted_score"))


@_query(
    _REAL_SCORE_SQL + _BEST_SQL + _CLUSTER_SQL.replace("'Master'", "'customer'") + """SELECT master_column, enrichment_dataset, enrichment_column, enrichment_candidates, round(weighted_score, 4) AS weighted_score,
  round(100.0 * n_both / n_master, 5) AS percent_master_in_enrichment, round(100.0 * n_both / n_enrichment, 5) AS percent_enrichment_in_master FROM c WHERE enrichment_dataset <> 'customer'
QUALIFY row_number() OVER (PARTITION BY enrichment_dataset, enrichment_candidates ORDER BY weighted_score DESC NULLS LAST, master_column, enrichment_column) = 1"""
)
def selected_columns(spark, sf_dir):
    out = select.column_matches(_classified(spark, sf_dir), _overlaps(spark, sf_dir), master="customer")
    return out.withColumns({"weighted_score": F.round("weighted_score", 4)} | {c: F.round(c, 5) for c in ("percent_master_in_enrichment", "percent_enrichment_in_master")})


@_query()
def align_columns(spark, sf_dir):
    data = _datasets(spark, sf_dir, SHARED)
    return pipeline.align_columns({"Master": data["customer"], "supplier": data["supplier"], "nation": data["nation"]}, Config(typing_sample=None))
