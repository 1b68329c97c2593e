"""Personal data: exact patterns, and candidates of wider patterns that boosted trees accept by format and context."""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.boosting import BoostedTrees
from matchloom.llm.shared import only, slices, strings

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract. Where a start inside a run of digits can't match anyway, it is not tried.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """From each @ to the left and to the right; nothing is scanned twice, whatever stands there."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, 0, found.end()
            last = found.end()
        else:
            last = at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[Span]:
    """The spans of the four exact patterns, by start, then kind; code points, end exclusive."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start():
                digits = _only_digits(m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m[0])) <= 15]
    return sorted(out)


#: High-recall generators by kind; their spans may overlap each other and the exact ones.
_AT = r"(?:\s?[\[({<]\s?at\s?[\])}>]\s?|\x20at\x20|＠)"
_DOT = r"(?:\s?[\[({<]\s?dot\s?[\])}>]\s?|\x20dot\x20|\.)"
_HEX = "[0-9A-Fa-f]{1,4}"
GENERATORS = (
    (0, re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}})+", re.I)),
    (1, re.compile(rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{2,7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![0-9A-Za-z:])")),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\x20?[\[({]\x20?(?:\.|dot)\x20?[\])}]\x20?[0-9]{1,3}){3}(?![0-9])", re.I)),
    (2, re.compile(r"(?<![0-9])[0-9]{3,6}(?:[\x20._/-]{1,2}[0-9]{2,6}){2,5}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])")),
    (3, re.compile(r"(?<![0-9+.])(?:\+[0-9]{1,3}[\x20./-]?|\(?0{1,2}[0-9]{1,3}\)?[\x20./-]?)?\(?[0-9]{2,4}\)?[\x20./-]{1,2}[0-9]{3,4}[\x20./-]?[0-9]{3,5}(?![0-9])")),
)
#: What every candidate of an e-mail address holds.
_AT_SIGN = re.compile(_AT, re.I)
#: Words of the context that speak for a kind, or for something else.
WORDS = {
    0: ("mail", "email", "contact", "write", "reach", "correo", "courriel", "send", "reply"),
    1: ("ip", "address", "host", "server", "login", "client", "ipv6", "peer", "gateway", "dns", "ping"),
    2: ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "carte", "tarjeta", "charge"),
    3: ("phone", "tel", "call", "mobile", "cell", "fax", "telefon", "whatsapp", "dial", "sms", "text", "ring"),
    9: ("order", "invoice", "isbn", "serial", "version", "id", "ref", "part", "code", "page", "date", "total", "sku", "issn", "article", "time", "license", "ticket", "case", "model", "account", "tracking", "mac", "ratio", "score", "build"),
}
#: Words before "at" that name no mailbox.
PLAIN = frozenset("a all and are arrive arrived available back be been book buy down found free games get go here home hosted in is it live look looked looking meet met more now online open order over point read see shop sold start stay stop there this two up us visit was we were work works you".split())
_WORD = re.compile(r"[a-z0-9]+")
_TOP_LEVEL = re.compile(r"(?i)(?:\.|dot)[\])}>\s]*(?:com|org|net|edu|gov|io|de|fr|es|uk|co|info|ch|it|nl|eu|us)\Z")
_CONTEXT = 40


def features(text: str, start: int, end: int, kind: int) -> list[float]:
    """Of the format of text[start:end] and of the words around it."""
    span = text[start:end]
    digits = _only_digits(span)
    letters = sum(c.isalpha() for c in span)
    before = _WORD.findall(text[max(0, start - _CONTEXT) : start].lower())[-5:]
    after = _WORD.findall(text[end : end + _CONTEXT].lower())[:3]
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    own = [next((len(before) - i for i, w in reversed(list(enumerate(before))) if w.startswith(WORDS[k]) and (k < 9 or w in WORDS[9])), 9) for k in (kind, 9)]
    name = re.split(_AT_SIGN, span)[0] if kind == 0 else ""
    marks = [c for c in span if c in " -./_"]
    return [
        kind,
        end - start,
        len(digits),
        letters,
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[0] if groups else 0,
        groups[-1] if groups else 0,
        len(marks),
        len(set(marks)),
        sum(span.count(c) for c in "([<{"),
        span.count(":"),
        float("::" in span),
        float(bool(digits) and luhn(digits)),
        float(digits[:1] in ("3", "4", "5", "6")),
        float(digits[:1] == "0"),
        float(span[:1] == "+" or text[max(0, start - 4) : start].strip().startswith("+")),
        float(_TOP_LEVEL.search(span) is not None),
        float(name.lower() in PLAIN),
        float(any(c in "._-0123456789" for c in name)),
        float(" dot " in span.lower()),
        float(text[end : end + 1].isalnum() or text[max(0, start - 1) : start].isalnum()),
        own[0],
        own[1],
        float(any(w.startswith(WORDS[kind]) for w in after)),
    ]


def candidates(text: str) -> list[Span]:
    out = []
    at = _AT_SIGN.search(text) is not None
    digit = _DIGIT.search(text) is not None
    for kind, pattern in GENERATORS:
        if at if kind == 0 else (":" in text or digit if kind == 1 else digit):
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return out


def _examples(n: int, seed: int) -> Iterator[tuple[str, int, int, int, int]]:
    """Made-up texts with a candidate in each: text, start, end, kind, label.

    Three of five are something else in the same shape: times, hardware addresses, ratios and scopes of names beside addresses; order and
    part numbers, dates and numbers with a wrong check digit beside cards and phones; "available at example.com" beside mailboxes. Contexts
    point to the right kind mostly, to none often, and to the wrong one sometimes, so that no feature settles a kind by itself.
    """
    r = random.Random(seed)
    syllables = ["an", "er", "in", "on", "th", "st", "re", "la", "mo", "ki", "ve", "do"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    hexes = lambda k, w=4: [f"{r.randrange(1 << 4 * w):x}" for _ in range(k)]
    cut = lambda x, sizes, sep: sep.join(x[sum(sizes[:i]) : sum(sizes[: i + 1])] for i in range(len(sizes)))

    def number(size: int, good: bool) -> str:
        body = r.choice("3456") + digits(size - 2)
        return body + next(c for c in "0123456789" if luhn(body + c) == good)

    def mailbox(good: bool) -> str:
        end = r.choice(["com", "org", "net", "de", "io", "co"])
        if good:
            name = r.choice([f"{word()}.{word()}", f"{word()}_{word()}", f"{word()}{digits(2)}", word()])
            at, dot = r.choice([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), ("[at]", "."), (" {at} ", "."), ("＠", "."), (" <at> ", " <dot> "), (" (at) ", "."), (" at ", ".")])
            return f"{name}{at}{word()}{dot}{end}"
        return r.choice([f"{r.choice(sorted(PLAIN))} at {word()}.{end}", f"{word()} at {word()}.{word().capitalize()}", f"{r.choice(sorted(PLAIN))} at {word()} dot {end}", f"{word()} at {digits(1)}.{digits(2)}", f"{word()} at {word()}.{word()}"])

    def address(good: bool) -> str:
        if good:
            k = r.randint(1, 4)
            return r.choice([":".join(hexes(8)), ":".join(hexes(k)) + "::" + ":".join(hexes(r.randint(1, 3))), r.choice(["[.]", "(.)", " [dot] ", "[dot]"]).join(str(r.randrange(256)) for _ in range(4))])
        return r.choice([f"{r.randrange(24):02d}:{r.randrange(60):02d}:{r.randrange(60):02d}", ":".join(x.zfill(2) for x in hexes(6, 2)), ":".join(str(r.randrange(1, 30)) for _ in range(r.randint(3, 5))), r.choice(["abc", "bad", "add", "face"]) + "::" + r.choice(["dead", "be", "cafe", "ad"]), "[.]".join(str(r.randrange(300, 999)) for _ in range(4)), f"{digits(3)}:{digits(2)}:{digits(3)}"])

    def card(good: bool) -> str:
        size = r.choice([16, 16, 16, 15, 13, 19])
        raw = number(size, good or r.random() < 0.1)
        sizes = [4, 6, 5] if size == 15 else [4, 4, 4, size - 12] if size > 13 else [4, 4, 5]
        if good:
            return cut(raw, sizes, r.choice([".", "_", "/", " . ", "--"])) if r.random() < 0.85 or size > 13 else raw
        return r.choice([cut(raw, sizes, r.choice([".", "_", "/", " ", "-"])), raw, f"{digits(4)}/{digits(2)}/{digits(2)}", f"{digits(4)}.{digits(3)}.{digits(2)}", f"{digits(3)}-{digits(4)}-{digits(5)}", " ".join(digits(r.randint(3, 5)) for _ in range(4))])

    def phone(good: bool) -> str:
        a, b, c = digits(3), digits(3), digits(4)
        if good:
            return r.choice([f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0049 {a} {b}{c}", f"0{a} {b} {c}", f"({a}){r.choice(' -')}{b} {c}"])
        return r.choice([f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{c} {b}{a}", f"{a}/{b}/{c}", f"20{digits(2)}-{digits(4)}-{digits(3)}", f"{digits(2)}.{b}.{a}", f"{c}.{b}{c}"])

    makers = (mailbox, address, card, phone)
    for _ in range(n):
        kind, good = r.randrange(4), r.random() < 0.4
        span, pick = makers[kind](good), r.random()
        fitting, wrong = (WORDS[kind], WORDS[9]) if good else (WORDS[9], WORDS[kind])
        cue = r.choice(fitting) if pick < (0.75 if good else 0.5) else r.choice(wrong) if pick > 0.96 else word()
        more = [r.choice(["is", "me", "no", "at", "my", "the", "under", "was"])] if r.random() < 0.4 else []
        head = " ".join([*(word() for _ in range(r.randint(0, 3))), cue, *more]) + r.choice([" ", " ", ": ", " : ", ", ", " ("])
        text = head + span + r.choice([" ", ". ", ", ", ") "]) + " ".join(word() for _ in range(r.randint(0, 4)))
        for s, k, e in candidates(text):
            if k == kind and s < len(head) + len(span) and e > len(head):
                yield text, s, e, k, int(good and s >= len(head) - 1 and e <= len(head) + len(span) + 1)


def calibrated(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores in order and the share of right ones at each, made monotone by pooling neighbours (isotonic regression)."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # right, all
    for right, n in zip(label[order].tolist(), np.ones(len(order)).tolist(), strict=True):
        pools.append([right, n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            right, n = pools.pop()
            pools[-1] = [pools[-1][0] + right, pools[-1][1] + n]
    return score[order], np.repeat([a / n for a, n in pools], [int(n) for _, n in pools])


@functools.lru_cache(maxsize=4)
def model(examples: int = 3000, sure: float = 0.8, seed: int = 7) -> tuple[BoostedTrees, tuple[float, ...]]:
    """Trees fitted on ``examples`` made-up texts, and the threshold of each kind.

    Thresholds are calibrated on as many texts again: a kind's scores become probabilities by isotonic regression, and its threshold is where
    a candidate is right with a probability of ``sure``, halfway to the next score below. Nothing else bounds them.
    """
    fit, held = (list(_examples(examples, s)) for s in (seed, seed + 1))
    table = lambda rows: (np.array([features(*r[:4]) for r in rows]), np.array([r[4] for r in rows], dtype=float))
    x, y = table(fit)
    trees = BoostedTrees(rounds=80, rate=0.2).fit(x, y)
    x, y = table(held)
    score, limits = trees.score(x), []
    for kind in range(len(KINDS)):
        of = x[:, 0] == kind
        s, probability = calibrated(score[of], y[of])
        first = int(np.searchsorted(probability, sure))
        limits.append(float("inf") if first == len(s) else float(s[first] if first == 0 else (s[first - 1] + s[first]) / 2))
    return trees, tuple(limits)


def choose(texts: list[str], base: list[list[Span]], trees: BoostedTrees, limits: tuple[float, ...]) -> list[list[Span]]:
    """The base spans and the accepted candidates; of candidates that overlap, that with the higher odds stays.

    Taken code points are marked, so a candidate costs its length, however many spans the text has.
    """
    found = [(i, s) for i, t in enumerate(texts) for s in candidates(t)]
    out = [list(b) for b in base]
    if found:
        score = trees.score(np.array([features(texts[i], s, e, k) for i, (s, k, e) in found], dtype=float))
        good = [(i, -v, s) for (i, s), v in zip(found, score.tolist(), strict=True) if v >= limits[s[1]]]
        taken: dict[int, bytearray] = {}
        for i, _, (s, k, e) in sorted(good):
            if i not in taken:
                taken = {i: bytearray(len(texts[i]))}
                for a, _, z in base[i]:
                    taken[i][a:z] = b"\1" * (z - a)
            if taken[i].find(1, s, e) < 0:
                out[i].append((s, k, e))
                taken[i][s:e] = b"\1" * (e - s)
    return [sorted(x) for x in out]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[Span]) -> str:
    """Each run of overlapping spans becomes the name of its first kind in brackets."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, text: str = "text", redacted: bool = False, examples: int = 3000) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (exact spans), base_sha256, spans (all), n_added, and with ``redacted`` the text without them.

    One pass over the texts, no shuffle; the model (some ten kB) goes with the task. Null and empty texts have no spans and become
    empty; repeated rows stay. Long texts are taken whole: every pattern is linear in the length of the text.
    """
    trees, limits = model(examples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = strings(batch.column(1))
            base = [base_spans(t) for t in texts]
            every = choose(texts, base, trees, limits)
            arrays = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            arrays += [pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string()), pa.array([written(s) for s in every], pa.string()), pa.array([len(s) - len(b) for s, b in zip(every, base, strict=True)], pa.int64())]
            if redacted:
                arrays.append(pa.array([redact(t, s) for t, s in zip(texts, every, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", *["redacted"] * redacted]
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long" + ", redacted string" * redacted
    rows = only(docs, doc_id="long", **{text: "string"})
    return rows.mapInArrow(lambda it: run(b.rename_columns(["doc_id", "text"]) for b in it), schema)


def redact_documents(docs: DataFrame, text: str = "text", examples: int = 3000) -> DataFrame:
    """The rows with the personal data in ``text`` replaced by its kind in brackets.

    Null texts stay null and empty ones empty; other columns, whatever their names, and repeated rows stay as they are; an empty table stays
    empty. Texts of any length are taken whole: batches are cut by bytes, and only a single longer text makes a larger one.
    """
    trees, limits = model(examples)
    docs = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    at, names = docs.columns.index(text), [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column=names[at]):
            given = batch.column(at).to_pylist()
            texts = [x or "" for x in given]
            found = choose(texts, [base_spans(t) for t in texts], trees, limits)
            clean = pa.array([None if x is None else redact(t, s) for x, t, s in zip(given, texts, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([clean if i == at else batch.column(i) for i in range(len(names))], names=names)

    plain = docs.toDF(*names)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op5_boosted_pii(spark, sf_dir: str) -> DataFrame:
    """The query: every document's personal data."""
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
