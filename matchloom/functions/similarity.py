"""Similarities: insert-delete ratios of texts (0 to 100) and cosines of vectors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table held in the bits of one number."""
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & where.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def ratio(a: str, b: str) -> float:
    """200 * common subsequence / both lengths; 100 for two empty texts."""
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    """The ratio of the texts with their tokens in order."""
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the common tokens and these with either side's own; 100 if one side has no own, 0 if one has no token."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    common = " ".join(sorted(left & right))
    if common and (left <= right or right <= left):
        return 100.0
    own = [" ".join(filter(None, [common, " ".join(sorted(x))])) for x in (left - right, right - left)]
    scores = [ratio(*own)]
    if common:
        scores += [ratio(common, x) for x in own]
    return max(scores)


def _udf(score):
    """A Pandas UDF, null if either side is null; equal pairs of a batch are scored once."""

    @pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a, b, strict=True):
            if pair[0] is None or pair[1] is None:
                out.append(None)
                continue
            if pair not in known:
                known[pair] = score(*pair)
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return run


fuzzy_ratio = _udf(ratio)
fuzzy_token_sort_ratio = _udf(token_sort_ratio)
fuzzy_token_set_ratio = _udf(token_set_ratio)


def token_set(text: Column) -> Column:
    """t (the different tokens of a normal form, with single spaces) and w (their length with single spaces between); null if the text is."""
    tokens = F.array_distinct(F.array_remove(F.split(text, " "), ""))
    return F.when(text.isNotNull(), F.struct(tokens.alias("t"), F.length(F.array_join(tokens, " ")).cast("double").alias("w")))


def token_set_bounds(x: Column, y: Column) -> Column:
    """least and most of the token-set ratio of two texts, by their ``token_set`` alone; null if a side is.

    Equal where the score follows from them: a side without tokens, or without tokens of its own. The common tokens are the start of
    both sides, so their ratio with either is one of lengths; of the own tokens at most the shorter side's can be common.
    """
    shared = F.array_intersect(x["t"], y["t"])
    common = F.length(F.array_join(shared, " ")).cast("double")
    least = F.when(F.size(shared) > 0, F.greatest(*[200.0 * common / (common + s["w"]) for s in (x, y)])).otherwise(0.0)
    most = F.greatest(least, 200.0 * F.least(x["w"], y["w"]) / (x["w"] + y["w"]))
    none = (F.size(x["t"]) == 0) | (F.size(y["t"]) == 0)
    inside = (F.size(shared) > 0) & ((F.size(shared) == F.size(x["t"])) | (F.size(shared) == F.size(y["t"])))
    sure = F.when(none, 0.0).when(inside, 100.0)
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(F.coalesce(sure, least).alias("least"), F.coalesce(sure, most).alias("most")))


def cosine(a: Column, b: Column, when_missing: float | None = None) -> Column:
    """Cosine in doubles; ``when_missing`` for null, empty or zero vectors and for unequal lengths."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms), F.lit(when_missing).cast("double"))


def mean_score(scores: Column) -> Column:
    """Mean of the scores that aren't null, in their order; null if there is none."""
    some = F.filter(scores, lambda x: x.isNotNull())
    return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0.0), lambda s, v: s + v) / F.size(some))
