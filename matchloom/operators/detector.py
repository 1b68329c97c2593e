"""A detector of languages fitted on labelled rows: counts of letters in threes, kept as a small table."""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Labelled rows that the counts are taken from at most, in the mean: half of all rows where that is fewer.
SAMPLE = 20_000
#: Threes kept for each label, the most frequent, and labels kept, those of most letters: the table's bound.
THREES, LABELS = 5_000, 200
#: What a three that a label never had counts as, and how many of a text's threes count as independent of each other.
_SMOOTH, _INDEPENDENT = 0.1, 0.6
_WORDS = re.compile(r"[^\W\d_]+")


def drawn(key: Column, share: Column | float) -> Column:
    """True for about that share of keys, the same ones at any time."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") < F.floor(F.lit(share) * F.lit(float(1 << 32)))


def sample_share(df: DataFrame, label: str, rows: int = SAMPLE) -> float:
    """The share of labelled rows to fit on: ``rows`` of them, half at most."""
    return min(0.5, rows / max(1, df.where(F.col(label).isNotNull()).count()))


def fit_languages(df: DataFrame, text: str, label: str, key: str, share: float) -> DataFrame:
    """label, three and n: how often each three of letters is in the lower-case words of the drawn rows of a label, a space on both sides of a word.

    Words are counted before they are taken apart. Rows without a text or label take no part; texts are taken whole.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(text).isNotNull() & drawn(F.col(key), share)).select(F.col(label).cast("string").alias("label"), F.lower(text).alias("text"))
    words = rows.select("label", F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))).alias("word")).groupBy("label", "word").agg(F.count(F.lit(1)).alias("n"))
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    threes = F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substr(padded, i, F.lit(3)))).alias("three")
    counts = words.select("label", "n", threes).groupBy("label", "three").agg(F.sum("n").alias("n"))
    most = counts.groupBy("label").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "label").limit(LABELS).select("label")
    order = W.partitionBy("label").orderBy(F.desc("n"), "three")
    return counts.join(most, "label").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= THREES).select("label", "three", "n")


@dataclass(frozen=True)
class Languages:
    """A fitted detector. Called with a text it gives the probability of ``wanted``, as ``is_english`` asks of a detector; texts without letters: 1."""

    digest: str
    labels: tuple[str, ...] = field(repr=False)
    logs: dict[str, tuple[float, ...]] = field(repr=False, compare=False)
    other: tuple[float, ...] = field(repr=False, compare=False)
    wanted: str = "en"

    def _scores(self, text: str) -> list[float] | None:
        found = Counter(f" {w} "[i : i + 3] for w in _WORDS.findall(text.lower()) for i in range(len(w)))
        if not found:
            return None
        out = [0.0] * len(self.labels)
        for three, n in found.items():
            for k, x in enumerate(self.logs.get(three, self.other)):
                out[k] += n * x
        return out

    def best(self, text: str | None) -> str | None:
        """The likeliest label, ties by name; null without letters."""
        scores = self._scores(text) if text and self.labels else None
        return None if scores is None else self.labels[max(range(len(scores)), key=lambda k: scores[k])]

    def __call__(self, text: str) -> float:
        scores = self._scores(text)
        if scores is None:
            return 1.0
        if self.wanted not in self.labels:
            return 0.0
        most = max(scores)
        shares = [math.exp(_INDEPENDENT * (s - most)) for s in scores]
        return shares[self.labels.index(self.wanted)] / sum(shares)


def load_languages(fitted: DataFrame, wanted: str = "en") -> Languages:
    """The detector of a table that ``fit_languages`` made and ``save`` may have kept; its rows are bounded by LABELS and THREES."""
    rows = sorted((r.label, r.three, r.n) for r in fitted.collect())
    labels = tuple(sorted({r[0] for r in rows}))
    kinds, total = len({r[1] for r in rows}), Counter()
    for name, _, n in rows:
        total[name] += n
    other = tuple(math.log(_SMOOTH / (total[name] + _SMOOTH * kinds)) for name in labels)
    logs: dict[str, list[float]] = {}
    for name, three, n in rows:
        k = labels.index(name)
        logs.setdefault(three, list(other))[k] = math.log((n + _SMOOTH) / (total[name] + _SMOOTH * kinds))
    return Languages(hashlib.sha256(repr(rows).encode()).hexdigest(), labels, {t: tuple(x) for t, x in logs.items()}, other, wanted)


def language_of(column: Column, languages: Languages) -> Column:
    """The likeliest language of a text, in Arrow batches; null for null and for texts without letters."""
    shared = functools.partial(Languages.best, languages)

    @F.pandas_udf("string")
    def ask(values: pd.Series) -> pd.Series:
        return values.map(lambda x: shared(x), na_action="ignore")

    return ask(column)
