"""Quality rules: text statistics, fixed limits, and robust multivariate outliers by minimum covariance determinant.

Native: DataFrame functions only. Statistics are fixed-point integers, so sums and quantiles don't depend on the order of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import SPACE_CLASS, SPACES, materialize, scratch

SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = ("q_len", "q_word", "q_sym", "q_line", "q_rep")
#: Fixed point of the transformed statistics.
SCALE = 1000
#: Least standard deviation of each, given those before it, so that statistics that hardly vary reject nothing by a trifle: about what
#: one symbol, one repeated line or one repeated window adds in a text of a hundred words and ten lines, and the noise of its word length.
FLOORS = (0.1, 0.05, 0.2, 0.1, 0.1)
#: Medians of the chi-square distributions with 1, 2, … degrees of freedom.
CHI2_MEDIANS = (0.4549, 1.3863, 2.366, 3.3567, 4.3515)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and base_failed to the rows.

    Words are runs of other than space and \\t..\\r. Null and empty texts have no words and fail. A window of five words counts as
    repeated when its 64-bit hash comes twice in the text. All in one row: nothing is shuffled, whatever the text's length.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.filter(F.split(body, SPACE_CLASS + "+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    out = docs.withColumns(
        {
            "_words": words,
            "_lines": lines,
            "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words", "_lines")
    windows = F.transform(F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + (k - 1)) for k in range(WINDOW)]))
    out = out.withColumn("_windows", F.when(F.size("_hashes") > WINDOW, windows).otherwise(F.array().cast("array<bigint>"))).drop("_hashes")
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn("_placed", F.when(again, F.array_sort(placed)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("_windows")
    at = F.col("_placed")
    twice = F.filter(at, lambda x, j: (F.get(at, j - 1)["h"] == x["h"]) | F.coalesce(F.get(at, j + 1)["h"] == x["h"], F.lit(False)))
    out = out.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_placed")
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate("_at", start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])
    out = out.withColumn("n_repeat_words", covered.cast("long")).drop("_at")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))


def _features(stats: DataFrame) -> DataFrame:
    """Logarithms and shares, in fixed point. Only for rows with words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = (
        F.log1p("n_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.log1p(F.lit(20.0) * F.col("n_symbols") / n),
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / n,
    )
    return stats.withColumns({name: F.round(v * SCALE).cast("long") for name, v in zip(FEATURES, values, strict=True)})


def _same(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Left join on keys that may be null. The right side has one row for each key; Spark broadcasts it if its size allows."""
    right = b.withColumnsRenamed({k: f"_{k}" for k in keys})
    return a.join(right, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left").drop(*[f"_{k}" for k in keys])


def _moments(rows: DataFrame, keys: tuple[str, ...], shrink: float) -> tuple[DataFrame, int]:
    """Mean and Cholesky factor of each group, drawn towards those of all groups by ``shrink`` rows' weight; and a digest of them, to the last
    place of the statistics' fixed point."""
    p = range(len(FEATURES))
    sums = [F.sum(F.col(f).cast("decimal(20,0)")).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    sums += [F.sum((F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("decimal(28,0)")).alias(f"s{i}{j}") for i in p for j in p if j <= i]
    names = ["n", *[f"s{i}" for i in p], *[f"s{i}{j}" for i in p for j in p if j <= i]]
    group = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums), "quality-sums")
    # of all groups, one row; the table of sums has one row for each group
    every = group.agg(*[F.sum(x).alias(f"all_{x}") for x in names])
    both = group.crossJoin(F.broadcast(every))
    weight = shrink / F.col("all_n").cast("double")
    both = both.select(*keys, *[((F.col(x).cast("double") + F.col(f"all_{x}").cast("double") * weight) / (F.col("n") + shrink)).alias(x) for x in names if x != "n"])
    both = both.select(*keys, *[(F.col(f"s{i}") / SCALE).alias(f"m{i}") for i in p], *[((F.col(f"s{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}")) / SCALE**2).alias(f"c{i}{j}") for i in p for j in p if j <= i])
    for j in p:  # Cholesky, column by column
        diagonal = F.sqrt(F.greatest(F.col(f"c{j}{j}") - sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0)), F.lit(FLOORS[j] ** 2)))
        both = both.withColumn(f"l{j}{j}", diagonal)
        both = both.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}") for i in p if i > j} or {"_": F.lit(0)}).drop("_")
    moments = materialize(both.drop(*[f"c{i}{j}" for i in p for j in p if j <= i]), "quality-moments", outlive=True)
    numbers = [F.round(F.col(c) * SCALE).cast("long") for c in moments.columns if c not in keys]
    return moments, moments.agg(F.bit_xor(F.xxhash64(*keys, *numbers))).first()[0]


def _distance(rows: DataFrame, moments: DataFrame, keys: tuple[str, ...], name: str) -> DataFrame:
    """Squared Mahalanobis distance, by forward substitution."""
    p = range(len(FEATURES))
    out = _same(rows, moments, keys)
    for i in p:
        out = out.withColumn(f"y{i}", (F.col(FEATURES[i]) / SCALE - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l{i}{i}"))
    out = out.withColumn(name, sum((F.col(f"y{i}") ** 2 for i in p), F.lit(0.0)))
    return out.drop(*[f"y{i}" for i in p], *[f"m{i}" for i in p], *[f"l{i}{j}" for i in p for j in p if j <= i])


def _bin(distance: Column) -> Column:
    """A distance as one of a few ten thousand numbers, in the same order: its quantile is then exact in bounded memory."""
    return F.round(F.log1p(distance) * 1000).cast("int")


def quality(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("lang", "source"), part: float = 0.75, steps: int = 12, shrink: float = 50.0, cutoff: float = 25.74, with_text: bool = True) -> DataFrame:
    """Adds the text statistics, ``base_failed``, ``distance`` (squared, robust) and ``kept`` to the rows.

    A row is rejected if it fails the fixed limits, or if its transformed statistics lie further than ``cutoff`` (the 0.9999 quantile of chi-square) from its group's
    robust centre. The centre and spread of each group are of the ``part`` of its rows with the smallest distances, found by concentration
    steps from medians and quartiles (minimum covariance determinant) until a step changes no mean or factor of any group by a thousandth,
    ``steps`` at most; they are drawn towards those of all rows with the weight of ``shrink`` rows, so that small groups act like large ones, and no standard deviation
    is below its ``FLOORS``. Distances are scaled by their median over all rows. Rows that fail the fixed limits take no part in the fit.
    Null keys form a group of their own; null and empty texts fail; texts of any length are taken whole, in one row; repeated rows count as
    often as they come; an empty table gives an empty result. Columns of ``docs`` named like an added one are replaced. Without
    ``with_text`` the text is left out.
    """
    added = ["n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept", *FEATURES]
    stats = _features(text_statistics(docs.drop(*added), text))
    stats = materialize(stats if with_text else stats.drop(text), "quality-stats")
    rows = stats.where(~F.col("base_failed")).select(*keys, *FEATURES)
    quart = rows.groupBy(*keys).agg(*[F.expr(f"percentile({f}, array(0.25d, 0.5d, 0.75d))").alias(f"p_{f}") for f in FEATURES])
    first = _same(rows, materialize(quart, "quality-quartiles"), keys)
    scaled = [((F.col(f) - F.col(f"p_{f}")[1]) / F.greatest((F.col(f"p_{f}")[2] - F.col(f"p_{f}")[0]) / 1.349, F.lit(low * SCALE))) ** 2 for f, low in zip(FEATURES, FLOORS, strict=True)]
    ranked = first.withColumn("d", sum(scaled, F.lit(0.0))).select(*keys, *FEATURES, "d")
    last = None
    for _ in range(steps):
        ranked = ranked.withColumn("d", _bin(F.col("d")))
        with scratch():
            limit = materialize(ranked.groupBy(*keys).agg(F.expr(f"percentile(d, {part}d)").alias("limit")), "quality-limits")
            inner = _same(ranked, limit, keys).where(F.col("d") <= F.col("limit"))
            moments, now = _moments(inner, keys, shrink)
        ranked = _distance(rows, moments, keys, "d")
        if now == last:
            break
        last = now
    # the core's spread understates that of all rows: scale it so that the median distance is as of a normal distribution in the
    # statistics that most rows vary in; the others add nothing to a typical distance. Below 1 it would undo the least deviations
    varying = first.agg(sum((F.coalesce(F.avg((F.col(f) != F.col(f"p_{f}")[1]).cast("double")) > 0.5, F.lit(False)).cast("int") for f in FEATURES), F.lit(0)).alias("_varying"))
    typical = ranked.groupBy(_bin(F.col("d")).alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.expr("percentile(d, 0.5d, n)").alias("_typical"))
    scale = materialize(varying.crossJoin(typical), "quality-scale")
    median = F.get(F.array(*[F.lit(x) for x in CHI2_MEDIANS]), F.greatest(F.col("_varying"), F.lit(1)) - 1)
    factor = F.greatest(F.expm1(F.col("_typical") / 1000) / median, F.lit(1.0))
    out = _distance(stats, moments, keys, "distance").crossJoin(F.broadcast(scale))
    out = out.withColumn("distance", F.when(~F.col("base_failed"), F.col("distance") / factor)).drop("_typical", "_varying", *FEATURES)
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))


def op9_robust_outliers(spark, sf_dir: str) -> DataFrame:
    """The query: statistics and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    found = quality(docs, with_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 3).alias("distance"))
