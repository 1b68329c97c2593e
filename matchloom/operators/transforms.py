"""Transforms found from examples: programs of one or more steps that turn a column's frequent values into values of the master's column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.functions.text import quote
from matchloom.operators.language import TRANSFORMS
from matchloom.sources.intermediate import materialize

#: A program: names of steps in the order in which they run; those made from the master's values carry an argument ("pad:9", "prefix:A-").
Program = Sequence[str]

_MARKS = {"space": " ", "dash": "-", "slash": "/", "at": "@", "dot": ".", "hash": "#", "comma": ",", "colon": ":", "underscore": "_"}
_PLACES = {"first": 1, "second": 2, "third": 3, "fourth": 4, "last": -1}


def _part(mark: str, place: int) -> Callable[[Column], Column]:
    return lambda c: F.trim(F.split_part(c, F.lit(mark), F.lit(place)))


#: Steps without an argument. Of programs that do the same, the one with fewer steps stays, then the one whose steps stand first here.
STEPS: Mapping[str, Callable[[Column], Column]] = {
    **{name: f for name, f in TRANSFORMS.items() if name not in ("identity", "zero_padded_9")},
    "upper": lambda c: F.upper(F.trim(c)),
    "title": lambda c: F.initcap(F.trim(c)),
    "letters": lambda c: F.regexp_replace(c, r"[^\p{L}]", ""),
    "no_leading_zeros": lambda c: F.regexp_replace(c, r"^0+(?=.)", ""),
    "single_spaces": lambda c: F.trim(F.regexp_replace(c, r"\s+", " ")),
    "no_brackets": lambda c: F.trim(F.regexp_replace(c, r"\([^()]*\)|\[[^\[\]]*\]", "")),
    **{f"{place}_by_{mark}": _part(sign, k) for mark, sign in _MARKS.items() for place, k in _PLACES.items()},
}


def _step(name: str) -> Callable[[Column], Column]:
    kind, _, argument = name.partition(":")
    if name in STEPS:
        return STEPS[name]
    if kind == "pad":
        return lambda c: F.when(F.length(c).between(1, int(argument) - 1), F.lpad(c, int(argument), "0")).otherwise(c)
    if kind == "prefix":
        return lambda c: F.when(F.length(c) > 0, F.concat(F.lit(argument), c)).otherwise(c)
    raise ValueError(f"no step {name!r}")


def run(program: Program, column: Column) -> Column:
    """The column after all steps of a program; null stays null."""
    return reduce(lambda c, name: _step(name)(c), program, column)


def label(program: Program) -> str:
    """A program's name in letters, digits and underscores."""
    return "_then_".join(x.partition(":")[0] for x in program) or "identity"


def transform_by(df: DataFrame, column: str, program: Program) -> DataFrame:
    """Adds ``<column>__TRANSFORMED``, the column after a program; null stays null."""
    return df.withColumn(f"{column}__TRANSFORMED", run(program, F.col(quote(column)).cast("string")))


def _filled(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: F.coalesce(f(x), F.lit(""))


def _programs(values: DataFrame, depth: int) -> DataFrame:
    """e_column, order (numbers of steps) and outputs of the programs of up to ``depth`` steps that differ in an output; ``values`` has e_column and inputs.

    Round by round: each program of the last round's is continued by each step; of programs with equal outputs the simplest stays, so that
    the next round continues no two of them. Outputs are arrays of as many values as ``inputs`` has.
    """
    known = values.select("e_column", F.array().cast("array<int>").alias("order"), F.col("inputs").alias("outputs"))
    for k in range(depth):
        each = F.array(*[F.struct(F.lit(i).alias("step"), F.transform("outputs", _filled(f)).alias("made")) for i, f in enumerate(STEPS.values())])
        grown = known.where(F.size("order") == k).select("e_column", "order", F.inline(each)).where(F.exists("made", lambda x: x != ""))
        every = known.unionByName(grown.select("e_column", F.concat("order", F.array("step")).alias("order"), F.col("made").alias("outputs")))
        simplest = every.groupBy("e_column", "outputs").agg(F.min(F.struct(F.size("order").alias("n"), "order")).alias("x"))
        known = materialize(simplest.select("e_column", F.col("x.order").alias("order"), "outputs"), "transform-programs")
    return known


def _endings(top: DataFrame) -> DataFrame:
    """m_column and endings: the steps that master values ask for at the end of a program, none, padding, a prefix, or both.

    The prefix is what the frequent master values all begin with, up to a mark or letter; padding is to the length of what follows it, if
    that is digits of one length in all of them.
    """
    low, high = F.col("low"), F.col("high")
    same = F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.length(low), F.length(high)), F.lit(1))), lambda i: F.substr(low, F.lit(1), i) == F.substr(high, F.lit(1), i))
    ends = top.where("dataset = 'm'").groupBy(F.col("column_name").alias("m_column")).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.collect_set("value").alias("values"))
    ends = ends.withColumn("prefix", F.regexp_replace(F.substr(low, F.lit(1), F.coalesce(F.array_max(same), F.lit(0))), r"[0-9]+$", ""))
    ends = ends.withColumn("rest", F.transform("values", lambda v: F.substr(v, F.length("prefix") + 1))).withColumn("width", F.array_max(F.transform("rest", F.length)))
    fixed = F.forall("rest", lambda r: r.rlike("^[0-9]+$") & (F.length(r) == F.col("width")))
    pad, prefix = F.concat(F.lit("pad:"), F.col("width").cast("string")), F.concat(F.lit("prefix:"), F.col("prefix"))
    has = F.length("prefix") > 0
    options = F.array(F.array().cast("array<string>"), F.when(fixed, F.array(pad)), F.when(has, F.array(prefix)), F.when(fixed & has, F.array(pad, prefix)))
    return ends.select("m_column", F.when(fixed, F.col("width")).alias("width"), "prefix", F.filter(options, lambda x: x.isNotNull()).alias("endings"))


def find_transforms(top: DataFrame, known: DataFrame, pairs: Sequence[tuple[str, str]], depth: int = 2, keep: int = 1) -> DataFrame:
    """e_column, m_column, program, n_found, n_values and rank: the ``keep`` best programs of each pair of an enrichment and a master column.

    ``top`` has dataset (e or m), column_name and value, a few frequent ones for each column, which bounds the search; ``known`` has
    column_name and value, all values of the master's columns, which programs are judged by: best is the one whose outputs are found there
    for most of the frequent values (n_found), then with most different ones (n_values), then with the fewest steps. Programs have up to
    ``depth`` steps of STEPS and one or two that the master's values ask for. Those that find nothing aren't given; neither are pairs
    of a column without values. Nulls take no part.
    """
    spark = top.sparkSession
    frequent = top.where(F.col("value").isNotNull())
    inputs = frequent.where("dataset = 'e'").groupBy(F.col("column_name").alias("e_column")).agg(F.sort_array(F.collect_set("value")).alias("inputs"))
    wanted = spark.createDataFrame(list(dict.fromkeys(pairs)), "e_column string, m_column string")
    names = F.array(*[F.lit(x) for x in STEPS])
    made = wanted.join(_programs(inputs.join(wanted, "e_column", "left_semi"), depth), "e_column").join(_endings(frequent), "m_column")
    made = made.select("e_column", "m_column", F.transform("order", lambda i: F.get(names, i)).alias("steps"), "order", "outputs", "width", "prefix", F.explode("endings").alias("ending"))
    padded, named = F.exists("ending", lambda x: x.startswith("pad:")), F.exists("ending", lambda x: x.startswith("prefix:"))

    def ended(x: Column) -> Column:
        x = F.when(padded & F.length(x).between(1, F.col("width") - 1), F.lpad(x, F.col("width"), F.lit("0"))).otherwise(x)
        return F.when(named & (x != ""), F.concat("prefix", x)).otherwise(x)

    out = made.select("e_column", "m_column", F.concat("steps", "ending").alias("program"), "order", F.explode(F.transform("outputs", ended)).alias("value")).where("value != ''")
    out = out.groupBy("e_column", "m_column", "program", "order", "value").agg(F.count(F.lit(1)).alias("n"))
    values = known.where(F.col("value").isNotNull()).select(F.col("column_name").alias("m_column"), "value").distinct()
    hits = out.join(values, ["m_column", "value"]).groupBy("e_column", "m_column", "program", "order").agg(F.sum("n").alias("n_found"), F.count(F.lit(1)).alias("n_values"))
    best = W.partitionBy("e_column", "m_column").orderBy(F.desc("n_found"), F.desc("n_values"), F.size("program"), "order", "program")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    return ranked.select("e_column", "m_column", "program", "n_found", "n_values", "rank")
