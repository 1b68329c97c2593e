"""Costly functions on distinct values only: English test, translation, value transforms, embeddings, judgements."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.clients import Embedder, LanguageModel, PromptModel
from matchloom.functions.english import probability
from matchloom.functions.similarity import fuzzy_ratio, fuzzy_token_set_ratio, fuzzy_token_sort_ratio
from matchloom.functions.text import ASCII_TEXT, is_ascii_text, quote
from matchloom.operators.replies import kept_vectors, through_store
from matchloom.schemas import EMBEDDING_LOOKUP
from matchloom.sources.intermediate import materialize

#: P(English) from this on counts.
ENGLISH = 0.8


def english_udf(detector: Callable[[str], float] = probability):
    """A UDF: null and plain ASCII are English, and texts whose probability of English, by the detector, is above ``ENGLISH``. A detector that
    fails on a text says no."""
    plain = re.compile(ASCII_TEXT)

    @F.pandas_udf(T.BooleanType())
    def ask(values: pd.Series) -> pd.Series:
        def one(x: str | None) -> bool:
            try:
                return x is None or plain.search(x) is not None or detector(x) > ENGLISH
            except Exception:  # a detector's verdict on odd text
                return False

        return values.map(one).astype(bool)

    return ask


def is_english(column: Column, detector: Callable[[str], float] | None = probability) -> Column:
    """True for null and plain ASCII; other texts ask the detector for the probability of English, and are not English without one."""
    plain = is_ascii_text(column)
    return plain if detector is None else F.when(plain, F.lit(True)).otherwise(english_udf(detector)(F.when(~plain, column)))


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Registers the scalar functions for SQL and for calls by name, and returns their names."""
    found = {"is_english": english_udf(), "fuzzy_ratio": fuzzy_ratio, "token_sort_ratio": fuzzy_token_sort_ratio, "token_set_ratio": fuzzy_token_set_ratio}
    for name, f in found.items():
        spark.udf.register(prefix + name, f)
    return [prefix + name for name in found]


def call_by_name(name: str, *columns: str) -> Column:
    """A registered or built-in function by its name."""
    return F.call_function(name, *[F.col(quote(c)) for c in columns])


def on_distinct(df: DataFrame, column: str, apply: Callable[[DataFrame], DataFrame], wanted: Column | None = None) -> DataFrame:
    """``apply`` gets the distinct non-null values (as ``value``) and adds ``result``; the rows get it by a left join on the value.

    A null stays unmatched, and so do values outside ``wanted``. Spark broadcasts the dictionary if its size allows.
    """
    values = df.select(F.col(quote(column)).cast("string").alias("value")).where(F.col("value").isNotNull())
    found = apply((values.where(wanted) if wanted is not None else values).distinct()).select(F.col("value").alias("_value"), "result")
    return df.join(found, F.col(quote(column)).cast("string") == F.col("_value"), "left").drop("_value")


def _batched(values: DataFrame, kind: str, call: Callable[[list[str]], list]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(result=call(batch["value"].tolist()))

    return values.mapInPandas(run, f"value string, result {kind}")


def translate_column(df: DataFrame, column: str, client: LanguageModel, detector: Callable[[str], float] | None = probability) -> DataFrame:
    """Replaces the values that aren't English by their translation; each different one is translated once, and once for all runs by a client with a store."""

    def translated(values: DataFrame) -> DataFrame:
        if not isinstance(client, PromptModel) or not client.store:
            return _batched(values, "string", client.translate)
        own = lambda rows: [r["value"] for r in rows]
        return through_store(values, client, lambda rows: client.translate_prompts(own(rows)), lambda rows, replies: [(x,) for x in client.translate_answers(own(rows), replies)], ["result"])

    out = on_distinct(df, column, translated, ~is_english(F.col("value"), detector))
    return out.withColumn(column, F.coalesce("result", F.col(quote(column)).cast("string"))).drop("result")


def embed_values(values: DataFrame, embedder: Embedder) -> DataFrame:
    """value and result (its vector; null for empty texts)."""
    return _batched(values, "array<float>", embedder.embed)


def embedding_lookup(values: DataFrame, embedder: Embedder, store: str | None = None) -> DataFrame:
    """norm and emb of each different non-null ``value``, written once: whatever reads the vectors later, a value is embedded once.

    With a ``store``, a folder of vectors by model and text that runs share, only values that no run has embedded yet are embedded.
    """
    if store:
        kept = kept_vectors(values, embedder, store, embed_values)
        return materialize(kept.select(F.col("value").alias("norm"), F.col("vector").alias("emb")), "embeddings")
    different = values.where(F.col("value").isNotNull()).select("value").distinct()
    found = embed_values(different, embedder).select(F.col("value").alias("norm"), F.col("result").cast("array<float>").alias("emb"))
    return materialize(found.select(*[f.name for f in EMBEDDING_LOOKUP.fields]), "embeddings")


#: Transforms by name: expressions only, so that nothing a model says is ever run as code. Ties go to the first.
TRANSFORMS: Mapping[str, Callable[[Column], Column]] = {
    "identity": lambda c: c,
    "lower": lambda c: F.lower(F.trim(c)),
    "no_punctuation": lambda c: F.trim(F.regexp_replace(c, r"[^\w\s]", "")),
    "no_company_suffix": lambda c: F.trim(F.regexp_replace(c, r"(?i)[\s,]+(inc|llc|ltd|corp|co|gmbh|sa|plc)\.?\s*$", "")),
    "digits": lambda c: F.regexp_replace(c, r"\D", ""),
    "zero_padded_9": lambda c: F.lpad(F.regexp_replace(c, r"\D", ""), 9, "0"),
    "domain": lambda c: F.lower(F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:www\.)?([^/:?#\s]+)", 1)),
}


def transform_hits(top: DataFrame, pairs: Sequence[tuple[str, str]]) -> dict[tuple[str, str], dict[str, int]]:
    """For each pair of an enrichment and a master column, how many of the one's frequent values each transform turns into the other's.

    ``top`` has dataset (e or m), column_name and value, a few for each column. The transforms are the very expressions that change the
    columns later, so what is counted is what will happen. One job for all pairs.
    """
    spark = top.sparkSession
    wanted = spark.createDataFrame(list(dict.fromkeys(pairs)), "e_column string, m_column string")
    e = top.where("dataset = 'e'").select(F.col("column_name").alias("e_column"), F.explode(F.create_map(*[x for name, f in TRANSFORMS.items() for x in (F.lit(name), f(F.col("value")))])).alias("transform", "value"))
    m = top.where("dataset = 'm'").select(F.col("column_name").alias("m_column"), "value").distinct()
    met = wanted.join(e, "e_column").join(m, ["m_column", "value"]).groupBy("e_column", "m_column", "transform").agg(F.count(F.lit(1)).alias("n"))
    out = {pair: dict.fromkeys(TRANSFORMS, 0) for pair in pairs}
    for r in met.collect():  # at most one for each mapped pair and transform
        out[r.e_column, r.m_column][r["transform"]] = r.n
    return out


def transform_column(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds ``<column>__TRANSFORMED``; null stays null."""
    return df.withColumn(f"{column}__TRANSFORMED", F.when(F.col(quote(column)).isNotNull(), TRANSFORMS[name](F.col(quote(column)).cast("string"))))


def describe_columns(metadata: DataFrame, client: LanguageModel) -> DataFrame:
    """Adds a description to each column of the metadata; one call for each dataset, with all its columns."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        rows = batch.to_dict("records")
        for r in rows:
            r["example_values"] = list(r["example_values"]) if r["example_values"] is not None else []
        return batch.assign(description=client.describe(rows))

    return metadata.groupBy("dataset").applyInPandas(run, T.StructType([*metadata.schema.fields, T.StructField("description", T.StringType())]))


def judge_column_pairs(features: DataFrame, client: LanguageModel) -> DataFrame:
    """Adds decision (Yes or No) and justification to each pair; a client with a store is asked nothing twice."""
    if isinstance(client, PromptModel) and client.store:
        return through_store(features, client, client.column_prompts, client.column_answers, ["decision", "justification"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                answers = client.judge_columns(batch.to_dict("records"))
                yield batch.assign(decision=[a for a, _ in answers], justification=[b for _, b in answers])

    more = [T.StructField(c, T.StringType()) for c in ("decision", "justification")]
    return features.mapInPandas(run, T.StructType([*features.schema.fields, *more]))
