"""What models have said, kept: each prompt is asked once, whatever fails and however often a run begins."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.clients import Embedder, PromptModel
from matchloom.sources.intermediate import delete, materialize

#: A store is a folder of Parquet files of these rows; ``key`` is the digest of the settings and the prompt.
REPLIES = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "prompt", "reply")])
#: A store of vectors: ``model`` names the embedder and its settings.
VECTORS = "model string, value string, vector array<float>"
#: Prompts whose replies are appended together, for each thread that asks.
EACH = 4


def reply_key(prompt: Column, model: PromptModel) -> Column:
    """The digest of a prompt and everything that the model is asked with."""
    return F.sha2(F.concat_ws("\n", F.lit(json.dumps(asdict(model.settings), sort_keys=True)), prompt), 256)


def read_store(spark: SparkSession, store: str, schema: T.StructType | str = REPLIES) -> DataFrame:
    """What a store holds; nothing where there is none yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(store) if there else spark.createDataFrame([], schema)


def _append(store: str, name: str, rows: list[tuple[str, str, str]]) -> None:
    """One file, whole or not at all: readers pass over names that begin with a dot, and a rename ends the write."""
    files, root = fs.FileSystem.from_uri(store)
    files.create_dir(root)
    hidden, final = f"{root}/.{name}", f"{root}/{name}"
    with files.open_output_stream(hidden) as out:
        pq.write_table(pa.table({c: [r[i] for r in rows] for i, c in enumerate(("key", "prompt", "reply"))}), out)
    files.move(hidden, final)


def _appended(store: str, prefix: str) -> dict[str, str]:
    """The replies of the files of one part of a run."""
    files, root = fs.FileSystem.from_uri(store)
    found = [f.path for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.base_name.startswith(prefix)]
    out: dict[str, str] = {}
    for path in found:
        with files.open_input_file(path) as f:
            table = pq.read_table(f)
        out |= dict(zip(table.column("key").to_pylist(), table.column("reply").to_pylist(), strict=True))
    return out


def ask_all(prompts: DataFrame, model: PromptModel) -> DataFrame:
    """key and reply of each different ``prompt``, from the model's store; what it lacks is asked and appended first.

    Prompts that the store holds are left out by an anti-join. The others are dealt to as many tasks as calls may be in flight, ``threads``
    calls each; a task appends its replies every few calls, those of a failing batch too. A task that is tried again reads what its
    earlier tries appended, and a run that begins again finds the replies of the one that ended, so a prompt is asked again only if its
    call failed, or was in flight when its task was stopped. Nulls aren't asked. The store is a folder that all executors reach.
    """
    spark, store = prompts.sparkSession, model.store
    keyed = materialize(prompts.where("prompt IS NOT NULL").select("prompt").distinct().select(reply_key(F.col("prompt"), model).alias("key"), "prompt"), "prompts")
    known = read_store(spark, store).select("key")
    missing = keyed.join(known, "key", "left_anti").repartition(max(1, model.in_flight // model.threads), "key").sortWithinPartitions("key")
    run = uuid.uuid4().hex

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = f"replies-{run}-{TaskContext.get().partitionId():06d}-"
        before = None

        def one(prompt: str) -> tuple[str | None, Exception | None]:
            try:
                return model.ask(prompt), None
            except Exception as e:  # kept until the others of its batch are appended
                return None, e

        with ThreadPoolExecutor(model.threads) as pool:
            for batch in batches:
                before = _appended(store, part) if before is None else before
                rows = [(k, p) for k, p in zip(*(c.to_pylist() for c in batch.columns), strict=True) if k not in before]
                for at in range(0, len(rows), EACH * model.threads):
                    some = rows[at : at + EACH * model.threads]
                    replies = list(pool.map(one, [p for _, p in some]))
                    good = [(k, p, r) for (k, p), (r, e) in zip(some, replies, strict=True) if e is None]
                    if good:
                        _append(store, f"{part}{uuid.uuid4().hex}.parquet", good)
                    for _, e in replies:
                        if e is not None:
                            raise e
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], names=["key"])

    missing.mapInArrow(ask, "key string").write.format("noop").mode("overwrite").save()
    # two lost tries may both have appended a reply: one of them stays
    return keyed.select("key").join(read_store(spark, store).groupBy("key").agg(F.min("reply").alias("reply")), "key")


def through_store(df: DataFrame, model: PromptModel, prompts: Callable[[list[dict]], list[str]], answers: Callable[[list[dict], list[str]], list[tuple]], names: Sequence[str]) -> DataFrame:
    """Adds the columns ``names`` (texts), read from the reply to each row's prompt."""
    own = df.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(_prompt=prompts(batch.to_dict("records")))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = answers(batch[own].to_dict("records"), batch["_reply"].tolist())
            yield batch[own].assign(**{c: [f[i] for f in found] for i, c in enumerate(names)})

    asked = materialize(df.mapInPandas(write, T.StructType([*df.schema.fields, T.StructField("_prompt", T.StringType())])), "asked")
    replies = ask_all(asked.select(F.col("_prompt").alias("prompt")), model).select(F.col("key").alias("_key"), F.col("reply").alias("_reply"))
    met = asked.withColumn("_key", reply_key(F.col("_prompt"), model)).join(replies, "_key").select(*[F.col(f"`{c}`") for c in own], "_reply")
    return met.mapInPandas(read, T.StructType([*df.schema.fields, *[T.StructField(c, T.StringType()) for c in names]]))


def compact(spark: SparkSession, store: str, files: int = 16) -> int:
    """Rewrites a store of many small files as a few, while nobody asks, and returns its replies. A file is deleted when what it held is written."""
    before = [f.path for f in _listed(store)]
    kept = materialize(read_store(spark, store).groupBy("key").agg(F.min_by("prompt", "reply").alias("prompt"), F.min("reply").alias("reply")), "compacted")
    n = kept.count()
    kept.coalesce(files).write.mode("append").parquet(store)
    where = fs.FileSystem.from_uri(store)[0]
    for path in before:
        where.delete_file(path)
    return n


def _listed(store: str) -> list[fs.FileInfo]:
    where, root = fs.FileSystem.from_uri(store)
    return [f for f in where.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]


def kept_vectors(values: DataFrame, embedder: Embedder, store: str, embed: Callable[[DataFrame, Embedder], DataFrame]) -> DataFrame:
    """value and vector of each different non-null ``value``: from the store of earlier runs, which gets the vectors that it lacks by one append.

    Vectors are kept by embedder (its class and settings) and text, so that a change of model finds none of the other's. A run that fails
    before its append leaves the store as it was.
    """
    spark, name = values.sparkSession, repr(embedder)
    different = materialize(values.where("value IS NOT NULL").select("value").distinct(), "different-values")
    known = read_store(spark, store, VECTORS).where(F.col("model") == name)
    missing = different.join(known.select("value"), "value", "left_anti")
    found = materialize(embed(missing, embedder).select(F.lit(name).alias("model"), "value", F.col("result").cast("array<float>").alias("vector")), "new-vectors")
    if not found.isEmpty():
        found.write.mode("append").parquet(store)
    own = read_store(spark, store, VECTORS).where(F.col("model") == name).groupBy("value").agg(F.first("vector").alias("vector"))
    return different.join(own, "value")


def forget(store: str) -> None:
    """Deletes a store."""
    delete(store)
