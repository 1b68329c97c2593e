"""Named datasets, files, tables and views."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.text import quote, safe_name
from matchloom.sources.intermediate import materialize, scratch

Datasets = Mapping[str, DataFrame]


def load_datasets(spark: SparkSession, sources: Mapping[str, str], master: str = "Master", cache: bool = False) -> dict[str, DataFrame]:
    """Datasets by name from Parquet paths or table names; the master must be among them."""
    if master not in sources:
        raise ValueError(f"there is no dataset named {master!r}")
    out = {name: spark.read.parquet(at) if "/" in at else spark.table(at) for name, at in sources.items()}
    return {name: df.persist() for name, df in out.items()} if cache else out


def release_datasets(datasets: Datasets) -> None:
    """Lets go of what ``load_datasets`` cached."""
    for df in datasets.values():
        df.unpersist()


def staging_views(datasets: Datasets, prefix: str = "raw_") -> list[str]:
    """A temporary view over each dataset; their names are made safe for SQL."""
    names = [prefix + safe_name(name).lower() for name in datasets]
    for view, df in zip(names, datasets.values(), strict=True):
        df.createOrReplaceTempView(view)
    return names


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, strict: bool = False) -> DataFrame:
    """A CSV file with a header, commas, optional double quotes and trimmed values. Without a schema, types are inferred in a pass of its own.

    Rows of another number of columns are filled with nulls or cut, unless ``strict``: then the first bad row is an error.
    """
    reader = spark.read.options(header=True, sep=",", quote='"', escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="FAILFAST" if strict else "PERMISSIVE")
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def load_into(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name, whatever their case, cast; those that ``df`` lacks are null. A value that can't be cast is an error."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(quote(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _beside(table: str, what: str) -> str:
    return f"{table[:-1]}__{what}`" if table.endswith("`") else f"{table}__{what}"


def _switch(spark: SparkSession, table: str, new: str) -> None:
    """Puts a whole table in the place of another: renames, each of which leaves a state that ``_restore`` mends."""
    last = _beside(table, "last")
    spark.sql(f"DROP TABLE IF EXISTS {last}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {last}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE {last}")


def _restore(spark: SparkSession, table: str) -> None:
    """After a switch that stopped half-way: the table as it was before."""
    last = _beside(table, "last")
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(last):
        spark.sql(f"ALTER TABLE {last} RENAME TO {table}")


def save(df: DataFrame, table: str, mode: str = "overwrite", counts: dict[str, int] | None = None) -> DataFrame:
    """Writes a table and returns it as read back: lineage ends there. ``counts`` gets the rows written by table name, observed as they are written: no second pass.

    A table that is there is overwritten by one written beside it, ``<table>__next``, which then takes its name: a write that fails leaves it
    as it was, and ``df`` may read it.
    """
    spark, seen = df.sparkSession, Observation()
    _restore(spark, table)
    there = mode == "overwrite" and spark.catalog.tableExists(table)
    target = _beside(table, "next") if there else table
    (df if counts is None else df.observe(seen, F.count(F.lit(1)).alias("n"))).write.mode(mode).saveAsTable(target)
    if there:
        _switch(spark, table, target)
    if counts is not None:
        counts[table] = seen.get["n"]
    return spark.table(table)


#: What a table's loads are written down in, and its rejected rows.
LOADS = "file string, bytes long, modified timestamp, loaded_at timestamp, rows long, rejected long"
REJECTED = "file string, line long, record string, loaded_at timestamp"
_BAD, _FILE = "_bad_record", "_from_file"


def _same_file(path: Column) -> Column:
    """A file's path without the slashes by which readers write it differently."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def load_files(spark: SparkSession, path: str, schema: T.StructType, table: str) -> dict[str, int]:
    """Appends the CSV files of ``path`` (a file, folder or pattern) to a table, each file once, and returns files, rows and rejected of this load.

    Columns are found by name in each file's header, whatever their order and case; those that a file lacks are null, others are left out.
    ``<table>__loads`` has a row for each loaded file: one of the same path, size and time isn't loaded again, a changed one is, and adds
    its rows. Records of another number of values than the header, or with a value that its type doesn't take, go to ``<table>__rejected`` with
    their file and line. A record is one line. The loads are written last: a run that fails before leaves a file to be loaded again.
    """
    loads, rejected = f"{table}__loads", f"{table}__rejected"
    for name, kind in ((table, schema), (loads, LOADS), (rejected, REJECTED)):
        ensure_table(spark, name, kind)
    files = spark.read.format("binaryFile").load(path).select(_same_file(F.col("path")).alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    new = files.join(spark.table(loads), ["file", "bytes", "modified"], "left_anti").collect()  # names of files, as a reader lists them
    if not new:
        return {"files": 0, "rows": 0, "rejected": 0}
    lines = spark.read.text([f.file for f in new]).select(_same_file(F.col("_metadata.file_path")).alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    by_header: dict[str, list[str]] = {}
    for r in lines.groupBy("file").agg(F.min_by("value", "at").alias("header")).collect():
        by_header.setdefault(r.header, []).append(r.file)
    now, kinds = F.current_timestamp(), {f.name.lower(): f.dataType for f in schema.fields}
    total = {"files": len(new), "rows": 0, "rejected": 0}
    with scratch():
        done = []
        for header, group in by_header.items():
            names = [x.strip() for x in next(csv.reader([header]))]
            typed = T.StructType([T.StructField(x, kinds.get(x.lower(), T.StringType())) for x in names] + [T.StructField(_BAD, T.StringType())])
            reader = spark.read.schema(typed).options(header=True, sep=",", quote='"', escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD)
            rows = materialize(reader.csv(group).withColumn(_FILE, _same_file(F.col("_metadata.file_path"))), "loaded-rows")
            done.append((rows, rows.where(F.col(_BAD).isNull()), rows.where(F.col(_BAD).isNotNull()).select(F.col(_FILE).alias("file"), F.col(_BAD).alias("record"))))
        bad = materialize(reduce(DataFrame.unionByName, [b for _, _, b in done]), "rejected-rows")
        tally = [r.groupBy(_FILE).agg(F.count_if(F.col(_BAD).isNull()).alias("rows"), F.count_if(F.col(_BAD).isNotNull()).alias("rejected")) for r, _, _ in done]
        counted = materialize(reduce(DataFrame.unionByName, tally), "load-counts")
        for _, good, _ in done:
            load_into(good.drop(_BAD, _FILE), schema).write.mode("append").saveAsTable(table)
        # lines are numbered in the files that have rejected records, and in no others
        numbered = lines.join(bad.select("file").distinct(), "file", "left_semi").withColumn("line", F.row_number().over(W.partitionBy("file").orderBy("at")).cast("long"))
        where = bad.distinct().join(numbered.where("line > 1").withColumnRenamed("value", "record"), ["file", "record"])
        where.select("file", "line", "record", now.alias("loaded_at")).write.mode("append").saveAsTable(rejected)
        names = spark.createDataFrame([(f.file, f.bytes, f.modified) for f in new], "file string, bytes long, modified timestamp")
        entry = names.join(counted.withColumnRenamed(_FILE, "file"), "file", "left").select("file", "bytes", "modified", now.alias("loaded_at"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("rejected", F.lit(0)).cast("long").alias("rejected"))
        entry = materialize(entry, "load-entries")
        found = entry.agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected")).first()
        total |= {"rows": found["rows"], "rejected": found.rejected}
        entry.write.mode("append").saveAsTable(loads)
    return total


def clone_table(spark: SparkSession, source: str, target: str, rows: bool = True) -> DataFrame:
    """A new table with the schema of another, and its rows."""
    df = spark.table(source)
    return save(df if rows else df.limit(0), target)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def from_local(spark: SparkSession, rows, schema: T.StructType, table: str | None = None) -> DataFrame:
    """A small local frame (pandas or rows) as a DataFrame of ``schema``, by column name where it has names; saved if a table is named."""
    df = load_into(spark.createDataFrame(rows), schema) if hasattr(rows, "columns") else spark.createDataFrame(rows, schema)
    return save(df, table) if table else df


def session(name: str, databases: Sequence[str] = (), **settings: str) -> SparkSession:
    """A session with what the operators count on (adaptive execution with skew joins, UTC), given settings besides, and the databases made."""
    builder = SparkSession.builder.appName(name)
    fixed = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for key, value in (fixed | settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for database in databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)}")
    return spark


def ensure_table(spark: SparkSession, table: str, schema: T.StructType | str) -> None:
    if not spark.catalog.tableExists(table):
        empty(spark, schema).write.saveAsTable(table)


def drop_tables(spark: SparkSession, database: str) -> list[str]:
    """Drops all tables of a database and returns their names."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    for name in names:
        spark.sql(f"DROP TABLE {quote(database)}.{quote(name)}")
    return names


def reset_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {quote(database)} CASCADE")
    spark.sql(f"CREATE DATABASE {quote(database)}")


def namespace(custom: str | None, default: str) -> str:
    """The database of a model: its own if it names one."""
    return custom.strip() if custom and custom.strip() else default


def with_decision(df: DataFrame, decision: str = "Yes", column: str = "final_llm_decision") -> DataFrame:
    return df.where(F.col(column) == decision)
