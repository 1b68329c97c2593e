"""Tables between steps: written into the folder that driver and executors share, read back, and deleted when nothing needs them."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Spark deletes the shuffle files of a finished query only where this is set; a written table needs them no more.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Temporary folders by application, where none is set.
_own: dict[str, str] = {}
#: Paths written in the scopes that are open, the innermost last.
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a temporary one, but only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _own.setdefault(spark.sparkContext.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="matchloom-")
        _own[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str, outlive: bool = False) -> str:
    """A path of its own in the shared folder; a ``scratch`` deletes it at its end, or the scope around that one if it is to ``outlive`` it."""
    path = f"{shared_folder(spark)}/matchloom/{name}-{uuid.uuid4().hex}"
    scopes = _scopes[:-1] if outlive else _scopes
    if scopes:
        scopes[-1].append(path)
    return path


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextlib.contextmanager
def _clean_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def materialize(df: DataFrame, name: str, codec: str = "zstd", narrow: bool = False, outlive: bool = False) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back: lineage ends there, and a lost executor costs nothing.

    The shuffle files of the write are deleted when it is done. A ``narrow`` table, of a few numbers a row and fresh from a shuffle, is
    written by an eighth of the usual tasks.
    """
    spark = df.sparkSession
    path = new_path(spark, name, outlive)
    df = df.coalesce(max(8, partitions(spark) // 8)) if narrow else df
    with _clean_shuffles(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_by(df: DataFrame, key: str, name: str, outlive: bool = False) -> str:
    """Writes ``df`` with a folder for each value of ``key``, a number, and returns the path: a task reads what concerns its own rows by ``own_rows``,
    so that these, where they are large, needn't be shuffled to meet it."""
    path = new_path(df.sparkSession, name, outlive)
    with _clean_shuffles(df.sparkSession):
        df.repartition(key).write.partitionBy(key).option("compression", "zstd").parquet(path)
    return path


def own_rows(path: str, key: str, value: int) -> pa.Table | None:
    """In a task: the rows of a value, of what ``write_by`` wrote; none if it has none."""
    store, root = fs.FileSystem.from_uri(path)
    found = store.get_file_info(fs.FileSelector(f"{root}/{key}={value}", allow_not_found=True))
    tables = [pq.ParquetFile(x.path, filesystem=store).read(use_threads=False) for x in sorted(found, key=lambda x: x.path) if x.path.endswith(".parquet")]
    return pa.concat_tables(tables) if tables else None


def delete(path: str) -> None:
    """Deletes a written table or folder; what isn't there, or lies in a store that pyarrow doesn't reach, stays as it is."""
    with contextlib.suppress(OSError, ValueError, NotImplementedError):
        store, root = fs.FileSystem.from_uri(path)
        store.delete_dir(root)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Everything that is written by ``materialize`` within is deleted at the end: read or write the result before that."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(path)
