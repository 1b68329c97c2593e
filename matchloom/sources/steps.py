"""Runs that go on: each step's table is kept with a manifest entry by the fingerprint of all that it comes from."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.text import quote
from matchloom.sources.intermediate import delete, materialize


def fingerprint(df: DataFrame) -> str:
    """A digest of a frame's schema and rows, whatever their order: equal frames have equal ones, in any run. One pass, sums of two hashes a row."""
    row = F.to_json(F.struct(*[F.col(quote(c)) for c in df.columns])) if df.columns else F.lit("")
    sums = [F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return hashlib.sha256(json.dumps([df.schema.jsonValue(), *df.agg(F.count(F.lit(1)), *sums).first()]).encode()).hexdigest()


class Steps:
    """The tables of steps in a ``folder`` that driver and executors share, or, without one, tables of this run alone (``materialize``).

    A step has a key: a digest of its name and of what decides its rows (keys of earlier steps, fingerprints of frames, settings as text). A
    table is written under a name of its own first; then an entry with its name and schema is moved to ``manifest/<key>.json``. So an entry
    is there only for a whole table, a run that stops leaves all finished steps, and the next run with the same keys reads them. Two
    runs that make a step at once both write it; the later entry counts, and either is right. ``made`` and ``kept`` list the steps.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder.rstrip("/") if folder else None
        self.made: list[str] = []
        self.kept: list[str] = []

    def key(self, name: str, *parts: object) -> str:
        return hashlib.sha256(json.dumps([name, *[repr(p) for p in parts]]).encode()).hexdigest()

    def input(self, df: DataFrame) -> str:
        """What stands for a frame in keys; nothing is read where nothing is kept."""
        return fingerprint(df) if self.folder else ""

    def table(self, name: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The step's table: that of an earlier run, or ``make``'s rows, written. ``make`` isn't called where the table is there."""
        if not self.folder:
            self.made.append(name)
            return materialize(make(), name)
        if entry := self._entry(key):
            self.kept.append(name)
            return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.folder}/{entry['table']}")
        df, table = make(), f"tables/{key[:16]}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{table}")
        self._enter(key, {"step": name, "table": table, "schema": df.schema.jsonValue()})
        self.made.append(name)
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{table}")

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder if "://" in self.folder else f"file://{self.folder}")

    def _entry(self, key: str) -> dict | None:
        store, root = self._place()
        path = f"{root}/manifest/{key}.json"
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_stream(path) as f:
            return json.loads(f.read())

    def _enter(self, key: str, entry: dict) -> None:
        store, root = self._place()
        store.create_dir(f"{root}/manifest", recursive=True)
        draft = f"{root}/manifest/.{key}-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps(entry).encode())
        store.move(draft, f"{root}/manifest/{key}.json")

    def entries(self) -> dict[str, dict]:
        """All entries of the folder by key."""
        store, root = self._place()
        files = store.get_file_info(fs.FileSelector(f"{root}/manifest", allow_not_found=True))
        keys = [f.base_name.removesuffix(".json") for f in files if f.base_name.endswith(".json")]
        return {k: e for k in keys if (e := self._entry(k))}

    def sweep(self) -> int:
        """Deletes tables without an entry, which stopped runs leave, and returns their number. Not while another run writes."""
        store, root = self._place()
        known = {e["table"] for e in self.entries().values()}
        left = [f.base_name for f in store.get_file_info(fs.FileSelector(f"{root}/tables", allow_not_found=True)) if f"tables/{f.base_name}" not in known]
        for name in left:
            store.delete_dir(f"{root}/tables/{name}")
        return len(left)

    def forget(self) -> None:
        """Deletes everything that is kept."""
        if self.folder:
            for part in ("manifest", "tables"):
                delete(f"{self.folder if '://' in self.folder else f'file://{self.folder}'}/{part}")
