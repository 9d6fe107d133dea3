"""Tables published through versions and an atomic pointer.

A table is a folder with data folders and numbered pointers:

    <root>/data-00000002-<hex>/   rows, written and validated before any reader knows them
    <root>/pointers/00000002      one small file that names the data folder

A pointer is created once and never replaced, and no folder is renamed, so
this also holds in object stores.  Readers take the highest pointer that is
complete: a stop at any step leaves them the version before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Check = Callable[[DataFrame], bool]


class Store:
    """The few file operations that a published table needs, in Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def create(self, name: str, text: str) -> None:
        """A new file; one that exists is an error."""
        out = self.fs.create(self._path(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def versions(spark: SparkSession, root: str) -> list[dict]:
    """The complete pointers, newest last."""
    store, out = Store(spark, root), []
    for name in store.names("pointers"):
        try:
            p = json.loads(store.read(f"pointers/{name}"))
        except ValueError:  # its writer stopped while it wrote this
            continue
        if {"version", "data", "rows", "schema"} <= set(p):
            out.append(p)
    return out


def current(spark: SparkSession, root: str) -> DataFrame:
    """The published rows; a table that was never published is an error."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no published version below {root}")
    return spark.read.schema(known[-1]["schema"]).parquet(f"{root.rstrip('/')}/{known[-1]['data']}")


def sound(keys: list[str] | None = None, may_be_empty: bool = False) -> Check:
    """The usual check: some rows, and no null in ``keys``, in one scan."""
    def check(df: DataFrame) -> bool:
        bad = [F.count(F.when(F.col(k).isNull(), 1)) for k in keys or []]
        r = df.agg(F.count(F.lit(1)), *bad).first()
        return (may_be_empty or r[0] > 0) and not any(r[1:])

    return check


def _write(df: DataFrame, path: str) -> int:
    from pyspark.sql import Observation
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return seen.get["rows"]


def _point(store: Store, version: int, data: str, rows: int, schema: str) -> None:
    store.create(f"pointers/{version:08d}", json.dumps({"version": version, "data": data, "rows": rows, "schema": schema}))


def _clean(store: Store, keep: int) -> None:
    """Older versions go, and folders that no pointer ever named."""
    kept = {p["data"] for p in versions(store.spark, store.root)[-keep:]}
    for name in store.names(""):
        if name.startswith("data-") and name not in kept:
            store.delete(name)


def publish(df: DataFrame, root: str, check: Check | None = None, keep: int = 2) -> int:
    """Write ``df`` as the next version of ``root``, check it as it was written,
    and point to it; returns the version.  The last ``keep`` versions stay.

    ``check`` (default: not empty) sees the written rows; besides, they must be
    as many as went in.  If it fails, readers keep the version before.  One
    writer at a time; of two, the later pointer is an error, not a lost table."""
    store = Store(df.sparkSession, root)
    taken = [int(n) for n in store.names("pointers") if n.isdigit()]
    version = max(taken, default=0) + 1
    data = f"data-{version:08d}-{uuid.uuid4().hex[:12]}"
    rows = _write(df, f"{store.root}/{data}")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{store.root}/{data}")
    if written.count() != rows or not (check or sound())(written):
        raise ValueError(f"validation failed for {root}; previous version kept")
    _point(store, version, data, rows, df._jdf.schema().toDDL())
    _clean(store, keep)
    return version
