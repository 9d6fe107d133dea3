"""Landing source files as published tables.

A missing file is skipped and an empty one reported, and the run goes on; the
cleaning that follows asks for what landed and fails if it never did."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee.sources import publish as P

LOADED, MISSING, EMPTY = "loaded", "missing", "empty"


@dataclass(frozen=True)
class Source:
    """A file, folder or glob, and how it is read."""

    path: str
    read: Callable[[SparkSession, str], DataFrame]


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file of ``path`` (a file, folder or glob)?"""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return bool(found)


def land(spark: SparkSession, root: str, sources: dict[str, Source]) -> DataFrame:
    """Publish each source below ``root``; (dataset, status, rows) of each.

    A loaded source replaces what landed before, in one step; a missing or
    empty one leaves it."""
    report = []
    for name, source in sources.items():
        if not exists(spark, source.path):
            report.append((name, MISSING, 0))
            continue
        rows = source.read(spark, source.path)
        if rows.isEmpty():
            report.append((name, EMPTY, 0))
            continue
        P.publish(rows, f"{root.rstrip('/')}/{name}")
        report.append((name, LOADED, P.versions(spark, f"{root.rstrip('/')}/{name}")[-1]["rows"]))
    return spark.createDataFrame(report, "dataset string, status string, rows long")


def landed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """What landed last; an error if nothing ever did."""
    return P.current(spark, f"{root.rstrip('/')}/{name}")
