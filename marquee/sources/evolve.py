"""Tables whose columns grow from one append to the next.

    <root>/data-00000002-<hex>/   rows of one append, in the columns they came with
    <root>/pointers/00000002      the table's columns so far, and its data folders with their own

Columns are matched without case and keep their first spelling.  New columns
are added, types are widened, columns that an append lacks are NULL there.
Nothing that lies in the table is written again: readers cast the older rows,
which Spark does while it scans.  A pointer is created once, like those of
``publish``, so a stop at any step leaves readers the table before.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.publish import Check, Store, _write

#: Whole-number types from narrow to wide, with the digits of their values.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
MOST_DIGITS = 38


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds all values of both; text holds any scalar.
    Types without one (a long and a double, an array and a number) are an error."""
    if a == b:
        return a
    scalar = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, scalar) and isinstance(b, scalar):
        kinds = {type(a), type(b)}
        if T.StringType in kinds:
            return T.StringType()
        if a in WHOLE and b in WHOLE:
            return max(a, b, key=WHOLE.get)
        if kinds == {T.FloatType, T.DoubleType}:
            return T.DoubleType()
        if T.DoubleType in kinds or T.FloatType in kinds:
            other = a if isinstance(b, (T.DoubleType, T.FloatType)) else b
            if WHOLE.get(other, MOST_DIGITS) <= 10:  # a double holds every int
                return T.DoubleType()
        if T.DecimalType in kinds and all(isinstance(x, T.DecimalType) or x in WHOLE for x in (a, b)):
            digits, scale = zip(*[(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (WHOLE[x], 0) for x in (a, b)])
            if max(digits) + max(scale) <= MOST_DIGITS:
                return T.DecimalType(max(digits) + max(scale), max(scale))
        if kinds == {T.DateType, T.TimestampType} or kinds == {T.DateType, T.TimestampNTZType}:
            return a if isinstance(b, T.DateType) else b
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def merged(known: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of ``known``, widened where ``new`` needs it, then the added ones."""
    incoming = {f.name.lower(): f for f in new.fields}
    if len(incoming) != len(new.fields):
        raise ValueError("columns differ by case only")
    have = {f.name.lower() for f in known.fields}
    out = []
    for f in known.fields:
        other = incoming.get(f.name.lower())
        try:
            out.append(T.StructField(f.name, wider(f.dataType, other.dataType) if other else f.dataType))
        except ValueError as e:
            raise ValueError(f"column {f.name}: {e}") from None
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in have])


def generations(spark: SparkSession, root: str) -> list[dict]:
    """The complete pointers, newest last."""
    store, out = Store(spark, root), []
    for name in store.names("pointers"):
        try:
            p = json.loads(store.read(f"pointers/{name}"))
        except ValueError:  # its writer stopped while it wrote this
            continue
        if {"version", "schema", "parts"} <= set(p):
            out.append(p)
    return out


def schema_of(pointer: dict) -> T.StructType:
    return T.StructType.fromJson(pointer["schema"])


def _next(store: Store) -> int:
    return max((int(n) for n in store.names("pointers") if n.isdigit()), default=0) + 1


def _add(store: Store, df: DataFrame, check: Check | None, schema: T.StructType, before: list[dict]) -> int:
    version = _next(store)
    data = f"data-{version:08d}-{uuid.uuid4().hex[:12]}"
    rows = _write(df, f"{store.root}/{data}")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{store.root}/{data}")
    if written.count() != rows or (check and not check(written)):
        raise ValueError(f"validation failed for {store.root}; its rows were not added")
    parts = before + [{"data": data, "rows": rows, "schema": df.schema.jsonValue()}]
    store.create(f"pointers/{version:08d}", json.dumps({"version": version, "schema": schema.jsonValue(), "parts": parts}))
    return version


def append(df: DataFrame, root: str, check: Check | None = None) -> list[str]:
    """Add the rows of ``df`` to the table, which is created if there is none;
    returns the names of the added columns.  Columns without a common type, and
    rows that fail ``check``, are an error before any reader sees them."""
    spark = df.sparkSession
    known = generations(spark, root)
    old = schema_of(known[-1]) if known else T.StructType([])
    schema = merged(old, df.schema)
    _add(Store(spark, root), df, check, schema, known[-1]["parts"] if known else [])
    return schema.names[len(old.names):]


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """All rows in the table's columns, as of ``version`` (default: the last).
    Folders of one schema are one scan, so branches grow with the schemas."""
    known = [p for p in generations(spark, root) if version is None or p["version"] == version]
    if not known:
        raise FileNotFoundError(f"no such version below {root}")
    schema, alike = schema_of(known[-1]), {}
    for part in known[-1]["parts"]:
        alike.setdefault(json.dumps(part["schema"], sort_keys=True), []).append(f"{root.rstrip('/')}/{part['data']}")
    return reduce(DataFrame.unionByName, [_as(spark.read.schema(T.StructType.fromJson(json.loads(own))).parquet(*paths), schema) for own, paths in alike.items()])


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def compact(spark: SparkSession, root: str, keep: int = 2) -> int:
    """All rows written once more in the present columns, as one folder; the
    last ``keep`` versions stay readable, and folders that none of them names go."""
    store = Store(spark, root)
    df = read(spark, root)
    version = _add(store, df, None, df.schema, [])
    kept = {part["data"] for p in generations(spark, root)[-keep:] for part in p["parts"]}
    for name in store.names(""):
        if name.startswith("data-") and name not in kept:
            store.delete(name)
    return version
