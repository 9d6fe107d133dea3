"""Sources and sinks.

Readers take explicit schemas (no inference pass over the data); writers
go through Spark's DataFrameWriter.  Reloads never leave a half-written
table visible: data lands in a new versioned table and a view is repointed
only after validation (S7)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.session import app_scratch_dir


def csv_options(multiline: bool = False, corrupt_column: str | None = None) -> dict[str, object]:
    """One set of CSV options for batch and stream readers: header, doubled
    quotes, PERMISSIVE.  ``multiline`` allows line breaks in quoted fields, at
    the price of one task for each file."""
    out = {"header": True, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": multiline}
    return out | ({"columnNameOfCorruptRecord": corrupt_column} if corrupt_column else {})


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             corrupt_column: str | None = None, multiline: bool = False) -> DataFrame:
    """Header CSV; malformed lines go to ``corrupt_column`` when given.
    Files split across tasks unless ``multiline`` is asked for."""
    return spark.read.schema(schema).options(**csv_options(multiline, corrupt_column) | {"header": header}).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """S3: JSON with a nested summary struct.  JSON-lines (``multiline=False``)
    splits across tasks; a single top-level array needs ``multiline=True``
    and is read by one task per file."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetchsize: int = 10_000,
              properties: dict | None = None) -> DataFrame:
    """JDBC table read, partitioned on a numeric column when bounds are
    given (the reference reads through a single connection)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10_000,
               properties: dict | None = None) -> None:
    """JDBC append / error-if-exists write with batched inserts."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", batchsize)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def table_or_csv(spark: SparkSession, table: str, csv_path: str, schema: StructType | str) -> DataFrame:
    """Read the upstream table when it exists, else the landed CSV."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return read_csv(spark, csv_path, schema)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a layer namespace if missing, with its tables below ``location``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def sync_table_schema(df: DataFrame, table: str) -> list[str]:
    """Add the DataFrame's columns missing on the target table
    (case-insensitive names); returns the added column names."""
    spark = df.sparkSession
    existing = {f.name.lower() for f in spark.table(table).schema.fields}
    missing = [f for f in df.schema.fields if f.name.lower() not in existing]
    if missing:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [f.name for f in missing]


def _observed(df: DataFrame):
    """``df`` and an observation that counts its rows while they are written."""
    from pyspark.sql import Observation
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def safe_reload(df: DataFrame, name: str, validate=None, keep_previous: bool = False) -> str:
    """Write ``df`` to a new versioned table, validate it (default: as many
    rows as were written), then repoint view ``name`` to it and drop the
    previous version, which the view names in a property.  The source runs
    once.  A failed write or validation leaves the old view."""
    spark = df.sparkSession
    version = f"{name}__v{uuid.uuid4().hex[:12]}"
    counted, seen = _observed(df)
    counted.write.mode("errorifexists").saveAsTable(version)
    written = spark.table(version)
    ok = validate(written) if validate else written.count() == seen.get["rows"]
    if not ok:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise ValueError(f"validation failed for {name}; previous version kept")
    previous = None
    if spark.catalog.tableExists(name):
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        previous = properties.get("reload.version")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('reload.version' = '{version}') AS SELECT * FROM {version}")
    if previous and not keep_previous and previous != version:
        spark.sql(f"DROP TABLE IF EXISTS {previous}")
    return version


def safe_reload_path(df: DataFrame, name: str, base_dir: str, validate=None) -> str:
    """S7 for file-based layers: write a new version folder under
    ``base_dir``, validate it (default: as many rows as were written), then
    repoint temp view ``name`` to it.  Readers keep the old version on any
    failure; nothing is overwritten in place."""
    spark = df.sparkSession
    path = f"{base_dir.rstrip('/')}/{name}/v-{uuid.uuid4().hex[:12]}"
    counted, seen = _observed(df)
    counted.write.mode("errorifexists").parquet(path)
    written = spark.read.parquet(path)
    ok = validate(written) if validate else written.count() == seen.get["rows"]
    if not ok:
        raise ValueError(f"validation failed for {name}; previous version kept ({path} not published)")
    written.createOrReplaceTempView(name)
    return path


def replace_path(df: DataFrame, path: str, validate=None) -> str:
    """S7 for a fixed path: write beside it, validate, then swap by two renames.
    Until the swap, and after any failure before it, readers see the old rows."""
    spark = df.sparkSession
    new, old = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex[:12]}" for kind in ("new", "old"))
    counted, seen = _observed(df)
    counted.write.mode("errorifexists").parquet(new)
    written = spark.read.schema(df.schema).parquet(new)
    if not (validate(written) if validate else written.count() == seen.get["rows"]):
        raise ValueError(f"validation failed for {path}; previous version kept ({new} not published)")
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    target = to_path(path.rstrip("/"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(target)
    if had:
        fs.rename(target, to_path(old))
    if not fs.rename(to_path(new), target):
        if had:
            fs.rename(to_path(old), target)
        raise OSError(f"could not publish {path}")
    if had:
        fs.delete(to_path(old), True)
    return path


def write_layer(df: DataFrame, name: str, materialized: str = "table", path: str | None = None) -> DataFrame:
    """Staging models as (lazy) temp views; marts as versioned Parquet below
    ``path``, or as a versioned table behind a view.  Readers keep the last good
    version if a run fails."""
    if materialized == "view":
        df.createOrReplaceTempView(name)
        return df
    if path:
        from marquee.sources import publish
        publish.publish(df, path, publish.sound(may_be_empty=True))
        return publish.current(df.sparkSession, path)
    safe_reload(df, name)
    return df.sparkSession.table(name)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{app_scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


MOVIES_MAIN_SCHEMA = "id string, title string, release_date string, budget string, revenue string"
RATINGS_SCHEMA = ("movie_id bigint, ratings_summary struct<avg_rating:double,total_ratings:bigint,"
                  "std_dev:double>, last_rated bigint")


def typed_movies(raw: DataFrame, *more: str) -> DataFrame:
    """Typed view of a landed catalogue file (id, title, date, money), with the columns ``more`` as they are."""
    from marquee.functions.dates import parse_mixed_date
    from marquee.functions.numeric import to_number
    return raw.select(to_number("id").try_cast("bigint").alias("id"), "title",
                      parse_mixed_date("release_date").alias("release_date"),
                      to_number("budget").alias("budget"), to_number("revenue").alias("revenue"), *more)


# ---- the catalogue's landed files -------------------------------------------
MOVIES_COLUMNS = ["id", "title", "release_date", "budget", "revenue"]
EXTENDED_COLUMNS = ["id", "genres", "production_companies", "production_countries", "spoken_languages"]
BENCHMARK_COLUMNS = ["title", "release_date", "budget", "revenue"]


def read_text_csv(spark: SparkSession, path: str, columns: list[str], multiline: bool = False) -> DataFrame:
    """Header CSV read as text (no inference pass), columns picked by name
    so extra source columns are ignored; missing optional ones become NULL.

    ``ingest_seq`` orders rows by file, then by place in the file, for
    keep-first deduplication: (path, start of the split, row in the split).
    With ``multiline`` quoted fields may hold line breaks; files still split."""
    if multiline:
        from marquee.sources.splits import read_csv_records
        return read_csv_records(spark, path, columns)
    raw = spark.read.options(**csv_options()).csv(path)
    have = {c.lower(): c for c in raw.columns}
    cols = [F.col(have[c.lower()]).alias(c) if c.lower() in have else F.lit(None).cast("string").alias(c)
            for c in columns]
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("row"))
    return raw.select(*cols, place.alias("ingest_seq"))


def read_ratings_json(spark: SparkSession, path: str, top_level_array: bool = True) -> DataFrame:
    """S3: ratings with a nested summary from one JSON array a file, read in
    splits; JSON lines are read with ``top_level_array=False``."""
    if top_level_array:
        from marquee.sources.splits import read_json_array
        return read_json_array(spark, path, RATINGS_SCHEMA)
    return read_json(spark, path, RATINGS_SCHEMA)
