"""Incremental landing of new files.

The reference loads large CSVs in 50 000-row chunks (replace, then append).
The Spark form is a file stream with ``trigger(availableNow=True)``: every
run picks up only files not yet seen (tracked in the checkpoint), processes
them in bounded micro-batches (``maxFilesPerTrigger``) and appends to the
sink exactly once.  Re-running after a failure resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.io import csv_options


CORRUPT = "_corrupt_record"


def incremental_ingest(spark: SparkSession, source_dir: str, schema: str, target_dir: str,
                       checkpoint_dir: str, fmt: str = "csv", max_files_per_trigger: int = 64,
                       options: dict | None = None, multiline: bool = False) -> None:
    """Land every not-yet-processed file of ``source_dir`` into Parquet at
    ``target_dir``.

    CSV is read with the batch reader's options (``multiline`` for line breaks
    in quoted fields); a record that does not fit the schema is landed with its
    text in ``_corrupt_record``, for ``read_landed`` to set apart."""
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.schema(f"{schema}, {CORRUPT} string").options(**csv_options(multiline, CORRUPT))
    else:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir).withColumn("_ingested_file", F.input_file_name())
    q = (stream.writeStream.format("parquet").option("path", target_dir)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()


PLACE = "_place"  # of a row: its file's time and path, then the place in the file


def incremental_keep_first(spark: SparkSession, source_dir: str, schema: str, target_dir: str, checkpoint_dir: str,
                           key: str, fmt: str = "csv", max_files_per_trigger: int = 64, options: dict | None = None) -> None:
    """Land new files and keep the first row of each ``key`` over all runs.

    What landed is the state: a micro-batch keeps the first row of each key in
    file order and drops keys that an earlier batch has.  It is written to its
    own folder, which a repeated batch replaces, so a stop between or within
    batches does no harm.  The first batch of a new checkpoint replaces what
    lies in ``target_dir``, later ones append.  Rows without a key are dropped.

    File order is by modification time, then path, so a file must land after
    those that it repeats."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in ((csv_options() if fmt == "csv" else {}) | (options or {})).items():
        reader = reader.option(k, v)
    place = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")
    rows = reader.load(source_dir).select("*", place.alias(PLACE))
    names = [c for c in rows.columns if c != PLACE]
    target = target_dir.rstrip("/")

    def keep(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        at = batch.where(F.col(key).isNotNull()).withColumn(PLACE, F.struct(F.col(PLACE), F.monotonically_increasing_id()))
        # partial minima: a key that fills a third of the batch leaves one row a task
        first = at.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*names), PLACE).alias("r")).select("r.*")
        if number:
            have = session.read.schema(f"{schema}, batch long").parquet(target).where(F.col("batch") < number)
            first = first.join(have.select(key), key, "left_anti").select(*names)
        else:
            path = session._jvm.org.apache.hadoop.fs.Path(target)
            path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)
        first.write.mode("overwrite").parquet(f"{target}/batch={number}")

    rows.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination()


def read_landed(spark: SparkSession, target_dir: str, corrupt: bool = False) -> DataFrame:
    """The landed rows, or with ``corrupt`` the texts of the quarantined ones."""
    landed = spark.read.parquet(target_dir).drop("_ingested_file")
    if CORRUPT not in landed.columns:
        return landed.limit(0) if corrupt else landed
    if corrupt:
        return landed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return landed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
