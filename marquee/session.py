"""Session helpers: defaults that a submitter can override, and the shared folder."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "marquee", driver_memory: str = "8g") -> SparkSession:
    """A session with the library's defaults for everything that is not set.

    Settings of spark-submit, of spark-defaults and of a running session win;
    a local master is taken only if the submitter names none."""
    running = SparkSession.getActiveSession()
    # start the JVM with the memory default, so that the submitted settings can be read
    SparkContext._ensure_initialized(conf=SparkConf().set("spark.driver.memory", driver_memory))
    submitted = SparkConf()
    named = "PYSPARK_GATEWAY_PORT" in os.environ or "master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    wanted = {
        **DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions),
    }
    builder = SparkSession.builder
    for key, value in wanted.items():
        if running is None and not submitted.contains(key):
            builder = builder.config(key, value)
    if running is None and not named:  # spark-submit always fills in a master
        builder = builder.appName(app).master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint directory that the session names in
    ``spark.checkpoint.dir``.  Where none is set, a local session gets a
    temporary folder; a cluster is an error, as its machines share no folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif is_local(sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's written layers; later reads of them fail."""
    path = spark._jvm.org.apache.hadoop.fs.Path(app_scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, label: str = "stage"):
    """Write ``df`` once as Parquet into a fresh folder under the shared
    checkpoint directory and return the re-read DataFrame.

    This cuts lineage like ``checkpoint()`` but in one job (an eager RDD
    checkpoint computes its input twice unless cached) and gives columnar
    reads with pruning and pushdown downstream.  Task retries after a lost
    executor rewrite the same partition through the commit protocol."""
    import uuid

    spark = df.sparkSession
    path = f"{app_scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    # the schema is known: skip footer inference on read-back
    return spark.read.schema(df.schema).parquet(path)


def app_scratch_dir(spark) -> str:
    """Per-application folder under the shared checkpoint directory; all
    intermediates of one run live below it and can be dropped together."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/marquee/{spark.sparkContext.applicationId}"
