"""Sources, sinks and the incremental ingest on small frames."""

import tempfile

import pytest
from pyspark.sql import functions as F

from marquee.sources import io
from marquee.streaming.incremental import incremental_ingest, read_landed


@pytest.fixture()
def movies(spark):
    return spark.createDataFrame([("1", "A, the", "2016-04-22", "10", "20"), ("2", None, "11/01/1996", "0", "x")],
                                 io.MOVIES_MAIN_SCHEMA)


def test_csv_roundtrip_and_table_or_csv(spark, movies):
    path = tempfile.mkdtemp(prefix="csv-") + "/m"
    movies.write.option("header", True).csv(path)
    back = io.read_csv(spark, path, io.MOVIES_MAIN_SCHEMA)
    assert sorted(back.collect()) == sorted(movies.collect())
    assert io.table_or_csv(spark, "no_such_table", path, io.MOVIES_MAIN_SCHEMA).count() == 2
    typed = {r.id: r for r in io.typed_movies(back).collect()}
    assert typed[2].revenue is None and str(typed[1].release_date) == "2016-04-22"


def test_safe_reload_and_schema_sync(spark, movies):
    io.ensure_schema(spark, "silver_base")
    v1 = io.safe_reload(movies, "silver_base.movies")
    assert spark.table("silver_base.movies").count() == 2
    v2 = io.safe_reload(movies.where("id = '1'"), "silver_base.movies")
    assert v1 != v2 and spark.table("silver_base.movies").count() == 1
    with pytest.raises(ValueError):
        io.safe_reload(movies, "silver_base.movies", validate=lambda df: False)
    assert spark.table("silver_base.movies").count() == 1   # old version still served
    added = io.sync_table_schema(movies.withColumn("Extra_Flag", F.lit(True)), v2)
    assert added == ["Extra_Flag"] and "Extra_Flag" in spark.table(v2).columns
    assert io.sync_table_schema(movies.withColumn("extra_flag", F.lit(True)), v2) == []


def test_write_layer_view_and_table(spark, movies):
    io.write_layer(movies, "stg_view_test", "view")
    assert spark.table("stg_view_test").count() == 2
    assert io.write_layer(movies, "mart_table_test", "table").count() == 2
    assert io.write_layer(movies.where("id = '1'"), "mart_table_test", "table").count() == 1


def test_a_layer_survives_a_failed_run(spark, movies, tmp_path):
    path = str(tmp_path / "mart")
    assert io.write_layer(movies, "mart", path=path).count() == 2
    with pytest.raises(Exception, match="broken"):
        io.write_layer(movies.withColumn("title", F.raise_error(F.lit("broken"))), "mart", path=path)
    from marquee.sources import publish
    assert publish.current(spark, path).count() == 2
    assert io.write_layer(movies.limit(0), "mart", path=path).count() == 0


def test_incremental_ingest_exactly_once(spark, movies):
    base = tempfile.mkdtemp(prefix="ingest-")
    movies.write.option("header", True).csv(f"{base}/src/drop1")
    incremental_ingest(spark, f"{base}/src/*", io.MOVIES_MAIN_SCHEMA, f"{base}/out", f"{base}/ck")
    movies.where("id = '1'").write.option("header", True).csv(f"{base}/src/drop2")
    incremental_ingest(spark, f"{base}/src/*", io.MOVIES_MAIN_SCHEMA, f"{base}/out", f"{base}/ck")
    incremental_ingest(spark, f"{base}/src/*", io.MOVIES_MAIN_SCHEMA, f"{base}/out", f"{base}/ck")
    assert read_landed(spark, f"{base}/out").count() == 3    # drop1 (2) + drop2 (1), nothing twice


def test_safe_reload_path_keeps_old_version(spark, movies):
    base = tempfile.mkdtemp(prefix="pub-")
    io.safe_reload_path(movies, "pub_movies", base)
    assert spark.table("pub_movies").count() == 2
    with pytest.raises(ValueError):
        io.safe_reload_path(movies.where("id = '1'"), "pub_movies", base, validate=lambda df: False)
    assert spark.table("pub_movies").count() == 2


def test_read_text_csv_by_header_name(spark):
    path = tempfile.mkdtemp(prefix="hdr-") + "/m.csv"
    with open(path, "w") as f:
        f.write('revenue,Title,extra,id\n"1,000",The Matrix,x,7\n5,"A, B",y,8\n')
    df = io.read_text_csv(spark, path, io.MOVIES_COLUMNS)
    rows = {r.id: r for r in df.collect()}
    assert df.columns == io.MOVIES_COLUMNS + ["ingest_seq"]
    assert rows["7"].title == "The Matrix" and rows["7"].revenue == "1,000" and rows["7"].budget is None
    assert rows["8"].title == "A, B"


def test_csv_splits_and_keeps_file_order(spark):
    base = tempfile.mkdtemp(prefix="order-")
    for name, rows in (("a", 3), ("b", 60_000)):  # the larger file is packed first
        with open(f"{base}/{name}.csv", "w") as f:
            f.write("id,title\n" + "".join(f"{i % 2},{name}{i}\n" for i in range(rows)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = io.read_text_csv(spark, base, ["id", "title", "budget"])
        assert df.rdd.getNumPartitions() > 4
        first = df.groupBy("id").agg(F.min_by("title", "ingest_seq").alias("t")).collect()
        assert {r.id: r.t for r in first} == {"0": "a0", "1": "a1"}
        last = df.groupBy().agg(F.max_by("title", "ingest_seq").alias("t")).first().t
        assert last == "b59999" and df.where("budget IS NOT NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_stream_and_batch_read_alike(spark):
    base = tempfile.mkdtemp(prefix="alike-")
    import os
    os.makedirs(f"{base}/src")
    with open(f"{base}/src/x.csv", "w") as f:
        f.write('id,n\n"a ""q""\nnext line",1\nb,2\nc,notanumber\n')
    incremental_ingest(spark, f"{base}/src", "id string, n int", f"{base}/out", f"{base}/ck", multiline=True)
    batch = io.read_csv(spark, f"{base}/src", "id string, n int", multiline=True)
    assert sorted(r.id for r in read_landed(spark, f"{base}/out").collect()) == sorted(r.id for r in batch.where("n IS NOT NULL").collect()) == ['a "q"\nnext line', "b"]
    assert [r[0] for r in read_landed(spark, f"{base}/out", corrupt=True).collect()] == ["c,notanumber"]


def test_submitted_settings_survive(tmp_path):
    import subprocess
    import sys
    code = ("from marquee.session import build_session, ensure_checkpoint_dir\ns = build_session()\n"
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    import os
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=77 pyspark-shell", "PYTHONPATH": os.getcwd()}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 77 UTC" in out.stdout, out.stderr[-500:]


def test_a_cluster_needs_a_shared_folder():
    from marquee.session import ensure_checkpoint_dir, is_local

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
    assert is_local("local[4]") and is_local("local") and not is_local("local-cluster[2,1,1024]")


def test_replace_path_swaps_or_keeps(spark, movies):
    path = tempfile.mkdtemp(prefix="swap-") + "/t"
    io.replace_path(movies, path)
    assert spark.read.parquet(path).count() == 2
    io.replace_path(movies.where("id = '1'"), path)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        io.replace_path(movies, path, validate=lambda df: False)
    assert spark.read.parquet(path).count() == 1
