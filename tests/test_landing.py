"""The landing of the generated tables: what its shuffles carry."""

import datetime as dt
import re

from pyspark.sql import functions as F

from marquee.sources.adapter import generated_raw


def write_tables(spark, at):
    day = dt.datetime(2015, 3, 1)
    tables = {
        "nation": ([(1, "N1", 0), (2, "N2", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "customer": ([(5, 1), (5, 2), (6, None)], "c_custkey bigint, c_nationkey int"),
        "supplier": ([(7, 1), (8, 2)], "s_suppkey bigint, s_nationkey int"),
        "part": ([(3, "a", "T1", "B1"), (4, "b", "T2", "B1")], "p_partkey bigint, p_name string, p_type string, p_brand string"),
        "orders": ([(1, 5, "O", 10.0, day, "x"), (2, 6, "P", 20.0, day, "x"), (None, 6, "O", 1.0, day, "x")],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 3, 7, 4.0, 0.5, day), (1, 4, 8, 2.0, 0.0, day), (None, 4, 8, 9.0, 0.0, day), (2, None, 7, 1.0, 0.0, day)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_discount double, l_shipdate timestamp"),
        "events": ([(1, 2.0, day)], "user_id bigint, value double, ts timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def staged(spark, at):
    seen = []
    generated_raw(spark, at, stage=lambda df: seen.append(df) or df)
    return seen[0]


def below(plan, exchange):
    """The plan lines below the first exchange whose line has ``exchange``."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[\s:|+-]*", x).group()) for x in lines]
    at = next(k for k, x in enumerate(lines) if "Exchange hashpartitioning" in x and exchange in x)
    end = next((k for k in range(at + 1, len(lines)) if depth[k] <= depth[at]), len(lines))
    return "\n".join(lines[at + 1:end])


def test_lines_and_orders_move_before_they_are_wide(spark, tmp_path, capsys):
    at = write_tables(spark, tmp_path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged(spark, at).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plan = capsys.readouterr().out
    assert "collect_set" in plan
    assert "collect_set" not in below(plan, "l_orderkey")  # a line is not an aggregate of its own
    assert "collect_set" not in below(plan, "o_custkey")  # customers are joined to narrow orders


def test_landing_keeps_every_order_and_copy(spark, tmp_path):
    rows = staged(spark, write_tables(spark, tmp_path)).select(
        "o_orderkey", F.col("lang.name").alias("lang"), "min_part_name", "line_revenue", "sum_price", "types", F.size("nations").alias("n")).collect()
    got = sorted(map(tuple, rows), key=str)
    assert got == sorted([(1, "R", "a", 4.0, 6.0, ["T1", "T2"], 2), (1, "R", "a", 4.0, 6.0, ["T1", "T2"], 2),
                          (2, None, None, 1.0, 1.0, [], 1), (None, None, None, None, None, None, None)], key=str)


def exchanged(plan, key):
    """Output columns of the exchange on ``key`` in a formatted plan."""
    part = next(p for p in plan.split("\n\n") if re.search(rf"\) Exchange\n", p) and f"hashpartitioning({key}#" in p)
    return set(re.findall(r"([a-z_]+)#", next(x for x in part.splitlines() if x.startswith("Input"))))


def test_each_shuffle_of_lines_carries_only_what_is_read_later(spark, tmp_path, capsys):
    at = write_tables(spark, tmp_path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged(spark, at).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plan = capsys.readouterr().out
    numbers = {"l_orderkey", "l_extendedprice", "l_discount", "l_shipdate"}
    assert exchanged(plan, "l_suppkey") == numbers | {"l_suppkey", "l_partkey"}
    assert exchanged(plan, "l_partkey") == numbers | {"l_partkey", "s_nationkey"}
    assert exchanged(plan, "l_orderkey") == numbers | {"s_nationkey", "p_name", "p_type", "p_brand"}


def test_a_nation_in_two_rows_counts_a_line_twice(spark, tmp_path):
    at = write_tables(spark, tmp_path)
    spark.createDataFrame([(1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int").write.mode("append").parquet(f"{at}/nation.parquet")
    got = {r.o_orderkey: (r.sum_price, r.names) for r in staged(spark, at).select("o_orderkey", "sum_price", F.col("nations.name").alias("names")).collect()}
    assert got == {1: (10.0, ["N1's Isles", "\u00c9N2"]), 2: (2.0, ["N1's Isles"]), None: (None, None)}
