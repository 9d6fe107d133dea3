"""Generated TPC-H-style tables -> the catalogue domain's raw inputs.

Mapping (movie := order), see FIXTURES.md section 2:

* movies_main: id (text), title = lowest part name of the order's lines +
  ' ' + custkey % 97 (NULL without lines), release_date = order date
  rendered in one of three text formats by orderkey % 3, budget = total
  price (0 for status 'P'), revenue = sum of discounted line prices (0
  without lines).  All columns are text, like a landed CSV.
* movie_extended: genres = distinct part types, production_companies =
  distinct brands (comma lists), production_countries = list literal of the
  distinct supplier nations, spoken_languages = list literal of the
  customer's region.
* ratings: events per user_id as a nested summary + epoch seconds.
* benchmark: every order with lines - the same title for orderkey % 3 = 0,
  else one that matches nothing (suffix ' cut'), first ship date, average line
  price as budget, summed line price as revenue.
* dirt in movies_main: customers with custkey % 37 = 0 land a second, later row
  of the same id with another title, a written date in one of four forms (or
  words that are none) and money that is no number; those with custkey % 41 = 0 a row whose id is text or missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


LATER = 10**12  # ingest sequence of rows that land after all first ones


@dataclass
class RawTables:
    movies_main: DataFrame
    movie_extended: DataFrame
    ratings: DataFrame
    benchmark: DataFrame


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(x) -> "F.Column":
    # sums of 2-decimal money done exactly, then rounded half-up to cents
    return F.round(F.sum(x.cast("decimal(38,10)")), 2).cast("double")


def _epoch_seconds(ts) -> "F.Column":
    # timezone-free epoch seconds of a wall-clock (NTZ) timestamp
    return (F.unix_date(ts.cast("date")).cast("bigint") * 86400 + F.hour(ts) * 3600
            + F.minute(ts) * 60 + F.second(ts)).cast("bigint")


def _title(min_part_name, custkey):
    return F.when(min_part_name.isNotNull(),
                  F.concat(min_part_name, F.lit(" "), (custkey % 97).cast("string")))


def _literal_list(arr, key_field: str, key_name: str):
    def item(s):
        name = F.replace(s["name"], F.lit("\u00c9"), F.lit("\\xc9"))
        mark = F.when(name.contains("'"), F.lit('"')).otherwise(F.lit("'"))
        note = F.when(s[key_field] % 5 == 3, F.lit(", 'note': None")).otherwise(F.lit(""))
        return F.concat(F.lit("{'" + key_name + "': '"), s[key_field].cast("string"), F.lit("', 'name': "),
                        mark, name, mark, note, F.lit("}"))

    return F.when(F.size(arr) > 0, F.concat(F.lit("["), F.array_join(F.transform(arr, item), ", "),
                                           F.lit("]")))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line facts with part and supplier-nation attributes, partitioned by order.

    Each shuffle carries as little as it can: the supplier's nation key takes the
    place of the supplier key first, the part's texts come in last, and the
    nations' names once the lines lie with their order.  Lines without an order
    stay out, as nothing joins them."""
    li = _read(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.when(F.col("p_partkey") % 3 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("p_brand"))
    supp = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation has 25 rows by definition of the schema: a proven broadcast size
    # its names with commas, quotes and letters that a list literal escapes
    name, kind = F.col("n_name"), F.col("n_nationkey") % 5
    dirty = F.when(kind == 0, F.concat(name, F.lit(", Republic of"))).when(kind == 1, F.concat(name, F.lit("'s Isles"))) \
        .when(kind == 2, F.concat(F.lit("\u00c9"), name)).otherwise(name)
    nation = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", dirty.alias("n_name")))
    lines = li.join(supp, li.l_suppkey == supp.s_suppkey, "left").drop("l_suppkey", "s_suppkey") \
        .join(part, li.l_partkey == part.p_partkey, "left").drop("l_partkey", "p_partkey")
    return lines.repartition("l_orderkey").join(nation, F.col("s_nationkey") == nation.n_nationkey, "left")


def per_order(lines: DataFrame) -> DataFrame:
    """Order-level line aggregates (set aggregates are bounded by the small
    type/brand/nation domains, not by the order size).

    ``lines`` are partitioned by order.  Before that a task's file part holds few
    lines of one order: aggregated there, a line is an array and a sum for each
    column and more bytes than before."""
    return lines.groupBy("l_orderkey").agg(
        F.min("p_name").alias("min_part_name"),
        _money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_revenue"),
        F.array_sort(F.collect_set("p_type")).alias("types"),
        F.array_sort(F.collect_set("p_brand")).alias("brands"),
        F.array_sort(F.collect_set(F.struct(F.col("n_name").alias("name"),
                                            F.col("n_nationkey").alias("iso")))).alias("nations"),
        F.min("l_shipdate").alias("first_ship"),
        F.round(F.avg("l_extendedprice").cast("decimal(38,10)"), 2).cast("double").alias("avg_price"),
        _money(F.col("l_extendedprice")).alias("sum_price"),
    )


def generated_raw(spark: SparkSession, sf_dir: str, stage=None) -> RawTables:
    """``stage`` (optional) materialises the order-level frame all four raw
    tables project from, so the line aggregation runs once ("landing").

    Customers are joined to the orders' own few columns; the wide line
    aggregates come last and move once, by order."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    agg = per_order(order_lines(spark, sf_dir))
    cust = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    region = F.broadcast(_read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    cust_region = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left") \
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left") \
        .select("c_custkey", F.struct(F.col("r_name").alias("name"),
                                      F.col("r_regionkey").alias("iso")).alias("lang"))
    o = orders.join(cust_region, orders.o_custkey == cust_region.c_custkey, "left").drop("c_custkey")
    ox = o.join(agg, o.o_orderkey == agg.l_orderkey, "left").drop("l_orderkey")
    if stage is not None:
        ox = stage(ox)
    title = _title(F.col("min_part_name"), F.col("o_custkey"))
    fmt = F.col("o_orderkey") % 3
    release = (F.when(fmt == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
                .when(fmt == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
                .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy")))
    def landed(id_, name, date, budget, revenue, later):
        return F.struct(id_.alias("id"), name.alias("title"), date.alias("release_date"), budget.alias("budget"),
                        revenue.alias("revenue"), (F.col("o_orderkey") + later).cast("bigint").alias("ingest_seq"))

    key, cust_key = F.col("o_orderkey").cast("string"), F.col("o_custkey")
    clean_row = landed(
        key, title, release,
        F.when(F.col("o_orderstatus") == "P", F.lit(0.0)).otherwise(F.col("o_totalprice")).cast("string"),
        F.coalesce(F.col("line_revenue"), F.lit(0.0)).cast("string"), 0)
    forms = ["MMM d yyyy", "d MMMM yyyy", "yyyy/M/d", "MMMM d, yyyy"]
    written = F.coalesce(*[F.when(F.col("o_orderkey") % 5 == k, F.date_format("o_orderdate", f)) for k, f in enumerate(forms)], F.lit("some day"))
    second_row = landed(key, F.concat(title, F.lit(" again")), written, F.lit("n/a"), F.lit("5d"), LATER)
    bad_id = landed(F.when(cust_key % 2 == 0, F.concat(F.lit("x"), key)), title, F.lit("unknown"), F.lit("0"), F.lit("0"), 2 * LATER)
    rows = F.array(clean_row, F.when(cust_key % 37 == 0, second_row), F.when(cust_key % 41 == 0, bad_id))
    movies_main = ox.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))
    movie_extended = ox.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.size("types") > 0, F.array_join("types", ",")).alias("genres"),
        F.when(F.size("brands") > 0, F.array_join("brands", ",")).alias("production_companies"),
        _literal_list(F.col("nations"), "iso", "iso_3166_1").alias("production_countries"),
        F.when(F.col("lang.name").isNotNull(),
               _literal_list(F.array(F.col("lang")), "iso", "iso_639_1")).alias("spoken_languages"),
        F.col("o_orderkey").alias("ingest_seq"),
    )

    ev = _read(spark, sf_dir, "events")
    ratings = ev.groupBy("user_id").agg(
        F.round(F.avg("value").cast("decimal(38,10)"), 2).cast("double").alias("avg_rating"),
        F.count(F.lit(1)).cast("bigint").alias("total_ratings"),
        F.round(F.stddev_samp("value").cast("decimal(38,10)"), 4).cast("double").alias("std_dev"),
        F.max(_epoch_seconds(F.col("ts"))).alias("last_rated"),
    ).select(
        F.col("user_id").alias("movie_id"),
        F.when(F.col("user_id") % 13 != 0, F.struct("avg_rating", "total_ratings", "std_dev")).alias("ratings_summary"),
        "last_rated",
    )
    if stage is not None:
        ratings = stage(ratings)

    bench = ox.where(F.col("min_part_name").isNotNull()).select(
        F.when(F.col("o_orderkey") % 3 == 0, title).otherwise(F.concat(title, F.lit(" cut"))).alias("title"),
        F.date_format("first_ship", "yyyy-MM-dd").alias("release_date"),
        F.col("avg_price").cast("string").alias("budget"),
        F.col("sum_price").cast("string").alias("revenue"),
    )
    return RawTables(movies_main, movie_extended, ratings, bench)
