"""What the medians, the slicer measures and the list literals no longer do twice."""

from pyspark.sql import functions as F

from marquee.functions.text import literal_or_csv_tokens
from marquee.operators import percentile
from marquee.plans import clean, relations


def test_percentiles_sort_only_rows_near_the_wanted_ranks(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919 % 5000) - 2500.5).alias("v"))
    df = df.unionByName(spark.createDataFrame([(0, float("inf")), (0, float("-inf")), (1, 0.0), (1, -0.0), (1, 5e-324), (1, None)], "g long, v double"))
    rows, sorted_ = [], percentile.range_sorted
    monkeypatch.setattr(percentile, "range_sorted", lambda d, *more: rows.append(d.count()) or sorted_(d, *more))
    got = {tuple(r) for r in percentile.group_percentiles(df, ["g"], "v", {"a": 0.1, "b": 0.5}).select("g", "a", "b").collect()}
    assert got == {tuple(r) for r in df.groupBy("g").agg(F.percentile("v", 0.1), F.percentile("v", 0.5)).collect()}
    assert rows[0] < 500  # of 5005 values


def test_value_steps_follow_the_values(spark):
    values = [float("-inf"), -1.7e308, -2.0, -1.0, -5e-324, 0.0, 5e-324, 1.0, 2.0, 1.7e308, float("inf")]
    steps = [r.s for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").select("k", percentile.value_step(F.col("v")).alias("s")).orderBy("k").collect()]
    assert steps == sorted(steps) and len(set(steps)) == len(values)


def test_slicer_measures_write_one_row_a_movie(spark, monkeypatch):
    fact = spark.createDataFrame([(k, 1.0, 1.0, 0.0, float(k), True) for k in (1, 2, 3)], "movie_id long, revenue double, budget double, profit double, roi_pct double, is_roi_eligible boolean")
    genre = spark.createDataFrame([(1, "A"), (1, "B"), (1, "B"), (1, None), (2, "A"), (None, "A")], "movie_id long, genre string")
    country = spark.createDataFrame([(1, "X"), (1, "Y"), (2, None)], "movie_id long, country string")
    rows, write = [], relations.materialize
    monkeypatch.setattr(relations, "materialize", lambda d, *more: rows.append(d.count()) or write(d, *more))
    bridges = {"genre": relations.Bridge(genre, "genre"), "country": relations.Bridge(country, "country")}
    got = {(r.genre, r.country): r.total_movies for r in relations.kpi_by_slicer(fact, bridges, ["genre", "country"]).collect()}
    assert got == {("A", "X"): 1, ("A", "Y"): 1, ("B", "X"): 1, ("B", "Y"): 1, ("A", None): 2, ("B", None): 1, (None, "X"): 1, (None, "Y"): 1, (None, None): 2}
    assert rows == [2]


def test_a_list_literal_is_parsed_once(spark, capsys):
    texts = ["[{'iso': '3', 'name': 'A, B', 'note': None,}, {'name': \"C's \\xc9\"}]", "[{'name': 'None, True'}, 5]", "a, b,", "[]", "[{'name': 'O'Brien'}]", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r.x for r in df.select("k", literal_or_csv_tokens("t").alias("x")).orderBy("k").collect()]
    assert got[:4] == [["A, B", "C's \u00c9"], ["None, True"], ["a", "b"], []] and got[5] == []
    spark.range(2).select(literal_or_csv_tokens(F.col("id").cast("string")).alias("x")).explain()
    assert capsys.readouterr().out.count("regexp_extract_all") == 1


def test_business_rules_build_only_the_models_they_read(spark, monkeypatch):
    from types import SimpleNamespace

    from marquee import registry
    from marquee.config import Scope
    movie = spark.createDataFrame([(1.0, 5.0, 4.0, 400.0, None, True, True, True)], "budget double, revenue double, profit double, roi_pct double, budget_quartile int, is_budget_reported boolean, is_revenue_reported boolean, is_roi_eligible boolean")
    only = SimpleNamespace(scope=Scope(min_budget=1, min_revenue=1), fact_genre_budget_roi_recommendable=spark.createDataFrame([(0,)], "movie_count long"),
                           fact_movie_performance=movie, fact_movie_roi_analysis=movie, stg_movies_roi_eligible=movie)
    monkeypatch.setattr(registry, "wh", lambda *_: only)
    got = {r.test_name: r.failures for r in registry.QUERIES["business_rule_tests"](spark, "").collect()}
    assert got == {"test_fact_genre_budget_roi_recommendable_min_sample": 1, "test_fact_movie_performance_budget_quartile_consistency": 1,
                   "test_fact_movie_roi_analysis_profit_consistency": 0, "test_fact_movie_roi_analysis_roi_pct_consistency": 0,
                   "test_stg_movies_roi_eligible_flag_consistency": 0}


def test_the_smallest_row_moves_as_one_copy(spark, capsys):
    from marquee.operators.dedup import keep_smallest
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (1, None, 9.0), (2, "c", None), (2, "c", 1.0), (None, "z", 1.0), (None, "y", 5.0)], "id long, title string, budget double")
    got = sorted(map(tuple, keep_smallest(df, ["id"]).collect()), key=str)
    assert got == sorted([(1, None, 9.0), (2, "c", None), (None, "y", 5.0)], key=str)
    clean._dedup_first(df).explain("formatted")
    moved = next(p for p in capsys.readouterr().out.split("\n\n") if ") Exchange\n" in p)
    columns = next(x for x in moved.splitlines() if x.startswith("Input")).split("[2]")
    assert len(columns) == 2  # the id and one packed row
