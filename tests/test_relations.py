"""Slicers over bridges, the year comparison with gaps, and keep-first over runs."""

import os

import pytest

from marquee.plans import analyses
from marquee.plans.relations import Bridge, kpi_by_slicer, sliced

FACT = "movie_id long, revenue double, budget double, profit double, roi_pct double, is_roi_eligible boolean"


@pytest.fixture
def model(spark):
    fact = spark.createDataFrame([(1, 10.0, 4.0, 6.0, 150.0, True), (2, 20.0, 5.0, 15.0, 300.0, False), (3, None, 1.0, None, None, None), (4, 7.0, 7.0, 0.0, 0.0, True)], FACT)
    genre = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (3, "B"), (1, "A")], "movie_id long, genre string")
    country = spark.createDataFrame([(1, "X"), (1, "Y"), (2, "Y"), (4, "X")], "movie_id long, country string")
    return fact, {"genre": Bridge(genre, "genre"), "country": Bridge(country, "country")}


def test_a_movie_counts_once(model):
    fact, bridges = model
    got = {(r.genre, r.country): (r.total_movies, r.total_revenue, r.median_roi_pct, r.recommendation_movies) for r in kpi_by_slicer(fact, bridges, ["genre", "country"]).collect()}
    assert got == {("A", "X"): (1, 10.0, 150.0, 1), ("A", "Y"): (2, 30.0, 225.0, 1), ("B", "X"): (1, 10.0, 150.0, 1), ("B", "Y"): (1, 10.0, 150.0, 1),
                   ("A", None): (2, 30.0, 225.0, 1), ("B", None): (1, 10.0, 150.0, 1), (None, "X"): (1, 10.0, 150.0, 1), (None, "Y"): (2, 30.0, 225.0, 1), (None, None): (2, 30.0, 225.0, 1)}


def test_slicers_reduce_facts(model):
    fact, bridges = model
    pick = lambda **chosen: sorted(r.movie_id for r in sliced(fact, bridges, chosen).collect())
    assert pick(genre=["A", "B"]) == [1, 2, 3] and pick(genre=["B"], country=["X"]) == [1] and pick(country=["none"]) == [] and pick() == [1, 2, 3, 4]
    got = {(r.genre): r.total_movies for r in kpi_by_slicer(fact, bridges, ["genre"], {"country": ["Y"], "genre": ["A"]}).collect()}
    assert got == {"A": 2, None: 2}


def test_year_comparison_has_blank_periods(spark):
    dates = [(20100105, 2010), (20110301, 2011), (20140401, 2014), (20200101, 2020)]
    dim = spark.createDataFrame([(k, f"{k // 10000}-{k // 100 % 100:02}-{k % 100:02}", y) for k, y in dates], "date_key int, d string, year int").selectExpr("date_key", "date(d) AS date_day", "year")
    fact = spark.createDataFrame([(20100105, 4.0), (20110301, 6.0), (20140401, 5.0), (20200101, None)], "date_key int, revenue double")
    got = {r.year: tuple(r)[1:] for r in analyses.calendar_yoy_revenue(fact, dim).collect()}
    assert got == {2010: (4.0, None, 4.0, 0.0), 2011: (6.0, 4.0, 2.0, 0.5), 2012: (None, 6.0, -6.0, -1.0), 2014: (5.0, None, 5.0, 0.0), 2015: (None, 5.0, -5.0, -1.0), 2020: (None, None, None, 0.0)}
    periods = {(r.grain, str(r.period_start)): (r.total_revenue, r.prev_calendar_year_revenue) for r in analyses.calendar_yoy_by_period(fact, dim).collect()}
    assert periods["month", "2011-01-01"] == (None, 4.0) and periods["quarter", "2011-01-01"] == (6.0, 4.0) and ("month", "2012-01-01") not in periods


def test_keep_first_over_runs_and_stops(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from marquee.streaming.incremental import incremental_keep_first, read_landed
    src, dst, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    os.makedirs(src)
    want = {}

    def file(n, pairs):
        path = f"{src}/f{n}.csv"
        with open(path, "w") as f:
            f.write("id,title\n" + "".join(f"{i or ''},{t}\n" for i, t in pairs))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        for i, t in pairs:
            if i:
                want.setdefault(i, t)

    def run():
        incremental_keep_first(spark, src, "id string, title string", dst, ck, "id", max_files_per_trigger=1)

    file(1, [("1", "a"), ("1", "b"), ("2", "c"), (None, "no id")])
    file(2, [("2", "later"), ("3", "d")] + [("4", f"hot{k}") for k in range(500)])
    run()
    assert {r.id: r.title for r in read_landed(spark, dst).collect()} == want
    file(3, [("3", "later"), ("5", "e")])
    file(4, [("5", "later"), ("6", "f")])
    real, calls = DataFrameWriter.parquet, []

    def stop(self, path, *a, **k):
        calls.append(path)
        if len(calls) == 2:  # the second batch of this run
            raise RuntimeError("stopped between batches")
        return real(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", stop)
    with pytest.raises(Exception, match="stopped"):
        run()
    monkeypatch.undo()
    run()
    run()  # nothing new
    got = read_landed(spark, dst).collect()
    assert {r.id: r.title for r in got} == want and len(got) == len(want)
    # a new checkpoint replaces
    incremental_keep_first(spark, src, "id string, title string", dst, str(tmp_path / "ck2"), "id")
    got = read_landed(spark, dst).collect()
    assert {r.id: r.title for r in got} == want and len(got) == len(want)
