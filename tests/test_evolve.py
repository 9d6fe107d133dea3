"""Tables whose columns grow: added, widened and missing columns."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from marquee.sources import evolve as E


def got(spark, root, **kw):
    df = E.read(spark, root, **kw)
    return df.columns, sorted((tuple(r) for r in df.collect()), key=repr)


def test_added_widened_and_missing_columns(spark, tmp_path):
    root = str(tmp_path / "t")
    assert E.append(spark.createDataFrame([(1, "a", 7)], "Id int, title string, n smallint"), root) == ["Id", "title", "n"]
    assert E.append(spark.createDataFrame([(1 << 40, "b", 70_000, True)], "id long, TITLE string, n int, flag boolean"), root) == ["flag"]
    assert E.append(spark.createDataFrame([(3,)], "ID short"), root) == []
    columns, rows = got(spark, root)
    assert columns == ["Id", "title", "n", "flag"]
    assert rows == sorted([(1, "a", 7, None), (1 << 40, "b", 70_000, True), (3, None, None, None)], key=repr)
    assert [f.dataType.simpleString() for f in E.read(spark, root).schema.fields] == ["bigint", "string", "int", "boolean"]
    assert got(spark, root, version=1) == (["Id", "title", "n"], [(1, "a", 7)])
    with pytest.raises(FileNotFoundError):
        E.read(spark, root, version=9)


def test_one_scan_a_schema_and_compaction(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(4):
        E.append(spark.createDataFrame([(k,)], "a int"), root)
    E.append(spark.createDataFrame([(9, "x")], "a int, `b.c d` string"), root)
    plan = E.read(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    before = got(spark, root)
    assert E.compact(spark, root, keep=1) == 6 and got(spark, root) == before
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 1


def test_a_filter_reaches_the_scans(spark, tmp_path):
    root = str(tmp_path / "t")
    E.append(spark.createDataFrame([(1, "a")], "id long, t string"), root)
    E.append(spark.createDataFrame([(2, "b", 1)], "id long, t string, n int"), root)
    plan = E.read(spark, root).where("id = 2").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(id,2)") == 2 and plan.count("ReadSchema: struct<id:bigint>") == 2


def test_refused_appends_leave_the_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    E.append(spark.createDataFrame([(1, [1])], "id long, xs array<int>"), root)
    for rows, schema in (([(1.5,)], "id double"), ([("a",)], "xs string"), ([(1, 2)], "A int, b int")):
        df = spark.createDataFrame(rows, schema)
        with pytest.raises(ValueError):
            E.append(df.withColumnsRenamed({"A": "B"}) if schema == "A int, b int" else df, root)
    with pytest.raises(ValueError):
        E.append(spark.createDataFrame([(None, None)], "id long, xs array<int>"), root, check=lambda df: df.where("id IS NULL").isEmpty())
    monkeypatch.setattr(E.Store, "create", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        E.append(spark.createDataFrame([(2, [2])], "id long, xs array<int>"), root)
    monkeypatch.undo()
    (tmp_path / "t" / "pointers" / "00000007").write_text('{"version": 7, "sch')
    assert got(spark, root) == (["id", "xs"], [(1, [1])])
    E.append(spark.createDataFrame([(3, None)], "id long, xs array<int>"), root)
    assert [r[0] for r in got(spark, root)[1]] == [1, 3]


@pytest.mark.parametrize("a,b,want", [("tinyint", "bigint", "bigint"), ("int", "double", "double"), ("float", "smallint", "double"), ("float", "double", "double"), ("int", "string", "string"),
                                      ("date", "timestamp", "timestamp"), ("decimal(10,2)", "decimal(9,4)", "decimal(12,4)"), ("bigint", "decimal(5,3)", "decimal(22,3)"), ("boolean", "string", "string"),
                                      ("bigint", "double", None), ("decimal(38,0)", "decimal(10,9)", None), ("boolean", "int", None), ("array<int>", "array<string>", None)])
def test_wider(a, b, want):
    a, b = (T.StructType.fromDDL(f"x {t}").fields[0].dataType for t in (a, b))
    for pair in ((a, b), (b, a)):
        if want is None:
            with pytest.raises(ValueError):
                E.wider(*pair)
        else:
            assert E.wider(*pair).simpleString() == want


def test_values_survive_widening(spark, tmp_path):
    root = str(tmp_path / "t")
    E.append(spark.createDataFrame([(dt.date(2020, 1, 2), 7)], "d date, n int"), root)
    E.append(spark.createDataFrame([(dt.datetime(2020, 1, 3, 4), "x")], "d timestamp, n string"), root)
    assert got(spark, root)[1] == [(dt.datetime(2020, 1, 2), "7"), (dt.datetime(2020, 1, 3, 4), "x")]


def test_empty_append(spark, tmp_path):
    root = str(tmp_path / "t")
    E.append(spark.createDataFrame([], "id long"), root)
    assert E.append(spark.createDataFrame([], "id long, x int"), root) == ["x"] and got(spark, root) == (["id", "x"], [])
