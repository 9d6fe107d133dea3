"""Published tables: readers keep the version before, wherever a writer stops."""

import pytest

from marquee.sources import landing as L
from marquee.sources import publish as P


def rows(spark, ids):
    return spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, title string")


def ids(spark, root):
    return sorted(r.id for r in P.current(spark, root).collect())


def test_versions_and_cleaning(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        P.current(spark, root)
    assert [P.publish(rows(spark, [k]), root, keep=2) for k in (1, 2, 3)] == [1, 2, 3]
    assert ids(spark, root) == [3]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 2


@pytest.mark.parametrize("step", ["_write", "_point", "_clean"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_stop_at_any_step(spark, tmp_path, monkeypatch, step, when):
    root = str(tmp_path / "t")
    P.publish(rows(spark, [1]), root)
    real = getattr(P, step)

    def stop(*a):
        if when == "after":
            real(*a)
        raise KeyboardInterrupt(step)

    monkeypatch.setattr(P, step, stop)
    with pytest.raises(KeyboardInterrupt):
        P.publish(rows(spark, [2]), root)
    monkeypatch.undo()
    # the new version counts from its pointer on
    pointed = step == "_clean" or (step, when) == ("_point", "after")
    assert ids(spark, root) == ([2] if pointed else [1])
    P.publish(rows(spark, [3]), root)
    assert ids(spark, root) == [3]


def test_a_half_written_pointer_does_not_count(spark, tmp_path):
    root = str(tmp_path / "t")
    P.publish(rows(spark, [1]), root)
    (tmp_path / "t" / "pointers" / "00000002").write_text('{"version": 2, "data": "data-0')
    assert ids(spark, root) == [1]
    assert P.publish(rows(spark, [5]), root) == 3 and ids(spark, root) == [5]


def test_checks(spark, tmp_path):
    root = str(tmp_path / "t")
    P.publish(rows(spark, [1]), root, P.sound(["id"]))
    for bad, check in ((rows(spark, []), None), (rows(spark, [2, None]), P.sound(["id"])), (rows(spark, [2]), lambda df: False)):
        with pytest.raises(ValueError, match="previous version kept"):
            P.publish(bad, root, check)
        assert ids(spark, root) == [1]
    P.publish(rows(spark, []), root, P.sound(may_be_empty=True))
    assert ids(spark, root) == [] and P.current(spark, root).columns == ["id", "title"]


def test_two_writers(spark, tmp_path):
    root = str(tmp_path / "t")
    P.publish(rows(spark, [1]), root)
    store = P.Store(spark, root)
    with pytest.raises(Exception, match="exist"):
        P._point(store, 1, "data-x", 1, "id bigint")
    assert ids(spark, root) == [1]


def test_landing(spark, tmp_path):
    from marquee.sources.io import read_text_csv
    read = lambda s, p: read_text_csv(s, p, ["id", "title"], multiline=True).drop("ingest_seq")
    (tmp_path / "a.csv").write_text('id,title\n1,"two\nlines"\n2,b\n')
    (tmp_path / "head.csv").write_text("id,title\n")
    (tmp_path / "none.csv").write_text("")
    root = str(tmp_path / "landed")
    sources = {n: L.Source(f"{tmp_path}/{n}.csv", read) for n in ("a", "head", "none", "absent")}
    report = {r.dataset: (r.status, r.rows) for r in L.land(spark, root, sources).collect()}
    assert report == {"a": ("loaded", 2), "head": ("empty", 0), "none": ("empty", 0), "absent": ("missing", 0)}
    assert sorted(r.title for r in L.landed(spark, root, "a").collect()) == ["b", "two\nlines"]
    with pytest.raises(FileNotFoundError):
        L.landed(spark, root, "absent")
    (tmp_path / "a.csv").unlink()  # what landed before stays
    assert {r.status for r in L.land(spark, root, {"a": sources["a"]}).collect()} == {"missing"}
    assert L.landed(spark, root, "a").count() == 2
