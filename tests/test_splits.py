"""Records over line breaks: split reads against Python's own csv and json."""

import csv
import io
import json
import random

import pytest
from marquee.sources import splits as S

FIELDS = ["id", "title", "note"]


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "700")
    spark.conf.set(keys[1], "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def movies(seed, n):
    rng = random.Random(seed)
    parts = ["a, b", 'say "hi"', "two\nlines", "\n\n", '"', "plain", "", "é 語", "x" * 90, "cr\r\nlf", ' "\n" ']
    return [(str(i), "".join(rng.choice(parts) for _ in range(rng.randrange(0, 5))), rng.choice(["", "n", "long " * 400 if i % 41 == 0 else "k"])) for i in range(n)]


def write_csv(path, rows, end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(FIELDS)
    w.writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_equals_csv_module(spark, small_splits, tmp_path, end):
    rows = movies(1, 300)
    write_csv(tmp_path / "a.csv", rows, end)
    assert S.lines_of(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    got = S.read_csv_records(spark, str(tmp_path), ["title", "ID", "note", "none"]).orderBy("ingest_seq").collect()
    assert [(r.ID, r.title or "", r.note or "") for r in got] == rows
    assert {r.none for r in got} == {None}


def test_csv_many_files(spark, small_splits, tmp_path):
    want = []
    for k in range(4):
        rows = movies(k + 5, 60)
        write_csv(tmp_path / f"f{k}.csv", rows)
        want += rows
    got = S.read_csv_records(spark, str(tmp_path), FIELDS).orderBy("ingest_seq").collect()
    assert [(r.id, r.title or "", r.note or "") for r in got] == want


def test_csv_record_over_many_splits(spark, small_splits, tmp_path):
    rows = [("1", "line\n" * 2000, "a"), ("2", "b", ""), ("3", "line\n" * 900, "c")]
    write_csv(tmp_path / "a.csv", rows)
    got = S.read_csv_records(spark, str(tmp_path), FIELDS).orderBy("ingest_seq").collect()
    assert [(r.id, r.title, r.note or "") for r in got] == rows


def test_csv_edges(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,title,note\n")
    assert S.read_csv_records(spark, str(tmp_path / "h.csv"), FIELDS).collect() == []
    (tmp_path / "b.csv").write_text("id,title,note\n\n1,a,b\n   \n2,c,d")
    assert [r.id for r in S.read_csv_records(spark, str(tmp_path / "b.csv"), FIELDS).orderBy("ingest_seq").collect()] == ["1", "2"]
    (tmp_path / "bad.csv").write_text('id,title,note\n1,"a,b\n2,c,d\n')
    with pytest.raises(ValueError, match="inside a quoted field"):
        S.read_csv_records(spark, str(tmp_path / "bad.csv"), FIELDS)


def ratings(n):
    rng = random.Random(3)
    texts = ["plain", 'quote " and \\ back', "brackets ]}[{,", "comma, comma", "\\", '\\"', "line\nbreak", "é"]
    return [{"movie_id": i, "note": rng.choice(texts), "ratings_summary": rng.choice([None, {}, {"avg_rating": i / 4, "tags": [["a", "]"], []]}]), "last_rated": i if i % 3 else None} for i in range(n)]


@pytest.mark.parametrize("style", ["indented", "lines", "several", "odd"])
def test_json_array_equals_json_module(spark, small_splits, tmp_path, style):
    rows = ratings(200)
    dumped = [json.dumps(r) for r in rows]
    text = {"indented": json.dumps(rows, indent=2), "lines": "[\n" + ",\n".join(dumped) + "\n]\n", "odd": "[" + "\n,\n\n".join(dumped) + "]",
            "several": "[" + ",\n".join(", ".join(dumped[k: k + 7]) for k in range(0, 200, 7)) + "]"}[style]
    (tmp_path / "r.json").write_text(text)
    assert S.lines_of(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    got = S.read_json_array(spark, str(tmp_path), "movie_id bigint, note string, ratings_summary struct<avg_rating:double,tags:array<array<string>>>, last_rated bigint")
    want = {r["movie_id"]: (r["note"], (r["ratings_summary"] or {}).get("avg_rating"), r["last_rated"]) for r in rows}
    assert {r.movie_id: (r.note, r.ratings_summary and r.ratings_summary.avg_rating, r.last_rated) for r in got.collect()} == want


def test_json_edges(spark, tmp_path):
    schema = "movie_id bigint"
    for k, (text, want) in enumerate([("[]", []), ("[\n\n]", []), ('[{"movie_id": 1}]', [1]), (' \n[ {"movie_id": 2}\n ,\n{"movie_id": 3} ] \n', [2, 3])]):
        (tmp_path / f"{k}.json").write_text(text)
        assert sorted(r.movie_id for r in S.read_json_array(spark, str(tmp_path / f"{k}.json"), schema).collect()) == want
    (tmp_path / "open.json").write_text('[{"movie_id": 1}\n,{"movie_id": 2')
    with pytest.raises(ValueError, match="not closed"):
        S.read_json_array(spark, str(tmp_path / "open.json"), schema)
