import base64
import hashlib
import os

from marquee.llm import warc as W

from .helpers import SF


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, sha string, last long")


def row(i, html, url="http://a.net/"):
    return (i, url, html, "clash", "clash", 1)


def expect(rows, least=0):
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        same = [x[0] for x in rows if (x[2] or "") == (html or "") and x[0] is not None]
        top = max(same) if same and len(data) >= least else None
        visit = top is not None and top != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if visit else "response", top if visit else None, True))
    return sorted(out, key=repr)


def run(spark, df, root, **kw):
    o = W.WarcOptions(**kw)
    m = W.write_warc(df, str(root), o, 3)
    got = W.read_warc(m, str(root)).collect()
    return m.collect(), sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.digest_ok) for r in got), key=repr), got


ROWS = [row(1, "<p>a</p>"), row(2, "<p>a</p>"), row(3, None), row(4, ""), row(5, "x" * 300_000), row(5, "x" * 300_000), row(6, "x" * 300_000), row(None, "<p>a</p>"),
        row(None, "only here"), row(9, "é ü\r\n\r\nWARC/1.1\r\n"), row(10, "z", None), row(11, "z2", ""), row(12, "z3", "http://a/ b\r\nX: y")]


def test_round_trip_and_revisits(spark, tmp_path):
    manifest, got, full = run(spark, pages(spark, ROWS), tmp_path / "w")
    assert got == expect(ROWS) and sum(m.records for m in manifest) == len(ROWS)
    by = {(r.page_id, r.record_type): r for r in full}
    assert by[(9, "response")].payload.decode() == ROWS[9][2] and by[(1, "revisit")].payload is None
    assert "\r" not in by[(12, "response")].url and not os.path.exists(tmp_path / "w" / "_temporary")
    for m in manifest:
        assert hashlib.sha256((tmp_path / "w" / m.file).read_bytes()).hexdigest() == m.sha256


def test_small_payloads_are_no_revisits(spark, tmp_path):
    _, got, _ = run(spark, pages(spark, ROWS), tmp_path / "w", least_revisit=100)
    assert got == expect(ROWS, 100)


def test_files_roll_and_bytes_repeat(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    a, got, _ = run(spark, df, tmp_path / "a", file_bytes=8_000)
    b, again, _ = run(spark, df.repartition(5), tmp_path / "b", file_bytes=8_000)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and got == again and len(a) > 3
    assert got == expect([(r.page_id, r.url, r.html) for r in df.collect()])


def test_same_bytes_under_any_partitioning_and_settings(spark, tmp_path):
    """60,000 pages, a third without an id, a sixth equal in everything."""
    from pyspark.sql import functions as F
    i = F.col("id")
    df = spark.range(60_000).select(F.when(i % 3 != 0, F.when(i % 6 == 1, F.lit(-77)).otherwise(i)).alias("page_id"), F.when(i % 6 == 1, F.lit("u")).otherwise(F.concat(F.lit("http://h/"), (i % 50).cast("string"))).alias("url"),
                                    F.when(i % 6 == 1, F.lit("same")).when(i % 9 == 0, F.lit("")).otherwise(F.repeat(F.sha1(i.cast("string")), 3)).alias("html"))
    seen = []
    for parts, shuffle in ((1, "3"), (7, "8"), (40, "19")):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        try:
            m = W.write_warc(df.repartition(parts), str(tmp_path / shuffle), W.WarcOptions(shard_bytes=1 << 21))
            seen.append(sorted(map(tuple, m.collect())))
            if shuffle == "8":
                back = W.read_warc(m, str(tmp_path / shuffle))
                assert back.where("NOT digest_ok").count() == 0 and back.where("page_id IS NULL").count() == 20_000
                assert back.where("page_id = -77").select("record_type").distinct().count() == 1 and back.where("page_id = -77").count() == 10_000
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 64
    records = [m[3] for m in seen[0]]
    assert sum(records) == 60_000 and max(records) < 2 * 60_000 / 64


def test_record_ids_are_unique_over_shards(spark, tmp_path):
    rows = [row(5, "x" * 40)] * 30 + [row(5, "y" * 40, f"u{k}") for k in range(30)] + [row(None, "n")] * 40 + [row(None, f"n{k}") for k in range(20)]
    m = W.write_warc(pages(spark, rows), str(tmp_path / "w"), shards=9)
    ids = []
    for f in m.collect():
        with open(tmp_path / "w" / f.file, "rb") as stream:
            ids += [h["WARC-Record-ID"] for _, h, _ in W._records(stream) if h["WARC-Type"] != "warcinfo"]
    assert len(ids) == len(set(ids)) == 120 and {"<urn:page:5>", "<urn:page:5:59>", "<urn:page:null:59>"} <= set(ids)
    assert m.select("shard").distinct().count() == 9


def test_every_member_is_gzip_and_has_its_record(spark, tmp_path):
    import gzip
    m, _, full = run(spark, pages(spark, ROWS[:5]), tmp_path / "w")
    for r in full:
        data = (tmp_path / "w" / r.file).read_bytes()[r.offset:]
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())


def test_empty_table(spark, tmp_path):
    manifest, got, _ = run(spark, pages(spark, []), tmp_path / "w")
    assert manifest == [] and got == []


def test_damage_is_noticed(spark, tmp_path):
    import io
    rec = W.page_record(1, 0, "u", b"payload", W.base32_sha1(b"payload"), None, False, W.WarcOptions())
    assert [h["WARC-Type"] for _, h, _ in W._records(io.BytesIO(rec + rec))] == ["response"] * 2
    try:
        list(W._records(io.BytesIO(rec + rec[:-9])))
        raise AssertionError("no error")
    except ValueError:
        pass
