from pyspark.sql import functions as F

from marquee.llm import url_filter as U

CASES = [
    (1, "http://Example.ORG/es/a", "example.org", "/es/a", "example.org/es/", "block"),
    (2, "https://sub.example.org/en/17?x=1", "sub.example.org", "/en/17", "example.org/en/1", "block"),
    (3, "https://notexample.org/es/a", "notexample.org", "/es/a", "org/", "allow"),
    (4, "https://a.com/fr/1", "a.com", "/fr/1", "com/fr/", "allow"),
    (5, "https://a.com/de/1#f", "a.com", "/de/1", "com/de/", "block"),
    (6, "https://a.net/listed.html?utm_source=x", "a.net", "/listed.html", None, "block"),
    (7, "http://www.a.net/listed/", "www.a.net", "/listed/", None, "block"),
    (8, "http://a.net/other", "a.net", "/other", None, "allow"),
    (9, None, "", "", None, "allow"),
    (10, "no scheme", "", "", None, "allow"),
    (11, "", "", "", None, "allow"),
    (12, "http://org", "org", "", None, "allow"),
    (13, "x://a.org?q=/es/", "a.org", "", None, "allow"),
    (14, "a://b://c.org/", "b:", "//c.org/", None, "allow"),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string")


def test_contract_cases(spark):
    listed = pages(spark, [(0, "a.net/listed"), (0, "a.net/listed"), (0, None)]).select("url")
    df = pages(spark, [(c[0], c[1]) for c in CASES]).withColumns({"verdict": F.lit("old"), "block": F.lit(1), "w0": F.lit(2)})
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(df, listed).collect()}
    assert got == {c[0]: c[2:] for c in CASES}


def test_filter_has_no_false_negatives_and_join_removes_false_positives(spark, monkeypatch):
    monkeypatch.setattr(U.BloomShape, "for_keys", classmethod(lambda cls, n: cls(1, 2)))  # one small block: nearly all bits set
    listed = spark.range(400).select(F.concat(F.lit("h.net/p"), F.col("id").cast("string")).alias("u"))
    df = spark.range(1200).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.net/p"), F.col("id").cast("string")).alias("url"))
    got = {r.page_id: r.listed for r in U.judge_urls(df, listed).collect()}
    assert all(got[i] == (i < 400) for i in range(1200))


def test_filter_passes_few_others(spark):
    listed = spark.range(4000).select(F.concat(F.lit("in"), F.col("id").cast("string")).alias("canonical"))
    shape = U.BloomShape.for_keys(4000)
    bloom = U.build_filter(listed, shape)
    probe = spark.range(4000).select(F.concat(F.lit("out"), F.col("id").cast("string")).alias("canonical"))

    def passed(df):
        j = df.withColumn("b", U._block(F.col("canonical"), shape)).join(bloom, F.col("b") == F.col("__op_at"))
        hit = F.lit(True)
        for i in range(shape.words):
            mask = U._mask(F.col("canonical"), i)
            hit = hit & (F.col(f"__op_w{i}").bitwiseAND(mask) == mask)
        return j.where(hit).count()

    assert passed(listed) == 4000 and passed(probe) < 400


def test_repeated_rows_empty_list_and_table(spark):
    empty = pages(spark, []).select("url")
    df = pages(spark, [(1, "http://a.net/x")] * 50 + [(None, None)] * 3)
    assert [r.verdict for r in U.judge_urls(df, empty).collect()] == ["allow"] * 53
    assert U.judge_urls(pages(spark, []), empty).collect() == []
    long = "http://a.net/" + "y" * 100_000
    assert U.judge_urls(pages(spark, [(1, long)]), pages(spark, [(1, long[7:])]).select("url")).first().verdict == "block"
