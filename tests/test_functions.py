"""Scalar functions on the hand-made edge rows of FIXTURES.md section 3."""

import datetime as dt

from pyspark.sql import functions as F

from marquee.functions import (epoch_to_timestamp, literal_names_array, literal_names_text, normalize_title,
                               parse_mixed_date, pct_change, rint_bigint, round_dec, split_csv_list,
                               to_number, to_positive_number)


def col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_parse_mixed_date(spark):
    vals = ["2016-04-22", "11/01/1996", "17-10-2008", " 1/2/2016 ", "03/04/2000", "2016-02-30", "abc", "", None]
    got = [r[0] for r in col(spark, vals).select(parse_mixed_date("v")).collect()]
    assert got == [dt.date(2016, 4, 22), dt.date(1996, 11, 1), dt.date(2008, 10, 17), dt.date(2016, 1, 2),
                   dt.date(2000, 3, 4), None, None, None, None]


def test_parse_written_dates(spark):
    day = ["Jan 5 2016", "January 5, 2016", "january 5th 2016", "Jan. 5 '16", "5 January 2016", "5th of Jan, 2016", "5-Jan-2016", "05-jan-16", "2016/1/5", "2016.01.05",
           "Tuesday, Jan 5 2016", "tue 5 jan 2016", "1/5/16", "  JAN 5 2016 "]
    got = [r[0] for r in col(spark, day).select(parse_mixed_date("v")).collect()]
    assert dict(zip(day, got)) == dict.fromkeys(day, dt.date(2016, 1, 5))
    other = {"January 2016": dt.date(2016, 1, 1), "Sept 30 1999": dt.date(1999, 9, 30), "1/5/69": dt.date(1969, 1, 5), "1/5/68": dt.date(2068, 1, 5), "may 1 2000": dt.date(2000, 5, 1),
             "Feb 30 2016": None, "Janu 5 2016": dt.date(2016, 1, 5), "Janx 5 2016": None, "ma 5 2016": None, "Jan 2016 5": None, "5 2016": None, "unknown": None, "2016/13/5": None,
             "Jan 5": None, "n/a": None, "the 5 of 2016": None}
    got = [r[0] for r in col(spark, list(other)).select(parse_mixed_date("v")).collect()]
    assert dict(zip(other, got)) == other


def test_normalize_title_modes(spark):
    vals = ["The Matrix", "AVATAR", "up  in the air!", "a\\ssb", "Se7en", "", None]
    rows = col(spark, vals).select(normalize_title("v", "intent").alias("i"),
                                   normalize_title("v", "as_written").alias("w")).collect()
    assert [r.i for r in rows] == ["the matrix", "avatar", "up in the air", "a ssb", "se7en", "", None]
    # as written: capitals are stripped before lower-casing, blanks never collapse
    assert [r.w for r in rows][:3] == ["he  atrix", "", "up  in the air"]


def test_numeric_coercion(spark):
    vals = ["12.0", " 7 ", "abc", "NaN", "0", "-5", "1,000", None]
    rows = col(spark, vals).select(to_number("v").alias("n"), to_positive_number("v").alias("p")).collect()
    assert [r.n for r in rows] == [12.0, 7.0, None, None, 0.0, -5.0, None, None]
    assert [r.p for r in rows] == [12.0, 7.0, None, None, None, None, None, None]


def test_literal_lists(spark):
    vals = ["[{'iso': 'CI', 'name': \"Cote D'Ivoire\"}]", "[]", "False", "{'name': 'x'}",
            "[{'iso': 'US', 'name': None}, {'iso': 'FR', 'name': 'France'}]",
            "[{'name': 'A, B'}]", "[{'name': 'Espa\\xf1ol'}]", "not a list", None]
    rows = col(spark, vals).select(literal_names_text("v").alias("t"),
                                   F.size(literal_names_array("v")).alias("n")).collect()
    assert [r.t for r in rows] == ["Cote D'Ivoire", "", "False", "{'name': 'x'}", "France", "A, B", "Español",
                                   "not a list", None]
    assert [r.n for r in rows] == [1, 0, 0, 0, 1, 1, 1, 0, 0]


def test_split_csv_list(spark):
    rows = col(spark, ["Drama, Comedy,,", "", None]).select(split_csv_list("v").alias("a")).collect()
    assert [r.a for r in rows] == [["Drama", "Comedy"], [], []]


def test_epoch_to_timestamp(spark):
    rows = col(spark, [1425941529, 0, None], "bigint").select(
        epoch_to_timestamp("v").alias("t"), epoch_to_timestamp("v", zero_is_null=False).alias("z")).collect()
    assert rows[0].t == dt.datetime(2015, 3, 9, 22, 52, 9)
    assert rows[1].t is None and rows[1].z == dt.datetime(1970, 1, 1)
    assert rows[2].t is None


def test_rounding_and_pct(spark):
    df = spark.createDataFrame([(1.005, 3.5, 110.0, 100.0), (2.675, 2.5, 5.0, 0.0)], "a double, b double, c double, p double")
    rows = df.select(round_dec("a").alias("r"), rint_bigint("b").alias("i"), pct_change("c", "p").alias("g")).collect()
    assert [r.r for r in rows] == [1.01, 2.68]          # half-up on the decimal value
    assert [r.i for r in rows] == [4, 2]                 # half-even like the warehouse cast
    assert [r.g for r in rows] == [10.0, None]           # only when prev > 0


def test_country_tokens_intent_keeps_commas(spark):
    from marquee.functions.text import literal_or_csv_tokens
    vals = ["[{'iso': 'KR', 'name': 'Korea, Republic of'}, {'iso': 'FR', 'name': 'France'}]", "[]",
            "France, Spain", None]
    rows = col(spark, vals).select(literal_or_csv_tokens("v").alias("t")).collect()
    assert [r.t for r in rows] == [["Korea, Republic of", "France"], [], ["France", "Spain"], []]
    # as written: join then split breaks the name
    joined = col(spark, vals[:1]).select(split_csv_list(literal_names_text("v")).alias("t")).first().t
    assert joined == ["Korea", "Republic of", "France"]


def test_literals_keep_names_whole(spark):
    from marquee.functions import literal_names_array, literal_names_text
    vals = ["[{'name': 'A: None B'}, {'name': \"it's True, 'x'\"}]", "[{'name': 'a'},]", "[1, 2]", "[{'iso': None, 'name': 'b'}, 3, {'ok': True}]", "[{'name': 'a'"]
    rows = col(spark, vals).select(literal_names_text("v").alias("t"), literal_names_array("v").alias("a")).collect()
    assert [r.t for r in rows] == ["A: None B,it's True, 'x'", "a", "", "b", "[{'name': 'a'"]
    assert rows[0].a == ["A: None B", "it's True, 'x'"] and rows[2].a == [] and rows[3].a == ["b"]


def test_numbers_are_plain(spark):
    from marquee.functions import to_number
    vals = ["5d", "5f", "0x1F", "NaN", "Infinity", " 12.50 ", "-.5", "1e3", "1.", "", "1,000", None]
    assert [r[0] for r in col(spark, vals).select(to_number("v")).collect()] == [None] * 5 + [12.5, -0.5, 1000.0, 1.0, None, None, None]
