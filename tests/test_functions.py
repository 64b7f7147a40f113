"""Parsing, dates and JSON on small hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import dates, text
from millrace.sources.messages import encode_json
from millrace.sources.replay import number_table, rows_table


def one(df):
    return tuple(df.first())


def lines(spark, *values):
    return rows_table(spark, [(v,) for v in values], schemas.LINE)


def test_person_line(spark):
    line = "41:Maren:Sol:Vik:X:1984-02-03:none:1200"
    person = one(text.parse_delimited(lines(spark, line), schemas.PERSON, ":"))
    assert person == (41, "Maren", "Sol", "Vik", "X", dt.date(1984, 2, 3), "none", 1200)


def test_bad_lines_are_kept_and_marked(spark):
    parsed = text.parse_delimited(
        lines(spark, "video,3,10", "video,x,10", "video"), schemas.SOCIAL_POST, valid="ok"
    )
    assert [tuple(r) for r in parsed.collect()] == [
        ("video", 3, 10, True),
        ("video", None, 10, False),
        ("video", None, None, False),
    ]


def test_delimiter_is_not_a_pattern(spark):
    parsed = text.parse_delimited(lines(spark, "a|1"), "name string, n int", "|")
    assert one(parsed) == ("a", 1)


def test_words_drop_empty_pieces(spark):
    found = [r.word for r in text.words(lines(spark, " a  bb ", "")).collect()]
    assert found == ["a", "bb"]


def test_blank_lines_are_lines(spark):
    found = [r.value for r in text.lines(lines(spark, "a\n\nb", ""), "value").collect()]
    assert found == ["a", "", "b", ""]


def test_first_and_middle_names(spark):
    people = rows_table(spark, [("Ann", "Bea"), ("Cid", "Dee")], "first string, middle string")
    names = text.explode_columns(people, ["first", "middle"], "name")
    assert [r.name for r in names.collect()] == ["Ann", "Bea", "Cid", "Dee"]


def test_path_segment_out_of_range_is_null(spark):
    assert one(text.path_segments(lines(spark, "a/b"), "value", {1: "x", 5: "y"})) == ("b", None)


def test_malformed_json_gives_nulls(spark):
    rows = text.json_records(lines(spark, "{bad", '{"a":"x","b":"k"}'), "a int, b string")
    assert [tuple(r) for r in rows.collect()] == [(None, None), (None, "k")]


def test_json_encoding_omits_nulls(spark):
    row = rows_table(spark, [(None, "x")], "a int, b string")
    assert one(encode_json(row, F.col("b"), ["a", "b"])) == ("x", '{"b":"x"}')


def test_age_in_calendar_years(spark):
    cases = [
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
        ("1990-11-24", "2020-11-23", 29),
        ("1990-11-24", "2020-11-24", 30),
    ]
    rows = rows_table(spark, cases, "born string, today string, age int")
    ages = rows.select(
        "age", dates.age_years(F.to_date("born"), F.to_date("today")).alias("computed")
    )
    assert all(r.age == r.computed for r in ages.collect())


def test_epoch_millis(spark):
    row = rows_table(spark, [(7500,)], "ms long").select(dates.from_millis(F.col("ms")))
    assert one(row) == (dt.datetime(1970, 1, 1, 0, 0, 7, 500_000),)


def test_full_name(spark):
    row = rows_table(spark, [("Ann", "Bee")], "a string, b string")
    assert one(row.select(dates.full_name("a", "b"))) == ("Ann Bee",)


def test_number_table(spark):
    doubled = number_table(spark, 1_000_000).select((F.col("number") * 2).alias("d"))
    assert one(doubled.agg(F.sum("d"), F.max("d"))) == (1_000_001_000_000, 2_000_000)
