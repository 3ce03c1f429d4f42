"""Edge frames for the rules that differ between engines: NULL, ties, bounds, rounding, weeks."""

import datetime as dt

from pyspark.sql import functions as F

from tidegrain.functions import dates as D
from tidegrain.functions import numbers as N
from tidegrain.functions import text as X
from tidegrain.operators import joins as J
from tidegrain.operators import ranking as R


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} {t}" for n, t in zip(names, [_type(v) for v in cols.values()])))
    return df.select(expr.alias("x")).first()["x"]


def _type(v):
    return {int: "bigint", float: "double", str: "string", type(None): "double", dt.datetime: "timestamp_ntz", dt.date: "date"}[type(v)]


def test_two_value_minimum_is_null_when_either_is(spark, rows):
    df = spark.createDataFrame([(0, None), (1, 2)], "a int, b int")
    assert rows(df.select(N.min2(F.col("a"), F.col("b")), N.max2(F.col("a"), F.col("b")))) == [(1, 2), (None, None)]


def test_half_up_and_half_even(spark, rows):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[1] for r in sorted(df.select("x", N.half_up(F.col("x"), 0)).collect())] == [-3.0, 1.0, 2.0, 3.0]
    assert [r[1] for r in sorted(df.select("x", N.half_even(F.col("x"), 0)).collect())] == [-2.0, 0.0, 2.0, 2.0]


def test_last_day_is_whole(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 23, 59),), (dt.datetime(2024, 4, 1),)], "t timestamp_ntz")
    assert df.where(D.between_days(F.col("t"), "2024-01-01", "2024-03-31")).count() == 1


def test_not_in_with_null(spark, rows):
    keys = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(J.not_in(keys, "k", spark.createDataFrame([(1,)], "v int"), "v")) == [(2,)]
    assert rows(J.not_in(keys, "k", spark.createDataFrame([(1,), (None,)], "v int"), "v")) == []
    assert len(rows(J.not_in(keys, "k", spark.createDataFrame([], "v int"), "v"))) == 3


def test_weeks_and_weekend(spark, rows):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2021, 1, 3), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r[0]: (r[1], r[2]) for r in df.select("d", D.week_monday(F.col("d")), D.is_weekend(F.col("d"))).collect()}
    assert got == {d: (int(d.strftime("%W")), d.weekday() >= 5) for d in days}


def test_day_gap_rounds_or_truncates(spark):
    a, b = dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 3, 11)
    gap = D.day_gap(F.col("b"), F.col("a"))
    assert one(spark, N.half_up(gap, 0), a=a, b=b) == 2.0
    assert one(spark, F.floor(gap), a=a, b=b) == 1


def test_email_domain(spark, rows):
    df = spark.createDataFrame([("a@b.com",), ("noat",), ("a@b@c",), (None,)], "e string")
    assert sorted((r[0] for r in df.select(X.email_domain(F.col("e"))).collect()), key=str) == [None, "b.com", "b@c", "noat"]


def test_default_out_of_range_also_replaces_null(spark):
    e = N.default_out_of_range(F.col("x"), 1, 360, 180.0)
    assert one(spark, e, x=0.0) == 180.0 and one(spark, e, x=360.0) == 360.0 and one(spark, e, x=None) == 180.0


def test_ties_kept_or_not(spark, rows):
    df = spark.createDataFrame([("g", 1, 5), ("g", 2, 5), ("g", 3, 4), ("h", 4, 1)], "g string, id int, v int")
    assert rows(R.top_of_group(df, ["g"], "v"), "id") == [(1,), (2,), (4,)]
    assert rows(R.first_per_key(df, ["g"], [F.col("v").desc(), F.col("id")]), "id") == [(1,), (4,)]
    assert rows(R.keep_top_ranked(df, "v", 2, "r"), "id", "r") == [(1, 1), (2, 1)]
    assert rows(R.keep_top_ranked(df, "v", 3, "r"), "id", "r") == [(1, 1), (2, 1), (3, 3)]
    assert rows(R.dense_top(df, ["g"], "v", 1, "r"), "id", "r") == [(1, 1), (2, 1), (4, 1)]


def test_top_ranked_with_nulls_and_no_rows(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 7), (3, None)], "id int, v int")
    assert rows(R.keep_top_ranked(df, "v", 3, "r"), "id", "r") == [(2, 1)]
    assert rows(R.keep_top_ranked(df.limit(0), "v", 3, "r"), "id", "r") == []


def test_group_stats_treat_null_as_a_group(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "k string, v int")
    for stage in (False, True):
        assert rows(R.with_group_stats(df, ["k"], stage=stage, s=F.sum("v")), "v", "s") == [(1, 4), (3, 4), (5, 5)]


def test_titles_and_text(spark, rows):
    df = spark.createDataFrame([("*hello   WORLD of USA#",), ("STAIRWAY TO HEAVEN",), ("  ",), (None,), ("the USA",)], "t string")
    got = [r[0] for r in df.select(X.clean_title(F.col("t"))).collect()]
    assert got == ["Hello WORLD Of USA", "Stairway To Heaven", "Unknown Track", "Unknown Track", "The USA"]
    assert one(spark, X.clean_text(F.col("t")), t="  #heLLo (World)% ") == "Hello world"
    assert one(spark, X.strip_thousands(F.col("t")), t="1,234,567") == 1234567
    assert one(spark, X.strip_thousands(F.col("t")), t="n/a") is None
    assert one(spark, X.decimal_comma(F.col("t")), t="12,5") == 12.5
    assert one(spark, X.mask_secret(F.col("t"), F.lit("Production")), t="abc") == "***"
    assert one(spark, X.mask_secret(F.col("t"), F.lit("Nowhere")), t="abc") is None


def test_hour_range(spark):
    assert one(spark, F.date_format(D.parse_hour_range(F.col("d"), F.col("h")), "yyyy-MM-dd HH"), d="05/03/2024", h="07-08") == "2024-03-05 07"
    assert one(spark, D.parse_hour_range(F.col("d"), F.col("h")), d="2024", h="07-08") is None


def test_tariff_periods(spark):
    def tariff(text):
        return one(spark, D.tariff_period(F.col("t").cast("timestamp")), t=text)

    expected = {h: "P3" for h in range(0, 8)} | {h: "P2" for h in (8, 9, 14, 15, 16, 17, 22, 23)} | {h: "P1" for h in (10, 11, 12, 13, 18, 19, 20, 21)}
    for h in (0, 7, 8, 10, 13, 14, 17, 18, 21, 22, 23):
        assert tariff(f"2026-05-13 {h:02d}:30:00") == expected[h]
    assert tariff("2026-05-16 11:00:00") == "P6" and tariff("2026-12-25 11:00:00") == "P6"
