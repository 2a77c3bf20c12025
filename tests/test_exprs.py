import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendlens.functions import exprs


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(row,) for row in rows], schema)
    make = column(df) if callable(column) else column
    return [r[0] for r in df.select(make).collect()]


def test_title_case_breaks_words_at_every_non_letter(spark):
    texts = ["in progress", "on-hold", "they're DONE", "4th item", "a\tb", "", None]
    got = values(spark, texts, "x string", exprs.title_case(F.col("x")))
    assert got == [t.title() if t is not None else None for t in texts]


def test_lenient_numbers(spark):
    got = values(spark, ["1.5", "abc", None, " 7 "], "x string", lambda df: exprs.as_double(df, "x"))
    assert got == [1.5, None, None, 7.0]


def test_lenient_dates_need_a_full_iso_day(spark):
    texts = ["2024-02-29", "2023-02-29", "2024", "not-a-date", None]
    got = values(spark, texts, "x string", lambda df: exprs.as_date(df, "x"))
    assert got == [dt.date(2024, 2, 29), None, None, None, None]


@pytest.mark.parametrize("trim, expected", [(True, [None, None, None, None, "7"]), (False, [None, None, None, " ", "7"])])
def test_blank_to_null(spark, trim, expected):
    got = values(spark, ["", "None", "nan", " ", "7"], "x string", exprs.blank_to_null(F.col("x"), trim=trim))
    assert got == expected


def test_percentage_without_a_positive_whole_is_zero(spark):
    df = spark.createDataFrame([(9.0, 10.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(exprs.percentage(F.col("a"), F.col("b"))).collect()] == [90.0, 0.0, 0.0]


def test_email_base(spark):
    names = ["Ann Lee", " Ann  van der Lee ", "Cher", "José O'Neil", "R2-D2", "123", "", None]
    got = values(spark, names, "x string", exprs.email_base(F.col("x")))
    assert got == ["ann.lee", "ann.lee", "cher", "josé.oneil", "rd", "", "", ""]


def test_gaussian_is_repeatable_and_standard(spark):
    df = spark.range(20_000).select(exprs.gaussian(7, F.col("id")).alias("z"), exprs.gaussian(7, F.col("id")).alias("again"))
    row = df.agg(F.avg("z"), F.stddev("z"), F.count_if(F.col("z") != F.col("again"))).first()
    assert abs(row[0]) < 0.03 and abs(row[1] - 1) < 0.03 and row[2] == 0
