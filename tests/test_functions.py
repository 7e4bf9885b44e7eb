import random
from datetime import date
from fractions import Fraction

from pyspark.sql import functions as F

from helpers import half_up
from regiopanel.functions import (
    day_from_parts,
    day_from_text,
    day_text,
    decimal_comma,
    int_div,
    month_window,
    padded_key,
    percent_text,
    ratio_or_zero,
    round_ratio,
)


def test_round_ratio_equals_exact_arithmetic(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(-5000, 5000), rng.randint(-300, 300)) for _ in range(2000)]
    pairs += [(201, 200), (1, 8), (-1, 8), (1, -8), (10**12, 3), (0, 7)]
    pairs = [(n, d) for n, d in pairs if d]
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)], "i int, n long, d long")
    out = df.select("i", round_ratio("n", "d", 2).alias("r"), round_ratio("n", "d", 1, 1000).alias("s")).collect()
    for row in out:
        n, d = pairs[row.i]
        assert row.r == half_up(Fraction(n, d), 2), (n, d)
        assert row.s == half_up(Fraction(n * 1000, d), 1), (n, d)


def test_round_ratio_without_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 2)], "n long, d long")
    assert [r[0] for r in df.select(round_ratio("n", "d", 2)).collect()] == [None, None, None]
    assert [r[0] for r in df.select(ratio_or_zero("n", "d", 2)).collect()] == [0.0, 0.0, 0.0]


def test_dates(spark):
    df = spark.createDataFrame(
        [("2020/12/18 00:00:00+00", "18.12.2021, 00:00 Uhr"), ("2020-12-18", "18.12.2021"), ("2021-13-01", "x")],
        "a string, b string",
    )
    out = df.select(day_from_text("a"), day_from_parts("b"), day_text(day_from_parts("b"))).collect()
    good = (date(2020, 12, 18), date(2021, 12, 18), "18.12.2021")
    assert [tuple(r) for r in out] == [good, good, (None, None, None)]


def test_month_window_reaches_the_scan(spark, tmp_path):
    days = spark.sql("select explode(sequence(date'2021-11-01', date'2022-01-31')) as d")
    days.write.parquet(str(tmp_path / "d"))
    hit = spark.read.parquet(str(tmp_path / "d")).filter(month_window("d", 2021, 12, first_day=10))
    assert hit.count() == 22
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2021-12-10)" in plan and "LessThan(d,2022-01-01)" in plan


def test_export_texts(spark):
    df = spark.createDataFrame([(1001, 0.0001, 0.0182), (11000, 70.0, 0.5), (7, -1.25, 0.0)], "k int, x double, p double")
    out = [tuple(r) for r in df.select(padded_key("k"), decimal_comma("x"), percent_text("p")).collect()]
    assert out == [("01001", "0,0001", "1.82%"), ("11000", "70,0", "50.00%"), ("00007", "-1,25", "0.00%")]


def test_int_div(spark):
    df = spark.createDataFrame([(11012,), (1001,)], "k int")
    assert [r[0] for r in df.select(int_div("k", 1000)).collect()] == [11, 1]
    assert df.select(int_div(F.col("k"), 1000).cast("int")).count() == 2


def test_ratio_of_large_counts_is_exact(spark):
    num, den = 61_000_000_007, 150_000_000_001
    df = spark.createDataFrame([(num, den), (-num, den)], "n long, d long")
    got = [r[0] for r in df.select(round_ratio("n", "d", 4, scale=100_000)).collect()]
    expected = half_up(Fraction(num * 100_000, den), 4)
    assert got == [expected, -expected]
