import math
import random
from datetime import date, timedelta
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendlake import functions as fn


def value(spark, column, rows=1):
    return spark.range(rows).select(column.alias("v")).first().v


def labels(*pairs):
    return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in pairs])


def amounts(*numbers):
    typed = [F.struct(F.lit(n).cast("double").alias("amount")) for n in numbers]
    return F.array(*typed).cast("array<struct<amount: double>>")


def test_label_value_takes_first_match(spark):
    items = labels(("env", "dev"), ("env", "prod"))
    assert value(spark, fn.label_value(items, "env")) == "dev"
    assert value(spark, fn.label_value(items, "team")) is None
    assert value(spark, fn.label_value(F.lit(None).cast("array<struct<key:string,value:string>>"), "a")) is None


def test_array_total_skips_nulls_and_is_never_null(spark):
    assert value(spark, fn.array_total(amounts(1.5, None, -0.5), "amount")) == 1.0
    assert value(spark, fn.array_total(amounts(), "amount")) == 0.0
    assert value(spark, fn.array_total(amounts(None), "amount")) == 0.0
    missing = F.lit(None).cast("array<struct<amount: double>>")
    assert value(spark, fn.array_total(missing, "amount")) == 0.0


def test_array_count_of_null_is_null(spark):
    assert value(spark, fn.array_count(F.lit(None).cast("array<int>"))) is None
    assert value(spark, fn.array_count(F.array().cast("array<int>"))) == 0


def test_text_list_skips_nulls(spark):
    assert value(spark, fn.text_list(F.array(F.lit("a"), F.lit(None), F.lit("b")))) == "a, b"


@pytest.mark.parametrize(
    "later, earlier, months",
    [
        (date(2024, 2, 1), date(2024, 1, 31), 1),
        (date(2024, 1, 31), date(2024, 1, 1), 0),
        (date(2024, 1, 31), date(2024, 2, 1), -1),
        (date(2025, 1, 1), date(2023, 12, 31), 13),
    ],
)
def test_month_boundaries(spark, later, earlier, months):
    assert value(spark, fn.month_boundaries(F.lit(later), F.lit(earlier))) == months


def test_calendar(spark):
    saturday = F.lit(date(2024, 1, 6))
    assert value(spark, fn.day_name(saturday)) == "Saturday"
    assert value(spark, fn.is_weekend(saturday)) is True
    assert value(spark, fn.is_weekend(F.lit(date(2024, 1, 8)))) is False
    assert value(spark, fn.month_of(saturday)) == date(2024, 1, 1)


def test_ratio_is_guarded(spark):
    one = F.lit(1.0)
    assert value(spark, fn.ratio(one, F.lit(4.0))) == 0.25
    assert value(spark, fn.ratio(one, F.lit(0.0))) is None
    assert value(spark, fn.ratio(one, F.lit(-2.0))) is None
    assert value(spark, fn.ratio(one, F.lit(None).cast("double"))) is None


def test_key_of_is_null_with_a_null_part(spark):
    assert value(spark, fn.key_of(F.lit("a"), F.lit(date(2024, 1, 2)))) == "a|2024-01-02"
    assert value(spark, fn.key_of(F.lit("a"), F.lit(None).cast("string"))) is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-(10**12), 10**12)), max_size=30))
def test_exact_sum_equals_integer_arithmetic(spark, units):
    """Amounts with four decimals add up exactly, in any order of the rows."""
    rows = [(None if u is None else u / 10_000,) for u in units]
    df = spark.createDataFrame(rows, "x double")
    known = [u for u in units if u is not None]
    expected = sum(known) / 10_000 if known else None
    for data in (df, df.repartition(3)):
        total = data.agg(fn.exact_sum("x").alias("v")).first().v
        assert total == expected or math.isclose(total, expected, rel_tol=1e-15)
        count = data.agg(fn.exact_mean("x").alias("v")).first().v
        assert (count is None) == (not known)


def test_exact_sum_goes_beyond_a_double_of_micros(spark):
    big = spark.range(1000).select(F.lit(9e14).alias("x"))
    assert big.agg(fn.exact_sum("x").alias("v")).first().v == 9e17


def test_exact_sum_keeps_small_amounts(spark):
    """A million rows of 4e-7 or 1e-9 are not rounded away, whatever the sign and the order."""
    for small in (4e-7, 1e-9, 1e-15):
        data = spark.range(1_000_000).select(
            F.lit(small).alias("x"), F.when(F.col("id") % 2 == 0, small).otherwise(-3 * small).alias("y")
        )
        row = data.agg(fn.exact_sum("x").alias("x"), fn.exact_sum("y").alias("y")).first()
        assert math.isclose(row.x, small * 1e6, rel_tol=1e-9)
        assert math.isclose(row.y, -small * 1e6, rel_tol=1e-9)
        assert small < 1e-8 or row.x == math.fsum([small] * 1_000_000)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_subnormal=False), min_size=1, max_size=30))
def test_exact_sum_equals_fsum(spark, amounts):
    df = spark.createDataFrame([(x,) for x in amounts], "x double")
    total = df.repartition(3).agg(fn.exact_sum("x").alias("v")).first().v
    assert math.isclose(total, math.fsum(amounts), rel_tol=3e-16, abs_tol=1e-22)


def test_exact_sum_as_window(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, None), (4, 0.3)], "i int, x double")
    w = Window.orderBy("i").rowsBetween(-1, 0)
    got = [r.v for r in df.select("i", fn.exact_sum("x", w).alias("v")).orderBy("i").collect()]
    assert got == [0.1, math.fsum([0.1, 0.2]), 0.2, 0.3]
    mean = [r.v for r in df.select("i", fn.exact_mean("x", w).alias("v")).orderBy("i").collect()]
    assert mean == [0.1, math.fsum([0.1, 0.2]) / 2, 0.2, 0.3]


def test_days_of_a_month(spark):
    days = [date(2024, 1, 1) + timedelta(days=d) for d in (0, 0, 30, 15, 15)]
    rows = [(d, p) for d, p in zip(days, ["a", "b", "a", None, "b"], strict=True)]
    df = spark.createDataFrame([*rows, (None, "c")], "d date, p string")
    row = df.agg(fn.day_count("d").alias("days"), F.count_distinct("p").alias("kinds")).first()
    assert (row.days, row.kinds) == (3, 3)
    empty = df.where(F.lit(False)).agg(fn.day_count("d").alias("days"), F.count_distinct("p").alias("kinds"))
    assert tuple(empty.first()) == (0, 0)


def nearest(amounts):
    return float(sum((Fraction(x) for x in amounts), Fraction(0)))


@pytest.mark.parametrize(
    "amounts",
    [
        [1.5, 2.0**-53, 2.0**-78],
        [1.5, 2.0**-53],
        [-1.5, -(2.0**-53), -(2.0**-78)],
        [-1.5, -(2.0**-53), 2.0**-78],
        [2.0**27, 2.0**-26, 2.0**-78],
        [2.0**27 + 2.0**-25, 2.0**-26],
        [2.0**53, 1.0],
        [2.0**53, 1.0, 2.0**-78],
        [2.0**53 + 2, 1.0, -(2.0**-60)],
        [2.0**62, 512.0, 2.0**-78],
        [2.0**62, 512.0],
        [2.0**-78, -(2.0**40)],
        [0.1] * 10,
        [1e15, 0.125, -1e15, 2.0**-70],
        [-0.0, 0.0],
    ],
)
def test_exact_sum_rounds_once(spark, amounts):
    df = spark.createDataFrame([(x,) for x in amounts], "x double").repartition(2)
    assert df.agg(fn.exact_sum("x").alias("v")).first().v == nearest(amounts)


def test_random_sums_are_the_nearest_doubles(spark):
    """Groups of amounts of very different sizes and signs, among them halves of last bits."""
    rng = random.Random(7)
    groups = []
    for _ in range(3000):
        exponents = rng.choice([(-25, 40), (-25, 0), (20, 60), (-24, 61)])
        low, high = exponents
        amounts = [
            rng.choice([-1, 1]) * math.ldexp(rng.getrandbits(53) | 1 << 52, rng.randint(low, high) - 53)
            for _ in range(rng.randint(1, 6))
        ]
        top = max(amounts, key=abs)
        half = math.ulp(top) / 2
        if rng.random() < 0.5 and half >= 2.0**-78:
            amounts += [half, rng.choice([0.0, 2.0**-78, -(2.0**-78)])]
        groups.append(amounts)
    rows = [(g, x) for g, amounts in enumerate(groups) for x in amounts]
    df = spark.createDataFrame(rows, "g int, x double").repartition(3)
    got = {r.g: r.v for r in df.groupBy("g").agg(fn.exact_sum("x").alias("v")).collect()}
    assert got == {g: nearest(amounts) for g, amounts in enumerate(groups)}
