"""Joins of the marts.

No join here carries a broadcast hint.  Where no hint asks for a merge, Spark broadcasts a side
whose size it knows to be below ``spark.sql.autoBroadcastJoinThreshold`` (from file statistics,
or from the shuffle already written when adaptive execution looks again); beyond that it
sort-merges, and adaptive execution splits a hot key over several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.functions import amount_parts, joined_amount


def keep_known(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join: facts without a dimension row are dropped."""
    return facts.join(dimension, on, "inner")


def add_attributes(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left equi-join: facts without a dimension row stay, with NULL attributes."""
    return facts.join(dimension, on, "left")


def join_pairs(facts: DataFrame, pairs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts with the columns of ``pairs``, met by all keys in one shuffle; NULL meets NULL.

    For facts that need attributes by several keys: the distinct keys of the facts meet one
    dimension after the other, as they are thin, and the wide facts move once instead of once for
    each dimension.  A fact comes once for each row of its keys, as it would from single joins.
    Sort-merged at any size: the files of a few days of facts can be small where their rows are
    hundreds of MB, which a broadcast would send through the driver.
    """
    names = {key: f"_pair_{key}" for key in on}
    met = pairs.withColumnsRenamed(names)
    matches = [facts[key].eqNullSafe(met[name]) for key, name in names.items()]
    return facts.join(met.hint("merge"), matches, "inner").drop(*names.values())


def add_rollups(
    df: DataFrame,
    rollups: Sequence[DataFrame],
    on: str | Sequence[str],
    defaults: Mapping[str, int | float] | None = None,
) -> DataFrame:
    """Left-join aggregates that hold one row per key; fill the named columns when absent.

    Rollups grow with ``df`` and are sort-merged at any size: all meet on one shuffle of ``df``,
    and none is sent through the driver.
    """
    for rollup in rollups:
        df = df.join(rollup.hint("merge"), on, "left")
    if not defaults:
        return df
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def live_months(
    intervals: DataFrame,
    first_month: Column,
    last_month: Column,
    start: str = "start_date",
    end: str = "end_date",
    month: str = "usage_month",
) -> DataFrame:
    """A row per interval and month it touches, months limited to the given range.

    A month counts when the interval starts on or before its last day and ends on or after
    its first day (or never).  The months are generated from each interval's own row, so the
    range join needs no comparison of all months with all intervals; what follows is a plain
    grouping or an equi-join on the month.
    """
    from_month = F.greatest(F.trunc(F.col(start), "MM"), first_month)
    to_month = F.least(F.coalesce(F.trunc(F.col(end), "MM"), last_month), last_month)
    bounded = (
        intervals.where(F.col(start).isNotNull())
        .withColumns({"_from_month": from_month, "_to_month": to_month})
        .where(F.col("_from_month") <= F.col("_to_month"))
    )
    one_month = F.make_ym_interval(F.lit(0), F.lit(1))
    return bounded.withColumn(
        month, F.explode(F.sequence("_from_month", "_to_month", one_month))
    ).drop("_from_month", "_to_month")


def live_totals(
    intervals: DataFrame,
    keys: Sequence[str],
    amount: str,
    first_month: Column,
    last_month: Column,
    total: str,
    count: str,
    start: str = "start_date",
    end: str = "end_date",
    month: str = "usage_month",
) -> DataFrame:
    """Sum of an amount and number of the intervals live per key and month, if there are any.

    The totals of :func:`live_months` without a row per interval and month: an interval adds its
    amount in its first month and takes it away after its last one, and a running sum over the
    months with a change, at most one row each per key, gives the totals.  Sums are exact, so
    what is taken away leaves nothing behind.
    """
    from_month = F.greatest(F.trunc(F.col(start), "MM"), first_month)
    to_month = F.least(F.coalesce(F.trunc(F.col(end), "MM"), last_month), last_month)
    bounded = (
        intervals.where(F.col(start).isNotNull())
        .withColumns({"_from_month": from_month, "_to_month": to_month})
        .where(F.col("_from_month") <= F.col("_to_month"))
    )
    parts = [f"_part{i}" for i, _ in enumerate(amount_parts(amount))]
    known = F.when(F.col(amount).isNotNull(), 1).otherwise(0)
    values = {"_live": F.lit(1), "_known": known} | {
        name: F.coalesce(part, F.lit(0)) for name, part in zip(parts, amount_parts(amount), strict=True)
    }
    steps = F.array(F.struct(F.col("_from_month").alias("m"), F.lit(1).alias("sign")),
                    F.struct(F.add_months("_to_month", 1).alias("m"), F.lit(-1).alias("sign")))
    changes = (
        bounded.withColumns(values)
        .withColumn("_step", F.explode(steps))
        .groupBy(*keys, F.col("_step.m").alias(month))
        .agg(*[F.sum(F.col("_step.sign") * F.col(name)).alias(name) for name in values])
    )
    order = Window.partitionBy(*keys).orderBy(month)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.add_months(F.lead(month).over(order), -1), last_month)
    levels = changes.withColumns(
        {name: F.sum(name).over(running) for name in values} | {"_until": until}
    ).where("_live > 0")
    one_month = F.make_ym_interval(F.lit(0), F.lit(1))
    sums = joined_amount([F.col(part) for part in parts])
    return levels.withColumn(month, F.explode(F.sequence(month, "_until", one_month))).select(
        *keys, month, F.when(F.col("_known") > 0, sums).alias(total), F.col("_live").cast("long").alias(count)
    )


def live_in_listed_months(
    months: DataFrame,
    intervals: DataFrame,
    start: str = "start_date",
    end: str = "end_date",
    month: str = "usage_month",
) -> DataFrame:
    """The same rows as :func:`live_months`, for an explicit list of months.

    Months not in the list are dropped by a semi-join after the generation, which gives
    the result of the overlap condition without a nested-loop join.
    """
    bounds = months.agg(F.min(month).alias("first"), F.max(month).alias("last"))
    generated = live_months(
        intervals,
        bounds.select("first").scalar(),
        bounds.select("last").scalar(),
        start,
        end,
        month,
    )
    return generated.join(months.select(month).distinct(), month, "left_semi")


def overlap_condition(month: Column, start: Column, end: Column) -> Column:
    """The overlap test itself, for joins against a handful of months."""
    return (start <= F.last_day(month)) & (end.isNull() | (end >= month))
