"""Window analytics over already aggregated rows.

The per-group windows here run on daily or per-service totals, never on usage lines: the rows
of one group are bounded by the calendar or by the service catalogue.  Totals of groups with
no such bound are computed as an aggregate and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.functions import amount_parts, exact_sum, joined_amount, ratio


def add_trend(
    daily: DataFrame,
    keys: Sequence[str],
    day: str,
    amount: str,
    average: str,
    previous: str,
    rows: int = 7,
) -> DataFrame:
    """Trailing mean over the last ``rows`` rows (not days) and the previous row's amount.

    The mean's sum is the difference of two running sums, exact as both are integers: a row costs
    one addition a part, however many rows the mean spans.  All windows share one exchange and sort.
    """
    ordered = Window.partitionBy(*keys).orderBy(day)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [f"_part_{n}" for n in range(4)]
    split = daily.withColumns(dict(zip(names, amount_parts(amount), strict=True)))
    running = split.withColumns(
        {
            **{name: F.coalesce(F.sum(name).over(so_far), F.lit(0).cast("long")) for name in names},
            "_count": F.count(amount).over(so_far),
            previous: F.lag(amount).over(ordered),
        }
    )
    last = {name: F.col(name) - F.lag(name, rows, 0).over(ordered) for name in [*names, "_count"]}
    mean = joined_amount([F.col(name) for name in names]) / F.nullif(F.col("_count"), F.lit(0)).cast("double")
    others = [column for column in daily.columns if column != average]
    return running.withColumns(last).select(*others, mean.alias(average), previous)


def change_columns(amount: str, previous: str, average: str) -> dict[str, Column]:
    """Change, relative change and ratio to the trailing mean."""
    return {
        "day_over_day_change_usd": F.col(amount) - F.col(previous),
        "day_over_day_change_pct": ratio(amount, previous) - 1,
        "spend_vs_7d_avg_ratio": ratio(amount, average),
    }


def rank_by_amount(
    df: DataFrame, keys: Sequence[str], amount: str, tie_break: Sequence[str], rank: str
) -> DataFrame:
    """Row number by falling amount; the tie break makes equal amounts deterministic."""
    return df.withColumn(rank, _position(keys, amount, tie_break).cast("long"))


def _position(keys: Sequence[str], amount: str, tie_break: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(amount), *tie_break))


def add_window_total(df: DataFrame, keys: Sequence[str], amount: str, total: str) -> DataFrame:
    """Group total as a window, for groups of bounded size that are sorted together anyway."""
    return df.withColumn(total, exact_sum(amount, Window.partitionBy(*keys)))


def add_joined_total(
    df: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    amount: str,
    total: str,
    buckets: int = 1,
) -> DataFrame:
    """Group total of ``source`` joined onto ``df``, for groups of any size.

    The total is combined map-side, so a key that holds a third of the rows costs its
    reducer one row per map task; a window would bring all its rows into one task.  ``source``
    may be ``df`` itself: the step that made it is then shuffled once and used twice.  Keys
    match NULL to NULL, as a window partition does.  Where there are few groups, ``buckets`` deals
    the rows of each into so many parts, and repeats its total for each: a shuffle on three keys
    has rows in three tasks only.
    """
    names = {key: f"_total_{key}" for key in keys}
    totals = source.groupBy(*[F.col(key).alias(name) for key, name in names.items()]).agg(
        exact_sum(amount).alias(total)
    )
    matches = [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]
    if buckets == 1:
        return df.join(totals, matches, "left").drop(*names.values())
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*df.columns), F.lit(buckets)))
    parts = F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))
    repeated = totals.withColumn("_part", F.explode(parts))
    return dealt.join(repeated, [*matches, F.col("_bucket") == F.col("_part")], "left").drop(
        *names.values(), "_bucket", "_part"
    )


def add_grand_total_share(df: DataFrame, amount: str, share: str) -> DataFrame:
    """Percentage of the grand total, from a one-row subquery instead of an unpartitioned window.

    Where ``df`` is an aggregate, subquery and rows share its shuffle: it is computed once.
    """
    grand_total = df.agg(exact_sum(amount).alias("grand_total")).scalar()
    return df.withColumn(share, 100.0 * F.col(amount) / F.nullif(grand_total, F.lit(0.0)))


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    tie_break: Sequence[str],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """The ``n`` largest rows of each group; Spark limits each group before the shuffle."""
    # The cast comes after the filter: Spark only limits groups early on the bare row number.
    top = df.withColumn(rank, _position(keys, amount, tie_break)).where(F.col(rank) <= n)
    return top.withColumn(rank, F.col(rank).cast("long"))
