"""Declarative data checks.  Each returns the offending rows; no rows means the check passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their counts."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list, with their counts; NULL is not checked."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def orphan_values(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Non-NULL child keys that no parent row carries, with their row counts.

    Keys are counted first, so the anti-join moves one row per key and a hot key is
    reduced before it is shuffled.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return keys.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


@dataclass(frozen=True)
class Check:
    """One declared check of one column."""

    model: str
    column: str
    kind: str  # not_null, unique, relationships or accepted_values
    accepted: tuple[str, ...] = field(default=())
    parent: str | None = None
    parent_column: str | None = None


def _findings(df: DataFrame, model: str, checks: Sequence[Check]) -> list[Column]:
    """What a row of a table tells the suite: structs of check, hash, value, n and parent."""

    def told(number: int, hashed: Column | None, value: Column | None, n: int, parent: int) -> Column:
        return F.struct(
            F.lit(number).alias("check"),
            (F.lit(None).cast("long") if hashed is None else hashed).alias("hash"),
            (F.lit(None).cast("string") if value is None else value.cast("string")).alias("value"),
            F.lit(n).cast("long").alias("n"),
            F.lit(parent).alias("parent"),
        )

    found = []
    for number, check in enumerate(checks):
        if check.model == model:
            column = F.col(check.column)
            if check.kind == "not_null":
                found.append(F.when(column.isNull(), told(number, None, None, 1, 0)))
            elif check.kind == "accepted_values":
                found.append(F.when(~column.isin(*check.accepted), told(number, None, None, 1, 0)))
            elif check.kind == "unique":
                hashed = F.xxhash64(column.cast("string"))
                found.append(F.when(column.isNotNull(), told(number, hashed, None, 1, 0)))
            else:
                found.append(F.when(column.isNotNull(), told(number, None, column, 1, 0)))
        if check.kind == "relationships" and check.parent == model:
            column = F.col(check.parent_column)
            found.append(F.when(column.isNotNull(), told(number, None, column, 0, 1)))
    return found


def _exploded(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    parts = []
    for model in dict.fromkeys(name for c in checks for name in (c.model, c.parent) if name):
        found = _findings(tables[model], model, checks)
        rows = tables[model].select(F.explode(F.array(*found)).alias("x"))
        parts.append(rows.where("x IS NOT NULL").select("x.*"))
    return reduce(DataFrame.unionAll, parts)


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: model, column_name, check_kind, failing_rows.

    A duplicated value counts once, every other check counts rows.

    However many checks there are, each table is scanned once: a row says what it means to every
    check of its table, and all of that meets in one aggregate, combined before it is shuffled.
    Only failing rows count for row checks.  A relationship is the child's and the parent's values
    grouped together, so a hot key is one row from each task and there is no join.  Of unique
    columns only 64-bit hashes are shuffled; a hash that comes twice may be two values, so just
    the rows of such hashes are read again and counted by value.  Where there are none, which is
    known before that second scan would begin, it falls away.
    """
    grouped = (
        _exploded(tables, checks)
        .groupBy("check", "hash", "value")
        .agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    )
    # Orphans and failing rows count; hashes do not.  Both uses below need all columns of the
    # aggregate and filter on its results alone, so they share its shuffle.
    counted = grouped.where((F.col("parent") == 0) & (F.col("n") > 0)).select(
        "check", F.when(F.col("hash").isNull(), F.col("n")).otherwise(0).alias("failing")
    )
    outcomes = [counted]
    if any(c.kind == "unique" for c in checks):
        twice = grouped.where(F.when(F.col("hash").isNotNull(), F.col("n") > 1 + F.col("parent")))
        suspects = _values_of(tables, checks).join(twice.select("check", "hash"), ["check", "hash"])
        doubles = suspects.groupBy("check", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        outcomes.append(doubles.select("check", F.lit(1).cast("long").alias("failing")))
    spark = tables[checks[0].model].sparkSession
    declared = spark.createDataFrame(
        [(n, c.model, c.column, c.kind) for n, c in enumerate(checks)],
        "check int, model string, column_name string, check_kind string",
    )
    none = declared.select("check", F.lit(0).cast("long").alias("failing"))
    sums = reduce(DataFrame.unionAll, [*outcomes, none]).groupBy("check").agg(
        F.sum("failing").alias("failing_rows")
    )
    return declared.join(sums, "check").select("model", "column_name", "check_kind", "failing_rows")


def _values_of(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``check, hash, value`` of the columns that must be unique."""
    parts = []
    for model in dict.fromkeys(c.model for c in checks if c.kind == "unique"):
        own = [(n, F.col(c.column).cast("string")) for n, c in enumerate(checks) if c.model == model and c.kind == "unique"]
        values = [
            F.struct(F.lit(n).alias("check"), F.xxhash64(v).alias("hash"), v.alias("value")) for n, v in own
        ]
        rows = tables[model].select(F.explode(F.array(*values)).alias("x")).select("x.*")
        parts.append(rows.where(F.col("value").isNotNull()))
    return reduce(DataFrame.unionAll, parts)
