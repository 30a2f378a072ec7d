"""Grouping with many exact sums and distinct counts at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions import amount_parts, joined_amount
from spendlake.functions.numbers import as_column


def _text(value: Column, kind: str) -> Column:
    """A value as a text that tells it from all others of its type."""
    if kind in ("float", "double"):
        value = value + F.lit(0.0)  # one zero
    return value.cast("string")


def _distinct_values(df: DataFrame, keys: Sequence[str], columns: list[Column]) -> DataFrame:
    """``keys, _number``: a row for each distinct value of each column in a group."""
    kinds = [kind for _, kind in df.select(*columns).dtypes]
    texts = [_text(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    if len(texts) == 1:
        values = df.select(*keys, F.lit(0).alias("_number"), texts[0].alias("_value"))
    else:
        pairs = [F.struct(F.lit(n).alias("_number"), t.alias("_value")) for n, t in enumerate(texts)]
        values = df.select(*keys, F.explode(F.array(*pairs)).alias("_x")).select(*keys, "_x.*")
    return values.where(F.col("_value").isNotNull()).distinct().select(*keys, "_number")


def summarise(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column | str] | Sequence[str] = (),
    distinct: Mapping[str, Column | str] | None = None,
    others: Mapping[str, Column] | None = None,
    rows: str | None = None,
) -> DataFrame:
    """One row per group: ``keys, rows, others, distinct, sums``.

    ``sums`` are exact sums of amounts, by name; ``distinct`` counts distinct values that are not
    NULL; ``rows`` names the number of rows; ``others`` are aggregates that skip NULLs.

    Spark's own distinct counts beside sums send every row once for each distinct column, with the
    buffers of all sums, through both shuffles.  Here the distinct columns go through a thin branch
    of (keys, column number, value) that is made distinct, counted by group and joined to the sums.
    All keys are one struct, so that NULL meets NULL, and both sides already lie by it: the join
    moves nothing.  Where nobody reads the counts, Spark drops the branch, as its key is unique.
    Both branches combine before they are shuffled, on all keys (and the value), so a key that
    holds a third of the rows costs each reducer little.  ``df`` is read twice, for the distinct
    columns and for the sums.
    """
    amounts = dict(sums) if isinstance(sums, Mapping) else {name: name for name in sums}
    parts = {name: [f"_{name}_{n}" for n in range(4)] for name in amounts}
    lines = df.select(
        "*",
        *[
            part.alias(alias)
            for name, amount in amounts.items()
            for alias, part in zip(parts[name], amount_parts(amount), strict=True)
        ],
    )
    counted = list((distinct or {}).items())
    key = F.struct(*keys).alias("_key")
    found = lines.groupBy(*([key] if counted and keys else keys)).agg(
        F.count(F.lit(1)).alias(rows or "_rows"),
        *[column.alias(name) for name, column in (others or {}).items()],
        *[F.sum(alias).alias(alias) for aliases in parts.values() for alias in aliases],
    )
    if counted:
        values = _distinct_values(df, keys, [as_column(column) for _, column in counted])
        flags = [F.count_if(F.col("_number") == n).alias(name) for n, (name, _) in enumerate(counted)]
        if keys:
            found = found.join(values.groupBy(key).agg(*flags), "_key", "left")
        else:
            found = found.crossJoin(values.agg(*flags))
    return found.select(
        *([F.col("_key")[name].alias(name) for name in keys] if counted else keys),
        *([rows] if rows else []),
        *(others or {}),
        *[F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name, _ in counted],
        *[joined_amount([F.col(a) for a in aliases]).alias(name) for name, aliases in parts.items()],
    )
