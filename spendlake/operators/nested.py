"""Turning nested arrays into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_structs(
    df: DataFrame,
    array: str,
    keep: Sequence[str | Column] = (),
    alias: str = "item",
) -> DataFrame:
    """One row per element of ``array`` with the ``keep`` columns repeated.

    A parent whose array is empty or NULL gives no row.  ``array`` may be a path into a
    struct (``pricing.tiers``).  The element stays a struct column called ``alias``, so
    only the fields selected afterwards are read from the file.
    """
    return df.select(*keep, F.explode(F.col(array)).alias(alias))


def explode_labels(df: DataFrame, labels: str, keep: Sequence[str | Column]) -> DataFrame:
    """Tall (keep.., label_key, label_value) rows for allocation by any label."""
    exploded = explode_structs(df, labels, keep, alias="label")
    names = [c for c in exploded.columns if c != "label"]
    return exploded.select(
        *names,
        F.col("label.key").alias("label_key"),
        F.col("label.value").alias("label_value"),
    )
