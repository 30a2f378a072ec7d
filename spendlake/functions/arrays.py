"""Reading nested arrays in place, without exploding or joining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake.functions.numbers import as_column


def label_value(labels: Column | str, key: str) -> Column:
    """Value of the first label called ``key``; NULL when the row has none.

    Works on the array of keys and the array of values, without a lambda, so it is compiled
    with the rest of the projection.
    """
    pairs = as_column(labels)
    position = F.array_position(pairs["key"], key)  # 0 when absent, and get(-1) is NULL
    return F.get(pairs["value"], (position - 1).cast("int"))


def array_total(items: Column | str, field: str) -> Column:
    """Sum of one numeric field over an array of structs.

    NULL amounts are skipped; an empty or NULL array totals 0.0.
    """
    total = F.aggregate(
        as_column(items),
        F.lit(0.0),
        lambda acc, item: acc + F.coalesce(item[field].cast("double"), F.lit(0.0)),
    )
    return F.coalesce(total, F.lit(0.0))


def array_count(items: Column | str) -> Column:
    """Number of elements as a long; NULL for a NULL array."""
    return F.array_size(as_column(items)).cast("long")


def text_list(items: Column | str, separator: str = ", ") -> Column:
    """The strings of an array joined into one; NULL elements are left out."""
    return F.array_join(as_column(items), separator)
