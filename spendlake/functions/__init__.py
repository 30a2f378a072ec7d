"""Column -> Column helpers; all of them stay inside the JVM."""

from spendlake.functions.arrays import array_count, array_total, label_value, text_list
from spendlake.functions.dates import (
    day_name,
    is_weekend,
    month_boundaries,
    month_of,
    utc_date,
)
from spendlake.functions.numbers import (
    amount_parts,
    day_count,
    exact_mean,
    exact_sum,
    joined_amount,
    key_of,
    ratio,
    zero_if_null,
)

__all__ = [
    "array_count",
    "array_total",
    "amount_parts",
    "day_count",
    "day_name",
    "exact_mean",
    "exact_sum",
    "joined_amount",
    "is_weekend",
    "key_of",
    "label_value",
    "month_boundaries",
    "month_of",
    "ratio",
    "text_list",
    "utc_date",
    "zero_if_null",
]
