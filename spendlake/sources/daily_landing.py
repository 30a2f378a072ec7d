"""Landing an export day by day, so that later reads skip the days they do not need."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import functions as F

from spendlake.sinks.tables import Layout, Warehouse
from spendlake.sources.landing import READERS, path_exists

log = logging.getLogger(__name__)


def land_days(
    warehouse: Warehouse,
    name: str,
    source: str,
    schema: str,
    column: str = "usage_date",
    layout: str = "array",
    strict: bool = True,
) -> list[date] | None:
    """Replace the days of a landing table that ``source`` has rows for; returns them.

    Other days stay as they were landed, so an export may hold only what changed.  All its days
    count at once.  A refresh that looks back some days then lists and reads only their files,
    where a flat landing folder is scanned whole.  Rows without a day are a partition of their own,
    replaced by the next export that has such rows.  None when there is no such file.
    """
    if not path_exists(warehouse.spark, source):
        log.warning("skipping %s: not found", source)
        return None
    rows = READERS[layout](warehouse.spark, source, schema, strict)
    if rows.schema[column].dataType.simpleString() != "date":
        raise ValueError(f"{column} is no date")
    daily = Layout(column)
    if not warehouse.exists(name):
        warehouse.replace(name, rows.where(F.lit(False)), daily)
    days = warehouse.overwrite_partitions(name, rows, daily, drop_vanished=False)
    log.info("%s: landed %s days", name, len(days))
    return days
