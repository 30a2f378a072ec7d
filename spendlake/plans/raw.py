"""Raw models: the landed rows plus where and when they were loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.settings import Settings


def stamp(landed: DataFrame, source_name: str) -> DataFrame:
    """All landed columns, then ``_source_table`` and ``_loaded_at``."""
    return landed.withColumns(
        {"_source_table": F.lit(source_name), "_loaded_at": F.current_timestamp()}
    )


def raw_customers(customers: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return stamp(customers, f"{settings.landing_database}.customers")


def raw_products(products: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return stamp(products, f"{settings.landing_database}.products")


def raw_cloud_usage(usage: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return stamp(usage, f"{settings.landing_database}.cloud_usage")
