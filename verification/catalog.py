"""Registration of queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from spendlake.plans import core, finops, raw, staging
from spendlake.settings import Settings, prepare_session
from spendlake.sinks.turns import in_turns, is_turn, turns_for
from spendlake.sources import star_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = date(2002, 1, 1)
SETTINGS = Settings(as_of=AS_OF)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare_session(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


class Models:
    """All models over the star tables of one folder, each worked out when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def source(self, name: str) -> DataFrame:
        return star_tables.read_table(self.spark, self.folder, name)

    def by_customers(self, name: str) -> DataFrame:
        """A model over usage lines, for some customers after the others where there are many lines.

        Every group, join and window of these models has the customer among its keys, except the
        join of the accounts, which stay whole.
        """
        turns = turns_for(self.spark, f"{self.folder}/lineitem.parquet")
        if turns == 1:
            return getattr(self, name)

        def plan(usage: DataFrame, turn: int) -> DataFrame:
            own, mine = Models(self.spark, self.folder), is_turn("customer_id", turn, turns)
            own.stg_cloud_usage = usage
            own.dim_customers = self.dim_customers.where(mine)
            own.dim_billing_accounts = self.dim_billing_accounts
            own.stg_subscriptions = self.stg_subscriptions.where(mine)
            return getattr(own, name)

        usage = self.stg_cloud_usage.drop("labels", "_loaded_at")
        return in_turns(usage, "customer_id", turns, plan)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return raw.raw_customers(star_tables.customers(self.spark, self.folder))

    @cached_property
    def raw_products(self) -> DataFrame:
        return raw.raw_products(star_tables.products(self.spark, self.folder))

    @cached_property
    def raw_cloud_usage(self) -> DataFrame:
        return raw.raw_cloud_usage(star_tables.cloud_usage(self.spark, self.folder))

    @cached_property
    def raw_event_usage(self) -> DataFrame:
        return raw.raw_cloud_usage(star_tables.event_usage(self.spark, self.folder))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw_customers)

    @cached_property
    def stg_customer_contacts(self) -> DataFrame:
        return staging.stg_customer_contacts(self.raw_customers)

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return staging.stg_subscriptions(self.raw_customers, SETTINGS)

    @cached_property
    def stg_billing_accounts(self) -> DataFrame:
        return staging.stg_billing_accounts(self.raw_customers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw_products)

    @cached_property
    def stg_product_features(self) -> DataFrame:
        return staging.stg_product_features(self.raw_products)

    @cached_property
    def stg_product_pricing_tiers(self) -> DataFrame:
        return staging.stg_product_pricing_tiers(self.raw_products)

    @cached_property
    def stg_cloud_usage(self) -> DataFrame:
        return staging.stg_cloud_usage(self.raw_cloud_usage)

    @cached_property
    def stg_event_usage(self) -> DataFrame:
        return staging.stg_cloud_usage(self.raw_event_usage)

    @cached_property
    def stg_cloud_usage_credits(self) -> DataFrame:
        return staging.stg_cloud_usage_credits(self.raw_cloud_usage)

    @cached_property
    def stg_cloud_usage_labels(self) -> DataFrame:
        return staging.stg_cloud_usage_labels(self.raw_cloud_usage)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.dim_customers(
            self.stg_customers,
            self.stg_subscriptions,
            self.stg_billing_accounts,
            self.stg_customer_contacts,
            SETTINGS,
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        return core.dim_products(
            self.stg_products,
            self.stg_product_features,
            self.stg_product_pricing_tiers,
            self.stg_subscriptions,
        )

    @cached_property
    def dim_billing_accounts(self) -> DataFrame:
        return core.dim_billing_accounts(
            self.stg_billing_accounts, self.stg_customers, self.stg_cloud_usage
        )

    @cached_property
    def fct_subscriptions(self) -> DataFrame:
        return core.fct_subscriptions(
            self.stg_subscriptions, self.stg_customers, self.stg_products
        )

    @cached_property
    def fct_cloud_usage_daily(self) -> DataFrame:
        return finops.fct_cloud_usage_daily(
            self.stg_cloud_usage, self.dim_customers, self.dim_billing_accounts, SETTINGS
        )

    @cached_property
    def agg_customer_daily_spend(self) -> DataFrame:
        return finops.agg_customer_daily_spend(self.fct_cloud_usage_daily)

    @cached_property
    def agg_customer_monthly_spend(self) -> DataFrame:
        # The line items alone bound the months, without the joins of the fact.
        months = self.source("lineitem").selectExpr("trunc(l_shipdate, 'MM') AS usage_month")
        return finops.agg_customer_monthly_spend(
            self.fct_cloud_usage_daily, self.stg_subscriptions, SETTINGS, months
        )

    @cached_property
    def agg_service_monthly_spend(self) -> DataFrame:
        return finops.agg_service_monthly_spend(self.fct_cloud_usage_daily)

    @cached_property
    def allocated_spend(self) -> DataFrame:
        return finops.allocated_spend(self.fct_cloud_usage_daily)

    @cached_property
    def agg_cost_allocation_monthly(self) -> DataFrame:
        return finops.agg_cost_allocation_monthly(self.fct_cloud_usage_daily)
