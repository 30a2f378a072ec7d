"""Ready-made reports on the staging tables and marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import exact_sum
from spendlake.operators.windows import add_grand_total_share


def usage_line(usage: DataFrame, usage_id: str) -> DataFrame:
    """What one billing line looks like."""
    return usage.where(F.col("usage_id") == usage_id).select(
        "usage_id",
        "usage_date",
        "customer_id",
        "cloud_provider",
        "service_name",
        "sku_description",
        "usage_quantity",
        "usage_unit",
        "list_cost_usd",
        "discount_usd",
        "net_cost_usd",
        "credit_amount_usd",
        "effective_cost_usd",
        "environment",
        "team",
        "cost_centre",
    )


def grain_check(usage: DataFrame) -> DataFrame:
    """Rows, days, accounts, services and SKUs of the usage lines."""
    return usage.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("usage_date").alias("days"),
        F.count_distinct("billing_account_id").alias("accounts"),
        F.count_distinct("service_id").alias("services"),
        F.count_distinct("sku_id").alias("skus"),
    )


def credits_of_line(credits: DataFrame, usage_id: str) -> DataFrame:
    return credits.where(F.col("usage_id") == usage_id).select(
        "usage_id", "credit_type", "credit_amount_usd"
    )


def labels_of_line(labels: DataFrame, usage_id: str) -> DataFrame:
    return labels.where(F.col("usage_id") == usage_id).select(
        "usage_id", "label_key", "label_value"
    )


def first_subscriptions(subscriptions: DataFrame, n: int = 8) -> DataFrame:
    """The first subscriptions by customer."""
    return (
        subscriptions.select(
            "customer_id",
            "subscription_id",
            "product_id",
            "subscription_tier",
            "seats",
            "mrr_usd",
            "subscription_status",
            "start_date",
            "end_date",
        )
        .orderBy("customer_id", "subscription_id")
        .limit(n)
    )


def spend_vs_revenue(monthly: DataFrame) -> DataFrame:
    """Cloud spend against subscription revenue, customer by month."""
    return monthly.select(
        "customer_name",
        "usage_month",
        F.round("effective_cost_usd").alias("cloud_spend"),
        F.round("subscription_mrr_usd").alias("our_revenue"),
        F.round("revenue_to_spend_ratio", 3).alias("rev_per_dollar_spend"),
        F.round("total_savings_usd").alias("savings"),
    ).orderBy("usage_month", F.desc("cloud_spend"), "customer_name")


def top_cost_drivers(
    services: DataFrame, month: date, per_customer: int = 3, n: int = 12
) -> DataFrame:
    """The dearest services of each customer in a month."""
    return (
        services.where((F.col("service_cost_rank") <= per_customer) & (F.col("usage_month") == F.lit(month)))
        .select(
            "customer_name",
            "usage_month",
            "cloud_provider",
            "service_name",
            F.round("effective_cost_usd").alias("spend"),
            F.round(F.col("share_of_customer_month_spend") * 100, 1).alias("pct_of_month"),
            "service_cost_rank",
        )
        .orderBy("customer_name", "service_cost_rank")
        .limit(n)
    )


def spend_spikes(daily: DataFrame, n: int = 8) -> DataFrame:
    """The days that stand out most from their trailing mean."""
    return (
        daily.where(F.col("spend_vs_7d_avg_ratio").isNotNull())
        .orderBy(F.desc("spend_vs_7d_avg_ratio"), "customer_provider_day_key")
        .limit(n)
        .select(
            "customer_name",
            "cloud_provider",
            "usage_date",
            F.round("effective_cost_usd").alias("spend"),
            F.round("effective_cost_7d_avg_usd").alias("avg_7d"),
            F.round("spend_vs_7d_avg_ratio", 2).alias("vs_avg"),
            F.round(F.col("day_over_day_change_pct") * 100, 1).alias("dod_pct"),
        )
    )


def unallocated_share(allocation: DataFrame) -> DataFrame:
    """Spend and percentage by cost centre."""
    by_centre = allocation.groupBy("cost_centre").agg(
        exact_sum("effective_cost_usd").alias("amount")
    )
    return (
        add_grand_total_share(by_centre, "amount", "share")
        .select(
            "cost_centre",
            F.round("amount").alias("spend"),
            F.round("share", 1).alias("pct"),
        )
        .orderBy(F.desc("spend"), "cost_centre")
    )


def spend_by_environment(allocation: DataFrame) -> DataFrame:
    return (
        allocation.groupBy("environment")
        .agg(F.round(exact_sum("effective_cost_usd")).alias("spend"))
        .orderBy(F.desc("spend"), "environment")
    )


def customer_360(customers: DataFrame) -> DataFrame:
    """The customer dimension, largest recurring revenue first."""
    return customers.orderBy(F.desc("active_mrr_usd"), "customer_name").select(
        "customer_name",
        "customer_segment",
        "sales_region",
        "customer_status",
        "active_subscription_count",
        F.round("active_mrr_usd").alias("mrr"),
        "cloud_providers",
        "is_multicloud",
    )


# name -> (model it reads, report, the options it needs)
REPORTS = {
    "usage_line": ("stg_cloud_usage", usage_line, ("usage_id",)),
    "grain_check": ("stg_cloud_usage", grain_check, ()),
    "credits_of_line": ("stg_cloud_usage_credits", credits_of_line, ("usage_id",)),
    "labels_of_line": ("stg_cloud_usage_labels", labels_of_line, ("usage_id",)),
    "first_subscriptions": ("stg_subscriptions", first_subscriptions, ()),
    "spend_vs_revenue": ("agg_customer_monthly_spend", spend_vs_revenue, ()),
    "top_cost_drivers": ("agg_service_monthly_spend", top_cost_drivers, ("month",)),
    "spend_spikes": ("agg_customer_daily_spend", spend_spikes, ()),
    "unallocated_share": ("agg_cost_allocation_monthly", unallocated_share, ()),
    "spend_by_environment": ("agg_cost_allocation_monthly", spend_by_environment, ()),
    "customer_360": ("dim_customers", customer_360, ()),
}
