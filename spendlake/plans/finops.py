"""Spend marts: the usage fact and its daily and monthly aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import (
    day_count,
    key_of,
    month_of,
    ratio,
    zero_if_null,
)
from spendlake.operators.grouping import summarise
from spendlake.operators.joins import add_attributes, join_pairs, keep_known, live_totals
from spendlake.operators.windows import (
    add_joined_total,
    add_trend,
    add_window_total,
    change_columns,
    rank_by_amount,
)
from spendlake.plans.core import CUSTOMER_ATTRIBUTES
from spendlake.settings import Settings

COST_MEASURES = [
    "list_cost_usd",
    "discount_usd",
    "net_cost_usd",
    "credit_amount_usd",
    "effective_cost_usd",
]
SAVING_MEASURES = ["flexsave_savings_usd", "optimisation_savings_usd", "total_savings_usd"]
UNALLOCATED = "unallocated"


def fct_cloud_usage_daily(
    usage: DataFrame,
    customers: DataFrame,
    accounts: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Usage line with customer and account attributes.

    Lines of unknown customers are dropped, lines of unknown accounts are kept.
    """
    # Customers and accounts grow with the lines; merged, neither is sent through the driver.
    account_attributes = accounts.select(
        "billing_account_id", "billing_currency", "payment_terms", "is_reseller_account"
    ).hint("merge")
    customer_attributes = customers.select(*CUSTOMER_ATTRIBUTES).hint("merge")
    # Customer and account first meet the distinct pairs of both, so the wide lines move once.  They
    # then lie by the pair: the aggregates by customer that follow combine map-side and shuffle
    # anew, and a hot customer is not met raw in one task.
    pair = ["customer_id", "billing_account_id"]
    known = keep_known(usage.select(*pair).distinct(), customer_attributes, "customer_id")
    joined = join_pairs(usage, add_attributes(known, account_attributes, "billing_account_id"), pair)
    return joined.select(
        "usage_id",
        "usage_date",
        "usage_month",
        "usage_day_name",
        "is_weekend",
        *CUSTOMER_ATTRIBUTES,
        "billing_account_id",
        "billing_currency",
        "payment_terms",
        "is_reseller_account",
        "cloud_provider",
        "project_id",
        "project_name",
        "service_id",
        "service_name",
        "service_category",
        "sku_id",
        "sku_description",
        "cloud_region",
        "cloud_zone",
        "environment",
        "team",
        "cost_centre",
        "application",
        "usage_quantity",
        "usage_unit",
        "list_unit_price_usd",
        "list_cost_usd",
        "discount_usd",
        "discount_rate",
        "net_cost_usd",
        "credit_amount_usd",
        "credit_count",
        "effective_cost_usd",
        "is_flexsave_eligible",
        *SAVING_MEASURES,
        F.lit(settings.reporting_currency).alias("reporting_currency"),
    )


def agg_customer_daily_spend(fact: DataFrame) -> DataFrame:
    """Spend per customer, provider and day, with trailing mean and change.

    The trailing rows reach over partition boundaries, so this model is always rebuilt whole.
    """
    keys = [
        "customer_id",
        "customer_name",
        "customer_segment",
        "sales_region",
        "cloud_provider",
        "usage_date",
        "usage_month",
    ]
    daily = summarise(
        fact,
        keys,
        sums=COST_MEASURES + SAVING_MEASURES,
        distinct={"service_count": "service_id", "project_count": "project_id"},
        rows="usage_line_count",
    )
    average, previous = "effective_cost_7d_avg_usd", "prev_day_effective_cost_usd"
    trend = add_trend(
        daily,
        ["customer_id", "cloud_provider"],
        "usage_date",
        "effective_cost_usd",
        average,
        previous,
    )
    key = key_of("customer_id", "cloud_provider", "usage_date")
    return trend.select(key.alias("customer_provider_day_key"), "*").withColumns(
        change_columns("effective_cost_usd", previous, average)
    )


def subscription_revenue(subscriptions: DataFrame, months: DataFrame) -> DataFrame:
    """Recurring revenue and number of subscriptions live per customer and month.

    ``months`` only bounds the months generated: any rows with a ``usage_month`` that
    cover the months asked for.  A subscription counts whatever its status.
    """
    bounds = months.agg(F.min("usage_month").alias("first"), F.max("usage_month").alias("last"))
    return live_totals(
        subscriptions.select("customer_id", "mrr_usd", "start_date", "end_date"),
        ["customer_id"],
        "mrr_usd",
        bounds.select("first").scalar(),
        bounds.select("last").scalar(),
        total="subscription_mrr_usd",
        count="live_subscription_count",
    )


def agg_customer_monthly_spend(
    fact: DataFrame,
    subscriptions: DataFrame,
    settings: Settings = Settings(),
    months: DataFrame | None = None,
) -> DataFrame:
    """Spend per customer and month beside the subscription revenue live in that month.

    ``months`` may name a cheaper source than the fact for the range of months.  By default
    it is taken from the usage dates, the fact's partition column: no data column is read.
    """
    keys = [*CUSTOMER_ATTRIBUTES, "usage_month"]
    eligible = F.when(F.col("is_flexsave_eligible"), F.col("effective_cost_usd"))
    monthly = summarise(
        fact,
        keys,
        sums={
            **{name: name for name in COST_MEASURES + SAVING_MEASURES},
            "flexsave_eligible_cost_usd": eligible,
        },
        distinct={
            "billing_account_count": "billing_account_id",
            "cloud_provider_count": "cloud_provider",
            "service_count": "service_id",
        },
        others={"active_days": day_count("usage_date")},
    )
    if months is None:
        months = fact.select(month_of("usage_date").alias("usage_month"))
    revenue = subscription_revenue(subscriptions, months)
    joined = monthly.join(revenue, ["customer_id", "usage_month"], "left").withColumns(
        {
            "subscription_mrr_usd": zero_if_null("subscription_mrr_usd", 0.0),
            "live_subscription_count": zero_if_null("live_subscription_count"),
        }
    )
    per_day = F.col("effective_cost_usd") / F.nullif(F.col("active_days"), F.lit(0))
    return joined.select(
        key_of("customer_id", "usage_month").alias("customer_month_key"),
        *keys,
        "active_days",
        "billing_account_count",
        "cloud_provider_count",
        "service_count",
        *COST_MEASURES,
        per_day.alias("avg_daily_effective_cost_usd"),
        *SAVING_MEASURES,
        zero_if_null("flexsave_eligible_cost_usd", 0.0).alias("flexsave_eligible_cost_usd"),
        ratio("total_savings_usd", "list_cost_usd").alias("savings_rate"),
        "subscription_mrr_usd",
        "live_subscription_count",
        ratio("subscription_mrr_usd", "effective_cost_usd").alias("revenue_to_spend_ratio"),
        F.lit(settings.reporting_currency).alias("reporting_currency"),
    )


def agg_service_monthly_spend(fact: DataFrame) -> DataFrame:
    """Spend per customer, month, provider and service, ranked within the customer month.

    A window group holds the services of one customer month, at most the providers'
    catalogues, so rank and total share one sort.
    """
    keys = [
        "customer_id",
        "customer_name",
        "customer_segment",
        "usage_month",
        "cloud_provider",
        "service_id",
        "service_name",
        "service_category",
    ]
    service = summarise(
        fact,
        keys,
        sums=["usage_quantity", *COST_MEASURES, "total_savings_usd"],
        distinct={"sku_count": "sku_id", "region_count": "cloud_region"},
        rows="usage_line_count",
    )
    month = ["customer_id", "usage_month"]
    total, rank = "customer_month_effective_cost_usd", "service_cost_rank"
    tie_break = ["cloud_provider", "service_id", "service_category", "service_name"]
    ranked = rank_by_amount(
        add_window_total(service, month, "effective_cost_usd", total),
        month,
        "effective_cost_usd",
        tie_break,
        rank,
    )
    return ranked.withColumn(
        "share_of_customer_month_spend", ratio("effective_cost_usd", total)
    )


def allocated_spend(fact: DataFrame) -> DataFrame:
    """Spend per customer, month, provider and label bucket, from one pass over the fact.

    Reports that need no share of the month start here and spare the total.
    """
    labels = ("environment", "team", "cost_centre", "application")
    unlabelled = F.when(F.col("cost_centre").isNull(), F.col("effective_cost_usd"))
    lines = fact.withColumns(
        {
            "_unallocated": unlabelled,
            **{name: F.coalesce(F.col(name), F.lit(UNALLOCATED)) for name in labels},
        }
    )
    keys = ["customer_id", "customer_name", "customer_segment", "usage_month", "cloud_provider", *labels]
    measures = ["net_cost_usd", "credit_amount_usd", "effective_cost_usd", "total_savings_usd"]
    return summarise(
        lines,
        keys,
        sums={**{name: name for name in measures}, "unallocated_cost_usd": "_unallocated"},
        rows="usage_line_count",
    )


def agg_cost_allocation_monthly(fact: DataFrame) -> DataFrame:
    """Spend per label bucket with its share of the customer's month.

    Labels are free text, so the buckets of one customer month have no bound: the total is
    joined, not computed as a window.  It is the sum of the buckets' amounts, as a window's would
    be, so the shares of a month add up to one.
    """
    total, allocated = "customer_month_effective_cost_usd", allocated_spend(fact)
    with_total = add_joined_total(
        allocated, allocated, ["customer_id", "usage_month"], "effective_cost_usd", total
    )
    return with_total.withColumns(
        {
            "share_of_customer_month_spend": ratio("effective_cost_usd", total),
            "is_missing_cost_centre": F.col("cost_centre") == UNALLOCATED,
        }
    )
