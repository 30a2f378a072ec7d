"""Core marts: customers, products, billing accounts and subscriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import (
    amount_parts,
    exact_sum,
    joined_amount,
    month_boundaries,
    ratio,
    text_list,
)
from spendlake.operators.grouping import summarise
from spendlake.operators.joins import add_rollups, keep_known
from spendlake.settings import Settings

CUSTOMER_ATTRIBUTES = [
    "customer_id",
    "customer_name",
    "customer_segment",
    "customer_status",
    "sales_region",
    "account_manager_name",
]


def dim_customers(
    customers: DataFrame,
    subscriptions: DataFrame,
    accounts: DataFrame,
    contacts: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Customer dimension with revenue, cloud footprint and primary contact.

    Name and e-mail of the primary contact are the maximum of each on its own, so a customer
    with two primary contacts may show the name of one and the e-mail of the other.
    """
    revenue = subscriptions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("subscription_count"),
        F.count_if("is_active").alias("active_subscription_count"),
        exact_sum(F.when(F.col("is_active"), F.col("mrr_usd"))).alias("active_mrr_usd"),
        exact_sum(F.when(F.col("is_active"), F.col("arr_usd"))).alias("active_arr_usd"),
        F.min("start_date").alias("first_subscription_date"),
    )
    # A handful of providers exist, so their set is small.
    providers = F.array_sort(F.collect_set("cloud_provider"))
    footprint = accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("billing_account_count"),
        F.count_distinct("cloud_provider").alias("cloud_provider_count"),
        # NULL, not '', when no account names a provider.
        F.when(F.array_size(providers) > 0, text_list(providers)).alias("cloud_providers"),
        F.min("activated_on").alias("first_account_activated_on"),
    )
    primary = (
        contacts.where("is_primary_contact")
        .groupBy("customer_id")
        .agg(
            F.max("contact_name").alias("primary_contact_name"),
            F.max("contact_email").alias("primary_contact_email"),
        )
    )
    # The counts of the joined rows replace the array lengths of the master record.
    master = customers.drop("subscription_count", "billing_account_count")
    joined = add_rollups(
        master,
        [revenue, footprint, primary],
        "customer_id",
        {
            "subscription_count": 0,
            "active_subscription_count": 0,
            "active_mrr_usd": 0.0,
            "active_arr_usd": 0.0,
            "billing_account_count": 0,
            "cloud_provider_count": 0,
        },
    )
    return joined.select(
        "customer_id",
        "customer_name",
        "customer_status",
        "customer_segment",
        "industry",
        "sales_region",
        "address_country",
        "address_country_code",
        "address_city",
        "account_manager_id",
        "account_manager_name",
        "account_manager_email",
        "primary_contact_name",
        "primary_contact_email",
        "contact_count",
        "subscription_count",
        "active_subscription_count",
        "active_mrr_usd",
        "active_arr_usd",
        "first_subscription_date",
        "billing_account_count",
        "cloud_provider_count",
        "cloud_providers",
        (F.col("cloud_provider_count") > 1).alias("is_multicloud"),
        "first_account_activated_on",
        "customer_created_at",
        "customer_created_date",
        month_boundaries(settings.as_of_date(), "customer_created_date").alias(
            "customer_tenure_months"
        ),
    )


def dim_products(
    products: DataFrame, features: DataFrame, tiers: DataFrame, subscriptions: DataFrame
) -> DataFrame:
    """Product dimension with feature availability, price range and adoption."""
    status = F.col("availability_status")
    availability = features.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("feature_count"),
        F.count_if(status == "GA").alias("ga_feature_count"),
        F.count_if(status == "PREVIEW").alias("preview_feature_count"),
        F.count_if(status == "RETIRED").alias("retired_feature_count"),
    )
    prices = tiers.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("pricing_tier_count"),
        F.min("rate_pct").alias("min_rate_pct"),
        F.max("rate_pct").alias("max_rate_pct"),
        F.max("max_monthly_spend_usd").alias("max_addressable_monthly_spend_usd"),
    )
    adoption = summarise(
        subscriptions,
        ["product_id"],
        sums={"active_mrr_usd": F.when(F.col("is_active"), F.col("mrr_usd"))},
        distinct={"customer_count": "customer_id"},
        others={"active_subscription_count": F.count_if("is_active")},
        rows="subscription_count",
    )
    joined = add_rollups(
        products.drop("feature_count", "pricing_tier_count"),
        [availability, prices, adoption],
        "product_id",
        {
            "pricing_tier_count": 0,
            "feature_count": 0,
            "ga_feature_count": 0,
            "preview_feature_count": 0,
            "retired_feature_count": 0,
            "customer_count": 0,
            "subscription_count": 0,
            "active_subscription_count": 0,
            "active_mrr_usd": 0.0,
        },
    )
    return joined.select(
        "product_id",
        "product_name",
        "product_family",
        "product_description",
        "is_active_product",
        "launch_date",
        "supported_providers",
        "supported_providers_list",
        "supported_provider_count",
        "pricing_model",
        "pricing_currency",
        "base_fee_usd",
        "pricing_tier_count",
        "min_rate_pct",
        "max_rate_pct",
        "max_addressable_monthly_spend_usd",
        "feature_count",
        "ga_feature_count",
        "preview_feature_count",
        "retired_feature_count",
        "customer_count",
        "subscription_count",
        "active_subscription_count",
        "active_mrr_usd",
    )


_COST_PARTS = [f"cost_part_{n}" for n in range(4)]


def _usage_state(usage: DataFrame) -> DataFrame:
    """What a line adds to its account: a count and the parts of its cost, which add up exactly."""
    parts = zip(_COST_PARTS, amount_parts("effective_cost_usd"), strict=True)
    return usage.select(
        "billing_account_id",
        "usage_date",
        F.lit(1).cast("long").alias("usage_line_count"),
        *[part.alias(name) for name, part in parts],
    )


def account_usage_by_day(usage: DataFrame) -> DataFrame:
    """Mergeable totals per account and day, from which lifetime totals are made without the lines."""
    sums = [F.sum(name).alias(name) for name in ("usage_line_count", *_COST_PARTS)]
    return _usage_state(usage).groupBy("billing_account_id", "usage_date").agg(*sums)


def dim_billing_accounts(
    accounts: DataFrame, customers: DataFrame, usage: DataFrame
) -> DataFrame:
    """Billing account with its customer and its lifetime usage."""
    return billing_accounts_by_state(accounts, customers, _usage_state(usage))


def billing_accounts_by_state(
    accounts: DataFrame, customers: DataFrame, state: DataFrame
) -> DataFrame:
    """The same from totals per account and day, or any finer ones."""
    lifetime = state.groupBy("billing_account_id").agg(
        F.min("usage_date").alias("first_usage_date"),
        F.max("usage_date").alias("last_usage_date"),
        F.sum("usage_line_count").alias("usage_line_count"),
        joined_amount([F.sum(name) for name in _COST_PARTS]).alias("lifetime_effective_cost_usd"),
    )
    # As many customers as accounts, in proportion: merged, so that none goes through the driver.
    owners = customers.select(*CUSTOMER_ATTRIBUTES).hint("merge")
    owned = keep_known(accounts, owners, "customer_id")
    joined = add_rollups(
        owned,
        [lifetime],
        "billing_account_id",
        {"usage_line_count": 0, "lifetime_effective_cost_usd": 0.0},
    )
    return joined.select(
        "billing_account_id",
        *CUSTOMER_ATTRIBUTES,
        "cloud_provider",
        "billing_currency",
        "payment_terms",
        "is_reseller_account",
        "activated_on",
        "usage_line_count",
        "lifetime_effective_cost_usd",
        "first_usage_date",
        "last_usage_date",
    )


def fct_subscriptions(
    subscriptions: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Subscription fact; subscriptions of unknown customers or products are dropped."""
    catalogue = products.select(
        "product_id", "product_name", "product_family", "pricing_model", "is_active_product"
    )
    joined = keep_known(
        keep_known(subscriptions, customers.select(*CUSTOMER_ATTRIBUTES), "customer_id"),
        catalogue,
        "product_id",
    )
    return joined.select(
        "subscription_id",
        "customer_id",
        "product_id",
        *CUSTOMER_ATTRIBUTES[1:],
        "product_name",
        "product_family",
        "pricing_model",
        "is_active_product",
        "subscription_tier",
        "subscription_status",
        "billing_frequency",
        "seats",
        "mrr_usd",
        "arr_usd",
        ratio("mrr_usd", "seats").alias("mrr_per_seat_usd"),
        "start_date",
        "end_date",
        "is_active",
        "is_churned",
        "tenure_months",
    )
