"""The declared data checks of all layers.

Fixed values: which column carries which check, and the accepted values.
"""

from __future__ import annotations

from spendlake.operators.quality import Check

CUSTOMER_STATUSES = ("active", "churned")
CUSTOMER_SEGMENTS = ("Enterprise", "Mid-Market", "Startup")
CLOUD_PROVIDERS = ("GCP", "AWS", "Azure")
AVAILABILITIES = ("GA", "PREVIEW", "RETIRED")
CREDIT_TYPES = (
    "committed_use_discount",
    "sustained_use_discount",
    "promotional_credit",
    "reseller_discount",
)


def _key(model: str, column: str) -> list[Check]:
    return [Check(model, column, "not_null"), Check(model, column, "unique")]


def _present(model: str, *columns: str) -> list[Check]:
    return [Check(model, column, "not_null") for column in columns]


def _reference(model: str, column: str, parent: str, required: bool = True) -> list[Check]:
    link = Check(model, column, "relationships", parent=parent, parent_column=column)
    return [*(_present(model, column) if required else []), link]


def _one_of(model: str, column: str, accepted: tuple[str, ...]) -> list[Check]:
    return [Check(model, column, "accepted_values", accepted=accepted)]


SOURCE_CHECKS = [
    *_key("customers", "customer_id"),
    *_key("products", "product_id"),
    *_key("cloud_usage", "usage_id"),
    *_present("cloud_usage", "usage_date"),
]

RAW_CHECKS = [
    *_key("raw_customers", "customer_id"),
    *_present("raw_customers", "customer_name"),
    *_key("raw_products", "product_id"),
    *_key("raw_cloud_usage", "usage_id"),
    *_reference("raw_cloud_usage", "customer_id", "raw_customers"),
]

STAGING_CHECKS = [
    *_key("stg_customers", "customer_id"),
    *_one_of("stg_customers", "customer_status", CUSTOMER_STATUSES),
    *_one_of("stg_customers", "customer_segment", CUSTOMER_SEGMENTS),
    *_key("stg_customer_contacts", "contact_id"),
    *_reference("stg_customer_contacts", "customer_id", "stg_customers"),
    *_key("stg_subscriptions", "subscription_id"),
    *_reference("stg_subscriptions", "customer_id", "stg_customers"),
    *_reference("stg_subscriptions", "product_id", "stg_products"),
    *_present("stg_subscriptions", "mrr_usd"),
    *_key("stg_billing_accounts", "billing_account_id"),
    *_reference("stg_billing_accounts", "customer_id", "stg_customers"),
    *_one_of("stg_billing_accounts", "cloud_provider", CLOUD_PROVIDERS),
    *_key("stg_products", "product_id"),
    *_reference("stg_product_features", "product_id", "stg_products"),
    *_present("stg_product_features", "feature_code"),
    *_one_of("stg_product_features", "availability_status", AVAILABILITIES),
    *_reference("stg_product_pricing_tiers", "product_id", "stg_products"),
    *_present("stg_product_pricing_tiers", "tier_name"),
    *_key("stg_cloud_usage", "usage_id"),
    *_reference("stg_cloud_usage", "customer_id", "stg_customers"),
    *_reference("stg_cloud_usage", "billing_account_id", "stg_billing_accounts"),
    *_one_of("stg_cloud_usage", "cloud_provider", CLOUD_PROVIDERS),
    *_present("stg_cloud_usage", "net_cost_usd"),
    *_present("stg_cloud_usage_credits", "credit_id"),
    *_reference("stg_cloud_usage_credits", "usage_id", "stg_cloud_usage"),
    *_one_of("stg_cloud_usage_credits", "credit_type", CREDIT_TYPES),
    *_reference("stg_cloud_usage_labels", "usage_id", "stg_cloud_usage"),
    *_present("stg_cloud_usage_labels", "label_key"),
]

CORE_CHECKS = [
    *_key("dim_customers", "customer_id"),
    *_present("dim_customers", "active_mrr_usd"),
    *_key("dim_products", "product_id"),
    *_key("dim_billing_accounts", "billing_account_id"),
    *_reference("dim_billing_accounts", "customer_id", "dim_customers"),
    *_one_of("dim_billing_accounts", "cloud_provider", CLOUD_PROVIDERS),
    *_key("fct_subscriptions", "subscription_id"),
    *_reference("fct_subscriptions", "customer_id", "dim_customers"),
    *_reference("fct_subscriptions", "product_id", "dim_products"),
    *_present("fct_subscriptions", "mrr_usd"),
]

FINOPS_CHECKS = [
    *_key("fct_cloud_usage_daily", "usage_id"),
    *_reference("fct_cloud_usage_daily", "customer_id", "dim_customers"),
    *_reference("fct_cloud_usage_daily", "billing_account_id", "dim_billing_accounts"),
    *_present("fct_cloud_usage_daily", "effective_cost_usd"),
    *_key("agg_customer_daily_spend", "customer_provider_day_key"),
    *_present("agg_customer_daily_spend", "effective_cost_usd"),
    *_key("agg_customer_monthly_spend", "customer_month_key"),
    *_reference("agg_customer_monthly_spend", "customer_id", "dim_customers", required=False),
    *_present("agg_customer_monthly_spend", "effective_cost_usd"),
    *_present("agg_service_monthly_spend", "customer_id", "service_id"),
    *_present("agg_cost_allocation_monthly", "customer_id", "effective_cost_usd"),
]

ALL_CHECKS = [*SOURCE_CHECKS, *RAW_CHECKS, *STAGING_CHECKS, *CORE_CHECKS, *FINOPS_CHECKS]
