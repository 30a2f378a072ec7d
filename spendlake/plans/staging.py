"""Staging models: structs to columns, arrays to rows, names made uniform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions import (
    array_count,
    array_total,
    day_name,
    is_weekend,
    label_value,
    month_boundaries,
    month_of,
    ratio,
    text_list,
    utc_date,
)
from spendlake.operators.nested import explode_labels, explode_structs
from spendlake.settings import Settings


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    """One row per customer."""
    return raw_customers.select(
        "customer_id",
        "customer_name",
        F.lower("status").alias("customer_status"),
        F.col("segment").alias("customer_segment"),
        "industry",
        F.col("address.street").alias("address_street"),
        F.col("address.city").alias("address_city"),
        F.col("address.country").alias("address_country"),
        F.col("address.country_code").alias("address_country_code"),
        F.col("address.region").alias("sales_region"),
        F.col("account_manager.employee_id").alias("account_manager_id"),
        F.col("account_manager.name").alias("account_manager_name"),
        F.col("account_manager.email").alias("account_manager_email"),
        array_count("contacts").alias("contact_count"),
        array_count("subscriptions").alias("subscription_count"),
        array_count("billing_accounts").alias("billing_account_count"),
        F.col("created_at").alias("customer_created_at"),
        utc_date("created_at").alias("customer_created_date"),
        "_loaded_at",
    )


def stg_customer_contacts(raw_customers: DataFrame) -> DataFrame:
    """One row per contact."""
    contacts = explode_structs(raw_customers, "contacts", ["customer_id"], alias="contact")
    return contacts.select(
        "contact.contact_id",
        "customer_id",
        F.col("contact.full_name").alias("contact_name"),
        F.col("contact.email").alias("contact_email"),
        F.col("contact.role").alias("contact_role"),
        F.col("contact.is_primary").alias("is_primary_contact"),
    )


def stg_subscriptions(raw_customers: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per subscription, with yearly revenue and tenure."""
    subscriptions = explode_structs(raw_customers, "subscriptions", ["customer_id"], alias="sub")
    flat = subscriptions.select(
        "sub.subscription_id",
        "customer_id",
        "sub.product_id",
        F.col("sub.tier").alias("subscription_tier"),
        F.lower("sub.status").alias("subscription_status"),
        "sub.billing_frequency",
        "sub.seats",
        "sub.mrr_usd",
        (F.col("sub.mrr_usd") * 12).alias("arr_usd"),
        "sub.start_date",
        "sub.end_date",
    )
    until = F.coalesce("end_date", settings.as_of_date())
    return flat.withColumns(
        {
            "is_active": (F.col("subscription_status") == "active") & F.col("end_date").isNull(),
            "is_churned": F.col("end_date").isNotNull(),
            "tenure_months": month_boundaries(until, "start_date"),
        }
    )


def stg_billing_accounts(raw_customers: DataFrame) -> DataFrame:
    """One row per cloud billing account."""
    accounts = explode_structs(raw_customers, "billing_accounts", ["customer_id"], alias="account")
    return accounts.select(
        "account.billing_account_id",
        "customer_id",
        "account.cloud_provider",
        F.col("account.currency").alias("billing_currency"),
        "account.payment_terms",
        "account.is_reseller_account",
        "account.activated_on",
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    """One row per product."""
    return raw_products.select(
        "product_id",
        "product_name",
        "product_family",
        F.col("description").alias("product_description"),
        F.col("is_active").alias("is_active_product"),
        "launch_date",
        "supported_providers",
        text_list("supported_providers").alias("supported_providers_list"),
        array_count("supported_providers").alias("supported_provider_count"),
        array_count("features").alias("feature_count"),
        F.col("pricing.model").alias("pricing_model"),
        F.col("pricing.currency").alias("pricing_currency"),
        F.col("pricing.base_fee_usd").alias("base_fee_usd"),
        array_count("pricing.tiers").alias("pricing_tier_count"),
        "_loaded_at",
    )


def stg_product_features(raw_products: DataFrame) -> DataFrame:
    """One row per product and feature."""
    features = explode_structs(raw_products, "features", ["product_id"], alias="feature")
    return features.select(
        "product_id",
        "feature.feature_code",
        "feature.feature_name",
        F.col("feature.availability").alias("availability_status"),
        F.col("feature.min_tier").alias("minimum_tier"),
        (F.col("feature.availability") == "GA").alias("is_generally_available"),
    )


def stg_product_pricing_tiers(raw_products: DataFrame) -> DataFrame:
    """One row per product and pricing tier; the tiers sit in an array inside a struct."""
    keep = [
        "product_id",
        F.col("pricing.model").alias("pricing_model"),
        F.col("pricing.currency").alias("pricing_currency"),
    ]
    tiers = explode_structs(raw_products, "pricing.tiers", keep, alias="tier")
    return tiers.select(
        "product_id",
        "tier.tier_name",
        "pricing_model",
        "pricing_currency",
        F.col("tier.min_monthly_spend_usd").cast("double").alias("min_monthly_spend_usd"),
        F.col("tier.max_monthly_spend_usd").cast("double").alias("max_monthly_spend_usd"),
        "tier.rate_pct",
        "tier.included_support",
    )


def stg_cloud_usage(raw_cloud_usage: DataFrame) -> DataFrame:
    """One flat row per usage line, with the usual labels and the credit total lifted out."""
    flat = raw_cloud_usage.select(
        "usage_id",
        "usage_date",
        F.col("export_time").alias("exported_at"),
        month_of("usage_date").alias("usage_month"),
        day_name("usage_date").alias("usage_day_name"),
        is_weekend("usage_date").alias("is_weekend"),
        "customer_id",
        "billing_account_id",
        "cloud_provider",
        "project.project_id",
        "project.project_name",
        "service.service_id",
        "service.service_name",
        "service.service_category",
        "sku.sku_id",
        "sku.sku_description",
        "sku.pricing_unit",
        "sku.list_unit_price_usd",
        F.col("location.region").alias("cloud_region"),
        F.col("location.zone").alias("cloud_zone"),
        F.col("usage.quantity").alias("usage_quantity"),
        F.col("usage.unit").alias("usage_unit"),
        "cost.list_cost_usd",
        "cost.discount_usd",
        "cost.net_cost_usd",
        F.col("cost.currency").alias("cost_currency"),
        F.col("savings.flexsave_eligible").alias("is_flexsave_eligible"),
        "savings.flexsave_savings_usd",
        "savings.optimisation_savings_usd",
        label_value("labels", "env").alias("environment"),
        label_value("labels", "team").alias("team"),
        label_value("labels", "cost_centre").alias("cost_centre"),
        label_value("labels", "app").alias("application"),
        "labels",
        array_count("labels").alias("label_count"),
        array_count("credits").alias("credit_count"),
        array_total("credits", "amount_usd").alias("credit_amount_usd"),
        "_loaded_at",
    )
    return flat.withColumns(
        {
            "effective_cost_usd": F.col("net_cost_usd") + F.col("credit_amount_usd"),
            "total_savings_usd": F.col("flexsave_savings_usd") + F.col("optimisation_savings_usd"),
            "discount_rate": ratio("discount_usd", "list_cost_usd"),
        }
    )


def stg_cloud_usage_credits(raw_cloud_usage: DataFrame) -> DataFrame:
    """One row per usage line and credit."""
    keep = ["usage_id", "usage_date", "customer_id", "billing_account_id", "cloud_provider"]
    credited = raw_cloud_usage.where(F.array_size("credits") > 0)
    credits = explode_structs(credited, "credits", keep, alias="credit")
    return credits.select(
        "credit.credit_id",
        "usage_id",
        "usage_date",
        month_of("usage_date").alias("usage_month"),
        "customer_id",
        "billing_account_id",
        "cloud_provider",
        "credit.credit_type",
        F.col("credit.amount_usd").alias("credit_amount_usd"),
        F.abs("credit.amount_usd").alias("credit_abs_amount_usd"),
    )


def stg_cloud_usage_labels(raw_cloud_usage: DataFrame) -> DataFrame:
    """One row per usage line and label."""
    labelled = raw_cloud_usage.where(F.array_size("labels") > 0)
    return explode_labels(labelled, "labels", ["usage_id", "usage_date", "customer_id"])
