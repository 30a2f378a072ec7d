"""The 22 models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification.base_sql import money, sql
from verification.catalog import Models, query

_STAMPS = "'{0}' AS _source_table, true AS is_stamped"


def _stamped(df: DataFrame) -> DataFrame:
    """The load time differs between runs; only say whether it is there."""
    return df.withColumn("is_stamped", F.col("_loaded_at").isNotNull()).drop("_loaded_at")


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """UTC timestamps as plain ones, to be compared with SQL timestamps."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "raw_customers",
    sql(
        f"""SELECT customer_id, customer_name, industry, address_city, account_manager_id,
               contact_count, subscription_count, billing_account_count,
               {_STAMPS.format("landing.customers")} FROM cust""",
        "cust",
    ),
)
def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _stamped(Models(spark, folder).raw_customers).select(
        "customer_id",
        "customer_name",
        "industry",
        F.col("address.city").alias("address_city"),
        F.col("account_manager.employee_id").alias("account_manager_id"),
        F.array_size("contacts").cast("long").alias("contact_count"),
        F.array_size("subscriptions").cast("long").alias("subscription_count"),
        F.array_size("billing_accounts").cast("long").alias("billing_account_count"),
        "_source_table",
        "is_stamped",
    )


@query(
    "raw_products",
    sql(
        f"""SELECT product_id, product_name, product_family, launch_date, feature_count,
               pricing_model, base_fee_usd, {_STAMPS.format("landing.products")} FROM prod""",
        "prod",
    ),
)
def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    return _stamped(Models(spark, folder).raw_products).select(
        "product_id",
        "product_name",
        "product_family",
        "launch_date",
        F.array_size("features").cast("long").alias("feature_count"),
        F.col("pricing.model").alias("pricing_model"),
        F.col("pricing.base_fee_usd").alias("base_fee_usd"),
        "_source_table",
        "is_stamped",
    )


@query(
    "raw_cloud_usage",
    sql(
        f"""SELECT usage_id, usage_date, customer_id, billing_account_id, cloud_provider,
               list_cost_usd, credit_count, label_count,
               {_STAMPS.format("landing.cloud_usage")} FROM usage""",
        "usage",
    ),
)
def raw_cloud_usage(spark: SparkSession, folder: str) -> DataFrame:
    return _stamped(Models(spark, folder).raw_cloud_usage).select(
        "usage_id",
        "usage_date",
        "customer_id",
        "billing_account_id",
        "cloud_provider",
        "cost.list_cost_usd",
        F.array_size("credits").cast("long").alias("credit_count"),
        F.array_size("labels").cast("long").alias("label_count"),
        "_source_table",
        "is_stamped",
    )


@query("stg_customers", sql("SELECT * EXCLUDE (k, nk) FROM cust", "cust"))
def stg_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _naive(Models(spark, folder).stg_customers.drop("_loaded_at"), "customer_created_at")


@query("stg_customer_contacts", sql("SELECT * FROM contacts", "contacts"))
def stg_customer_contacts(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_customer_contacts


@query("stg_subscriptions", sql("SELECT * FROM subs", "subs"))
def stg_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_subscriptions


@query("stg_billing_accounts", sql("SELECT * FROM accounts", "accounts"))
def stg_billing_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_billing_accounts


@query("stg_products", sql("SELECT * EXCLUDE (k) FROM prod", "prod"))
def stg_products(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_products.drop("supported_providers", "_loaded_at")


@query("stg_product_features", sql("SELECT * FROM features", "features"))
def stg_product_features(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_product_features


@query("stg_product_pricing_tiers", sql("SELECT * FROM tiers", "tiers"))
def stg_product_pricing_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_product_pricing_tiers


@query(
    "stg_cloud_usage",
    sql(
        """SELECT *, 'env=' || environment || ',team=' || team
                   || coalesce(',cost_centre=' || cost_centre, '')
                   || coalesce(',app=' || application, '') AS labels FROM usage""",
        "usage",
    ),
)
def stg_cloud_usage(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).stg_cloud_usage.drop("_loaded_at")
    pairs = F.transform("labels", lambda item: F.concat(item["key"], F.lit("="), item["value"]))
    return _naive(usage.withColumn("labels", F.array_join(pairs, ",")), "exported_at")


@query("stg_cloud_usage_credits", sql("SELECT * FROM credits", "credits"))
def stg_cloud_usage_credits(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_cloud_usage_credits


@query("stg_cloud_usage_labels", sql("SELECT * FROM labels_tall", "labels_tall"))
def stg_cloud_usage_labels(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).stg_cloud_usage_labels


@query("dim_customers", sql("SELECT * FROM dim_cust", "dim_cust"))
def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _naive(Models(spark, folder).dim_customers, "customer_created_at")


@query(
    "dim_products",
    sql(
        f"""
        SELECT p.* EXCLUDE (k, feature_count, pricing_tier_count),
               coalesce(t.n, 0) AS pricing_tier_count, min_rate_pct, max_rate_pct,
               max_addressable_monthly_spend_usd, coalesce(f.n, 0) AS feature_count,
               coalesce(ga, 0) AS ga_feature_count, coalesce(preview, 0) AS preview_feature_count,
               coalesce(retired, 0) AS retired_feature_count,
               coalesce(customers, 0) AS customer_count, coalesce(s.n, 0) AS subscription_count,
               coalesce(n_active, 0) AS active_subscription_count,
               coalesce(mrr, 0) AS active_mrr_usd
        FROM prod p
        LEFT JOIN (SELECT product_id, count(*) AS n,
                          count(*) FILTER (availability_status = 'GA') AS ga,
                          count(*) FILTER (availability_status = 'PREVIEW') AS preview,
                          count(*) FILTER (availability_status = 'RETIRED') AS retired
                   FROM features GROUP BY product_id) f ON f.product_id = p.product_id
        LEFT JOIN (SELECT product_id, count(*) AS n, min(rate_pct) AS min_rate_pct,
                          max(rate_pct) AS max_rate_pct,
                          max(max_monthly_spend_usd) AS max_addressable_monthly_spend_usd
                   FROM tiers GROUP BY product_id) t ON t.product_id = p.product_id
        LEFT JOIN (SELECT product_id, count(DISTINCT customer_id) AS customers, count(*) AS n,
                          count(*) FILTER (is_active) AS n_active,
                          {money("CASE WHEN is_active THEN mrr_usd END")} AS mrr
                   FROM subs GROUP BY product_id) s ON s.product_id = p.product_id
        """,
        "prod",
        "features",
        "tiers",
        "subs",
    ),
)
def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).dim_products.drop("supported_providers")


@query(
    "dim_billing_accounts",
    sql(
        f"""
        SELECT a.billing_account_id, a.customer_id, customer_name, customer_segment,
               customer_status, sales_region, account_manager_name, cloud_provider,
               billing_currency, payment_terms, is_reseller_account, activated_on,
               coalesce(n, 0) AS usage_line_count, coalesce(cost, 0) AS lifetime_effective_cost_usd,
               first_usage_date, last_usage_date
        FROM accounts a JOIN cust c ON c.customer_id = a.customer_id
        LEFT JOIN (SELECT billing_account_id, count(*) AS n, min(usage_date) AS first_usage_date,
                          max(usage_date) AS last_usage_date, {money("effective_cost_usd")} AS cost
                   FROM usage GROUP BY billing_account_id) u
          ON u.billing_account_id = a.billing_account_id
        """,
        "accounts",
        "usage",
    ),
)
def dim_billing_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).dim_billing_accounts


@query(
    "fct_subscriptions",
    sql(
        """
        SELECT subscription_id, s.customer_id, s.product_id, customer_name, customer_segment,
               customer_status, sales_region, account_manager_name, product_name, product_family,
               pricing_model, is_active_product, subscription_tier, subscription_status,
               billing_frequency, seats, mrr_usd, arr_usd,
               CASE WHEN seats > 0 THEN mrr_usd / seats END AS mrr_per_seat_usd,
               start_date, end_date, is_active, is_churned, tenure_months
        FROM subs s JOIN cust c ON c.customer_id = s.customer_id
        JOIN prod p ON p.product_id = s.product_id
        """,
        "subs",
        "prod",
    ),
)
def fct_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).fct_subscriptions


@query("fct_cloud_usage_daily", sql("SELECT * FROM fact", "fact"))
def fct_cloud_usage_daily(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).by_customers("fct_cloud_usage_daily")


@query("agg_customer_daily_spend", sql("SELECT * FROM daily", "daily"))
def agg_customer_daily_spend(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).by_customers("agg_customer_daily_spend")


@query("agg_customer_monthly_spend", sql("SELECT * FROM monthly", "monthly"))
def agg_customer_monthly_spend(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).by_customers("agg_customer_monthly_spend")


@query("agg_service_monthly_spend", sql("SELECT * FROM services", "services"))
def agg_service_monthly_spend(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).by_customers("agg_service_monthly_spend")


@query("agg_cost_allocation_monthly", sql("SELECT * FROM allocation", "allocation"))
def agg_cost_allocation_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).by_customers("agg_cost_allocation_monthly")
