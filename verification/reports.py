"""The example reports.  Ties are broken by a key, so limits pick the same rows everywhere."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from spendlake.plans import reports, staging
from verification.base_sql import money, sql
from verification.catalog import Models, query

# An event that is a purchase, so the line has a credit.
LINE = "evt_48"


@query(
    "rpt_usage_line",
    sql(
        f"""SELECT usage_id, usage_date, customer_id, cloud_provider, service_name,
               sku_description, usage_quantity, usage_unit, list_cost_usd, discount_usd,
               net_cost_usd, credit_amount_usd, effective_cost_usd, environment,
               CAST(NULL AS VARCHAR) AS team, CAST(NULL AS VARCHAR) AS cost_centre
        FROM event_lines WHERE usage_id = '{LINE}'""",
        "event_lines",
    ),
)
def usage_line(spark: SparkSession, folder: str) -> DataFrame:
    return reports.usage_line(Models(spark, folder).stg_event_usage, LINE)


@query(
    "rpt_grain_check",
    sql(
        """SELECT count(*) AS total_rows, count(DISTINCT usage_date) AS days,
               count(DISTINCT billing_account_id) AS accounts,
               count(DISTINCT service_id) AS services, count(DISTINCT sku_id) AS skus
        FROM usage""",
        "usage",
    ),
)
def grain_check(spark: SparkSession, folder: str) -> DataFrame:
    return reports.grain_check(Models(spark, folder).stg_cloud_usage)


@query(
    "rpt_credits_of_line",
    sql(
        f"""SELECT usage_id, 'promotional_credit' AS credit_type, credit_amount_usd
        FROM event_lines WHERE usage_id = '{LINE}' AND event_type = 'purchase'""",
        "event_lines",
    ),
)
def credits_of_line(spark: SparkSession, folder: str) -> DataFrame:
    credits = staging.stg_cloud_usage_credits(Models(spark, folder).raw_event_usage)
    return reports.credits_of_line(credits, LINE)


@query(
    "rpt_labels_of_line",
    sql(
        f"""SELECT usage_id, 'env' AS label_key, event_type AS label_value
        FROM event_lines WHERE usage_id = '{LINE}'""",
        "event_lines",
    ),
)
def labels_of_line(spark: SparkSession, folder: str) -> DataFrame:
    labels = staging.stg_cloud_usage_labels(Models(spark, folder).raw_event_usage)
    return reports.labels_of_line(labels, LINE)


@query(
    "rpt_subscriptions",
    sql(
        """SELECT customer_id, subscription_id, product_id, subscription_tier, seats, mrr_usd,
               subscription_status, start_date, end_date
        FROM subs ORDER BY customer_id, subscription_id LIMIT 8""",
        "subs",
    ),
)
def first_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return reports.first_subscriptions(Models(spark, folder).stg_subscriptions)


@query(
    "rpt_spend_vs_revenue",
    sql(
        """SELECT customer_name, usage_month, round(effective_cost_usd) AS cloud_spend,
               round(subscription_mrr_usd) AS our_revenue,
               round(revenue_to_spend_ratio, 3) AS rev_per_dollar_spend,
               round(total_savings_usd) AS savings
        FROM monthly ORDER BY usage_month, cloud_spend DESC, customer_name""",
        "monthly",
    ),
)
def spend_vs_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.spend_vs_revenue(Models(spark, folder).agg_customer_monthly_spend)


@query(
    "rpt_top_cost_drivers",
    sql(
        """SELECT customer_name, usage_month, cloud_provider, service_name,
               round(effective_cost_usd) AS spend,
               round(share_of_customer_month_spend * 100, 1) AS pct_of_month, service_cost_rank
        FROM services WHERE service_cost_rank <= 3 AND usage_month = DATE '1998-05-01'
        ORDER BY customer_name, service_cost_rank LIMIT 12""",
        "services",
    ),
)
def top_cost_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_cost_drivers(
        Models(spark, folder).agg_service_monthly_spend, date(1998, 5, 1)
    )


@query(
    "rpt_spend_spikes",
    sql(
        """SELECT customer_name, cloud_provider, usage_date, round(effective_cost_usd) AS spend,
               round(effective_cost_7d_avg_usd) AS avg_7d,
               round(spend_vs_7d_avg_ratio, 2) AS vs_avg,
               round(day_over_day_change_pct * 100, 1) AS dod_pct
        FROM daily WHERE spend_vs_7d_avg_ratio IS NOT NULL
        ORDER BY spend_vs_7d_avg_ratio DESC, customer_provider_day_key LIMIT 8""",
        "daily",
    ),
)
def spend_spikes(spark: SparkSession, folder: str) -> DataFrame:
    return reports.spend_spikes(Models(spark, folder).agg_customer_daily_spend)


@query(
    "rpt_unallocated_share",
    sql(
        f"""SELECT cost_centre, round(amount) AS spend,
               round(100.0 * amount / (SELECT {money("amount")} FROM by_centre), 1) AS pct
        FROM by_centre ORDER BY spend DESC, cost_centre""",
        "allocation",
    ).replace(
        "SELECT cost_centre, round(amount)",
        f""", by_centre AS (SELECT cost_centre, {money("effective_cost_usd")} AS amount
            FROM allocation GROUP BY cost_centre) SELECT cost_centre, round(amount)""",
        1,
    ),
)
def unallocated_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.unallocated_share(Models(spark, folder).allocated_spend)


@query(
    "rpt_spend_by_environment",
    sql(
        f"""SELECT environment, round({money("effective_cost_usd")}) AS spend
        FROM allocation GROUP BY environment ORDER BY spend DESC, environment""",
        "allocation",
    ),
)
def spend_by_environment(spark: SparkSession, folder: str) -> DataFrame:
    return reports.spend_by_environment(Models(spark, folder).allocated_spend)


@query(
    "rpt_customer_360",
    sql(
        """SELECT customer_name, customer_segment, sales_region, customer_status,
               active_subscription_count, round(active_mrr_usd) AS mrr, cloud_providers,
               is_multicloud
        FROM dim_cust ORDER BY active_mrr_usd DESC, customer_name""",
        "dim_cust",
    ),
)
def customer_360(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_360(Models(spark, folder).dim_customers)
