"""Projections, nested arrays, filters and scalar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import functions as fn
from spendlake.operators.nested import explode_labels, explode_structs
from spendlake.plans.raw import stamp
from verification.base_sql import ratio, sql
from verification.catalog import AS_OF, SETTINGS, Models, query

# --- projections -----------------------------------------------------------------------------


@query(
    "flatten_structs",
    sql(
        """SELECT usage_id, project_id, project_name, service_id, service_name, service_category,
               cloud_region, cloud_zone, list_cost_usd, discount_usd, net_cost_usd FROM usage""",
        "usage",
    ),
)
def flatten_structs(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).raw_cloud_usage.select(
        "usage_id",
        "project.project_id",
        "project.project_name",
        "service.service_id",
        "service.service_name",
        "service.service_category",
        F.col("location.region").alias("cloud_region"),
        F.col("location.zone").alias("cloud_zone"),
        "cost.list_cost_usd",
        "cost.discount_usd",
        "cost.net_cost_usd",
    )


@query(
    "rename_columns",
    """SELECT c_custkey AS customer_key, c_name AS customer_name,
           c_mktsegment AS customer_segment FROM customer""",
)
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    return (
        Models(spark, folder)
        .source("customer")
        .select("c_custkey", "c_name", "c_mktsegment")
        .withColumnsRenamed(
            {
                "c_custkey": "customer_key",
                "c_name": "customer_name",
                "c_mktsegment": "customer_segment",
            }
        )
    )


@query(
    "star_plus_derived",
    """SELECT *, l_extendedprice * (1 - l_discount) AS net_cost,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""",
)
def star_plus_derived(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    return lines.withColumn("net_cost", F.expr("l_extendedprice * (1 - l_discount)")).withColumn(
        "charge", F.col("net_cost") * (F.lit(1) + F.col("l_tax"))
    )


@query("literal_column", "SELECT o_orderkey, 'USD' AS reporting_currency FROM orders")
def literal_column(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    return orders.select("o_orderkey", F.lit(SETTINGS.reporting_currency).alias("reporting_currency"))


@query(
    "composite_key",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_returnflag END
           || '|' || l_suppkey || '|' || CAST(l_shipdate AS DATE) AS line_key FROM lineitem""",
)
def composite_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    flag = F.when(F.col("l_linenumber") != 7, F.col("l_returnflag"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        fn.key_of(flag, "l_suppkey", F.to_date("l_shipdate")).alias("line_key"),
    )


@query(
    "cast_columns",
    """SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_number,
           CAST(p_partkey AS VARCHAR) AS part_text FROM part""",
)
def cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    return (
        Models(spark, folder)
        .source("part")
        .select(
            "p_partkey",
            F.col("p_size").cast("double").alias("size_number"),
            F.col("p_partkey").cast("string").alias("part_text"),
        )
    )


@query("column_subset", "SELECT c_custkey, c_mktsegment FROM customer")
def column_subset(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).source("customer").select("c_custkey", "c_mktsegment")


@query(
    "raw_stamp",
    "SELECT *, 'landing.orders' AS _source_table, true AS is_stamped FROM orders",
)
def raw_stamp(spark: SparkSession, folder: str) -> DataFrame:
    stamped = stamp(Models(spark, folder).source("orders"), "landing.orders")
    return stamped.withColumn("is_stamped", F.col("_loaded_at").isNotNull()).drop("_loaded_at")


# --- nested arrays ---------------------------------------------------------------------------


@query(
    "explode_structs",
    sql(
        """SELECT usage_id, credit_id, credit_type, credit_amount_usd AS amount_usd
        FROM credits""",
        "credits",
    ),
)
def explode_credits(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).raw_cloud_usage
    return explode_structs(usage, "credits", ["usage_id"], "credit").select(
        "usage_id", "credit.credit_id", "credit.credit_type", "credit.amount_usd"
    )


@query(
    "explode_in_struct",
    sql(
        """SELECT product_id, pricing_model, base_fee_usd, tier_name, rate_pct
        FROM tiers JOIN (SELECT product_id, base_fee_usd FROM prod) USING (product_id)""",
        "tiers",
    ),
)
def explode_in_struct(spark: SparkSession, folder: str) -> DataFrame:
    keep = [
        "product_id",
        F.col("pricing.model").alias("pricing_model"),
        F.col("pricing.base_fee_usd").alias("base_fee_usd"),
    ]
    products = Models(spark, folder).raw_products
    return explode_structs(products, "pricing.tiers", keep, "tier").select(
        "product_id", "pricing_model", "base_fee_usd", "tier.tier_name", "tier.rate_pct"
    )


@query(
    "label_value",
    sql("SELECT usage_id, environment, cost_centre, application FROM usage", "usage"),
)
def label_value(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).raw_cloud_usage.select(
        "usage_id",
        fn.label_value("labels", "env").alias("environment"),
        fn.label_value("labels", "cost_centre").alias("cost_centre"),
        fn.label_value("labels", "app").alias("application"),
    )


@query("array_sum", sql("SELECT usage_id, credit_amount_usd FROM usage", "usage"))
def array_sum(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).raw_cloud_usage.select(
        "usage_id", fn.array_total("credits", "amount_usd").alias("credit_amount_usd")
    )


@query("array_length", sql("SELECT usage_id, credit_count, label_count FROM usage", "usage"))
def array_length(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).raw_cloud_usage.select(
        "usage_id",
        fn.array_count("credits").alias("credit_count"),
        fn.array_count("labels").alias("label_count"),
    )


@query("array_to_string", sql("SELECT product_id, supported_providers_list FROM prod", "prod"))
def array_to_string(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).raw_products.select(
        "product_id", fn.text_list("supported_providers").alias("supported_providers_list")
    )


@query(
    "array_passthrough",
    sql(
        """SELECT product_id, supported_provider_count,
               supported_provider_count AS passed_count, supported_providers_list AS passed_text
        FROM prod""",
        "prod",
    ),
)
def array_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    staged = Models(spark, folder).stg_products
    return staged.select(
        "product_id",
        "supported_provider_count",
        fn.array_count("supported_providers").alias("passed_count"),
        fn.text_list("supported_providers").alias("passed_text"),
    )


@query(
    "tall_key_value",
    sql("SELECT usage_id, label_key, label_value FROM labels_tall", "labels_tall"),
)
def tall_key_value(spark: SparkSession, folder: str) -> DataFrame:
    return explode_labels(Models(spark, folder).raw_cloud_usage, "labels", ["usage_id"])


# --- filters ---------------------------------------------------------------------------------


@query(
    "filter_nonempty_array",
    sql("SELECT usage_id, credit_count FROM usage WHERE credit_count > 0", "usage"),
)
def filter_nonempty_array(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).raw_cloud_usage.where(F.array_size("credits") > 0)
    return usage.select("usage_id", fn.array_count("credits").alias("credit_count"))


@query(
    "filter_boolean",
    sql("SELECT contact_id, customer_id FROM contacts WHERE is_primary_contact", "contacts"),
)
def filter_boolean(spark: SparkSession, folder: str) -> DataFrame:
    contacts = Models(spark, folder).stg_customer_contacts
    return contacts.where(F.col("is_primary_contact")).select("contact_id", "customer_id")


@query("filter_point_lookup", "SELECT * FROM lineitem WHERE l_orderkey = 42")
def filter_point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return Models(spark, folder).source("lineitem").where(F.col("l_orderkey") == 42)


@query(
    "filter_rank_and_month",
    sql(
        """SELECT customer_id, cloud_provider, service_id, service_category, service_cost_rank
        FROM services WHERE service_cost_rank <= 3 AND usage_month = DATE '1997-03-01'""",
        "services",
    ),
)
def filter_rank_and_month(spark: SparkSession, folder: str) -> DataFrame:
    services = Models(spark, folder).agg_service_monthly_spend
    month = F.lit(date(1997, 3, 1))
    return services.where((F.col("service_cost_rank") <= 3) & (F.col("usage_month") == month)).select(
        "customer_id", "cloud_provider", "service_id", "service_category", "service_cost_rank"
    )


@query(
    "filter_not_null",
    sql("SELECT usage_id, cost_centre FROM usage WHERE cost_centre IS NOT NULL", "usage"),
)
def filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).stg_cloud_usage
    return usage.where(F.col("cost_centre").isNotNull()).select("usage_id", "cost_centre")


@query(
    "predicate_flags",
    sql(
        """SELECT subscription_id, is_active, is_churned,
               coalesce(product_id = 'prd_1', false) AS is_first_product FROM subs""",
        "subs",
    ),
)
def predicate_flags(spark: SparkSession, folder: str) -> DataFrame:
    flat = Models(spark, folder).stg_subscriptions.drop("is_active", "is_churned")
    return flat.select(
        "subscription_id",
        ((F.col("subscription_status") == "active") & F.col("end_date").isNull()).alias("is_active"),
        F.col("end_date").isNotNull().alias("is_churned"),
        (F.col("product_id") == "prd_1").alias("is_first_product"),
    )


@query(
    "in_list",
    """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE dayofweek(o_orderdate) IN (0, 6) AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def in_list(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    return orders.where(
        fn.is_weekend(F.to_date("o_orderdate")) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    ).select("o_orderkey", "o_orderpriority")


# --- scalar functions ------------------------------------------------------------------------

_ORDER_DAY = "CAST(o_orderdate AS DATE)"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    return orders.withColumn("day", F.to_date("o_orderdate"))


@query(
    "date_trunc_month",
    f"SELECT o_orderkey, CAST(date_trunc('month', {_ORDER_DAY}) AS DATE) AS order_month FROM orders",
)
def date_trunc_month(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select("o_orderkey", fn.month_of("day").alias("order_month"))


@query("day_name", f"SELECT o_orderkey, dayname({_ORDER_DAY}) AS day_name FROM orders")
def day_name(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select("o_orderkey", fn.day_name("day").alias("day_name"))


@query(
    "is_weekend",
    f"SELECT o_orderkey, dayofweek({_ORDER_DAY}) IN (0, 6) AS is_weekend FROM orders",
)
def is_weekend(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select("o_orderkey", fn.is_weekend("day").alias("is_weekend"))


@query("timestamp_to_date", "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events")
def timestamp_to_date(spark: SparkSession, folder: str) -> DataFrame:
    events = Models(spark, folder).source("events")
    return events.select("event_id", fn.utc_date(F.col("ts").cast("timestamp")).alias("event_date"))


@query(
    "month_diff",
    """SELECT l_orderkey, l_linenumber,
           date_diff('month', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS months
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def month_diff(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    joined = models.source("lineitem").join(
        models.source("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    months = fn.month_boundaries(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return joined.select("l_orderkey", "l_linenumber", months.alias("months"))


@query("date_sub_days", f"SELECT o_orderkey, {_ORDER_DAY} - 3 AS three_days_before FROM orders")
def date_sub_days(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return orders.select("o_orderkey", F.date_sub("day", 3).alias("three_days_before"))


@query("last_day", f"SELECT o_orderkey, last_day({_ORDER_DAY}) AS month_end FROM orders")
def last_day(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select("o_orderkey", F.last_day("day").alias("month_end"))


@query(
    "current_date",
    f"""SELECT o_orderkey, date_diff('month', {_ORDER_DAY}, DATE '{AS_OF}') AS tenure_months,
           true AS today_is_later FROM orders""",
)
def current_date(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(
        "o_orderkey",
        fn.month_boundaries(SETTINGS.as_of_date(), "day").alias("tenure_months"),
        (F.current_date() > F.col("day")).alias("today_is_later"),
    )


@query("current_timestamp", "SELECT o_orderkey, true AS is_stamped_after FROM orders")
def current_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    stamped = F.current_timestamp() > F.col("o_orderdate").cast("timestamp")
    return _orders(spark, folder).select("o_orderkey", stamped.alias("is_stamped_after"))


@query("lower", "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer")
def lower(spark: SparkSession, folder: str) -> DataFrame:
    customer = Models(spark, folder).source("customer")
    return customer.select("c_custkey", F.lower("c_mktsegment").alias("segment"))


@query(
    "concat",
    f"SELECT o_orderkey, o_custkey || '|' || o_orderstatus || '|' || {_ORDER_DAY} AS k FROM orders",
)
def concat(spark: SparkSession, folder: str) -> DataFrame:
    key = fn.key_of("o_custkey", "o_orderstatus", "day")
    return _orders(spark, folder).select("o_orderkey", key.alias("k"))


@query(
    "abs",
    sql("SELECT credit_id, abs(credit_amount_usd) AS magnitude FROM credits", "credits"),
)
def absolute(spark: SparkSession, folder: str) -> DataFrame:
    credits = Models(spark, folder).stg_cloud_usage_credits
    return credits.select("credit_id", F.abs("credit_amount_usd").alias("magnitude"))


@query(
    "coalesce",
    sql(
        """SELECT usage_id, coalesce(credit_count, 0) AS credits,
               coalesce(application, 'none') AS application FROM usage""",
        "usage",
    ),
)
def coalesce(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).stg_cloud_usage
    return usage.select(
        "usage_id",
        fn.zero_if_null("credit_count").alias("credits"),
        F.coalesce("application", F.lit("none")).alias("application"),
    )


@query(
    "nullif",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS per_discount
    FROM lineitem""",
)
def nullif(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    per_discount = F.col("l_extendedprice") / F.nullif(F.col("l_discount"), F.lit(0.0))
    return lines.select("l_orderkey", "l_linenumber", per_discount.alias("per_discount"))


@query(
    "guarded_ratio",
    f"""SELECT l_orderkey, l_linenumber, {ratio("l_tax", "l_discount")} AS tax_by_discount
    FROM lineitem""",
)
def guarded_ratio(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    guarded = fn.ratio("l_tax", "l_discount")
    return lines.select("l_orderkey", "l_linenumber", guarded.alias("tax_by_discount"))


@query(
    "arithmetic",
    """SELECT l_orderkey, l_linenumber, l_extendedprice - l_extendedprice * l_discount AS net,
           l_quantity * 12 AS yearly, l_extendedprice + CASE WHEN l_linenumber = 7 THEN NULL
               ELSE l_tax END AS with_missing
    FROM lineitem""",
)
def arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    price = F.col("l_extendedprice")
    tax = F.when(F.col("l_linenumber") != 7, F.col("l_tax"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        (price - price * F.col("l_discount")).alias("net"),
        (F.col("l_quantity") * 12).alias("yearly"),
        (price + tax).alias("with_missing"),
    )


@query(
    "if_null_else",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS open FROM orders",
)
def if_null_else(spark: SparkSession, folder: str) -> DataFrame:
    open_price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
    return _orders(spark, folder).select("o_orderkey", open_price.alias("open"))


@query(
    "round",
    """SELECT o_orderkey, round(o_totalprice) AS whole, round(o_totalprice / 1000, 1) AS thousands
    FROM orders""",
)
def rounded(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(
        "o_orderkey",
        F.round("o_totalprice").alias("whole"),
        F.round(F.col("o_totalprice") / 1000, 1).alias("thousands"),
    )


@query(
    "cast",
    f"SELECT o_orderkey, CAST({_ORDER_DAY} AS VARCHAR) AS day_text, "
    "CAST(o_custkey AS DOUBLE) AS customer_number FROM orders",
)
def cast(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(
        "o_orderkey",
        F.col("day").cast("string").alias("day_text"),
        F.col("o_custkey").cast("double").alias("customer_number"),
    )


@query(
    "date_compare",
    f"""SELECT o_orderkey, {_ORDER_DAY} >= DATE '1998-05-01' AS is_late FROM orders
    WHERE {_ORDER_DAY} >= DATE '1900-01-01'""",
)
def date_compare(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).where(F.col("day") >= F.lit(date(1900, 1, 1)))
    return orders.select("o_orderkey", (F.col("day") >= F.lit(date(1998, 5, 1))).alias("is_late"))
