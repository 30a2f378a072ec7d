"""Landing, tables, incremental refresh and data checks.

These queries write below the shared folder the session names and return what is read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import replace
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions import exact_sum
from spendlake.operators import quality
from spendlake.operators.incremental import since_target
from spendlake.plans import checks, registry, staging
from spendlake.plans.pipeline import Pipeline
from spendlake.settings import Settings, passing_shuffles, shared_folder
from spendlake.sinks.tables import Layout, Warehouse
from spendlake.sinks.turns import turns_for
from spendlake.sources import landing, star_tables
from spendlake.sources.schemas import CLOUD_USAGE, CUSTOMERS
from verification.base_sql import money, sql
from verification.catalog import AS_OF, Models, query

DAY_LAYOUT = Layout("usage_date", ("customer_id", "cloud_provider"), "Usage lines by day.")


def _settings(spark: SparkSession, **changes: object) -> Settings:
    """A database and folder of its own for every run."""
    settings = Settings(
        as_of=AS_OF, database=f"v_{uuid.uuid4().hex}", base_path=shared_folder(spark)
    )
    return replace(settings, **changes)


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, _settings(spark))


# --- landing ---------------------------------------------------------------------------------


def _as_array_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of one partition as the lines of one JSON array."""
    opening = "["
    for batch in batches:
        lines = []
        for record in batch["value"]:
            lines.append(opening + record)
            opening = ","
        yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["]" if opening == "," else "[]"]})


def _write_json_arrays(df: DataFrame, path: str) -> None:
    # Exports of any size come in files of ordinary size, however few files the table has.
    records = df.select(F.to_json(F.struct("*")).alias("value")).hint("rebalance")
    records.mapInPandas(_as_array_lines, "value string").write.text(path)


_CUSTOMER_SQL = sql(
    """SELECT customer_id, customer_name, address_city, customer_created_date, contact_count,
           subscription_count, billing_account_count FROM cust""",
    "cust",
)


def _customer_summary(landed: DataFrame) -> DataFrame:
    staged = staging.stg_customers(landed.withColumn("_loaded_at", F.current_timestamp()))
    return staged.select(
        "customer_id",
        "customer_name",
        "address_city",
        "customer_created_date",
        "contact_count",
        "subscription_count",
        "billing_account_count",
    )


@query("land_json_array", _CUSTOMER_SQL)
def land_json_array(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark)
    _write_json_arrays(star_tables.customers(spark, folder), f"{base}/export")
    landing.land(spark, f"{base}/export", f"{base}/landing", CUSTOMERS)
    return _customer_summary(spark.read.schema(CUSTOMERS).parquet(f"{base}/landing"))


@query("land_split_array", _CUSTOMER_SQL)
def land_split_array(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark)
    _write_json_arrays(star_tables.customers(spark, folder), f"{base}/export")
    landing.land(spark, f"{base}/export", f"{base}/landing", CUSTOMERS, layout="split_array")
    return _customer_summary(spark.read.schema(CUSTOMERS).parquet(f"{base}/landing"))


@query("land_ndjson", _CUSTOMER_SQL)
def land_ndjson(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark)
    star_tables.customers(spark, folder).write.json(f"{base}/export")
    landing.land(spark, f"{base}/export", f"{base}/landing", CUSTOMERS, layout="ndjson")
    return _customer_summary(spark.read.schema(CUSTOMERS).parquet(f"{base}/landing"))


@query(
    "land_truncate",
    sql(
        """SELECT usage_id, usage_date, list_cost_usd FROM event_lines
        WHERE event_type = 'purchase'""",
        "event_lines",
    ),
)
def land_truncate(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark)
    usage = star_tables.event_usage(spark, folder)
    usage.write.json(f"{base}/first")
    usage.where(F.col("service.service_name") == "purchase").write.json(f"{base}/second")
    for load in ("first", "second"):
        landing.land(spark, f"{base}/{load}", f"{base}/landing", CLOUD_USAGE, layout="ndjson")
    landed = spark.read.schema(CLOUD_USAGE).parquet(f"{base}/landing")
    return landed.select("usage_id", "usage_date", "cost.list_cost_usd")


@query(
    "land_strict_schema",
    """SELECT count(*) AS row_count, true AS unknown_rejected, true AS object_rejected,
           true AS missing_skipped FROM customer""",
)
def land_strict_schema(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark)
    customers = star_tables.customers(spark, folder)
    customers.write.json(f"{base}/good")
    surprising = F.col("address").withField("planet", F.lit("Earth"))
    customers.withColumn("address", surprising).write.json(f"{base}/unknown")

    def rejected(name: str, layout: str) -> bool:
        try:
            landing.land(spark, f"{base}/{name}", f"{base}/bad", CUSTOMERS, layout)
        except landing.LandingError:
            return True
        return False

    landing.land(spark, f"{base}/good", f"{base}/landing", CUSTOMERS, layout="ndjson")
    skipped = landing.land(spark, f"{base}/absent.json", f"{base}/landing", CUSTOMERS) is None
    landed = spark.read.schema(CUSTOMERS).parquet(f"{base}/landing")
    return landed.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(rejected("unknown", "ndjson")).alias("unknown_rejected"),
        # The NDJSON files hold objects, so they are not arrays.
        F.lit(rejected("good", "array")).alias("object_rejected"),
        F.lit(skipped).alias("missing_skipped"),
    )


@query(
    "infer_nested_schema",
    sql(
        """SELECT usage_id, customer_id, net_cost_usd, is_flexsave_eligible, credit_count,
               label_count FROM usage""",
        "usage",
    ),
)
def infer_nested_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Lines read with the schema found in the files: structs and arrays keep their shape."""
    base = shared_folder(spark)
    # Compressed, as the text is some 15 times larger than the lines; a file is read by one task.
    export = star_tables.cloud_usage(spark, folder).write.option("maxRecordsPerFile", 200_000)
    export.json(f"{base}/export", compression="gzip")
    found = landing.infer_schema(spark, f"{base}/export")
    return (
        spark.read.schema(found)
        .json(f"{base}/export")
        .select(
            "usage_id",
            "customer_id",
            "cost.net_cost_usd",
            F.col("savings.flexsave_eligible").alias("is_flexsave_eligible"),
            F.array_size("credits").cast("long").alias("credit_count"),
            F.array_size("labels").cast("long").alias("label_count"),
        )
    )


@query(
    "source_row_count",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
        for name in ("customer", "part", "supplier", "orders", "lineitem", "events")
    ),
)
def source_row_count(spark: SparkSession, folder: str) -> DataFrame:
    names = ("customer", "part", "supplier", "orders", "lineitem", "events")
    return landing.row_counts({n: star_tables.read_table(spark, folder, n) for n in names})


@query(
    "source_freshness",
    """SELECT max(ts) AS newest, date_diff('second', date_trunc('second', max(ts)),
           TIMESTAMP '2024-02-01 00:00:00') AS age_seconds,
           max(ts) < TIMESTAMP '2024-01-31 00:00:00' AS is_stale FROM events""",
)
def source_freshness(spark: SparkSession, folder: str) -> DataFrame:
    usage = star_tables.event_usage(spark, folder)
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    result = landing.freshness(usage, "export_time", now, timedelta(days=1))
    return result.withColumn("newest", F.col("newest").cast("timestamp_ntz"))


# --- tables ----------------------------------------------------------------------------------

_LINE_SQL = sql(
    "SELECT usage_id, usage_date, customer_id, cloud_provider, effective_cost_usd FROM event_lines",
    "event_lines",
)


def _event_lines(spark: SparkSession, folder: str) -> DataFrame:
    return (
        Models(spark, folder)
        .stg_event_usage.select(
            "usage_id", "usage_date", "customer_id", "cloud_provider", "effective_cost_usd"
        )
    )


@query("sink_view", sql("SELECT contact_id, customer_id FROM contacts", "contacts"))
def sink_view(spark: SparkSession, folder: str) -> DataFrame:
    name = f"contacts_{uuid.uuid4().hex}"
    Models(spark, folder).stg_customer_contacts.createOrReplaceTempView(name)
    return spark.table(name).select("contact_id", "customer_id")


@query("sink_table", _LINE_SQL)
def sink_table(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    lines = _event_lines(spark, folder)
    warehouse.replace("lines", lines.where(F.lit(False)))
    warehouse.replace("lines", lines)
    return warehouse.read("lines")


@query("sink_partition_day", _LINE_SQL)
def sink_partition_day(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    warehouse.replace("lines", _event_lines(spark, folder), Layout("usage_date"))
    return warehouse.read("lines")


@query(
    "sink_partition_month",
    sql(
        f"""SELECT customer_id, usage_month, count(*) AS line_count,
               {money("effective_cost_usd")} AS effective_cost_usd
        FROM usage GROUP BY ALL""",
        "usage",
    ),
)
def sink_partition_month(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    monthly = (
        Models(spark, folder)
        .stg_cloud_usage.groupBy("customer_id", "usage_month")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            exact_sum("effective_cost_usd").alias("effective_cost_usd"),
        )
    )
    warehouse.replace("monthly", monthly, Layout("usage_month", ("customer_id",)))
    return warehouse.read("monthly")


@query("sink_cluster", _LINE_SQL)
def sink_cluster(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    warehouse.replace("lines", _event_lines(spark, folder), DAY_LAYOUT)
    return warehouse.read("lines")


@query("sink_recluster", _LINE_SQL)
def sink_recluster(spark: SparkSession, folder: str) -> DataFrame:
    """Written in files of some 64 kB, as if a day were large; then cut into disjoint ones."""
    warehouse, option = _warehouse(spark), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(option)
    spark.conf.set(option, "64kb")
    try:
        warehouse.replace("lines", _event_lines(spark, folder), DAY_LAYOUT)
        warehouse.recluster("lines", DAY_LAYOUT)
    finally:
        spark.conf.set(option, before)
    return warehouse.read("lines")


_RESTATED = date(2024, 1, 28)
_RESTATED_SQL = sql(
    """SELECT usage_id, usage_date, customer_id, cloud_provider,
           CASE WHEN usage_date >= DATE '2024-01-28' THEN effective_cost_usd * 2
                ELSE effective_cost_usd END AS effective_cost_usd FROM event_lines""",
    "event_lines",
)


def _restated(lines: DataFrame, since_day: date = _RESTATED) -> DataFrame:
    doubled = F.when(F.col("usage_date") >= since_day, F.col("effective_cost_usd") * 2)
    return lines.withColumn(
        "effective_cost_usd", F.coalesce(doubled, F.col("effective_cost_usd"))
    )


@query("sink_overwrite_partitions", _RESTATED_SQL)
def sink_overwrite_partitions(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    lines = _event_lines(spark, folder)
    warehouse.replace("lines", lines, DAY_LAYOUT)
    batch = _restated(lines).where(F.col("usage_date") >= F.lit(_RESTATED))
    warehouse.overwrite_partitions("lines", batch, DAY_LAYOUT, _RESTATED)
    return warehouse.read("lines")


_EVENT_MODELS = {"raw_cloud_usage", "stg_cloud_usage"}
_STORED_SQL = sql(
    """SELECT usage_id, usage_date, customer_id, list_cost_usd, credit_amount_usd
    FROM event_lines""",
    "event_lines",
)


def _event_pipeline(
    spark: SparkSession, usage: DataFrame, settings: Settings, names: set[str] = _EVENT_MODELS
) -> Pipeline:
    pipeline = Pipeline(spark, {"cloud_usage": usage}, settings)
    pipeline.build(names=names)
    return pipeline


def _stored(pipeline: Pipeline) -> DataFrame:
    return pipeline.table("stg_cloud_usage").select(
        "usage_id", "usage_date", "customer_id", "list_cost_usd", "credit_amount_usd"
    )


@query("materialise_mode", _STORED_SQL)
def materialise_mode(spark: SparkSession, folder: str) -> DataFrame:
    """Full mode replaces whatever the first, narrower build left."""
    usage = star_tables.event_usage(spark, folder)
    settings = _settings(spark, incremental=False)
    narrow = usage.where(F.col("usage_date") < F.lit(date(2024, 1, 10)))
    _event_pipeline(spark, narrow, settings)
    return _stored(_event_pipeline(spark, usage, settings))


@query(
    "schema_sync",
    sql(
        """SELECT usage_id, usage_date, customer_id, effective_cost_usd,
               CASE WHEN usage_date >= DATE '2024-01-28' THEN event_type END AS environment
        FROM event_lines""",
        "event_lines",
    ),
)
def schema_sync(spark: SparkSession, folder: str) -> DataFrame:
    """The batch has a column the table lacks, and lacks one the table has."""
    warehouse = _warehouse(spark)
    warehouse.replace("lines", _event_lines(spark, folder), DAY_LAYOUT)
    batch = (
        Models(spark, folder)
        .stg_event_usage.where(F.col("usage_date") >= F.lit(_RESTATED))
        .select("usage_id", "usage_date", "customer_id", "effective_cost_usd", "environment")
    )
    warehouse.overwrite_partitions(
        "lines", batch, Layout("usage_date", ("customer_id",)), _RESTATED
    )
    return warehouse.read("lines")


@query(
    "persist_docs",
    sql(
        """SELECT 'Usage lines.' AS table_comment, 'Key of the line.' AS column_comment,
               count(*) AS row_count FROM event_lines""",
        "event_lines",
    ),
)
def persist_docs(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    layout = Layout(
        "usage_date", description="Usage lines.", column_comments={"usage_id": "Key of the line."}
    )
    warehouse.replace("lines", _event_lines(spark, folder), layout)
    table = spark.catalog.getTable(f"{warehouse.database}.lines")
    comment = warehouse.describe_columns("lines")["usage_id"]
    return (
        warehouse.read("lines")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.lit(table.description).alias("table_comment"),
            F.lit(comment).alias("column_comment"),
            "row_count",
        )
    )


@query(
    "target_database",
    sql(
        """SELECT 'dev' AS target, count(*) AS row_count FROM event_lines
        UNION ALL
        SELECT 'ci', count(*) FROM event_lines WHERE event_type = 'purchase'""",
        "event_lines",
    ),
)
def target_database(spark: SparkSession, folder: str) -> DataFrame:
    """The same models in two databases, told apart by the settings alone."""
    usage = star_tables.event_usage(spark, folder)
    inputs = {"dev": usage, "ci": usage.where(F.col("service.service_name") == "purchase")}
    counts = {}
    for target, landed in inputs.items():
        settings = _settings(spark)
        pipeline = _event_pipeline(
            spark, landed, replace(settings, database=f"{settings.database}_{target}")
        )
        counts[target] = pipeline.table("stg_cloud_usage")
    return landing.row_counts(counts).withColumnRenamed("table_name", "target")


@query(
    "select_by_tag",
    sql(
        """SELECT 'raw_cloud_usage' AS table_name, count(*) AS row_count FROM event_lines
        UNION ALL SELECT 'stg_cloud_usage', count(*) FROM event_lines
        UNION ALL SELECT 'stg_cloud_usage_credits', count(*) FROM event_lines
                  WHERE event_type = 'purchase'
        UNION ALL SELECT 'stg_cloud_usage_labels', count(*) FROM event_lines""",
        "event_lines",
    ),
)
def select_by_tag(spark: SparkSession, folder: str) -> DataFrame:
    usage = star_tables.event_usage(spark, folder)
    pipeline = Pipeline(spark, {"cloud_usage": usage}, _settings(spark))
    built = pipeline.build(tags={"cloud_usage"})
    return landing.row_counts({name: pipeline.table(name) for name in built})


# --- incremental refresh ---------------------------------------------------------------------

# The target holds the events before this day; the incoming rows are all events.
_TARGET_END = date(2024, 1, 20)


def _target_and_incoming(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = _event_lines(spark, folder)
    return lines.where(F.col("usage_date") < F.lit(_TARGET_END)), lines


@query(
    "incremental_date_filter",
    sql(
        f"""SELECT usage_id, usage_date FROM event_lines WHERE usage_date >= (
            SELECT coalesce(max(usage_date) - 3, DATE '1900-01-01') FROM event_lines
            WHERE usage_date < DATE '{_TARGET_END}')""",
        "event_lines",
    ),
)
def incremental_date_filter(spark: SparkSession, folder: str) -> DataFrame:
    target, incoming = _target_and_incoming(spark, folder)
    return since_target(incoming, target, "usage_date").select("usage_id", "usage_date")


@query(
    "incremental_month_filter",
    """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
    WHERE CAST(date_trunc('month', l_shipdate) AS DATE) >= (
        SELECT CAST(date_trunc('month', max(date_trunc('month', l_shipdate)) - INTERVAL 3 DAY)
                    AS DATE)
        FROM lineitem WHERE l_shipdate < DATE '1999-06-15')""",
)
def incremental_month_filter(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    monthly = lines.withColumn("usage_month", F.trunc(F.to_date("l_shipdate"), "MM"))
    target = monthly.where(F.col("l_shipdate") < F.lit("1999-06-15").cast("timestamp_ntz"))
    kept = since_target(monthly, target, "usage_month", grain="month")
    return kept.select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "first_run_full",
    sql(
        """SELECT 'no target' AS target, count(*) AS row_count FROM event_lines
        UNION ALL SELECT 'empty target', count(*) FROM event_lines
                  WHERE usage_date >= DATE '1900-01-01'""",
        "event_lines",
    ),
)
def first_run_full(spark: SparkSession, folder: str) -> DataFrame:
    lines = _event_lines(spark, folder)
    runs = {
        "no target": since_target(lines, None, "usage_date"),
        "empty target": since_target(lines, lines.where(F.lit(False)), "usage_date"),
    }
    return landing.row_counts(runs).withColumnRenamed("table_name", "target")


@query(
    "full_refresh_flag",
    sql("SELECT usage_id, usage_date FROM event_lines", "event_lines"),
)
def full_refresh_flag(spark: SparkSession, folder: str) -> DataFrame:
    target, incoming = _target_and_incoming(spark, folder)
    kept = since_target(incoming, target, "usage_date", full_refresh=True)
    return kept.select("usage_id", "usage_date")


@query(
    "lookback_days",
    sql(
        " UNION ALL ".join(
            f"""SELECT {n} AS lookback, count(*) AS row_count FROM event_lines
            WHERE usage_date >= (SELECT max(usage_date) - {n} FROM event_lines
                                 WHERE usage_date < DATE '{_TARGET_END}')"""
            for n in (0, 3, 10)
        ),
        "event_lines",
    ),
)
def lookback_days(spark: SparkSession, folder: str) -> DataFrame:
    target, incoming = _target_and_incoming(spark, folder)
    runs = {
        str(n): since_target(incoming, target, "usage_date", lookback_days=n) for n in (0, 3, 10)
    }
    counts = landing.row_counts(runs)
    return counts.select(F.col("table_name").cast("int").alias("lookback"), "row_count")


@query(
    "late_restatement",
    sql(
        """SELECT usage_id, usage_date, customer_id,
               CASE WHEN usage_date >= DATE '2024-01-27' THEN list_cost_usd * 2
                    ELSE list_cost_usd END AS list_cost_usd,
               credit_amount_usd
        FROM event_lines""",
        "event_lines",
    ),
)
def late_restatement(spark: SparkSession, folder: str) -> DataFrame:
    """Every line is restated; only days inside the lookback take the new amount.

    The stored days end on 30 January, so with 3 days of lookback the 27th is the first.
    """
    usage = star_tables.event_usage(spark, folder)
    settings = _settings(spark, incremental=True)
    _event_pipeline(spark, usage, settings)
    doubled = F.col("cost").withField("list_cost_usd", F.col("cost.list_cost_usd") * 2)
    return _stored(_event_pipeline(spark, usage.withColumn("cost", doubled), settings))


_SEAM_MODELS = {"raw_cloud_usage", "stg_cloud_usage", "raw_customers", "dim_customers"}
_SEAM_MODELS |= {"dim_billing_accounts", "fct_cloud_usage_daily", "agg_customer_daily_spend"}


@query(
    "full_rebuild_seam",
    sql(
        f"""
        SELECT *, {money("effective_cost_usd", "OVER w")} / count(*) OVER w
                   AS effective_cost_7d_avg_usd
        FROM (SELECT e.customer_id, cloud_provider, usage_date,
                     {money("effective_cost_usd")} AS effective_cost_usd
              FROM event_lines e JOIN cust c ON c.customer_id = e.customer_id GROUP BY ALL)
        WINDOW w AS (PARTITION BY customer_id, cloud_provider ORDER BY usage_date
                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "event_lines",
        "cust",
    ),
)
def full_rebuild_seam(spark: SparkSession, folder: str) -> DataFrame:
    """Trailing averages stay right over the seam of two incremental runs."""
    usage = star_tables.event_usage(spark, folder)
    settings = _settings(spark, incremental=True)
    landed = {"customers": star_tables.customers(spark, folder)}
    for part in (usage.where(F.col("usage_date") < F.lit(_TARGET_END)), usage):
        pipeline = Pipeline(spark, {**landed, "cloud_usage": part}, settings)
        pipeline.build(names=_SEAM_MODELS)
    return pipeline.table("agg_customer_daily_spend").select(
        "customer_id",
        "cloud_provider",
        "usage_date",
        "effective_cost_usd",
        "effective_cost_7d_avg_usd",
    )


# --- data checks -----------------------------------------------------------------------------


@query(
    "dq_not_null",
    sql("SELECT usage_id, usage_date FROM usage WHERE cost_centre IS NULL", "usage"),
)
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).stg_cloud_usage
    return quality.null_rows(usage, "cost_centre").select("usage_id", "usage_date")


@query(
    "dq_unique",
    """SELECT l_orderkey AS value, count(*) AS row_count FROM lineitem
    WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
)
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicated_values(Models(spark, folder).source("lineitem"), "l_orderkey")


@query(
    "dq_relationships",
    sql(
        """SELECT billing_account_id AS value, count(*) AS row_count FROM usage
        WHERE billing_account_id NOT IN (SELECT billing_account_id FROM accounts) GROUP BY 1""",
        "usage",
        "accounts",
    ),
)
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    key = "billing_account_id"
    return quality.orphan_values(models.raw_cloud_usage, key, models.stg_billing_accounts, key)


@query(
    "dq_accepted_values",
    """SELECT o_orderpriority AS value, count(*) AS row_count FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1""",
)
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    return quality.unexpected_values(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


def _check_sql(check: quality.Check, tables: dict[str, str]) -> str:
    column, table = check.column, tables[check.model]
    if check.kind == "not_null":
        failing = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    elif check.kind == "unique":
        failing = f"""SELECT count(*) FROM (SELECT {column} FROM {table}
            WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
    elif check.kind == "accepted_values":
        accepted = ", ".join(f"'{value}'" for value in check.accepted)
        failing = f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({accepted})"
    else:
        parent = tables[check.parent]
        failing = f"""SELECT count(*) FROM {table} t WHERE t.{column} IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM {parent} p WHERE p.{check.parent_column} = t.{column})"""
    return f"""SELECT '{check.model}' AS model, '{column}' AS column_name,
        '{check.kind}' AS check_kind, ({failing}) AS failing_rows"""


# Which flat SQL table holds the checked columns of each model.
_SQL_TABLES = {
    "customers": "cust",
    "products": "prod",
    "cloud_usage": "usage",
    "raw_customers": "cust",
    "raw_products": "prod",
    "raw_cloud_usage": "usage",
    "stg_customers": "cust",
    "stg_customer_contacts": "contacts",
    "stg_subscriptions": "subs",
    "stg_billing_accounts": "accounts",
    "stg_products": "prod",
    "stg_product_features": "features",
    "stg_product_pricing_tiers": "tiers",
    "stg_cloud_usage": "usage",
    "stg_cloud_usage_credits": "credits",
    "stg_cloud_usage_labels": "labels_tall",
    "dim_customers": "dim_cust",
    "dim_products": "prod",
    "dim_billing_accounts": "accounts_owned",
    "fct_subscriptions": "subs_known",
    "fct_cloud_usage_daily": "fact",
    "agg_customer_daily_spend": "daily",
    "agg_customer_monthly_spend": "monthly",
    "agg_service_monthly_spend": "services",
    "agg_cost_allocation_monthly": "allocation",
}
_EXTRA_TABLES = """,
accounts_owned AS (SELECT a.* FROM accounts a JOIN cust c ON c.customer_id = a.customer_id),
subs_known AS (SELECT s.* FROM subs s JOIN cust c ON c.customer_id = s.customer_id
               JOIN prod p ON p.product_id = s.product_id)
"""
_CHECKED = sorted(set(_SQL_TABLES.values()) - {"accounts_owned", "subs_known"})


def _suite_sql(suite: list[quality.Check]) -> str:
    rows = " UNION ALL ".join(_check_sql(check, _SQL_TABLES) for check in suite)
    return sql("", *_CHECKED).rstrip() + _EXTRA_TABLES + rows


def _stored_models(names: Iterable[str]) -> set[str]:
    """The stored models among these models and what the views among them read."""
    found: set[str] = set()
    for model in [registry.MODEL_BY_NAME[name] for name in names if name in registry.MODEL_BY_NAME]:
        found |= _stored_models(model.inputs) if model.kind == "view" else {model.name}
    return found


@query("dq_suite", _suite_sql(checks.ALL_CHECKS))
def dq_suite(spark: SparkSession, folder: str) -> DataFrame:
    """All 95 declared checks over stored models.

    A stored model is checked when no later model reads it, and dropped when no check is left that
    does: all of them together are many times the lines.
    """
    landed = {
        "customers": star_tables.customers(spark, folder),
        "products": star_tables.products(spark, folder),
        "cloud_usage": star_tables.cloud_usage(spark, folder),
    }
    # Usage is stored unpartitioned here: the line items spread over some 2,500 thin days.
    settings = _settings(spark, turns=turns_for(spark, f"{folder}/lineitem.parquet"))
    warehouse, tables, kept = Warehouse(spark, settings), dict(landed), set()
    waiting, outcomes = list(checks.ALL_CHECKS), []
    for place, model in enumerate(registry.MODELS, 1):
        inputs = {name: tables[name] for name in model.inputs}
        if model.kind == "view":
            tables[model.name] = model.plan(inputs, settings)
            continue
        warehouse.replace(model.name, model.parts(inputs, settings))
        tables[model.name] = warehouse.read(model.name)
        kept.add(model.name)
        later = _stored_models(name for m in registry.MODELS[place:] for name in m.inputs)
        ready = [c for c in waiting if c.model in tables and (c.parent or c.model) in tables]
        if kept <= later or not ready:
            continue
        # Where there are many lines, the checks of one model after those of another.
        of = {c: c.model if settings.turns > 1 else "" for c in ready}
        for one in dict.fromkeys(of.values()):
            with passing_shuffles(spark):
                outcomes += quality.run_checks(tables, [c for c in ready if of[c] == one]).collect()
        waiting = [c for c in waiting if c not in ready]
        needed = later | _stored_models(n for c in waiting for n in (c.model, c.parent) if n)
        for name in kept - needed:
            warehouse.drop(name)
        kept &= needed
    return spark.createDataFrame(
        outcomes, "model string, column_name string, check_kind string, failing_rows long"
    )
