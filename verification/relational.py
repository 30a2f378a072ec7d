"""Joins, aggregations, windows and sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions import array_total, exact_sum, label_value, month_of, text_list
from spendlake.operators import joins, windows
from spendlake.operators.grouping import summarise
from verification.base_sql import money, ratio, sql
from verification.catalog import Models, query

# --- joins -----------------------------------------------------------------------------------


@query(
    "inner_equi",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders
    JOIN customer ON c_custkey = o_custkey""",
)
def inner_equi(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    customer = models.source("customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.keep_known(models.source("orders"), customer, "o_custkey").select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query(
    "left_equi",
    sql(
        """SELECT usage_id, billing_currency, payment_terms FROM usage u
        LEFT JOIN accounts a ON a.billing_account_id = u.billing_account_id""",
        "usage",
        "accounts",
    ),
)
def left_equi(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    return joins.add_attributes(
        models.raw_cloud_usage.select("usage_id", "billing_account_id"),
        models.stg_billing_accounts,
        "billing_account_id",
    ).select("usage_id", "billing_currency", "payment_terms")


@query(
    "left_join_preaggregates",
    """SELECT s_suppkey, coalesce(n_lines, 0) AS n_lines, coalesce(n_parts, 0) AS n_parts
    FROM supplier
    LEFT JOIN (SELECT l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY 1) a
        ON a.l_suppkey = s_suppkey
    LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts FROM lineitem
               WHERE l_returnflag = 'R' GROUP BY 1) b ON b.l_suppkey = s_suppkey""",
)
def left_join_preaggregates(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    lines = models.source("lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    counts = lines.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
    returned = (
        lines.where(F.col("l_returnflag") == "R")
        .groupBy("s_suppkey")
        .agg(F.count_distinct("l_partkey").alias("n_parts"))
    )
    suppliers = models.source("supplier").select("s_suppkey")
    return joins.add_rollups(
        suppliers, [counts, returned], "s_suppkey", {"n_lines": 0, "n_parts": 0}
    )


@query(
    "left_multi_key",
    f"""
    SELECT a.o_custkey, a.order_month, a.n_orders, b.amount FROM (
        SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
               count(*) AS n_orders FROM orders GROUP BY 1, 2) a
    LEFT JOIN (
        SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
               {money("o_totalprice")} AS amount
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) b
      ON a.o_custkey = b.o_custkey AND a.order_month = b.order_month""",
)
def left_multi_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    monthly = orders.withColumn("order_month", month_of(F.to_date("o_orderdate")))
    keys = ["o_custkey", "order_month"]
    counted = monthly.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_orders"))
    finished = (
        monthly.where(F.col("o_orderstatus") == "F")
        .groupBy(*keys)
        .agg(exact_sum("o_totalprice").alias("amount"))
    )
    return joins.add_attributes(counted, finished, keys)


_INTERVALS = """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
           CASE WHEN o_orderstatus <> 'O' THEN max(CAST(l_shipdate AS DATE)) END AS end_date,
           o_totalprice AS mrr_usd
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey, o_orderdate, o_orderstatus, o_totalprice"""
_MONTHS = (
    "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS usage_month FROM orders"
)


def _intervals(models: Models) -> DataFrame:
    ends = (
        models.source("lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max(F.to_date("l_shipdate")).alias("last_ship"))
    )
    orders = models.source("orders").join(ends, "o_orderkey")
    return orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("start_date"),
        F.when(F.col("o_orderstatus") != "O", F.col("last_ship")).alias("end_date"),
        F.col("o_totalprice").alias("mrr_usd"),
    )


def _order_months(models: Models) -> DataFrame:
    month = month_of(F.to_date("o_orderdate")).alias("usage_month")
    return models.source("orders").select(month).distinct()


@query(
    "interval_overlap_join",
    f"""WITH intervals AS ({_INTERVALS}), months AS ({_MONTHS})
    SELECT usage_month, o_orderkey FROM months JOIN intervals
      ON start_date <= last_day(usage_month) AND (end_date IS NULL OR end_date >= usage_month)""",
)
def interval_overlap_join(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    live = joins.live_in_listed_months(_order_months(models), _intervals(models))
    return live.select("usage_month", "o_orderkey")


@query(
    "interval_overlap_totals",
    f"""WITH intervals AS ({_INTERVALS}), months AS ({_MONTHS})
    SELECT usage_month, count(*) AS live_count, {money("mrr_usd")} AS mrr_usd
    FROM months JOIN intervals
      ON start_date <= last_day(usage_month) AND (end_date IS NULL OR end_date >= usage_month)
    GROUP BY usage_month""",
)
def interval_overlap_totals(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    live = joins.live_in_listed_months(_order_months(models), _intervals(models))
    return live.groupBy("usage_month").agg(
        F.count(F.lit(1)).alias("live_count"), exact_sum("mrr_usd").alias("mrr_usd")
    )


@query(
    "lateral_unnest",
    sql(
        """SELECT customer_id, subscription_id, mrr_usd, start_date FROM subs""",
        "subs",
    ),
)
def lateral_unnest(spark: SparkSession, folder: str) -> DataFrame:
    customers = Models(spark, folder).raw_customers
    return customers.selectExpr("customer_id", "inline(subscriptions)").select(
        "customer_id", "subscription_id", "mrr_usd", "start_date"
    )


@query(
    "correlated_scalar_lookup",
    sql("SELECT usage_id, team, credit_amount_usd FROM usage", "usage"),
)
def correlated_scalar_lookup(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).raw_cloud_usage
    return usage.select(
        "usage_id",
        label_value("labels", "team").alias("team"),
        array_total("credits", "amount_usd").alias("credit_amount_usd"),
    )


# --- aggregations ----------------------------------------------------------------------------


@query("count_rows", "SELECT l_suppkey, count(*) AS line_count FROM lineitem GROUP BY l_suppkey")
def count_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    return lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("line_count"))


@query(
    "count_distinct",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS part_count FROM lineitem GROUP BY l_suppkey",
)
def count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    return lines.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("part_count"))


@query(
    "count_distinct_multi",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders,
           count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
           count(DISTINCT l_shipdate) AS days FROM lineitem GROUP BY l_returnflag""",
)
def count_distinct_multi(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    return lines.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_shipdate").alias("days"),
    )


@query(
    "count_if",
    """SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS open_orders,
           count(*) FILTER (o_totalprice > 250000) AS large_orders
    FROM orders GROUP BY o_custkey""",
)
def count_if(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    return orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
        F.count_if(F.col("o_totalprice") > 250000).alias("large_orders"),
    )


@query(
    "sum_measures",
    f"""SELECT l_suppkey, {money("l_extendedprice")} AS list_cost,
           {money("l_extendedprice * l_discount")} AS discount,
           {money("l_extendedprice * l_tax")} AS tax, sum(l_quantity) AS quantity
    FROM lineitem GROUP BY l_suppkey""",
)
def sum_measures(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice")
    lines = Models(spark, folder).source("lineitem")
    return lines.groupBy("l_suppkey").agg(
        exact_sum(price).alias("list_cost"),
        exact_sum(price * F.col("l_discount")).alias("discount"),
        exact_sum(price * F.col("l_tax")).alias("tax"),
        F.sum("l_quantity").alias("quantity"),
    )


@query(
    "sum_if",
    f"""SELECT o_custkey, {money("CASE WHEN o_orderstatus = 'P' THEN o_totalprice END")} AS pending
    FROM orders GROUP BY o_custkey""",
)
def sum_if(spark: SparkSession, folder: str) -> DataFrame:
    pending = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice"))
    orders = Models(spark, folder).source("orders")
    return orders.groupBy("o_custkey").agg(exact_sum(pending).alias("pending"))


@query(
    "min_max",
    """SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day,
           max(CAST(o_orderdate AS DATE)) AS last_day, max(o_orderpriority) AS last_priority,
           min(o_totalprice) AS smallest FROM orders GROUP BY o_custkey""",
)
def min_max(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    return orders.groupBy("o_custkey").agg(
        F.min(F.to_date("o_orderdate")).alias("first_day"),
        F.max(F.to_date("o_orderdate")).alias("last_day"),
        F.max("o_orderpriority").alias("last_priority"),
        F.min("o_totalprice").alias("smallest"),
    )


@query(
    "string_agg_distinct_ordered",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority)
           AS priorities FROM orders GROUP BY o_custkey""",
)
def string_agg_distinct_ordered(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    priorities = text_list(F.array_sort(F.collect_set("o_orderpriority")))
    return orders.groupBy("o_custkey").agg(priorities.alias("priorities"))


@query("select_distinct", _MONTHS)
def select_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return _order_months(Models(spark, folder))


@query(
    "group_by_wide",
    f"""SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey, o_orderstatus, o_orderpriority,
           p_brand, p_type, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month,
           count(*) AS line_count, {money("l_extendedprice")} AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    GROUP BY ALL""",
)
def group_by_wide(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    joined = (
        models.source("lineitem")
        .join(models.source("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(models.source("part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("ship_month", month_of(F.to_date("l_shipdate")))
    )
    return joined.groupBy(
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
        "l_suppkey",
        "o_orderstatus",
        "o_orderpriority",
        "p_brand",
        "p_type",
        "ship_month",
    ).agg(F.count(F.lit(1)).alias("line_count"), exact_sum("l_extendedprice").alias("amount"))


@query(
    "global_aggregate",
    """SELECT count(*) AS total_rows, count(DISTINCT l_shipdate) AS days,
           count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts,
           count(DISTINCT l_orderkey) AS orders FROM lineitem""",
)
def global_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    return lines.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("l_shipdate").alias("days"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_orderkey").alias("orders"),
    )


@query(
    "null_to_bucket",
    sql(
        f"""SELECT coalesce(usage.cost_centre, 'unallocated') AS cost_centre, count(*) AS line_count,
               {money("effective_cost_usd")} AS effective_cost_usd FROM usage GROUP BY 1""",
        "usage",
    ),
)
def null_to_bucket(spark: SparkSession, folder: str) -> DataFrame:
    usage = Models(spark, folder).stg_cloud_usage
    bucket = F.coalesce("cost_centre", F.lit("unallocated")).alias("cost_centre")
    return usage.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("line_count"),
        exact_sum("effective_cost_usd").alias("effective_cost_usd"),
    )


@query(
    "avg_daily",
    f"""SELECT o_custkey, {money("o_totalprice")} / nullif(count(DISTINCT o_orderdate), 0)
           AS average_per_day FROM orders GROUP BY o_custkey""",
)
def avg_daily(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    totals = summarise(
        orders, ["o_custkey"], sums={"amount": "o_totalprice"}, distinct={"days": "o_orderdate"}
    )
    average = F.col("amount") / F.nullif(F.col("days"), F.lit(0))
    return totals.select("o_custkey", average.alias("average_per_day"))


# --- windows ---------------------------------------------------------------------------------

_DAILY_EVENTS = f"""(SELECT user_id, event_type, CAST(ts AS DATE) AS day, {money("value")} AS amount
    FROM events GROUP BY ALL)"""
_EVENT_ORDER = "OVER (PARTITION BY user_id, event_type ORDER BY day)"
_EVENT_7 = """OVER (PARTITION BY user_id, event_type ORDER BY day
    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


def _daily_events(spark: SparkSession, folder: str) -> DataFrame:
    events = Models(spark, folder).source("events")
    return events.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(
        exact_sum("value").alias("amount")
    )


def _event_trend(spark: SparkSession, folder: str) -> DataFrame:
    daily = _daily_events(spark, folder)
    return windows.add_trend(daily, ["user_id", "event_type"], "day", "amount", "avg_7", "previous")


@query(
    "moving_avg_7",
    f"""SELECT user_id, event_type, day,
           {money("amount", _EVENT_7)} / count(amount) {_EVENT_7} AS avg_7 FROM {_DAILY_EVENTS}""",
)
def moving_avg_7(spark: SparkSession, folder: str) -> DataFrame:
    return _event_trend(spark, folder).select("user_id", "event_type", "day", "avg_7")


@query(
    "lag_1",
    f"SELECT user_id, event_type, day, lag(amount) {_EVENT_ORDER} AS previous FROM {_DAILY_EVENTS}",
)
def lag_1(spark: SparkSession, folder: str) -> DataFrame:
    return _event_trend(spark, folder).select("user_id", "event_type", "day", "previous")


_CUSTOMER_MONTH_SEGMENTS = f"""(
    SELECT o_custkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, p_type,
           {money("l_extendedprice")} AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    GROUP BY ALL)"""


def _customer_month_types(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    joined = (
        models.source("lineitem")
        .join(models.source("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(models.source("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    month = month_of(F.to_date("l_shipdate")).alias("ship_month")
    return joined.groupBy("o_custkey", month, "p_type").agg(
        exact_sum("l_extendedprice").alias("amount")
    )


_MONTH_KEYS = ["o_custkey", "ship_month"]


@query(
    "row_number_desc",
    f"""SELECT *, row_number() OVER (PARTITION BY o_custkey, ship_month
                                     ORDER BY amount DESC, p_type) AS type_rank
    FROM {_CUSTOMER_MONTH_SEGMENTS}""",
)
def row_number_desc(spark: SparkSession, folder: str) -> DataFrame:
    types = _customer_month_types(spark, folder)
    return windows.rank_by_amount(types, _MONTH_KEYS, "amount", ["p_type"], "type_rank")


@query(
    "partition_total",
    f"""SELECT *, {money("amount", "OVER (PARTITION BY o_custkey, ship_month)")} AS month_total
    FROM {_CUSTOMER_MONTH_SEGMENTS}""",
)
def partition_total(spark: SparkSession, folder: str) -> DataFrame:
    types = _customer_month_types(spark, folder)
    return windows.add_window_total(types, _MONTH_KEYS, "amount", "month_total")


@query(
    "share_of_total",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
           {ratio("l_extendedprice", "total")} AS share
    FROM lineitem JOIN (SELECT l_returnflag, {money("l_extendedprice")} AS total
                        FROM lineitem GROUP BY 1) USING (l_returnflag)""",
)
def share_of_total(spark: SparkSession, folder: str) -> DataFrame:
    lines = Models(spark, folder).source("lineitem")
    with_total = windows.add_joined_total(
        lines, lines, ["l_returnflag"], "l_extendedprice", "total", buckets=64
    )
    share = F.when(F.col("total") > 0, F.col("l_extendedprice") / F.col("total"))
    return with_total.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", share.alias("share")
    )


@query(
    "window_over_aggregate",
    f"""SELECT p_brand, amount, 100.0 * amount / {money("amount", "OVER ()")} AS pct
    FROM (SELECT p_brand, {money("l_extendedprice")} AS amount
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand)""",
)
def window_over_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    joined = models.source("lineitem").join(
        models.source("part"), F.col("l_partkey") == F.col("p_partkey")
    )
    brands = joined.groupBy("p_brand").agg(exact_sum("l_extendedprice").alias("amount"))
    return windows.add_grand_total_share(brands, "amount", "pct")


@query(
    "day_over_day",
    f"""SELECT user_id, event_type, day, amount - previous AS day_over_day_change_usd,
           {ratio("amount", "previous")} - 1 AS day_over_day_change_pct
    FROM (SELECT *, lag(amount) {_EVENT_ORDER} AS previous FROM {_DAILY_EVENTS})""",
)
def day_over_day(spark: SparkSession, folder: str) -> DataFrame:
    changes = windows.change_columns("amount", "previous", "avg_7")
    wanted = ["day_over_day_change_usd", "day_over_day_change_pct"]
    return _event_trend(spark, folder).select(
        "user_id", "event_type", "day", *[changes[name].alias(name) for name in wanted]
    )


@query(
    "spend_vs_trailing_avg",
    f"""SELECT user_id, event_type, day, {ratio("amount", "avg_7")} AS spend_vs_7d_avg_ratio,
           {ratio("amount", "avg_7")} > 1.5 AS is_spike
    FROM (SELECT *, {money("amount", _EVENT_7)} / count(amount) {_EVENT_7} AS avg_7
          FROM {_DAILY_EVENTS})""",
)
def spend_vs_trailing_avg(spark: SparkSession, folder: str) -> DataFrame:
    name = "spend_vs_7d_avg_ratio"
    ratio_column = windows.change_columns("amount", "previous", "avg_7")[name]
    return _event_trend(spark, folder).select(
        "user_id",
        "event_type",
        "day",
        ratio_column.alias(name),
        (ratio_column > 1.5).alias("is_spike"),
    )


@query(
    "top_n_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders
    ) WHERE rank <= 3""",
)
def top_n_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    top = windows.top_per_group(orders, ["o_custkey"], "o_totalprice", ["o_orderkey"], 3)
    return top.select("o_custkey", "o_orderkey", "o_totalprice", "rank")


# --- sorting ---------------------------------------------------------------------------------


@query(
    "order_by_limit",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 8",
)
def order_by_limit(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    return (
        orders.orderBy("o_custkey", "o_orderkey")
        .limit(8)
        .select("o_custkey", "o_orderkey", "o_totalprice")
    )


@query(
    "order_multi_mixed",
    f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority,
           {money("o_totalprice")} AS amount
    FROM orders GROUP BY 1, 2 ORDER BY month, amount DESC, o_orderpriority""",
)
def order_multi_mixed(spark: SparkSession, folder: str) -> DataFrame:
    orders = Models(spark, folder).source("orders")
    month = month_of(F.to_date("o_orderdate")).alias("month")
    totals = orders.groupBy(month, "o_orderpriority").agg(exact_sum("o_totalprice").alias("amount"))
    return totals.orderBy("month", F.desc("amount"), "o_orderpriority")


@query(
    "topk_desc",
    """SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 8""",
)
def topk_desc(spark: SparkSession, folder: str) -> DataFrame:
    events = Models(spark, folder).source("events")
    return events.select("event_id", "user_id", "value").orderBy(F.desc("value"), "event_id").limit(8)


@query(
    "order_by_alias_ordinal",
    f"""SELECT event_type, {money("value")} AS spend FROM events GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def order_by_alias_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    events = Models(spark, folder).source("events")
    totals = events.groupBy("event_type").agg(exact_sum("value").alias("spend"))
    return totals.orderBy(F.desc("spend"), "event_type")
