"""What the optimiser makes of the models: columns read, joins dropped, nothing nested-loop."""

import re

import pytest
from pyspark.sql import functions as F

from spendlake.functions import label_value
from spendlake.plans import core, finops, reports, staging
from spendlake.settings import Settings
from tests import fixtures as fx
from verification.catalog import Models


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(df):
    return re.findall(r"ReadSchema: (struct<.*>)", plan(df))


@pytest.fixture(scope="module", autouse=True)
def whole_schemas(spark):
    """Plans show the schemas of scans uncut."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw tables and the fact as Parquet files."""
    base = str(tmp_path_factory.mktemp("stored"))
    tables = {"customers": fx.customers(spark), "usage": fx.usage(spark, fx.january_lines())}
    for name, df in tables.items():
        df.withColumn("_loaded_at", F.current_timestamp()).write.parquet(f"{base}/{name}")
    raw_customers, raw_usage = (spark.read.parquet(f"{base}/{n}") for n in ("customers", "usage"))
    fact = finops.fct_cloud_usage_daily(
        staging.stg_cloud_usage(raw_usage),
        staging.stg_customers(raw_customers),
        staging.stg_billing_accounts(raw_customers),
    )
    fact.write.parquet(f"{base}/fact")
    return raw_customers, raw_usage, spark.read.parquet(f"{base}/fact")


def test_only_the_nested_fields_used_are_read(stored):
    usage = stored[1].select("cost.net_cost_usd", label_value("labels", "env").alias("env"))
    assert read_schemas(usage) == [
        "struct<cost:struct<net_cost_usd:double>,labels:array<struct<key:string,value:string>>>"
    ]
    credits = staging.stg_cloud_usage_credits(stored[1]).select("usage_id", "credit_amount_usd")
    (schema,) = read_schemas(credits)
    assert re.findall(r"^struct<usage_id:string,credits:array", schema)
    assert "labels" not in schema and "cost" not in schema


def test_monthly_total_of_allocation_reads_one_measure(stored):
    totals = finops.allocated_spend(stored[2]).groupBy("customer_id", "usage_month").agg(
        F.sum("effective_cost_usd").alias("total")
    )
    (schema,) = read_schemas(totals)
    assert [c for c in re.findall(r"(\w+):", schema) if c.endswith("_usd")] == ["effective_cost_usd"]


def test_unallocated_share_scans_the_fact_once(stored):
    """Rows and grand total share the shuffle of the groups."""
    report = reports.unallocated_share(finops.allocated_spend(stored[2]))
    report.collect()
    final = plan(report).split("Initial Plan")[0]
    assert len(re.findall(r"FileScan parquet", final)) <= 1 and "ReusedExchange" in final


def test_no_mart_holds_sets_while_it_groups(stored):
    for model in (
        finops.agg_customer_daily_spend,
        finops.agg_service_monthly_spend,
        finops.allocated_spend,
    ):
        assert "ObjectHashAggregate" not in plan(model(stored[2]))


def test_no_sum_goes_through_an_expand(spark, stored):
    subscriptions = staging.stg_subscriptions(stored[0], Settings())
    for model in (
        finops.agg_customer_daily_spend(stored[2]),
        finops.agg_service_monthly_spend(stored[2]),
        finops.agg_customer_monthly_spend(stored[2], subscriptions),
    ):
        assert "Expand" not in plan(model)
        scans = [s for s in read_schemas(model) if "service_id" in s or "sku_id" in s]
        assert any("_usd" not in s for s in scans), "the thin branch reads no amount"


def test_filters_reach_the_scan(stored):
    assert "EqualTo(usage_id,u1)" in plan(stored[1].where("usage_id = 'u1'"))


def test_lifetime_usage_is_not_computed_for_account_attributes(stored):
    """The fact only takes attributes of the account, so the usage rollup falls away."""
    raw_customers, raw_usage, _ = stored
    customers = staging.stg_customers(raw_customers)
    accounts = core.dim_billing_accounts(
        staging.stg_billing_accounts(raw_customers), customers, staging.stg_cloud_usage(raw_usage)
    ).select("billing_account_id", "payment_terms")
    assert not any("credits" in schema for schema in read_schemas(accounts))


def test_no_model_uses_a_nested_loop_or_a_cross_join(spark, small_folder):
    models = Models(spark, small_folder)
    for name in (
        "dim_customers",
        "dim_products",
        "dim_billing_accounts",
        "fct_subscriptions",
        "fct_cloud_usage_daily",
        "agg_customer_daily_spend",
        "agg_customer_monthly_spend",
        "agg_service_monthly_spend",
        "agg_cost_allocation_monthly",
    ):
        text = plan(getattr(models, name))
        assert "NestedLoop" not in text and "Cartesian" not in text, name
        assert "Python" not in text and "Arrow" not in text, name


def test_revenue_bounds_come_from_the_partition_column(spark, stored, tmp_path):
    """On a table partitioned by day no data column is read to find the months."""
    path = str(tmp_path / "fact")
    stored[2].write.partitionBy("usage_date").parquet(path)
    subscriptions = staging.stg_subscriptions(stored[0], Settings())
    monthly = finops.agg_customer_monthly_spend(spark.read.parquet(path), subscriptions)
    monthly.collect()
    assert "struct<>" in read_schemas(monthly)


def test_a_side_of_some_tens_of_megabytes_is_not_broadcast(spark, tmp_path):
    """Files are compressed: such a side is many times larger as a hash table in the driver."""
    # Random doubles do not compress, so the file is about as large as its 20 MB of rows.
    path = str(tmp_path / "side")
    spark.range(0, 2_500_000, 1, 4).select("id", F.rand(1).alias("x")).write.parquet(path)
    side = spark.read.parquet(path)
    joined = spark.range(100_000_000).join(side, "id").select("id", "x")
    assert "BroadcastHashJoin" not in plan(joined) and "SortMergeJoin" in plan(joined)
