"""Stored models: full and incremental builds, schema changes, checks."""

import re
import uuid
from collections import Counter
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendlake import Settings
from spendlake.operators.quality import Check, run_checks
from spendlake.plans.pipeline import Pipeline
from spendlake.plans.registry import MODELS, select
from spendlake.plans.reports import REPORTS
from spendlake.sinks.tables import Layout, Warehouse
from tests import fixtures as fx

INCREMENTAL = [m.name for m in MODELS if m.kind == "incremental"]
STORED = [m.name for m in MODELS if m.kind != "view"]


@pytest.fixture
def settings(tmp_path):
    return Settings(
        as_of=date(2024, 3, 10), database=f"t_{uuid.uuid4().hex}", base_path=str(tmp_path)
    )


def landed(spark, lines):
    return {
        "customers": fx.customers(spark),
        "products": fx.products(spark),
        "cloud_usage": fx.usage(spark, lines),
    }


def content(df):
    columns = sorted(c for c in df.columns if c != "_loaded_at")
    return Counter(str(r) for r in df.select(*columns).collect())


def days(first, n):
    return [first + timedelta(days=i) for i in range(n)]


def make_lines(first, n, cost=10.0, credit=True):
    credits = [("promotional_credit", "k", -1.0)] if credit else []
    return [
        fx.line(f"{d}-{i}", d, cost=(cost + i, 0.0, cost + i, "USD"), credits=credits,
                cloud_provider="GCP" if i else "AWS")
        for d in days(first, n)
        for i in range(3)
    ]


def test_incremental_equals_full_rebuild(spark, settings, tmp_path):
    """Restated days, a day whose credits all vanished, new days; older days untouched."""
    first = make_lines(date(2024, 1, 20), 16)  # up to 4 February
    Pipeline(spark, landed(spark, first), settings).build()
    window = date(2024, 2, 1)  # 4 February minus three days
    second = (
        [x for x in first if x[1] < window]
        + make_lines(window, 1, cost=50.0)
        + make_lines(date(2024, 2, 2), 1, credit=False)
        + make_lines(date(2024, 2, 3), 5, cost=20.0)
    )
    refreshed = Pipeline(spark, landed(spark, second), replace(settings, incremental=True))
    refreshed.build()
    fresh = replace(settings, database=f"{settings.database}_full", base_path=str(tmp_path / "full"))
    rebuilt = Pipeline(spark, landed(spark, second), fresh)
    rebuilt.build()
    assert len(INCREMENTAL) == 8
    for name in STORED:
        assert content(refreshed.table(name)) == content(rebuilt.table(name)), name
    assert date(2024, 2, 2) not in refreshed.warehouse.partition_dates("stg_cloud_usage_credits")


def test_late_lines_outside_the_window_are_ignored(spark, settings):
    first = make_lines(date(2024, 1, 1), 10)
    pipeline = Pipeline(spark, landed(spark, first), replace(settings, incremental=True))
    pipeline.build(tags={"cloud_usage"})
    late = make_lines(date(2024, 1, 2), 1, cost=99.0) + make_lines(date(2024, 1, 8), 1, cost=99.0)
    again = Pipeline(spark, landed(spark, late), replace(settings, incremental=True))
    again.build(tags={"cloud_usage"})
    costs = {
        r.usage_date: r.top
        for r in again.table("stg_cloud_usage").groupBy("usage_date").agg(F.max("list_cost_usd").alias("top")).collect()
    }
    assert costs[date(2024, 1, 2)] == 12.0  # outside the lookback
    assert costs[date(2024, 1, 8)] == 101.0  # restated
    # The landing lacked the days around it; the raw history keeps them.
    assert again.table("raw_cloud_usage").select("usage_date").distinct().count() == 10


def test_full_refresh_takes_everything_without_dropping(spark, settings):
    pipeline = Pipeline(spark, landed(spark, make_lines(date(2024, 1, 1), 10)), settings)
    pipeline.build(tags={"cloud_usage"})
    late = landed(spark, make_lines(date(2024, 1, 2), 1, cost=99.0))
    flags = replace(settings, incremental=True, full_refresh=True)
    Pipeline(spark, late, flags).build(names={"raw_cloud_usage"})
    raw = Pipeline(spark, late, flags).table("raw_cloud_usage")
    assert raw.where("usage_date = '2024-01-02'").agg(F.max("cost.list_cost_usd")).first()[0] == 101.0
    assert raw.select("usage_date").distinct().count() == 10


def test_tables_of_an_earlier_session_are_found(spark, settings):
    lines = make_lines(date(2024, 1, 1), 4)
    incremental = replace(settings, incremental=True)
    Pipeline(spark, landed(spark, lines), incremental).build(tags={"cloud_usage"})
    # Forget the tables, as a session without a metastore would.
    for name in ("raw_cloud_usage", "stg_cloud_usage"):
        spark.sql(f"DROP TABLE {settings.database}.{name}")
    pipeline = Pipeline(spark, landed(spark, make_lines(date(2024, 1, 4), 1, cost=70.0)), incremental)
    pipeline.build(tags={"cloud_usage"})
    assert pipeline.warehouse.partition_dates("raw_cloud_usage") == days(date(2024, 1, 1), 4)
    top = pipeline.table("stg_cloud_usage").groupBy("usage_date").agg(F.max("list_cost_usd").alias("m"))
    assert {r.usage_date.day: r.m for r in top.collect()} == {1: 12.0, 2: 12.0, 3: 12.0, 4: 72.0}


def test_schema_sync(spark, settings):
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date")
    old = spark.createDataFrame([(1, "x", date(2024, 1, 1)), (2, "y", date(2024, 1, 2))], "a int, b string, usage_date date")
    warehouse.replace("t", old, layout)
    new = spark.createDataFrame([(3, 0.5, date(2024, 1, 2))], "a int, c double, usage_date date")
    warehouse.overwrite_partitions("t", new, layout, date(2024, 1, 2))
    assert content(warehouse.read("t")) == content(
        spark.createDataFrame([(1, None, date(2024, 1, 1)), (3, 0.5, date(2024, 1, 2))], "a int, c double, usage_date date")
    )
    wrong = spark.createDataFrame([("3", 0.5, date(2024, 1, 2))], "a string, c double, usage_date date")
    with pytest.raises(ValueError, match="type of"):
        warehouse.overwrite_partitions("t", wrong, layout)


def test_notes_outlive_the_catalog(spark, settings):
    """Columns dropped by schema sync stay dropped; comments, description and pruning come back."""
    warehouse = Warehouse(spark, settings)
    layout = Layout("usage_date", description="What 'usage' cost", column_comments={"a": "Natural key"})
    old = spark.createDataFrame([(1, "x", date(2024, 1, 1)), (2, "y", date(2024, 1, 2))], "a int, b string, usage_date date")
    warehouse.replace("t", old, layout)
    new = spark.createDataFrame([(3, 0.5, date(2024, 1, 2))], "a int, c double, usage_date date")
    warehouse.overwrite_partitions("t", new, layout, date(2024, 1, 2))
    before = content(warehouse.read("t"))
    spark.sql(f"DROP TABLE {settings.database}.t")
    again = Warehouse(spark, settings)
    assert again.exists("t") and again.read("t").columns == ["a", "c", "usage_date"]
    assert content(again.read("t")) == before
    assert again.describe_columns("t")["a"] == "Natural key"
    assert spark.catalog.getTable(f"{settings.database}.t").description == "What 'usage' cost"
    assert again.partition_dates("t") == [date(2024, 1, 1), date(2024, 1, 2)]
    assert not again.exists("unknown")


def test_writes_leave_no_shuffle_files(spark, settings):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = blocks.getAllFiles().mkString(",").split(",")
        return {f for f in files if "/shuffle_" in f and f.endswith(".data")}

    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    warehouse, before, chosen = Warehouse(spark, settings), shuffles(), spark.conf.get(option)
    totals = spark.range(5000).groupBy((F.col("id") % 500).alias("k")).agg(F.count("*").alias("n"))
    days = totals.withColumn("usage_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("k").cast("int") % 3))
    warehouse.replace("plain", totals)
    warehouse.replace("by_day", days, Layout("usage_date", ("k",)))
    warehouse.overwrite_partitions("by_day", days.where("k > 9"), Layout("usage_date", ("k",)))
    assert shuffles() <= before and spark.conf.get(option) == chosen
    assert warehouse.read("plain").count() == 500 and warehouse.read("by_day").count() == 490


def test_vanished_partitions_lose_their_files(spark, settings):
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date")
    first = date(2024, 1, 1)
    old = spark.createDataFrame([(i, first + timedelta(days=i)) for i in range(6)], "a int, usage_date date")
    warehouse.replace("t", old, layout)
    new = spark.createDataFrame([(9, first + timedelta(days=4))], "a int, usage_date date")
    warehouse.overwrite_partitions("t", new, layout, first + timedelta(days=2))
    assert [d.day for d in warehouse.partition_dates("t")] == [1, 2, 5]
    files = spark.read.parquet(warehouse.location("t"))
    assert sorted(r.a for r in files.collect()) == [0, 1, 9]


def test_clustering_makes_row_groups_selective(spark, settings):
    """Sorted files have disjoint ranges of the clustering column, so a filter skips row groups."""
    import pyarrow.parquet as pq

    rows = spark.range(40_000).select(((F.col("id") * 7919) % 40_000).alias("k"), F.lit("x" * 50).alias("v"))
    overlaps = {}
    for name, layout in (("plain", Layout()), ("clustered", Layout(cluster_by=("k",)))):
        warehouse = Warehouse(spark, settings)
        option = "parquet.block.size"
        spark.sparkContext._jsc.hadoopConfiguration().set(option, str(64 * 1024))
        try:
            warehouse.replace(name, rows.repartition(2), layout)
        finally:
            spark.sparkContext._jsc.hadoopConfiguration().unset(option)
        files = [f.removeprefix("file:") for f in warehouse.read(name).inputFiles()]
        groups = [
            pq.ParquetFile(f).metadata.row_group(i).column(0).statistics
            for f in files
            for i in range(pq.ParquetFile(f).metadata.num_row_groups)
        ]
        overlaps[name] = sum(g.min <= 12_345 <= g.max for g in groups) / len(groups), len(groups)
    assert overlaps["clustered"][1] > 2 and overlaps["clustered"][0] < overlaps["plain"][0]


def test_comments_are_stored(spark, settings):
    pipeline = Pipeline(spark, landed(spark, fx.january_lines()), settings)
    pipeline.build(names={"raw_cloud_usage"})
    assert "Billing lines" in spark.catalog.getTable(f"{settings.database}.raw_cloud_usage").description
    assert pipeline.warehouse.describe_columns("raw_cloud_usage")["usage_id"].startswith("Natural key")


def test_partition_filter_is_pruned(spark, settings):
    from spendlake.operators.incremental import since

    warehouse = Warehouse(spark, settings)
    df = spark.range(10).select("id", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("usage_date"))
    warehouse.replace("t", df, Layout("usage_date"))
    kept = since(warehouse.read("t"), "usage_date", date(2024, 1, 8))
    assert kept.count() == 3 and len(kept.inputFiles()) >= 3
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(usage_date" in plan


def test_select():
    assert {m.name for m in select(tags={"core"})} == {
        "dim_customers", "dim_products", "dim_billing_accounts", "fct_subscriptions"
    }
    assert [m.name for m in select(names={"stg_products", "raw_products"})] == ["raw_products", "stg_products"]
    assert len(select()) == 22
    assert next(m for m in MODELS if m.name == "agg_customer_daily_spend").refresh is None


def test_all_checks_run_and_find_the_flaws(spark, settings):
    pipeline = Pipeline(spark, landed(spark, fx.january_lines()), settings)
    pipeline.build()
    outcome = {(r.model, r.column_name, r.check_kind): r.failing_rows for r in pipeline.check().collect()}
    assert len(outcome) == 95
    failing = {k: v for k, v in outcome.items() if v}
    assert failing == {
        ("raw_cloud_usage", "customer_id", "relationships"): 1,
        ("stg_cloud_usage", "customer_id", "relationships"): 1,
        ("stg_subscriptions", "product_id", "relationships"): 1,
        ("stg_cloud_usage", "billing_account_id", "relationships"): 1,
        ("fct_cloud_usage_daily", "billing_account_id", "relationships"): 1,
        ("stg_cloud_usage_credits", "credit_type", "accepted_values"): 1,
    }


def test_each_check_kind_counts_its_failures(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    checks = [
        Check("child", "k", "not_null"),
        Check("child", "k", "unique"),
        Check("child", "k", "relationships", parent="parent", parent_column="k"),
        Check("child", "k", "accepted_values", accepted=("b",)),
    ]
    got = {r.check_kind: r.failing_rows for r in run_checks({"child": child, "parent": parent}, checks).collect()}
    assert got == {"not_null": 2, "unique": 1, "relationships": 1, "accepted_values": 3}


def test_empty_batch(spark, settings):
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date")
    rows = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 5))], "a int, usage_date date")
    warehouse.replace("t", rows, layout)
    nothing = rows.where(F.lit(False))
    assert warehouse.overwrite_partitions("t", nothing, layout, date(2024, 1, 2), drop_vanished=False) == []
    assert warehouse.read("t").count() == 2
    assert warehouse.overwrite_partitions("t", nothing, layout, date(2024, 1, 2)) == []
    assert [r.a for r in warehouse.read("t").collect()] == [1]


def test_month_models_skip_old_days_of_the_fact(spark, settings):
    """An incremental month model reads only the day partitions of the months it rebuilds."""
    lines = make_lines(date(2024, 1, 25), 30)
    pipeline = Pipeline(spark, landed(spark, lines), replace(settings, incremental=True))
    pipeline.build()
    planned = {}
    pipeline.warehouse.overwrite_partitions = lambda name, df, *rest: planned.update({name: df})
    lines += make_lines(date(2024, 5, 1), 1)
    pipeline.warehouse.high_water_mark = lambda name: date(2024, 3, 1)
    pipeline.build(names={"agg_service_monthly_spend"})
    files = planned["agg_service_monthly_spend"].inputFiles()
    assert files and all("usage_date=2024-02" in f for f in files)


def test_hot_day_is_written_as_several_files(spark, settings, tmp_path):
    """A third of the rows on one day do not end up in one task or file."""
    day = F.when(F.col("id") % 3 == 0, F.lit(date(2024, 1, 1))).otherwise(
        F.date_add(F.lit(date(2024, 1, 2)), (F.col("id") % 20).cast("int"))
    )
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("a"), day.alias("usage_date"))
    rows.repartition(8).write.parquet(str(tmp_path / "in"))
    # A shuffle wider than the number of days, as a cluster has it.
    options = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200kb", "spark.sql.shuffle.partitions": "400"}
    before = {option: spark.conf.get(option) for option in options}
    try:
        for option, value in options.items():
            spark.conf.set(option, value)
        warehouse = Warehouse(spark, settings)
        warehouse.replace("t", spark.read.parquet(str(tmp_path / "in")), Layout("usage_date", ("a",)))
    finally:
        for option, value in before.items():
            spark.conf.set(option, value)
    files = warehouse.read("t").select("usage_date", F.input_file_name().alias("f")).distinct()
    counts = {r.usage_date: r["count"] for r in files.groupBy("usage_date").count().collect()}
    assert counts[date(2024, 1, 1)] > 1 and counts[date(2024, 1, 5)] == 1


@pytest.fixture
def small_files(spark):
    """Shuffles wider than the number of days and files of some 100 kB, as large data has them."""
    options = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100kb", "spark.sql.shuffle.partitions": "100"}
    before = {option: spark.conf.get(option) for option in options}
    for option, value in options.items():
        spark.conf.set(option, value)
    yield
    for option, value in before.items():
        spark.conf.set(option, value)


def key_ranges(files):
    """First and last ``k`` in the row groups of each file, in order."""
    import pyarrow.parquet as pq

    ranges = []
    for file in files:
        parquet = pq.ParquetFile(file.removeprefix("file:")).metadata
        column = parquet.schema.to_arrow_schema().names.index("k")
        groups = [parquet.row_group(i).column(column).statistics for i in range(parquet.num_row_groups)]
        ranges.append((min(g.min for g in groups), max(g.max for g in groups), parquet.num_rows))
    return sorted(ranges)


def hot_rows(spark):
    """Half of the rows on one day, and there a third of them with one key."""
    day = F.when(F.col("id") % 2 == 0, F.lit(date(2024, 1, 1))).otherwise(
        F.date_add(F.lit(date(2024, 1, 2)), (F.col("id") % 21).cast("int"))
    )
    key = F.when(F.col("id") % 3 == 0, 5000).otherwise((F.col("id") * 7919) % 10_000)
    rows = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("a"), key.cast("int").alias("k"), day.alias("usage_date")
    )
    return rows.repartition(8)


def test_files_of_a_hot_day_become_disjoint(spark, settings, small_files):
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date", ("k",))
    rows = hot_rows(spark)
    warehouse.replace("t", rows, layout)
    hot = F.col("usage_date") == date(2024, 1, 1)
    before = key_ranges(warehouse.read("t").where(hot).inputFiles())
    holding = lambda ranges, k: sum(low <= k <= high for low, high, _ in ranges)
    assert len(before) > 3 and holding(before, 1234) > 3
    files = {f.partition("usage_date=")[2][:10]: f for f in warehouse.read("t").inputFiles()}
    done = warehouse.recluster("t", layout)
    assert "2024-01-01" in done and len(done) < len(files)
    after = key_ranges(warehouse.read("t").where(hot).inputFiles())
    assert len(after) > 3 and holding(after, 1234) <= 2 and holding(after, 9876) <= 2
    assert all(high <= low for (_, high, _), (low, _, _) in zip(after, after[1:]))
    # The hot key is cut, too.
    assert holding(after, 5000) > 1 and max(n for _, _, n in after) < 2 * 30_000 / len(after)
    # Other days keep their files, and nothing is left to do.
    kept = {f for day, f in files.items() if day not in done}
    assert kept and kept <= set(warehouse.read("t").inputFiles())
    assert warehouse.recluster("t", layout) == []
    stored = warehouse.read("t").select(rows.columns)
    assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()


def test_recluster_of_nulls_and_without_partitions(spark, settings, small_files):
    warehouse, layout = Warehouse(spark, settings), Layout(cluster_by=("k", "a"))
    rows = hot_rows(spark).withColumn("k", F.when(F.col("k") % 4 != 0, F.col("k")))
    warehouse.replace("plain", rows, layout)
    assert warehouse.recluster("plain", layout) == [""] and warehouse.recluster("plain", layout) == []
    undated = rows.withColumn("usage_date", F.lit(None).cast("date"))
    warehouse.replace("undated", undated, replace(layout, partition_by="usage_date"))
    assert len(warehouse.recluster("undated", replace(layout, partition_by="usage_date"))) == 1
    for name, expected in (("plain", rows), ("undated", undated)):
        stored = warehouse.read(name).select(rows.columns)
        assert stored.exceptAll(expected).isEmpty() and stored.count() == 60_000


def test_recluster_leaves_empty_unclustered_and_missing_tables(spark, settings):
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date", ("k",))
    assert warehouse.recluster("missing", layout) == []
    warehouse.replace("empty", hot_rows(spark).limit(0), layout)
    assert warehouse.recluster("empty", layout) == []
    warehouse.replace("plain", hot_rows(spark), Layout("usage_date"))
    assert warehouse.recluster("plain", Layout("usage_date")) == []


def test_reports_run_on_stored_models(spark, settings):
    pipeline = Pipeline(spark, landed(spark, fx.january_lines()), settings)
    pipeline.build()
    options = {"usage_id": "u1", "month": date(2024, 1, 1)}
    counts = {name: pipeline.report(name, **options).count() for name in REPORTS}
    assert counts == {
        "usage_line": 1, "grain_check": 1, "credits_of_line": 2, "labels_of_line": 4,
        "first_subscriptions": 6, "spend_vs_revenue": 2, "top_cost_drivers": 2, "spend_spikes": 3,
        "unallocated_share": 2, "spend_by_environment": 3, "customer_360": 3,
    }
    with pytest.raises(ValueError, match="usage_id"):
        pipeline.report("usage_line")


def test_schema_sync_of_types_and_nested_fields(spark, settings):
    """Wider types and nested fields that come and go, across old and new partitions and sessions."""
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date")
    old = spark.createDataFrame(
        [
            (1, 1.5, date(2024, 5, 1), ("USD", 7), [("k", 1)], {"m": ("x", 2)}, date(2024, 1, 1)),
            (2, None, None, None, None, None, date(2024, 1, 2)),
        ],
        "a int, f float, d date, cost struct<currency:string,n:int>, tags array<struct<k:string,n:int>>,"
        " more map<string,struct<p:string,q:int>>, usage_date date",
    )
    warehouse.replace("t", old, layout)
    new = spark.createDataFrame(
        [(2**40, 0.1, date(2024, 6, 1), (2**41, "EU"), [(2**42, "k", True)], {"m": (9,)}, date(2024, 1, 2))],
        "a bigint, f double, d date, cost struct<n:bigint,region:string>,"
        " tags array<struct<n:bigint,k:string,own:boolean>>, more map<string,struct<q:int>>, usage_date date",
    )
    change = warehouse.sync_schema("t", new)
    assert set(change.added) == {"cost.region", "tags.element.own"}
    assert set(change.removed) == {"cost.currency", "more.value.p"}
    assert set(change.widened) == {"a", "f", "cost.n", "tags.element.n"} and not change.rewritten
    files = set(warehouse.read("t").inputFiles())
    assert len(files) == 2, "no file was written anew"
    warehouse.overwrite_partitions("t", new, layout, date(2024, 1, 2))
    expected = [
        (1, 1.5, date(2024, 5, 1), (7, None), [("k", 1, None)], {"m": (2,)}, date(2024, 1, 1)),
        (2**40, 0.1, date(2024, 6, 1), (2**41, "EU"), [("k", 2**42, True)], {"m": (9,)}, date(2024, 1, 2)),
    ]
    plain = lambda v: tuple(map(plain, v)) if isinstance(v, (tuple, list)) else (
        {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else v
    )
    spark.sql(f"DROP TABLE {settings.database}.t")  # a new session
    for found in (warehouse, Warehouse(spark, settings)):
        rows = found.read("t").orderBy("usage_date").collect()
        assert plain(rows) == plain(expected)
        assert dict(found.read("t").dtypes)["a"] == "bigint"
    narrower = spark.createDataFrame([(5, 0.5, date(2024, 1, 3))], "a int, f float, usage_date date")
    warehouse.overwrite_partitions("t", narrower, layout, date(2024, 1, 3))
    assert dict(warehouse.read("t").dtypes) == {"a": "bigint", "f": "double", "usage_date": "date"}


def test_fields_that_return_and_types_files_lack_are_rewritten(spark, settings):
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date", ("a",))
    rows = [(1, "old", date(2024, 5, 1), date(2024, 1, 1)), (2, "old", None, date(2024, 1, 2))]
    warehouse.replace("t", spark.createDataFrame(rows, "a int, b string, d date, usage_date date"), layout)
    without = spark.createDataFrame([(3, date(2024, 6, 1), date(2024, 1, 2))], "a int, d date, usage_date date")
    warehouse.overwrite_partitions("t", without, layout, date(2024, 1, 2))
    again = spark.createDataFrame(
        [(4, "new", datetime(2024, 6, 1, 7), date(2024, 1, 2))], "a int, b string, d timestamp, usage_date date"
    )
    warehouse.overwrite_partitions("t", again, layout, date(2024, 1, 2))
    got = warehouse.read("t").select("a", "b", "d", "usage_date").orderBy("a").collect()
    assert [tuple(r) for r in got] == [
        (1, None, datetime(2024, 5, 1), date(2024, 1, 1)),  # the dropped text does not come back
        (4, "new", datetime(2024, 6, 1, 7), date(2024, 1, 2)),
    ]
    assert len(list(Path(warehouse.location("t")).glob("*/version=*"))) == 2, "nothing is left behind"
    with pytest.raises(ValueError, match="type of"):
        warehouse.sync_schema("t", spark.createDataFrame([("x",)], "a string"))


class Killed(Exception):
    pass


@pytest.mark.parametrize("partition", ["usage_date", None])
def test_a_lost_driver_leaves_the_table_as_it_was(spark, settings, monkeypatch, partition):
    """Killed between write and swap; found so by this and a new session; cleared by the next write."""
    layout = Layout(partition)
    warehouse = Warehouse(spark, settings)
    old = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "a int, usage_date date")
    new = spark.createDataFrame([(9, "n", date(2024, 1, 2))], "a int, b string, usage_date date")
    warehouse.replace("t", old, layout)

    def killed(*args, **kwargs):
        raise Killed

    write = {"replace": lambda w: w.replace("t", new, layout)}
    if partition:
        write["overwrite"] = lambda w: w.overwrite_partitions("t", new, layout)
    for attempt in write.values():
        with monkeypatch.context() as patch:
            patch.setattr("spendlake.sinks.tables.rename", killed)
            with pytest.raises(Killed):
                attempt(warehouse)
        assert len(list(Path(warehouse.location("t")).rglob("version=*"))) > (2 if partition else 1)
        assert content(warehouse.read("t")) == content(old)
        spark.sql(f"DROP TABLE {settings.database}.t")
        assert content(Warehouse(spark, settings).read("t")) == content(old)
    # Killed after the swap, before the catalog followed: the pointer holds.
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_define", killed)
        with pytest.raises(Killed):
            warehouse.replace("t", new, layout)
    assert content(Warehouse(spark, settings).read("t")) == content(new)
    warehouse.replace("t", old, layout)
    assert content(warehouse.read("t")) == content(old)
    assert len(list(Path(warehouse.location("t")).rglob("version=*"))) == (2 if partition else 1)
    assert len(list(Path(f"{warehouse.location('t')}.versions").glob("[!.]*"))) == 1


def test_readers_of_a_kept_version_go_on(spark, settings):
    warehouse = Warehouse(spark, replace(settings, kept_versions=1))
    for layout in (Layout(), Layout("usage_date")):
        name = f"t_{layout.partition_by}"
        rows = [spark.createDataFrame([(i, date(2024, 1, 1))], "a int, usage_date date") for i in range(4)]
        warehouse.replace(name, rows[0], layout)
        files = warehouse.read(name).inputFiles()
        warehouse.replace(name, rows[1], layout)
        assert [r.a for r in spark.read.parquet(*files).collect()] == [0]
        warehouse.replace(name, rows[2], layout)
        assert not any(Path(f.removeprefix("file:")).exists() for f in files)
        assert [r.a for r in warehouse.read(name).collect()] == [2]


def test_rows_without_a_day_have_a_partition(spark, settings):
    warehouse, layout = Warehouse(spark, settings), Layout("usage_date")
    rows = spark.createDataFrame([(1, None), (2, date(2024, 1, 2))], "a int, usage_date date")
    warehouse.replace("t", rows, layout)
    assert content(warehouse.read("t")) == content(rows)
    other = spark.createDataFrame([(3, None)], "a int, usage_date date")
    assert warehouse.overwrite_partitions("t", other, layout, drop_vanished=False) == []
    assert sorted(r.a for r in warehouse.read("t").collect()) == [2, 3]
    assert warehouse.partition_dates("t") == [date(2024, 1, 2)]


def test_partitions_are_sorted_by_the_clustering_columns(spark, settings):
    import pyarrow.parquet as pq

    warehouse = Warehouse(spark, settings)
    day = F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 3).cast("int"))
    rows = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"), day.alias("usage_date"))
    warehouse.replace("t", rows.repartition(4), Layout("usage_date", ("k",)))
    for file in warehouse.read("t").inputFiles():
        keys = pq.ParquetFile(file.removeprefix("file:")).read().column("k").to_pylist()
        assert keys == sorted(keys) and len(keys) > 100


def test_lifetime_totals_are_merged_from_days(spark, settings, tmp_path):
    """A refresh reads the days of its window and equals a full rebuild, deletions included."""
    first = make_lines(date(2024, 1, 20), 16)  # up to 4 February
    Pipeline(spark, landed(spark, first), settings).build()
    window = date(2024, 2, 1)
    # In the window a line of each day is gone, and a day is new.
    second = [x for x in first if x[1] < window or not x[0].endswith("-1")]
    second += make_lines(date(2024, 2, 5), 1, cost=0.1)
    refreshed = Pipeline(spark, landed(spark, second), replace(settings, incremental=True))
    read, overwrite = {}, refreshed.warehouse.overwrite_partitions

    def noted(name, df, *rest):
        read[name] = df.inputFiles()
        return overwrite(name, df, *rest)

    refreshed.warehouse.overwrite_partitions = noted
    refreshed.build()
    files = read["dim_billing_accounts_usage"]
    days_read = {re.search(r"usage_date=([0-9-]+)", f)[1] for f in files}
    assert days_read == {str(d) for d in days(window, 5)}
    fresh = replace(settings, database=f"{settings.database}_full", base_path=str(tmp_path / "full"))
    rebuilt = Pipeline(spark, landed(spark, second), fresh)
    rebuilt.build()
    accounts = refreshed.table("dim_billing_accounts")
    assert content(accounts) == content(rebuilt.table("dim_billing_accounts"))
    assert accounts.agg(F.sum("usage_line_count")).first()[0] == len(second)
    assert content(refreshed.warehouse.read("dim_billing_accounts_usage")) == content(
        rebuilt.warehouse.read("dim_billing_accounts_usage")
    )
    # A rebuild from scratch does not leave old totals for the next refresh.
    third = [x for x in second if x[1] != date(2024, 1, 25)]
    Pipeline(spark, landed(spark, third), settings).build()
    again = Pipeline(spark, landed(spark, third), replace(settings, incremental=True))
    again.build()
    assert again.table("dim_billing_accounts").agg(F.sum("usage_line_count")).first()[0] == len(third)


def file_scans(df):
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return re.findall(r"FileScan parquet", final)


def test_the_suite_scans_each_table_once(spark, tmp_path):
    tables = {
        "child": spark.range(4000).select(
            F.concat(F.lit("a long key of a row "), "id").alias("id"), (F.col("id") % 7).cast("string").alias("p"),
            F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("kind"),
        ),
        "parent": spark.range(7).select(F.col("id").cast("string").alias("p")),
    }
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    checks = [
        *[Check("child", c, "not_null") for c in ("id", "p", "kind")],
        Check("child", "id", "unique"),
        Check("parent", "p", "unique"),
        Check("child", "p", "relationships", parent="parent", parent_column="p"),
        Check("child", "kind", "accepted_values", accepted=("x", "y")),
    ]
    outcome = run_checks(stored, checks)
    assert [r.failing_rows for r in outcome.collect()] == [0] * 7
    assert len(file_scans(outcome)) == 2, "one scan a table, none for the second look"
    doubled = stored | {"child": stored["child"].unionAll(stored["child"].limit(3))}
    found = {(r.column_name, r.check_kind): r.failing_rows for r in run_checks(doubled, checks).collect()}
    assert found.pop(("id", "unique")) == 3 and set(found.values()) == {0}


def test_hashes_that_collide_are_no_duplicates(spark, monkeypatch):
    """With a hash of two values only, every value is looked at again, and none is wrongly found."""
    from spendlake.operators import quality

    monkeypatch.setattr(quality.F, "xxhash64", lambda v: F.length(v).cast("long") % 2)
    rows = spark.createDataFrame([(str(i),) for i in range(50)] + [("7",), ("7",), ("33",), (None,), (None,)], "k string")
    checks = [Check("t", "k", "unique"), Check("t", "k", "not_null")]
    assert [r.failing_rows for r in run_checks({"t": rows}, checks).collect()] == [2, 2]
