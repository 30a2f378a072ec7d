"""Operators on skewed and awkward rows, against brute force."""

import random
import re
from datetime import date, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from spendlake.functions import exact_sum
from spendlake.operators import joins, quality, windows
from spendlake.operators.grouping import summarise


def last_day(month):
    following = (month.replace(day=28) + timedelta(days=4)).replace(day=1)
    return following - timedelta(days=1)


def test_live_totals_equal_a_row_per_interval_and_month(spark):
    """Running sums of what starts and ends leave nothing behind, with gaps and nulls."""
    rows = [
        ("a", 0.1, date(2024, 1, 15), date(2024, 3, 1)),
        ("a", 0.2, date(2024, 3, 31), date(2024, 3, 31)),
        ("a", 7.0, date(2023, 1, 1), None),
        ("b", 1e-9, date(2024, 2, 1), date(2024, 2, 29)),
        ("b", None, date(2024, 6, 1), date(2024, 6, 2)),
        ("b", 5.5, date(2024, 6, 9), date(2024, 12, 31)),
        ("c", 1.0, date(2020, 1, 1), date(2020, 2, 1)),
        ("c", 1.0, None, None),
        (None, 2.5, date(2024, 7, 1), None),
    ]
    df = spark.createDataFrame(rows, "k string, x double, start_date date, end_date date")
    first, last = F.lit(date(2024, 1, 1)), F.lit(date(2024, 8, 1))
    expected = (
        joins.live_months(df, first, last)
        .groupBy("k", "usage_month")
        .agg(exact_sum("x").alias("total"), F.count("*").alias("n"))
    )
    got = joins.live_totals(df, ["k"], "x", first, last, "total", "n")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert got.count() == 8 + 1 + 3 + 2


def test_live_months_equals_the_overlap_condition(spark):
    rng = random.Random(5)
    first = date(2023, 1, 1)
    intervals = [(-1, None, date(2023, 3, 3)), (-2, date(2023, 4, 30), date(2023, 4, 1)),
                 (-3, date(2023, 1, 31), date(2023, 2, 1)), (-4, date(2030, 1, 1), None)]
    for i in range(200):
        start = first + timedelta(days=rng.randrange(700))
        end = start + timedelta(days=rng.randrange(-40, 200)) if i % 3 else None
        intervals.append((i, start, end))
    months = [date(2023, m, 1) for m in (2, 3, 7, 12)] + [date(2024, 5, 1)]
    df = spark.createDataFrame(intervals, "id int, start_date date, end_date date")
    month_df = spark.createDataFrame([(m,) for m in months], "usage_month date")
    expected = {
        (i, m) for i, s, e in intervals for m in months
        if s is not None and s <= last_day(m) and (e is None or e >= m)
    }
    got = joins.live_in_listed_months(month_df, df).collect()
    assert len(got) == len(expected) and {(r.id, r.usage_month) for r in got} == expected
    condition = joins.overlap_condition(F.col("usage_month"), F.col("start_date"), F.col("end_date"))
    direct = df.join(F.broadcast(month_df), condition).select("id", "usage_month")
    assert {tuple(r) for r in direct.collect()} == expected


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, and another share without any key."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        (F.col("id") % 97 / 8).alias("x"),
        "id",
    )
    return rows


def test_joined_total_equals_window_total(skewed):
    joined = windows.add_joined_total(skewed, skewed, ["k"], "x", "total").select("id", "k", "x", "total")
    windowed = windows.add_window_total(skewed, ["k"], "x", "total").select("id", "k", "x", "total")
    assert joined.count() == 9000
    assert joined.exceptAll(windowed).count() == 0


@pytest.fixture
def tiny_skew_limits(spark):
    """Limits under which a few kilobytes count as skew, and nothing is broadcast."""
    limits = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4kb",
    }
    before = {name: spark.conf.get(name) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_a_dimension_join_is_split(spark, skewed, tiny_skew_limits):
    numbers = spark.range(9000).where("id % 3 = 1").select(F.col("id").cast("string").alias("k"))
    dims = numbers.union(spark.range(1).select(F.lit("hot"))).withColumn("name", F.upper("k"))
    rows, plan = executed(joins.add_attributes(skewed, dims, "k"))
    assert len(rows) == 9000 and "skew=true" in plan
    assert sum(r.name is None for r in rows) == 3000
    rows, plan = executed(joins.keep_known(skewed, dims, "k"))
    assert len(rows) == 6000 and "skew=true" in plan


def test_hot_key_of_a_joined_total_is_split(skewed, tiny_skew_limits):
    rows, plan = executed(windows.add_joined_total(skewed, skewed, ["k"], "x", "total"))
    assert len(rows) == 9000 and "skew=true" in plan


def test_grouping_after_a_join_shuffles_on_all_keys(spark, skewed, tiny_skew_limits):
    """Rows that lie by a hot key after a join are combined before they are grouped."""
    dims = spark.range(9000).select(F.col("id").cast("string").alias("k"))
    grouped = joins.keep_known(skewed, dims, "k").groupBy("k", "x").count()
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(k#\d+, x#\d+", plan)


def test_grand_total_share(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, x double")
    got = {r.k: r.pct for r in windows.add_grand_total_share(df, "x", "pct").collect()}
    assert got == {"a": 25.0, "b": 75.0}


def test_top_per_group_limits_before_the_shuffle(skewed):
    top = windows.top_per_group(skewed, ["k"], "x", ["id"], 2)
    assert top.where("k = 'hot'").count() == 2
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_trend_shares_one_exchange(spark):
    daily = spark.createDataFrame([("a", date(2024, 1, d), float(d)) for d in (1, 2, 9)], "k string, day date, x double")
    trend = windows.add_trend(daily, ["k"], "day", "x", "avg", "prev")
    assert trend._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert [(r.avg, r.prev) for r in trend.orderBy("day").collect()] == [(1.0, None), (1.5, 1.0), (4.0, 2.0)]


def test_orphans_are_counted_by_key(spark, skewed):
    parent = spark.createDataFrame([("hot",)], "key string")
    orphans = quality.orphan_values(skewed, "k", parent, "key")
    assert orphans.agg(F.sum("row_count")).first()[0] == 3000


def odd_lines(rng):
    """Nulls in keys, values and amounts, one key with a third of all rows, repeated values."""
    return [
        (
            rng.choice(["hot", None, "a", "b"]) if i % 3 else "hot",
            rng.choice([1, None, 2]),
            rng.choice([None, "x", "y", "z", ""]),
            rng.choice([None, 0.0, -0.0, 1.5, float("nan")]),
            rng.choice([None, 0.1, 1e-9, -7.25]),
            rng.random() < 0.5,
        )
        for i in range(3000)
    ]


@pytest.mark.parametrize("keys", [["k", "n"], ["k"], []])
def test_summarise_equals_plain_aggregates(spark, keys):
    lines = spark.createDataFrame(
        odd_lines(random.Random(3)), "k string, n int, s string, d double, x double, flag boolean"
    ).repartition(5)
    negative = F.when(F.col("x") < 0, F.col("x"))
    got = summarise(
        lines,
        keys,
        sums={"total": "x", "negative": negative},
        distinct={"texts": "s", "numbers": "n", "doubles": "d"},
        others={"least": F.min("x"), "flags": F.count_if("flag")},
        rows="lines",
    )
    expected = lines.groupBy(*keys).agg(
        F.count("*").alias("lines"),
        F.min("x").alias("least"),
        F.count_if("flag").alias("flags"),
        F.count_distinct("s").alias("texts"),
        F.count_distinct("n").alias("numbers"),
        F.count_distinct("d").alias("doubles"),
        exact_sum("x").alias("total"),
        exact_sum(negative).alias("negative"),
    )
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    one = summarise(lines, keys, distinct={"texts": "s"})
    assert sorted(map(str, one.collect())) == sorted(map(str, expected.select(*keys, "texts").collect()))
    empty = summarise(lines.where(F.lit(False)), keys, sums=["x"], distinct={"texts": "s"}, rows="lines")
    assert [tuple(r) for r in empty.collect()] == ([] if keys else [(0, 0, None)])


def test_summarise_combines_before_each_shuffle(spark):
    """No sum goes through an Expand, and a hot key leaves each task as one row."""
    lines = spark.range(200_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("k"),
        (F.col("id") % 7).alias("v"),
        (F.col("id") % 5).alias("w"),
        (F.col("id") / 8).alias("x"),
    )
    got = summarise(lines, ["k"], sums=["x"], distinct={"vs": "v", "ws": "w"})
    assert {(r["vs"], r["ws"]) for r in got.collect()} == {(7, 5), (7, 1)}
    plan = got._jdf.queryExecution().executedPlan()
    assert "Expand" not in plan.toString()
    written, nodes = [], [plan.executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        stage = [node.plan()] if "QueryStage" in node.nodeName() else []
        children = node.children()
        nodes += stage + [children.apply(i) for i in range(children.size())]
    # Keys times values, and keys, from each task; never the 200,000 rows.
    assert written and max(written) <= 51 * 12 * 8


def test_trailing_mean_by_running_sums(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice("ab"), date(2024, 1, 1) + timedelta(days=d), rng.choice([None, 0.1, 1e-9, 5e11, -0.3]))
        for d in range(60)
    ]
    df = spark.createDataFrame(rows, "k string, d date, x double").repartition(3)
    got = windows.add_trend(df, ["k"], "d", "x", "mean", "before", rows=4)
    assert got.columns == ["k", "d", "x", "mean", "before"]
    expected = []
    for key in "ab":
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for i, r in enumerate(own):
            known = [Fraction(x) for _, _, x in own[max(0, i - 3) : i + 1] if x is not None]
            mean = float(sum(known, Fraction(0))) / len(known) if known else None
            expected.append((*r, mean, own[i - 1][2] if i else None))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


def test_unread_distinct_counts_are_not_worked_out(spark, tmp_path):
    """Counts that nobody selects cost no read of their columns."""
    path = str(tmp_path / "lines")
    spark.sql("SELECT id % 7 AS k, id * 0.5D AS x, id % 3 AS v FROM range(100)").write.parquet(path)
    lines = spark.read.parquet(path)
    whole = summarise(lines, ["k"], sums=["x"], distinct={"vs": "v"}, rows="lines")
    spared = whole.select("k", "x")
    text = spared._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Join" not in text
    assert {(r.k, r.x) for r in spared.collect()} == {(r.k, r.x) for r in whole.collect()}
    assert {(r.vs, r.lines) for r in whole.where("k < 2").collect()} == {(3, 15)}


def test_fact_lines_move_once_and_keep_repeats(spark, tiny_skew_limits):
    """Customers and accounts that come twice repeat a line; NULL accounts stay."""
    usage = spark.createDataFrame(
        [("u1", "c1", "a1"), ("u2", "c1", None), ("u3", "c2", "a9"), ("u4", "c9", "a1"), ("u5", None, "a1")],
        "usage_id string, c string, a string",
    )
    customers = spark.createDataFrame([("c1", "x"), ("c1", "y"), ("c2", "z")], "c string, name string")
    accounts = spark.createDataFrame([("a1", 1), ("a1", 2), (None, 3)], "a string, terms int")
    pairs = joins.add_attributes(
        joins.keep_known(usage.select("c", "a").distinct(), customers, "c"), accounts, "a"
    )
    joined = joins.join_pairs(usage, pairs, ["c", "a"])
    single = joins.add_attributes(joins.keep_known(usage, customers, "c"), accounts, "a")
    rows = lambda df: sorted(map(str, df.select("usage_id", "c", "a", "name", "terms").collect()))
    assert rows(joined) == rows(single) and joined.count() == 7


def test_joins_of_growing_tables_broadcast_nothing(spark):
    """Small files can hold many rows, so neither rollups nor lines and pairs go by the driver."""
    lines = spark.sql("SELECT id % 5 AS c, IF(id % 7 = 0, NULL, id % 3) AS a, id FROM range(90)")
    pairs = lines.select("c", "a").distinct()
    rollup = lines.groupBy("c").agg(F.count("*").alias("n"))
    met, plan = executed(joins.join_pairs(lines, pairs, ["c", "a"]))
    assert len(met) == 90 and "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    met, plan = executed(joins.add_rollups(lines, [rollup], "c"))
    assert {r.n for r in met} == {18} and "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_few_groups_are_dealt_over_many_tasks(spark):
    """The rows of one group do not meet in one task, and none is lost or doubled."""
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        lines = spark.sql("SELECT id, IF(id % 9 = 0, NULL, 'a') AS k, 1.5D AS x FROM range(9000)")
        total = windows.add_joined_total(lines, lines, ["k"], "x", "total", buckets=64)
        tasks = [r["count"] for r in total.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 9000 and max(tasks) < 6000
        assert {(r.k, r.total) for r in total.collect()} == {(None, 1500.0), ("a", 12000.0)}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
