"""Plans worked out for some customers after the others: the same rows, less on disk at a time."""

import os

import pytest

from spendlake.operators.grouping import summarise
from spendlake.plans import checks, registry
from spendlake.plans.pipeline import Pipeline
from spendlake.settings import Settings
from spendlake.sinks import turns
from spendlake.sinks.tables import Warehouse
from tests import fixtures as fx
from verification import models, storage


def texts(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Star tables of some hundred lines, with a customer of a third of them, and repeated lines."""
    base = str(tmp_path_factory.mktemp("star"))
    tables = {
        "region": "SELECT id AS r_regionkey, concat('R', id) AS r_name FROM range(2)",
        "nation": "SELECT id AS n_nationkey, concat('N', id) AS n_name, id % 2 AS n_regionkey FROM range(4)",
        "customer": """SELECT id AS c_custkey, concat('Customer', id) AS c_name, id % 4 AS c_nationkey,
            IF(id % 2 = 0, 'BUILDING', 'MACHINERY') AS c_mktsegment FROM range(1, 30)""",
        "part": """SELECT id AS p_partkey, concat('Part', id) AS p_name, concat('TYPE ', id % 5) AS p_type,
            concat('Brand#', id % 3) AS p_brand, CAST(id % 7 AS INT) AS p_size, id * 1.5D AS p_retailprice
            FROM range(1, 20)""",
        "orders": """SELECT id AS o_orderkey, IF(id % 3 = 0, 7, id % 31) AS o_custkey,
            element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus,
            concat(id % 5 + 1, '-X') AS o_orderpriority FROM range(1, 90)""",
        "lineitem": """SELECT id % 89 + 1 AS l_orderkey, id % 19 + 1 AS l_partkey, id % 6 AS l_suppkey,
            CAST(id % 7 + 1 AS INT) AS l_linenumber, id % 50 + 0.0D AS l_quantity, id * 1.1D AS l_extendedprice,
            id % 10 / 100D AS l_discount, id % 9 / 100D AS l_tax,
            element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS INT)) AS l_returnflag,
            IF(id % 2 = 0, 'O', 'F') AS l_linestatus,
            CAST(date_add(DATE'1995-01-01', CAST(id % 70 AS INT)) AS TIMESTAMP) AS l_shipdate
            FROM (SELECT * FROM range(300) UNION ALL SELECT * FROM range(9))""",
    }
    for name, query in tables.items():
        spark.sql(query).write.parquet(f"{base}/{name}.parquet")
    return base


def test_rows_in_turns_equal_rows_at_once(spark):
    """Null keys and turns without a row count; a share is gone when its turn has ended."""
    lines = spark.sql("SELECT IF(id % 3 = 0, NULL, id % 4) AS k, id % 7 AS v, id * 0.1D AS x FROM range(400)")
    seen, files = [], []

    def plan(share, turn):
        assert not any(map(os.path.exists, files))
        seen.append(turn)
        files.extend(f.removeprefix("file://") for f in share.inputFiles())
        return summarise(share, ["k"], sums=["x"], distinct={"vs": "v"}, rows="n")

    got = turns.in_turns(lines, "k", 8, plan)
    assert seen == list(range(8)) and files
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert texts(got) == texts(plan(lines, 0)) and got.count() == 5
    assert turns.in_turns(lines.limit(0), "k", 2, plan).collect() == []


def test_more_lines_take_more_turns_up_to_a_bound(spark, folder, monkeypatch):
    path = f"{folder}/lineitem.parquet"
    assert turns.turns_for(spark, path) == 1
    size = turns.stored_bytes(spark, path)
    monkeypatch.setattr(turns, "TURN_BYTES", size // 3 + 1)
    assert turns.turns_for(spark, path) == 3
    monkeypatch.setattr(turns, "TURN_BYTES", 1)
    assert turns.turns_for(spark, path) == turns.MOST_TURNS


@pytest.mark.parametrize(
    "name",
    [
        "fct_cloud_usage_daily",
        "agg_customer_daily_spend",
        "agg_customer_monthly_spend",
        "agg_service_monthly_spend",
        "agg_cost_allocation_monthly",
    ],
)
def test_a_query_in_turns_gives_the_same_rows(spark, folder, monkeypatch, name):
    whole = getattr(models, name)(spark, folder)
    monkeypatch.setattr(turns, "TURN_BYTES", 1)
    monkeypatch.setattr(turns, "MOST_TURNS", 2)
    parts = getattr(models, name)(spark, folder)
    assert "Exchange" not in parts._jdf.queryExecution().executedPlan().toString()
    assert parts.dtypes == whole.dtypes and texts(parts) == texts(whole) != []


def test_a_pipeline_in_turns_builds_the_same_tables(spark, tmp_path):
    built = ["fct_cloud_usage_daily", "agg_customer_daily_spend"]
    names = {"raw_cloud_usage", "stg_cloud_usage", "raw_customers", "dim_customers", "dim_billing_accounts"}
    landed = {"customers": fx.customers(spark), "cloud_usage": fx.usage(spark, fx.january_lines())}
    tables = []
    for count in (1, 2):
        settings = Settings(database=f"turns_{count}", base_path=str(tmp_path / str(count)), turns=count)
        pipeline = Pipeline(spark, landed, settings)
        pipeline.build(names=names | set(built))
        tables.append({name: texts(pipeline.table(name)) for name in built})
    assert tables[0] == tables[1] and all(tables[0].values())


def test_checked_models_are_dropped(spark, folder, monkeypatch):
    """All checks run, and no stored model outlives its last reader."""
    dropped, drop = [], Warehouse.drop

    def noted(self, name):
        drop(self, name)
        dropped.append(name)
        assert not {name, f"{name}.versions"} & set(os.listdir(f"{self.base_path}/{self.database}"))

    monkeypatch.setattr(Warehouse, "drop", noted)
    monkeypatch.setattr(turns, "TURN_BYTES", 1)
    monkeypatch.setattr(turns, "MOST_TURNS", 2)
    rows = storage.dq_suite(spark, folder).collect()
    assert len(rows) == len(checks.ALL_CHECKS)
    twice = {r.model: r.failing_rows for r in rows if (r.column_name, r.check_kind) == ("usage_id", "unique")}
    assert twice["cloud_usage"] == twice["raw_cloud_usage"] == twice["stg_cloud_usage"] == 9
    stored = [m.name for m in registry.MODELS if m.kind != "view"]
    assert sorted(dropped) == sorted(stored)
    assert dropped.index("raw_cloud_usage") < dropped.index("fct_cloud_usage_daily")
