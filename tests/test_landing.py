import json
import random
import uuid
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlake import Settings
from spendlake.operators.incremental import since
from spendlake.plans import raw
from spendlake.sinks.tables import Warehouse
from spendlake.sources import json_arrays, landing
from spendlake.sources.daily_landing import land_days
from spendlake.sources.schemas import CLOUD_USAGE, CUSTOMERS, PRODUCTS
from tests import fixtures as fx

PRODUCT = {
    "product_id": "p1", "product_name": "One", "product_family": "F", "description": "d",
    "launch_date": "2020-01-02", "is_active": True, "supported_providers": ["GCP"],
    "features": [], "pricing": {"model": "flat", "currency": "USD", "base_fee_usd": 1, "tiers": [
        {"tier_name": "T", "min_monthly_spend_usd": 0, "max_monthly_spend_usd": None,
         "rate_pct": 2.5, "included_support": "mail"}]},
}


def land(spark, tmp_path, text, schema=PRODUCTS, layout="array"):
    source = tmp_path / "export.json"
    source.write_text(text)
    return landing.land(spark, str(source), str(tmp_path / "landed"), schema, layout)


def test_pretty_printed_array(spark, tmp_path):
    assert land(spark, tmp_path, "\n" + json.dumps([PRODUCT, {**PRODUCT, "product_id": "p2"}], indent=2)) == 2
    row = spark.read.parquet(str(tmp_path / "landed")).orderBy("product_id").first()
    assert str(row.launch_date) == "2020-01-02" and row.pricing.tiers[0].rate_pct == 2.5


def test_second_load_replaces_the_first(spark, tmp_path):
    land(spark, tmp_path, json.dumps([PRODUCT] * 3))
    assert land(spark, tmp_path, json.dumps(PRODUCT), layout="ndjson") == 1


def test_object_is_not_an_array(spark, tmp_path):
    with pytest.raises(landing.LandingError, match="not a JSON array"):
        land(spark, tmp_path, json.dumps(PRODUCT, indent=2))


@pytest.mark.parametrize("layout", ["array", "ndjson"])
def test_unknown_field_at_any_depth(spark, tmp_path, layout):
    pricing = {**PRODUCT["pricing"], "surprise": 1}
    record = {**PRODUCT, "pricing": pricing}
    text = json.dumps([record]) if layout == "array" else json.dumps(record)
    with pytest.raises(landing.LandingError, match="pricing.surprise"):
        land(spark, tmp_path, text, layout=layout)


def test_malformed_record(spark, tmp_path):
    with pytest.raises((PySparkException, landing.LandingError)):
        land(spark, tmp_path, '{"product_id": "p1"}\n{"product_id": ', layout="ndjson")


def test_absent_file_is_skipped(spark, tmp_path):
    missing, target = str(tmp_path / "none.json"), str(tmp_path / "landed")
    assert landing.land(spark, missing, target, CUSTOMERS) is None
    assert not (tmp_path / "landed").exists()


def test_empty_array(spark, tmp_path):
    assert land(spark, tmp_path, "[]") == 0


@pytest.fixture
def small_splits(spark):
    option = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(option)
    yield lambda size: spark.conf.set(option, size)
    spark.conf.set(option, before)


NASTY = ["}", "{", "]", "[", '"', "\\", "\\\"", "},{", "\n", "\r\n", "é", "\u2028", "", "a", " ", "}]", '"}', "x" * 300]
ITEMS = "id long, text string, parts array<struct<name:string,more:struct<deep:string>>>"


def nasty_records(seed, n):
    draw = random.Random(seed)
    text = lambda: "".join(draw.choice(NASTY) for _ in range(draw.randrange(6)))
    return [
        {"id": i, "text": text(), "parts": [{"name": text(), "more": {"deep": text()}} for _ in range(draw.randrange(4))]}
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, indent, size", [(1, None, 150), (2, 2, 297), (3, None, 1 << 20)])
def test_array_is_cut_into_its_elements_at_any_split(spark, tmp_path, small_splits, seed, indent, size):
    records = nasty_records(seed, 14)
    folder = tmp_path / "in"
    folder.mkdir()
    for name, some in (("a", records[:9]), ("b", records[9:10]), ("c", []), ("d", records[10:])):
        text = json.dumps(some, indent=indent, ensure_ascii=seed % 2 == 0)
        (folder / f"{name}.json").write_text(text + "\n", newline="")
    small_splits(size)
    rows = landing.read_split_array(spark, str(folder), ITEMS).orderBy("id").collect()
    assert [r.asDict(recursive=True) for r in rows] == records


def test_one_array_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "x.json").write_text(json.dumps(nasty_records(7, 400)))
    small_splits(20_000)
    pieces = json_arrays._pieces(spark, str(tmp_path / "x.json"))
    assert pieces.select(F.spark_partition_id()).distinct().count() > 3
    assert landing.read_split_array(spark, str(tmp_path / "x.json"), ITEMS).count() == 400


@pytest.mark.parametrize("text", [
    '[{"id": 1}', '[{"id": 1}, {"id": 2', '[{"id": 1}, {"id": "2}]', '[{"id": 1} {"id": 2}]', '[{"id": 1}, 5, {"id": 2}]',
    '[{"id": 1}] x', '[{"id": 1}], {"id": 2}', '[{"id": 1}, ]', '[[{"id": 1}]]', '[1]', '[{"id": }]', '[{"id": 1}}]',
])
def test_broken_array_is_an_error(spark, tmp_path, small_splits, text):
    (tmp_path / "x.json").write_text(text)
    small_splits(6)
    with pytest.raises((PySparkException, landing.LandingError)):
        landing.read_split_array(spark, str(tmp_path / "x.json"), ITEMS).collect()


def test_inferred_fields_are_those_of_the_schema(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({**PRODUCT, "features": [
        {"feature_code": "f", "feature_name": "F", "availability": "GA", "min_tier": "T"}]}))
    found = landing.field_paths(landing.infer_schema(spark, str(tmp_path / "x.json")))
    assert found == landing.field_paths(StructType.fromDDL(PRODUCTS))
    assert "pricing.tiers.rate_pct" in found


def test_days_landed_anew_replace_their_own_only(spark, tmp_path):
    """A refresh of the raw table then lists the partitions of its window and no other."""
    settings = Settings(database=f"l_{uuid.uuid4().hex}", base_path=str(tmp_path / "lake"))
    warehouse = Warehouse(spark, settings)
    source = tmp_path / "usage.ndjson"

    def write(first, n, cost):
        days = [first + timedelta(days=i) for i in range(n)]
        rows = fx.usage(spark, [fx.line(f"{d}-{i}", d, cost=(cost, 0.0, cost, "USD")) for d in days for i in range(2)])
        source.write_text("\n".join(r.value for r in rows.select(F.to_json(F.struct("*")).alias("value")).collect()))
        return land_days(warehouse, "cloud_usage", str(source), CLOUD_USAGE, layout="ndjson"), days

    assert land_days(warehouse, "cloud_usage", str(tmp_path / "none"), CLOUD_USAGE) is None
    for first, n, cost in ((date(2024, 1, 1), 8, 1.0), (date(2024, 1, 6), 4, 5.0)):
        landed, days = write(first, n, cost)
        assert landed == days
    table = warehouse.read("cloud_usage")
    sums = table.groupBy("usage_date").agg(F.sum("cost.list_cost_usd").alias("cost")).collect()
    costs = {r.usage_date: r.cost for r in sums}
    assert costs == {date(2024, 1, d): 2.0 if d < 6 else 10.0 for d in range(1, 10)}
    refreshed = raw.raw_cloud_usage(since(table, "usage_date", date(2024, 1, 6)))
    assert {f.split("usage_date=")[1][:10] for f in refreshed.inputFiles()} == {f"2024-01-0{d}" for d in range(6, 10)}
    flat = StructType.fromDDL(CLOUD_USAGE)
    assert sorted(table.columns) == sorted(flat.names) and refreshed.count() == 8


def test_large_array_files_are_split_without_being_asked(spark, tmp_path, monkeypatch):
    """Files above the size one task may read go another way, small ones beside them do not."""
    (tmp_path / "in").mkdir()
    large = [{"a": n, "s": "x}" * 20} for n in range(500)]
    (tmp_path / "in" / "large.json").write_text(json.dumps(large))
    (tmp_path / "in" / "small.json").write_text(json.dumps([{"a": -1, "s": None}]))
    monkeypatch.setattr(landing, "WHOLE_FILE_BYTES", 2000)
    seen = []
    split = landing.read_split_array
    monkeypatch.setattr(
        landing, "read_split_array", lambda spark, path, *more: seen.append(path) or split(spark, path, *more)
    )
    rows = landing.read_json_array(spark, str(tmp_path / "in"), "a long, s string").collect()
    assert sorted(r.a for r in rows) == [-1, *range(500)]
    (files,) = seen
    assert [f.rsplit("/", 1)[1] for f in files] == ["large.json"]


def test_inferred_schema_reads_a_compressed_export(spark, small_folder, tmp_path, monkeypatch):
    """The text of all lines, many times the size of their tables, is never written plainly."""
    from verification import storage

    monkeypatch.setattr(storage, "shared_folder", lambda spark: str(tmp_path / "scratch"))
    rows = storage.infer_nested_schema(spark, small_folder).count()
    files = [f.name for f in (tmp_path / "scratch" / "export").glob("part-*")]
    assert rows > 0 and files and all(f.endswith(".json.gz") for f in files)
