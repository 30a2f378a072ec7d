"""Shards that all match the mixture of sources, by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; sorted by fractional rank
``(rank - 1/2) / size of the source``, the sources interleave evenly, and cutting that order into
equal runs gives shards whose row counts differ by one at most (law ``rows``).

No window holds more than a bucket of the hash or of the fractional rank: positions are a prefix
sum over bucket counts plus a row number inside the bucket, so a source with a third of all rows
costs no more than the others.  Rows are ranked one by one: equal texts may lie in several shards.

Null ids, sources and texts are ordinary values (a null source is a source of its own); rows equal
in every respect are told apart in arbitrary order, which cannot be seen in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import bucket_digits, stored


def seeded_order(seed: str, doc_id: Column) -> Column:
    """A hash of the seed and the id, as hex text that sorts in shuffled order."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _before(rows: DataFrame, keys: list[str], bucket: str, total: str) -> DataFrame:
    """For every key and bucket: the rows in earlier buckets, and all rows, of that key."""
    counts = rows.groupBy(*keys, bucket).agg(F.count("*").alias("_n"))
    own = Window.partitionBy(*keys) if keys else Window.partitionBy()
    earlier = own.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keys,
        bucket,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(own).alias(total),
    )


def _numbered(
    rows: DataFrame, keys: list[str], bucket: str, order: list[str], name: str, total: str
) -> DataFrame:
    """Adds the place of each row among those of its keys, from 0, and how many there are."""
    before = _before(rows, keys, bucket, total).withColumnsRenamed({k: f"_r{k}" for k in [*keys, bucket]})
    same = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in [*keys, bucket]]
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (
        rows.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(before, same)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside", *(f"_r{k}" for k in [*keys, bucket]))
    )


def stratified_shards(
    rows: DataFrame, shards: int = 16, seed: str = "1", rows_in_all: int | None = None
) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``rows`` has ``doc_id`` and ``source``; other columns stay, but for names that begin with an
    underscore.  Columns named ``shard`` or ``slot`` are replaced.
    """
    rows = rows.drop("shard", "slot")
    others = [c for c in rows.columns if c not in ("doc_id", "source")]
    count = rows.count() if rows_in_all is None else rows_in_all
    digits = bucket_digits(count)
    buckets = 16**digits
    hashed = rows.withColumn("_hash", seeded_order(seed, F.col("doc_id"))).withColumn(
        "_bucket", F.substring("_hash", 1, digits)
    )
    ranked = stored(
        _numbered(hashed, ["source"], "_bucket", ["_hash", *others], "_rank", "_size")
        .withColumn("_part", (2 * F.col("_rank") + 1) / (2 * F.col("_size")))
        .withColumn("_bucket", F.floor(F.col("_part") * buckets))
    )
    placed = _numbered(
        ranked, [], "_bucket", ["_part", "_hash", "source", *others], "_place", "_all"
    )
    return (
        placed.withColumn("shard", F.expr(f"_place * {shards} div _all").cast("int"))
        .withColumn("slot", F.expr(f"_place - (shard * _all + {shards} - 1) div {shards}"))
        .select(*rows.columns, "shard", "slot")
    )
