"""Exact deduplication by content-defined chunk recipes.

A text is cut where a hash of its last eight bytes ends in zeros, so equal texts are cut alike.
A document becomes its recipe: the ordered 64-bit fingerprints of its chunks.  Only documents that
share a recipe and a length can be equal; only their chunks move, each distinct chunk once per
task, and chunks of equal fingerprint are compared byte by byte and numbered.  Documents are equal
when their recipes of (fingerprint, number) are.

Null text counts as empty and equals it.  Of equal texts the row with the largest ``doc_id`` stays;
rows that repeat an id with its text are one document and share the verdict; a null id stays only
where all ids of the group are null.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, stored, utf8

#: Low bits that are zero at a cut: chunks of 1024 bytes on average.
CUT_BITS = 10
_ODD = np.uint64(0x9E3779B97F4A7C15)


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks of one text, the last one its length; none if it is empty."""
    n = len(data)
    if n <= 8:
        return np.array([n] if n else [], dtype=np.int64)
    ends = []
    for shift in range(8):
        eights = np.frombuffer(data, dtype="<u8", count=(n - shift) // 8, offset=shift)
        hit = np.flatnonzero((eights * _ODD) >> np.uint64(64 - CUT_BITS) == 0)
        ends.append(hit * 8 + shift + 8)
    ends = np.sort(np.concatenate(ends))
    return ends if len(ends) and ends[-1] == n else np.append(ends, n)


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _recipes(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = utf8(batch.column("text"))
    recipes = [[_signed(xxhash.xxh3_64_intdigest(c)) for c in chunks(t)] for t in texts]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            pa.array(recipes, pa.list_(pa.int64())),
        ],
        names=["doc_id", "n_bytes", "text_sha256", "recipe"],
    )


def _chunk_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys, parts, places, owners = [], [], [], []
    for owner, text in zip(batch.column("owner").to_pylist(), utf8(batch.column("text"))):
        for place, chunk in enumerate(chunks(text)):
            keys.append(_signed(xxhash.xxh3_64_intdigest(chunk)))
            parts.append(chunk)
            places.append(place)
            owners.append(owner)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(owners, pa.int64()),
            pa.array(places, pa.int32()),
            pa.array(keys, pa.int64()),
            pa.array(parts, pa.binary()),
        ],
        names=["owner", "place", "print", "chunk"],
    )


def verified_recipes(documents: DataFrame, recipes: DataFrame) -> DataFrame:
    """For documents that share a recipe: the recipe with a number for every chunk.

    The number tells chunks of equal fingerprint and different bytes apart.  Such a collision is
    looked for in every distinct chunk; where there is none all numbers are 1.
    """
    shared = (
        recipes.groupBy("n_bytes", "recipe")
        .agg(F.count("*").alias("_copies"))
        .where("_copies > 1")
        .drop("_copies")
    )
    candidates = stored(
        recipes.join(shared, ["n_bytes", "recipe"], "left_semi").select("doc_id", "n_bytes", "recipe")
    )
    ids = candidates.select(F.col("doc_id").alias("owner")).distinct()
    texts = documents.select(F.col("doc_id").alias("owner"), "text")
    rows = map_arrow(
        # Merged at any size: the ids grow with the data and are never to be broadcast.
        texts.join(ids.hint("merge"), texts["owner"].eqNullSafe(ids["owner"]), "left_semi"),
        _chunk_rows,
        "owner long, place int, print long, chunk binary",
    )
    collisions = (
        rows.groupBy("print", "chunk")
        .agg(F.lit(1))
        .groupBy("print")
        .agg(F.count("*").alias("_kinds"))
        .where("_kinds > 1")
    )
    if collisions.isEmpty():
        return candidates.withColumn("numbers", F.lit(None).cast("array<int>"))
    kinds = (
        rows.join(collisions, "print", "left_semi")
        .groupBy("print")
        .agg(F.sort_array(F.collect_set("chunk")).alias("_kinds"))
    )
    numbered = (
        rows.join(kinds, "print")
        .select("owner", "place", F.array_position("_kinds", F.col("chunk")).alias("_number"))
        .groupBy("owner")
        .agg(F.sort_array(F.collect_set(F.struct("place", "_number"))).alias("_numbers"))
    )
    return candidates.join(numbered, candidates["doc_id"].eqNullSafe(numbered["owner"]), "left").select(
        "doc_id", "n_bytes", "recipe", F.col("_numbers").cast("array<struct<place:int,number:int>>")["number"].alias("numbers")
    )


def exact_groups(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    recipes = stored(
        map_arrow(
            documents, _recipes, "doc_id long, n_bytes long, text_sha256 string, recipe array<long>"
        )
    )
    key = ["n_bytes", "recipe", "numbers"]
    verified = verified_recipes(documents, recipes)
    groups = (
        verified.groupBy(*key)
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    members = verified.dropDuplicates(["doc_id", *key]).join(
        groups.withColumnsRenamed({c: f"_{c}" for c in key}),
        [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key],
    ).select(F.col("doc_id").alias("_id"), "n_bytes", "recipe", "keep_id", "group_size")
    same = (
        recipes["doc_id"].eqNullSafe(F.col("_id"))
        & (recipes["n_bytes"] == members["n_bytes"])
        & (recipes["recipe"] == members["recipe"])
    )
    return (
        recipes.join(members, same, "left")
        .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
        .select(
            "doc_id",
            "keep_id",
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """The documents with one row of each group of equal texts.

    All columns stay as they are; names that begin with two underscores are kept for the inside.
    """
    # Stored, so that the shuffles that find the groups do not begin together with the last join.
    stay = stored(
        exact_groups(documents)
        .where("kept")
        .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__print"))
        .distinct()
    )
    own = F.sha2(F.coalesce("text", F.lit("")), 256)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__print"))
    rows = documents.withColumn("__own", own).join(stay.hint("merge"), same)
    return rows.dropDuplicates(["__id", "__print"]).select(*[f"`{c}`" for c in documents.columns])
