"""Mixing sources to target weights: fixed-length blocks, drawn per output shard.

The documents of a source, in the order of a seeded hash, are one run of words, cut into blocks of
``block_words``.  A source's target in words becomes a number of block draws.  Output shards of
``shard_blocks`` slots draw how many blocks they take of each source; the draws of a source are
numbered through all shards, and draw ``d`` takes the block a keyed permutation of the source's
block numbers gives for ``d``: one permutation for each pass over the source, so no block is
taken a third time before all were taken twice.  Slots and blocks meet in a join on the block.

The counts of the shards are multinomial given the sources' totals (a multivariate hypergeometric
draw), so targets are met to half a block.  They come from halving the range of shards: the draws
of one half are a draw from those of the whole, with a seed named by the half, so each task finds
the counts of its own shards and the driver keeps none.

A source's row in the driver is its name and two sums; more than ``MOST_SOURCES`` is an error.
Null texts have no words, a null source is a source and sorts last; documents without words take
no part.  Rows that repeat an id are documents of their own as long as they differ in source or
size; equal ones share what is taken, each up to twice its size.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from spendlake.llm.common import BLANKS, WORD, bucket_digits, let, ship, stored

BLOCK_WORDS = 128
SHARD_BLOCKS = 1024
WEIGHTS = (3.0, 1.0, 2.0)
#: The mix has this many times the words of the input.
SHARE = 1.5
#: No target exceeds this many times its source.
MOST_PASSES = 2
MOST_SOURCES = 100_000
#: numpy draws hypergeometric counts from fewer than 10**9 blocks; beyond, the normal limit.
EXACT_DRAWS = 10**9


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """``share`` of all words by weight, at most ``most`` times a size; excess is shared again."""
    result, left = [0.0] * len(sizes), share * sum(sizes)
    open_ = [i for i, size in enumerate(sizes) if size]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        for i in full or open_:
            result[i] = most * sizes[i] if full else unit * weights[i]
        if not full:
            break
        left -= sum(result[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return result


def _draw(rng: np.random.Generator, counts: np.ndarray, taken: int) -> np.ndarray:
    """How many of ``taken`` blocks, drawn without replacement, are of each source."""
    total = int(counts.sum())
    if total < EXACT_DRAWS:
        return rng.multivariate_hypergeometric(counts, taken, method="marginals")
    part = taken / total
    draw = rng.normal(counts * part, np.sqrt(counts * part * (1 - part)))
    draw = np.clip(np.rint(draw), 0, counts).astype(np.int64)
    while (over := int(draw.sum()) - taken) != 0:
        room = draw if over > 0 else counts - draw
        i = int(np.argmax(room))
        draw[i] -= np.clip(over, -int(room[i]), int(room[i]))
    return draw


def shard_counts(totals: list[int], shard: int, shard_blocks: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source in one shard, and in all shards before it."""
    counts = np.array(totals, dtype=np.int64)
    before = np.zeros_like(counts)
    low, high = 0, -(-int(counts.sum()) // shard_blocks)
    while high - low > 1:
        middle = (low + high) // 2
        name = f"{seed}|{low}|{middle}|{high}"
        rng = np.random.default_rng(xxhash.xxh3_64_intdigest(name))
        left = _draw(rng, counts, (middle - low) * shard_blocks)
        if shard < middle:
            high, counts = middle, left
        else:
            low, before, counts = middle, before + left, counts - left
    return counts, before


def permuted(numbers: np.ndarray, n: int, key: str) -> np.ndarray:
    """Images of numbers below ``n`` under a keyed permutation of 0 to n - 1.

    Four rounds that mix one half of the bits into the other; a value that lands outside goes
    round again.
    """
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << bits) - 1)
    keys = [np.uint64(xxhash.xxh3_64_intdigest(f"{key}|{r}") | 1) for r in range(4)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(bits), x & low
        for k in keys:
            mixed = (right + k) * k
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(29))) * k >> np.uint64(64 - bits))
        return left << np.uint64(bits) | right

    images = once(numbers.astype(np.uint64))
    while len(outside := np.flatnonzero(images >= np.uint64(n))):
        images[outside] = once(images[outside])
    return images.astype(np.int64)


def _sources(sized: DataFrame, weights: tuple[float, ...], share: float, most: float, block_words: int) -> pd.DataFrame:
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in rows]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share, most)
    blocks = [-(-s // block_words) for s in sizes]
    draws = [round(b * t / s) if s else 0 for b, t, s in zip(blocks, wanted, sizes)]
    return pd.DataFrame(
        {
            "source": [r["source"] for r in rows],
            "number": range(len(rows)),
            "source_size": sizes,
            "target": wanted,
            "blocks": blocks,
            "draws": draws,
        }
    )


_SOURCES = StructType(
    [
        StructField("source", StringType()),
        StructField("number", IntegerType()),
        StructField("source_size", LongType()),
        StructField("target", DoubleType()),
        StructField("blocks", LongType()),
        StructField("draws", LongType()),
    ]
)


def _slots(sources: pd.DataFrame, sized: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """A row per slot of every shard: shard, slot, number, pass, block."""
    spark = sized.sparkSession
    totals, blocks = sources["draws"].tolist(), sources["blocks"].tolist()

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"].tolist():
                counts, before = shard_counts(totals, shard, shard_blocks, seed)
                parts = []
                for number in np.flatnonzero(counts):
                    n = blocks[number]
                    draw = before[number] + np.arange(counts[number])
                    for turn in np.unique(draw // n):
                        inside = draw[draw // n == turn] % n
                        block = permuted(inside, n, f"{seed}|{number}|{turn}")
                        parts.append(pd.DataFrame({"number": number, "turn": turn, "block": block}))
                rows = pd.concat(parts, ignore_index=True)
                rng = np.random.default_rng(xxhash.xxh3_64_intdigest(f"{seed}|order|{shard}"))
                yield rows.assign(shard=shard, slot=rng.permutation(len(rows)))[
                    ["shard", "slot", "number", "turn", "block"]
                ]

    ship(spark)
    shards = -(-sum(totals) // shard_blocks)
    return spark.range(0, shards, 1, max(1, min(shards, shards // 8 + 1))).mapInPandas(
        fill, "shard long, slot long, number int, turn long, block long"
    )


def _offsets(rows: DataFrame) -> DataFrame:
    """Adds ``first``, the words of the source before each row, in the order of ``_hash``.

    A prefix sum over buckets of the hash and inside them, so no window holds a whole source.
    """
    bucketed = rows.withColumn("_bucket", F.substring("_hash", 1, bucket_digits(rows.count())))
    sums = bucketed.groupBy("number", "_bucket").agg(F.sum("size").alias("_sum"))
    order = Window.partitionBy("number").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "number", "_bucket", F.coalesce(F.sum("_sum").over(order), F.lit(0)).alias("_before")
    )
    inside = (
        Window.partitionBy("number", "_bucket")
        .orderBy("_hash", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        bucketed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(before, ["number", "_bucket"])
        .withColumn("first", F.col("_before") + F.col("_in"))
        .drop("_bucket", "_before", "_in")
    )


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


class Mixture:
    """The mix of a table with ``doc_id``, ``source`` and ``text``; other columns are not read."""

    def __init__(
        self,
        documents: DataFrame,
        weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE,
        most: float = MOST_PASSES,
        block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS,
        seed: int = 1,
        row_key: Column | None = None,
    ) -> None:
        spark, self.block_words = documents.sparkSession, block_words
        more = [] if row_key is None else [row_key.alias("row_key")]
        sized = stored(
            documents.select(
                F.col("doc_id").cast("long").alias("doc_id"),
                "source",
                n_words(F.col("text")).alias("size"),
                *more,
            )
        )
        more = ["row_key"] * len(more)
        table = _sources(sized, weights, share, most, block_words)
        #: source, its number, source_size, target, blocks, draws.
        self.sources = spark.createDataFrame(list(table.itertuples(index=False, name=None)), _SOURCES)
        sources = F.broadcast(self.sources.withColumnRenamed("source", "_source"))
        key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        #: doc_id, size, number, source_size, target of every document.
        self.documents = sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        run = _offsets(
            self.documents.where("size > 0").select("doc_id", "number", "size", F.md5(key).alias("_hash"), *more)
        )
        last = F.expr(f"(first + size - 1) div {block_words}")
        block = run.withColumn("block", F.explode(F.sequence(F.expr(f"first div {block_words}"), last)))
        #: Documents cut at block bounds: number, block, doc_id, size, the words [start, end) of the document and,
        #: if rows have keys, the row's key and place in its source.
        self.pieces = block.select(
            "number",
            "block",
            "doc_id",
            "size",
            F.greatest(F.col("block") * block_words - F.col("first"), F.lit(0)).alias("start"),
            F.least((F.col("block") + 1) * block_words - F.col("first"), F.col("size")).alias("end"),
            *[name for key in more for name in (key, "first")],
        )
        #: shard, slot, number, turn, block.
        self.slots = _slots(table, sized, shard_blocks, seed)

    def mixed(self) -> DataFrame:
        """The pieces of documents in each slot: shard, slot, doc_id, size, start, end, turn."""
        # Spark takes the slots for as small as the list of shards and would broadcast them.
        return self.slots.hint("merge").join(self.pieces, ["number", "block"])

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken (words the mix takes)."""
        words = (
            self.slots.groupBy("number", "block")
            .agg(F.count("*").alias("_times"))
            .hint("merge")
            .join(self.pieces, ["number", "block"])
            .groupBy("number", "doc_id", "size")
            .agg(F.sum(F.col("_times") * (F.col("end") - F.col("start"))).alias("_taken"))
        )
        rows = self.documents.groupBy("number", "doc_id", "size", "source_size", "target").agg(
            F.count("*").alias("_rows")
        )
        joined = rows.join(
            words.withColumnsRenamed({"doc_id": "_id", "size": "_size", "number": "_number"}).hint("merge"),
            (F.col("number") == F.col("_number"))
            & F.col("doc_id").eqNullSafe(F.col("_id"))
            & (F.col("size") == F.col("_size")),
            "left",
        )
        # Rows that are equal in id, source and size share their words evenly, first rows first.
        share = F.expr("(coalesce(_taken, 0) + _rows - 1 - _row) div _rows")
        return joined.withColumn("_row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1))).select(
            "doc_id", "size", "source_size", "target", share.alias("taken")
        )


def mixed_documents(documents: DataFrame, **settings: object) -> DataFrame:
    """The documents as the mix takes them: a row per document and pass over its source.

    A text that a pass takes whole is unchanged; of others the words of the blocks taken remain,
    joined by spaces.  Documents of which nothing is taken go.  ``n_chars`` follows the text.
    Rows with equal or null ids are told apart by source and text; of rows equal in all three each
    has its own share, with the further columns of one of them.  Names that begin with two
    underscores are kept for the inside.
    """
    fields = [F.col("doc_id").cast("string"), F.col("source").cast("string"), F.col("text")]
    # Null and any text are told apart by what precedes them.
    marked = [F.coalesce(F.concat(F.lit("+"), field), F.lit("-")) for field in fields]
    key = F.unhex(F.md5(F.concat_ws("\x00", *marked)))
    ranges = (
        Mixture(documents, row_key=key, **settings)
        .mixed()
        .groupBy("number", "first", "size", "turn", "row_key")
        .agg(
            F.sum(F.col("end") - F.col("start")).alias("__taken"),
            F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__ranges"),
        )
        .select(F.col("row_key").alias("__key"), F.col("size").alias("__size"), "__taken", "__ranges")
    )
    # Equal rows have a place each in the ranges, and one of them stands for all.
    rows = documents.withColumn("__key", key).dropDuplicates(["__key"])
    joined = rows.join(ranges.hint("merge"), "__key")
    words = F.array_remove(F.split("text", BLANKS), "")
    part = let(
        words,
        lambda w: F.array_join(
            F.transform(
                "__ranges",
                lambda r: F.array_join(
                    F.slice(w, (r["start"] + 1).cast("int"), (r["end"] - r["start"]).cast("int")), " "
                ),
            ),
            " ",
        ),
    )
    text = F.when(F.col("__taken") >= F.col("__size"), F.col("text")).otherwise(part)
    joined = joined.withColumn("text", text)
    if "n_chars" in documents.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return joined.select(*[f"`{c}`" for c in documents.columns])
