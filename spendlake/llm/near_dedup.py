"""Near-duplicate documents by an inverted join on MinHash signature coordinates.

A document is its set of distinct five-word shingles (64-bit hashes; fewer words are one shingle).
Documents with equal sets form a class, and one signature of ``COORDINATES`` minima stands for it.
Classes are posted under (coordinate, value) pairs.  Two sets of the wanted similarity agree in at
least ``least_matches`` coordinates (six standard deviations below the mean: a link is missed with
a chance of 1.4e-8 at exactly 85 %, 9.2e-9 at 80 %), so they meet in the first ``COORDINATES - least_matches + 1``
postings of both in any common order.  The order is rarest first, by counts of all postings, and
the common pairs of boilerplate are skipped.

Collisions are counted without listing all pairs of a posting list.  First each list pairs its
members with its smallest one only; pairs that agree in enough coordinates are confirmed on the
full sets.  Lists whose members then lie in one component are done.  Of the others, short lists
pair their members of different components; the members of long lists are compared block by block
in numpy, and only confirmed links leave the task.  Every candidate pair is thus either confirmed,
refuted, or already connected.

Words are split at ASCII white space and A-Z is lower-cased.  Null, empty and blank texts have
empty sets and no links.  Equal rows are in one class.  A null id links like any other; the id of
a component is the smallest that is not null.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm.common import WordHashes, map_arrow, maybe_among, mixed, release, ship, stored, utf8
from spendlake.llm.components import components

SHINGLE_WORDS = 5
COORDINATES = 128
#: Buckets of the table of posting counts, which is broadcast.
COUNT_BITS = 18
#: Lists up to this length list their remaining pairs, longer ones are compared in blocks.
SHORT_LIST = 64
BLOCK = 256

_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 2**64, COORDINATES, dtype=np.uint64)
_TIMES = _rng.integers(0, 2**64, COORDINATES, dtype=np.uint64) | np.uint64(1)


_HASHES = WordHashes()


def shingles(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashed = _HASHES.of(words)
    width = min(width, len(words))
    n = len(words) - width + 1
    result = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        result = result * _ODD + hashed[i : n + i]
    return np.unique(mixed(result))


def signature(values: np.ndarray) -> np.ndarray:
    """The smallest hash of the set under each of ``COORDINATES`` hash functions."""
    least = np.full(COORDINATES, 2**32 - 1, dtype=np.uint64)
    for start in range(0, len(values), 512):
        hashed = ((values[start : start + 512, None] ^ _XOR) * _TIMES) >> np.uint64(32)
        least = np.minimum(least, hashed.min(axis=0))
    return least.astype("<u4")


def least_matches(percent: int) -> int:
    """Coordinates in which sets of the similarity agree, but for six standard deviations."""
    p = percent / 100
    return max(1, floor(COORDINATES * p - 6 * sqrt(COORDINATES * p * (1 - p))))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingles(t) for t in utf8(batch.column("text"))]
    prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            batch.column("text_key"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([p and int.from_bytes(p[:8], "little", signed=True) for p in prints], pa.int64()),
            pa.array(prints, pa.binary()),
            pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
        ],
        names=["doc_id", "text_key", "n_shingles", "node", "print", "signature"],
    )


def _keys(signatures: pa.Array) -> np.ndarray:
    """Hashes of the (coordinate, value) pairs, a row per class."""
    values = np.frombuffer(b"".join(signatures.to_pylist()), dtype="<u4").reshape(-1, COORDINATES)
    return mixed(values.astype(np.uint64) + (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)))


def _bucket(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    for batch in batches:
        if batch.num_rows:
            total += np.bincount(_bucket(_keys(batch.column("signature"))).ravel(), minlength=len(total))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"]
    )


def postings(classes: DataFrame, matches: int) -> DataFrame:
    """``key, node``: each class under the rarest of its pairs, as many as a link must share one of."""
    ship(classes.sparkSession)
    counted = classes.select("signature").mapInArrow(_count, "bucket int, n long")
    # As Arrow: two columns of numbers, where rows of Python objects took 100 MB of the driver.
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    table[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    counts, wanted = classes.sparkSession.sparkContext.broadcast(table), COORDINATES - matches + 1

    def post(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = _keys(batch.column("signature"))
        order = np.lexsort((keys, counts.value[_bucket(keys)]), axis=1)[:, :wanted]
        first = np.take_along_axis(keys, order, axis=1).view(np.int64)
        nodes = batch.column("node").to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays(
            [pa.array(first.ravel()), pa.array(np.repeat(nodes, wanted))], names=["key", "node"]
        )

    return map_arrow(classes.select("node", "signature"), post, "key long, node long")


def _agreeing(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """The pairs whose signatures agree in enough coordinates."""
    side = classes.select("node", "signature")
    both = pairs.join(side.toDF("a", "_left").hint("merge"), "a").join(side.toDF("b", "_right").hint("merge"), "b")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = (_rows(batch.column("_left")) == _rows(batch.column("_right"))).sum(axis=1)
        return batch.select(["a", "b"]).filter(pa.array(same >= matches))

    return map_arrow(both.select("a", "b", "_left", "_right"), keep, "a long, b long")


def _rows(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), dtype="<u4").reshape(-1, COORDINATES)


def _sets(documents: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, items``: the full shingle sets of some classes, from one document of each."""
    # Stored, as it is read twice: once for the texts to shuffle, once to meet them.
    wanted = stored(classes.select("doc_id", "node").join(nodes, "node", "left_semi"))
    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), "text")
    # Only the texts wanted are shuffled, and few others.
    texts = maybe_among(texts, F.col("_id"), wanted, F.col("doc_id"))
    rows = texts.join(wanted.hint("merge"), texts["_id"].eqNullSafe(wanted["doc_id"])).select("node", "text")

    def fill(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t) for t in utf8(batch.column("text"))]
        nodes = [
            int.from_bytes(xxhash.xxh3_128_digest(s.tobytes())[:8], "little", signed=True) for s in found
        ]
        own = [n == m for n, m in zip(nodes, batch.column("node").to_pylist())]
        items = pa.array([s.tobytes() for s in found], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("node"), items], names=["node", "items"]).filter(
            pa.array(own)
        )

    # A repeated id may come with another text: only the class's own set is kept, once.
    return map_arrow(rows, fill, "node long, items binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, documents: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough on their full sets, stored."""
    pairs = stored(pairs)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = stored(_sets(documents, classes, nodes))
    both = pairs.join(sets.toDF("a", "_left").hint("merge"), "a").join(sets.toDF("b", "_right").hint("merge"), "b")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (batch.column(c).to_pylist() for c in ("_left", "_right"))
        own = [alike(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in zip(left, right)]
        return batch.select(["a", "b"]).filter(pa.array(own))

    links = stored(map_arrow(both.select("a", "b", "_left", "_right"), keep, "a long, b long"))
    release(pairs, sets)
    return links


def _long_list_links(
    posted: DataFrame, documents: DataFrame, classes: DataFrame, percent: int, matches: int
) -> DataFrame:
    """Links among the members of long lists, stored; ``posted`` as ``key, node, root``.

    Lists that share a member are compared as one family, so no pair is compared once a list.
    A family is cut into blocks; a task holds two blocks.
    """
    members = stored(posted.groupBy("key").agg(F.min("node").alias("b")).join(posted, "key"))
    star = members.select(F.col("node").alias("a"), "b")
    found = components(star)
    nodes = members.groupBy("node").agg(F.min("root").alias("root"))
    family = stored(
        nodes.join(found.withColumnRenamed("root", "_family"), "node", "left").select(
            "node", "root", F.coalesce("_family", "node").alias("family")
        )
    )
    sizes = family.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks"))
    placed = family.join(sizes, "family").withColumn("_block", F.pmod(F.xxhash64("node"), "_blocks"))
    sets = stored(_sets(documents, classes, family))
    # Each block meets itself and every other one, in the task of the pair of blocks.
    meets = placed.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    rows = (
        meets.withColumn("_low", F.least("_block", "_other"))
        .withColumn("_high", F.greatest("_block", "_other"))
        .join(sets.hint("merge"), "node")
        .join(classes.select("node", "signature"), "node")
        .select("family", "_low", "_high", "_block", "node", "root", "signature", "items")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        ids, roots = group["node"].to_numpy(), group["root"].to_numpy()
        blocks, single = group["_block"].to_numpy(), group["_low"].iat[0] == group["_high"].iat[0]
        rows = np.frombuffer(b"".join(group["signature"]), "<u4").reshape(-1, COORDINATES)
        sets = [np.frombuffer(s, "<u8") for s in group["items"]]
        parent = {r: r for r in roots}

        def top(r: int) -> int:
            while parent[r] != r:
                parent[r] = r = parent[parent[r]]
            return r

        links = []
        for i in range(len(ids) - 1):
            other = roots[i + 1 :] != roots[i]
            if not single:
                other &= blocks[i + 1 :] != blocks[i]
            rest = i + 1 + np.flatnonzero(other)
            near = rest[(rows[rest] == rows[i]).sum(axis=1) >= matches]
            for j in near.tolist():
                if top(roots[i]) != top(roots[j]) and alike(sets[i], sets[j], percent):
                    parent[top(roots[j])] = top(roots[i])
                    links.append((ids[i], ids[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    links = stored(rows.groupBy("family", "_low", "_high").applyInPandas(compare, "a long, b long"))
    release(members, family, sets)
    return links


def near_links(documents: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of the classes that are linked to a smaller one, directly or not."""
    matches = least_matches(percent)
    posted = postings(classes, matches)
    lists = posted.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    # Merged: the postings are many times the rows Spark estimates from the classes.
    met = stored(posted.join(lists.hint("merge"), "key"))
    pairs = met.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = _confirmed(_agreeing(pairs, classes, matches), documents, classes, percent)
    stars = components(links)
    rooted = met.where("n > 2").join(stars, "node", "left").select(
        "key", "n", "first", "node", F.coalesce("root", "node").alias("root")
    )
    open_lists = rooted.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
    rest = stored(rooted.join(open_lists.where("_low <> _high"), "key").drop("_low", "_high"))
    release(met)
    short = (
        rest.where(f"n <= {SHORT_LIST}")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("node", "root", "first"))).alias("m"))
        .select(F.explode("m").alias("x"), "m")
        .select("x", F.explode("m").alias("y"))
        .where("x.node < y.node AND x.root <> y.root AND x.node <> x.first")
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
    )
    # One after the other: planned as one, some twenty shuffles would begin at once, each with
    # buffers of megabytes in the driver.
    more = _confirmed(_agreeing(short, classes, matches), documents, classes, percent)
    long = _long_list_links(
        rest.where(f"n > {SHORT_LIST}").select("key", "node", "root"), documents, classes, percent, matches
    )
    release(rest)
    return components(stars.toDF("a", "b").union(more).union(long))


def _reached(documents: DataFrame, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, node, root, component_id`` of every document.

    ``text_key`` tells texts apart, ``node`` and ``root`` are the class of its set and the smallest
    one its class is connected with; both are null for texts without words.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = rows.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    sketched = stored(
        map_arrow(
            keyed,
            _sketch,
            "doc_id long, text_key string, n_shingles long, node long, print binary, signature binary",
        )
    )
    classes = stored(
        sketched.where("node IS NOT NULL")
        .groupBy("node", "print")
        .agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
    )
    # Signatures are the bulk of both tables: each goes as soon as nothing reads it.
    known = stored(sketched.select("doc_id", "text_key", "n_shingles", "node"))
    release(sketched)
    roots = near_links(rows, classes, percent)
    named = stored(
        classes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    )
    release(classes)
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    reached = named.join(least, "root").select("node", "root", "component_id").distinct()
    return known.join(reached, "node", "left").select(
        "doc_id", "text_key", "n_shingles", "node", "root", "component_id"
    )


def near_duplicates(documents: DataFrame, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 times the common shingles are at least ``percent`` times all
    shingles of both; ``component_id`` is the smallest id that can be reached, and that document
    is kept.
    """
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        _reached(documents, percent)
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def without_near_copies(documents: DataFrame, percent: int = 80) -> DataFrame:
    """The documents that stay: all without words, and one of each component.

    That is the one with the smallest id, among equal ids, or where all ids are null, the one with
    the smallest digest of its text; rows that repeat both stay with it.  Names that begin with two
    underscores are kept for the inside.
    """
    found = stored(_reached(documents, percent))
    # Nulls come last: an id that is there is smaller.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = found.where("root IS NOT NULL").groupBy("root").agg(F.min(place).alias("first"))
    alone = found.where("root IS NULL").select("doc_id", "text_key")
    stay = first.select("first.doc_id", "first.text_key").union(alone).distinct()
    key = F.md5(F.coalesce("text", F.lit("")))
    # With the digest in the key of the join, rows without an id are dealt out too.
    wanted = stay.toDF("__id", "__key").hint("merge")
    same = (key == F.col("__key")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    return documents.join(wanted, same, "left_semi").select(*[f"`{c}`" for c in documents.columns])
