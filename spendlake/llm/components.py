"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import ship, stored

#: Links that one task contracts at once.
TASK_LINKS = 1 << 20


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = links.select("a", "b").union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.union(own).where("a <> b")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the task's nodes to the smallest node they are connected with inside it."""
    parent: dict[int, int] = {}

    def top(node: int) -> int:
        root = node
        while (above := parent.get(root, root)) != root:
            root = above
        while node != root:
            parent[node], node = root, parent.get(node, node)
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = top(a), top(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    roots = np.array([top(n) for n in nodes], dtype=np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots)], names=["a", "b"])


def _contracted(links: DataFrame, tasks: int) -> DataFrame:
    """The same components by as many links or fewer, contracted in so many tasks."""
    ship(links.sparkSession)
    return stored(links.coalesce(tasks).mapInArrow(_forest, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for nodes that are no root.

    ``links`` has ``a`` and ``b``, in either direction.  Links are first contracted inside tasks of
    at most ``TASK_LINKS``, by union-find and without a shuffle; where one task holds all, that is
    the result.  Else large and small stars alternate, with contractions between, until one holds
    all or nothing changes; each step shuffles the links once or twice and keeps at most as many,
    and the smallest neighbour is an aggregate joined back, so no node's links meet in one task
    unless they fit.
    """
    links = stored(links.where("a <> b").select("a", "b"))
    tasks = ceil(links.count() / TASK_LINKS)
    before = None
    while tasks > 1:
        links = stored(_small_star(_large_star(_contracted(links, tasks)).distinct()).distinct())
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, tasks = now, ceil(now[0] / TASK_LINKS)
    return _contracted(links, 1).select(F.col("a").alias("node"), F.col("b").alias("root"))
