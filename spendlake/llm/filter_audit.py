"""How filters of documents interact: every order of them, from one pass over the documents.

A set of filters already applied is a state of the subset lattice; applying one more is an edge.
What an edge removes depends on its state only, not on the order in which it was reached, so the
``2**(k-1) * k`` edges of k filters say all there is about their ``k!`` orders.  Paths are counted
forward (orders that reach a state) and backward (orders that leave it for the end); the product
of both is the number of orders through an edge.  The removals of a filter's edges, weighted by
it, add up to its Shapley value over all orders, and each order's steps are read off the edges on
its path.

Documents enter as counts for each part and set of filters they fail, at most ``2**k`` rows a
part, so nothing after the first aggregate grows with the corpus.  Copies are told by the SHA-256
of the whole text and counted before and after they meet: a text that a third of all documents
share is a few rows in every shuffle.

Null texts are empty; a null part is the empty string.  A null id is no smaller and no larger than
any other, so such a row neither makes copies nor is one; rows that repeat the smallest id of their
text are no copies of each other.  Rows that repeat are counted each; if labels repeat an id, a
mark set in one of them holds.  Labels without an id, and documents without labels, mark nothing.
Empty tables give no rows.  Texts of any length are judged whole.  Only the columns named here are
read, so further ones may have any name.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import BLANKS, let, stored

#: The filters of ``failures``, by letter: bit i of a mask is the i-th letter.
FILTERS = "ABCDE"
#: Bit of the filter that fails copies of a document with a smaller id.
_COPY = 1 << FILTERS.index("E")


class Lattice:
    """States and edges of all orders of some filters, with the orders through each edge."""

    def __init__(self, letters: str) -> None:
        full = (1 << len(letters)) - 1
        by_size = sorted(range(full + 1), key=int.bit_count)
        forward, backward = {0: 1}, {full: 1}
        inside = lambda state: [b for b in range(len(letters)) if state >> b & 1]
        for state in by_size[1:]:
            forward[state] = sum(forward[state ^ 1 << b] for b in inside(state))
        for state in by_size[-2::-1]:
            backward[state] = sum(backward[state | 1 << b] for b in inside(full ^ state))
        #: State before, and bit of the filter applied, of each edge.
        self.edges = [(state, b) for state in by_size for b in inside(full ^ state)]
        #: Orders through each edge.
        self.paths = [forward[state] * backward[state | 1 << b] for state, b in self.edges]
        #: The orders themselves, by name.
        self.orders: list[list[str]] = [[] for _ in self.edges]
        number = {edge: i for i, edge in enumerate(self.edges)}
        for order in permutations(range(len(letters))):
            state = 0
            for b in order:
                self.orders[number[state, b]].append("".join(letters[x] for x in order))
                state |= 1 << b


def failures(documents: DataFrame) -> DataFrame:
    """``doc_id, part, text_hash, mask``: the filters each text fails by itself, and what tells copies."""
    text = F.coalesce("text", F.lit(""))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))

    def mask(words: Column) -> Column:
        size = F.size(words)
        fails = [
            size < 200,
            100 * F.size(F.array_distinct(words)) < 50 * size,
            100 * capitals > 3 * F.length(text),
            text.rlike("[#$%&*|]"),
        ]
        return sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_hash"),
        let(F.array_remove(F.split(text, BLANKS), ""), mask).cast("int").alias("mask"),
    )


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with ``good`` and ``toxic``, 1 where a label of their id says so.

    Both sides of the join are tables as they lie, so Spark splits a hot id (or all null ones).
    """
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id"))
    marks = stored(
        known.agg(
            F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
            F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
        )
    )
    return (
        rows.join(marks, rows["doc_id"] == marks["_id"], "left")
        .drop("_id")
        .fillna(0, ["good", "toxic"])
    )


def counts_by_mask(rows: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part and set of failed filters, copies told."""
    kind = ["text_hash", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    groups = by_id.groupBy(*kind).agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
        F.sum("n").alias("n"),
    )
    # A window holds one text: a row for each part and pair of marks it comes with.
    least = F.min("first.doc_id").over(Window.partitionBy("text_hash"))
    firsts = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    split = groups.withColumn("_own", firsts + F.col("without_id")).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("mask", F.col("_own").alias("n")),
                F.struct(
                    F.col("mask").bitwiseOR(F.lit(_COPY)).alias("mask"), (F.col("n") - F.col("_own")).alias("n")
                ),
            )
        ).alias("x"),
    )
    return split.groupBy("part", "x.mask").agg(
        F.sum("x.n").alias("n"),
        F.sum(F.col("x.n") * F.col("good")).alias("good"),
        F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"),
    )


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``part, mask, n, good, toxic``.

    ``kept`` documents stay after the step, ``removed`` go in it, ``redundant`` fail its filter but
    are gone already, ``unique_fails`` fail no other; ``good_lost`` and ``toxic_lost`` are the
    marked ones among the removed, and ``shapley`` what the filter removes over all orders.  The
    result has ``k!`` times k rows a part for k filters, by its nature.
    """
    lattice = Lattice(letters)
    at = lambda values: F.array(*map(F.lit, values))[F.col("edge")]
    edges = counts.withColumn("edge", F.explode(F.sequence(F.lit(0), F.lit(len(lattice.edges) - 1))))
    told = edges.withColumns(
        {"_state": at([s for s, _ in lattice.edges]), "_bit": at([1 << b for _, b in lattice.edges])}
    )
    gone = F.col("mask").bitwiseAND(F.col("_state")) != 0
    fails = F.col("mask").bitwiseAND(F.col("_bit")) != 0
    total = lambda cases, n="n": F.sum(F.when(cases, F.col(n)).otherwise(0))
    found = told.groupBy("part", "edge").agg(
        total(~gone & ~fails).alias("kept"),
        total(~gone & fails).alias("removed"),
        total(gone & fails).alias("redundant"),
        total(F.col("mask") == F.col("_bit")).alias("unique_fails"),
        total(~gone & fails, "good").alias("good_lost"),
        total(~gone & fails, "toxic").alias("toxic_lost"),
    )
    # A window holds the edges of one filter in one part.
    own = Window.partitionBy("part", at([b for _, b in lattice.edges]))
    weighted = found.withColumn("shapley", F.sum(F.col("removed") * at(lattice.paths)).over(own))
    orders = F.array(*[F.array(*map(F.lit, names)) for names in lattice.orders])[F.col("edge")]
    return weighted.select(
        "part",
        F.explode(orders).alias("filter_order"),
        at([s.bit_count() + 1 for s, _ in lattice.edges]).alias("step"),
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over all documents."""
    return audit(counts_by_mask(marked(failures(documents), labels)))
