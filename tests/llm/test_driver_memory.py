"""What the pipeline brings into the driver, and how much of a plan begins at once."""

import tracemalloc
import zlib

import numpy as np
import pytest

from spendlake.llm import components, exact_dedup, near_dedup, quality_classifier
from tests.llm.conftest import sentence


def test_posting_counts_take_little_of_the_driver(spark):
    """Nearly all 2^18 counts are there; as rows of Python objects they took 120 MB."""
    random = np.random.default_rng(1)
    rows = [(n, random.integers(0, 2**32, near_dedup.COORDINATES, "u4").tobytes()) for n in range(6000)]
    classes = spark.createDataFrame(rows, "node long, signature binary").repartition(2)
    del rows
    tracemalloc.start()
    try:
        posted = near_dedup.postings(classes, 64)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 20_000_000
    assert posted.count() == 6000 * (near_dedup.COORDINATES - 64 + 1)


def test_the_rarest_pairs_are_posted(spark):
    """A value that all classes share comes last, so nobody is posted under it."""
    random = np.random.default_rng(2)
    rows = []
    for n in range(300):
        own = random.integers(0, 2**32, near_dedup.COORDINATES, "u4")
        own[:40] = 7
        rows.append((n, own.tobytes()))
    classes = spark.createDataFrame(rows, "node long, signature binary").repartition(3)
    posted = near_dedup.postings(classes, 64)
    assert posted.groupBy("key").count().agg({"count": "max"}).first()[0] == 1


def test_the_fitted_space_comes_back_in_parts(spark, monkeypatch):
    """It equals the space fitted here, and no call of the driver gathers all its rows."""
    frame = type(spark.range(0))
    parts, plain = [], frame.toLocalIterator

    def in_parts(self, *args, **named):
        parts.append(self.rdd.glom().map(lambda rows: sum(len(r["content"]) for r in rows)).collect())
        return plain(self, *args, **named)

    monkeypatch.setattr(frame, "toArrow", lambda self: pytest.fail("all parts at once"))
    monkeypatch.setattr(frame, "toLocalIterator", in_parts)
    texts = [sentence(60 + n, seed=n) + " ###" * (n % 2) for n in range(24)]
    ids = [n for n in range(200) if not _held_out(n)][:24]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    expected = quality_classifier.Neighbours([t.encode() for t in texts], np.arange(24) % 2).arrays()
    assert model.arrays().keys() == expected.keys()
    assert all(np.array_equal(model.arrays()[k], v) for k, v in expected.items())
    [sizes] = parts
    assert sum(sizes) > 12_000_000 and max(sizes) <= 2 * quality_classifier._PART


def _held_out(n):
    return zlib.crc32(str(n).encode()) % 5 == 0


def test_no_step_begins_with_dozens_of_shuffles(spark, monkeypatch):
    """Each write is planned with at most 12 exchanges; the links of near copies had 28 here."""
    seen, plain = {}, near_dedup.stored

    def counted(module):
        def keep(rows):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            seen.setdefault(module, []).append(plan.count("Exchange "))
            return plain(rows)

        return keep

    for module in (near_dedup, components, exact_dedup):
        monkeypatch.setattr(module, "stored", counted(module.__name__))
    shared = sentence(120, seed=1).split()
    texts = [" ".join([*shared[:n], f"new{n}", *shared[n + 1 :]]) for n in range(100)] + [" ".join(shared)] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = near_dedup.without_near_copies(exact_dedup.without_copies(docs))
    assert kept.count() == 1
    assert max(n for counts in seen.values() for n in counts) <= 12
