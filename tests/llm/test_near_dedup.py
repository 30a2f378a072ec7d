"""Components however many tasks contract them, and which rows stay."""

import os
import random

import pytest
from pyspark.sql import functions as F

from spendlake.llm import components, near_dedup
from spendlake.llm.common import maybe_among, stored
from tests.llm.conftest import sentence


def roots_of(links):
    parent = {}

    def top(node):
        while parent.get(node, node) != node:
            node = parent[node]
        return node

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for link in links for n in link if top(n) != n}


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_components_equal_union_find(spark, monkeypatch, most):
    monkeypatch.setattr(components, "TASK_LINKS", most)
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (-5, 3), (3, -5)]
    links += [(500, i) for i in range(501, 540)]
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = components.components(frame).collect()
    assert {r["node"]: r["root"] for r in got} == roots_of(links) and len(got) == len(roots_of(links))
    assert components.components(frame.where("a = b")).collect() == []


def test_one_row_stays_with_null_and_repeated_ids(spark):
    base = sentence(200, seed=21).split()

    def near(n):
        return " ".join(base[:n] + [f"changed{n}"] + base[n + 1 :])

    other = sentence(150, seed=22)
    rows = [
        (None, near(20), "first null"),
        (None, near(60), "second null"),
        (None, other, "null apart"),
        (4, near(100), "four"),
        (4, near(140), "four again"),
        (4, sentence(90, seed=23), "four, another text"),
        (9, near(180), "nine"),
        (None, None, "no text"),
        (None, "", "empty"),
        (9, " \n", "blank"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, node string").repartition(4)
    kept = near_dedup.without_near_copies(frame, percent=85)
    assert kept.columns == ["doc_id", "text", "node"]
    got = {r["node"] for r in kept.collect()}
    family = {"first null", "second null", "four", "four again", "nine"}
    assert got - family == {"null apart", "four, another text", "no text", "empty", "blank"}
    assert len(got & family) == 1 and got & family <= {"four", "four again"}
    nulls = spark.createDataFrame([(None, near(n)) for n in (20, 60, 100)], "doc_id long, text string")
    assert near_dedup.without_near_copies(nulls, percent=85).count() == 1


def test_rows_that_may_be_among_the_wanted(spark):
    """All that are wanted, null included, and hardly any other."""
    rows = spark.range(20_000).union(spark.sql("SELECT CAST(NULL AS LONG) AS id"))
    wanted = rows.where("id % 1000 = 7 OR id IS NULL").select(F.col("id").alias("key"))
    got = [r.id for r in maybe_among(rows, F.col("id"), wanted, F.col("key")).collect()]
    assert {None, *range(7, 20_000, 1000)} <= set(got) and len(got) < 40
    assert maybe_among(rows, F.col("id"), wanted.limit(0), F.col("key")).count() == 0


def test_scratch_tables_and_shuffles_go_when_nothing_reads_them(spark, monkeypatch):
    """Signatures, postings and shingle sets are not kept until the session ends."""
    tables = []

    def remember(rows):
        tables.append(stored(rows))
        return tables[-1]

    monkeypatch.setattr(near_dedup, "stored", remember)
    texts = [sentence(60, seed=n % 30) for n in range(90)] + [None, ""]
    rows = [(n, f"{t} extra{n}" if t and n > 59 else t) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.near_duplicates(frame, percent=80)
    left = {c for t in tables if os.path.exists(t._scratch_folder) for c in t.columns}
    assert len(tables) > 6 and not left & {"signature", "items", "key"}
    found = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert found == {n: n % 30 if n < 90 else n for n in range(92)}
