"""The audit against one run of the filters for each of the 120 orders."""

from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from spendlake.llm import filter_audit
from tests.llm.conftest import rows, sentence

LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (9, 0, 1), (11, 1, None), (None, 1, 1), (77, 1, 1)]
MEASURES = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def more_rows():
    """Copies beside the odd cases: with null ids, a repeated smallest id and other languages."""
    clean = " ".join(f"word{n} of{n}" for n in range(150))
    extra = [(30, clean, "fr"), (30, clean, "en"), (31, clean, "en"), (None, clean, "fr"), (29, clean + "#", "")]
    return [(i, t, lang) for i, t, lang, *_ in rows()] + extra + [(5, sentence(90000, seed=9) + " UP" * 30000, "en")]


def brute_force(documents, labels):
    least = {}
    for i, text, _ in documents:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, mark in labels if i is not None and mark == 1}
    judged = []
    for i, text, lang in documents:
        text = text or ""
        w = text.encode().split()
        tests = [
            len(w) < 200,
            100 * len(set(w)) < 50 * len(w),
            100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            any(c in "#$%&*|" for c in text),
            i is not None and i > least[text],
        ]
        judged.append((lang or "", {x for x, t in zip("ABCDE", tests) if t}, i in good, i in toxic))
    found = {}
    for part in {x[0] for x in judged}:
        for order in map("".join, permutations("ABCDE")):
            left, own = [x for x in judged if x[0] == part], [x for x in judged if x[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                stay = [x for x in left if letter not in x[1]]
                fails = [x for x in own if letter in x[1]]
                found[part, order, step] = [
                    len(stay),
                    len(gone),
                    len(fails) - len(gone),
                    sum(x[1] == {letter} for x in own),
                    sum(x[2] for x in gone),
                    sum(x[3] for x in gone),
                ]
                left = stay
    shapley = Counter()
    for (part, order, step), values in found.items():
        shapley[part, order[step - 1]] += values[1]
    return {key: (*values, shapley[key[0], key[1][key[2] - 1]]) for key, values in found.items()}


def test_audit_equals_every_order_run(spark):
    documents = spark.createDataFrame(more_rows(), "doc_id long, text string, lang string")
    clashing = "good toxic part mask text_hash n first edge step _id _own".split()
    documents = documents.withColumns({name: F.lit("own") for name in clashing}).repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(documents, labels).collect()
    expected = brute_force(more_rows(), LABELS)
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[m] for m in MEASURES) for r in got} == expected
    assert len(got) == len(expected)


def test_audit_of_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(empty, labels).collect() == []


@pytest.mark.parametrize("letters", ["X", "XYZ", "ABCDE"])
def test_paths_through_each_layer_are_all_orders(letters):
    lattice = filter_audit.Lattice(letters)
    for size in range(len(letters)):
        layer = [i for i, (state, _) in enumerate(lattice.edges) if state.bit_count() == size]
        assert sum(lattice.paths[i] for i in layer) == len(set(permutations(letters)))
        assert all(len(lattice.orders[i]) == lattice.paths[i] for i in layer)
