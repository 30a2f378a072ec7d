"""Base spans against the plain patterns; trees, calibration, and spans added in planted texts."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlake.llm import pii
from tests.llm.conftest import rows, sentence

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checked(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain(text):
    """The base by the patterns as they are written."""
    only = lambda m: re.sub("[^0-9]", "", m.group())
    spans = [(0, *m.span()) for m in EMAIL.finditer(text)]
    spans += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    spans += [(2, *m.span()) for m in CARD.finditer(text) if 14 <= len(only(m)) <= 19 and checked(only(m))]
    spans += [(3, *m.span()) for m in PHONE.finditer(text) if 10 <= len(only(m)) <= 15]
    return sorted(spans, key=lambda s: (s[1], s[0]))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="@.+-a1 0()٣é9", max_size=60))
def test_base_equals_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e x@@y.z .@-.- a@b a@b. @b.c",
        "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.01 1.2.3. 1..2.3.4",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 40000000000000000000002",
        "+1 (743) 555-3824. +49-30-1234567890123456 +1  2 ++12 3456789 0123",
    ],
)
def test_base_of_hard_texts(text):
    assert pii.base_spans(text) == plain(text)


def test_base_takes_time_in_proportion_to_the_text():
    for unit in ("a", "9", "1.", "@", "+1 ", "a@", "4 ", "1.1.1 ", "a@b", "(", " at "):
        text = unit * (2_000_000 // len(unit))
        pii.base_spans(text)
        if unit not in ("4 ", "1.", "1.1.1 ", "a@", "a@b", "@", " at ", "+1 "):
            assert list(pii.candidates(text)) == []


def card(n):
    digits = "4" + "".join(str((n * 7919 + i * i * 31 + i * n) % 10) for i in range(14))
    return next(digits + str(d) for d in range(10) if checked(digits + str(d)))


def planted(n):
    """A text with a base span of each kind, and rows of digits that are none."""
    words = re.sub("[0-9]", "", sentence(40, seed=n)).split()
    bad = str(int(card(n)) ^ 1)
    phone = f"({200 + n % 700}) 555-{1000 + n * 7 % 9000}"
    return " ".join(
        [
            *words[:8],
            f"+1 {phone}",
            *words[8:16],
            card(n),
            *words[16:24],
            f"user{n}@mail{n % 7}.example.com",
            *words[24:32],
            f"10.{n % 256}.{n * 7 % 256}.9",
            *words[32:36],
            bad if not checked(bad) else "1234567890123",
            f"2024-{1 + n % 12:02}-{1 + n % 28:02} 300.{n}.5.600",
            f"@handle{n} broken{n}@host{n},",
            *words[36:],
        ]
    )


HIDDEN = [
    (9001, f"rev ono are {card(5)} {card(6)} in the ono", "card", card(6)),
    (9002, "ono are in the ono 1 (312) 555-8842 rev are ono in", "phone", "1 (312) 555-8842"),
    (9003, "nothing here but words and 12 apples, version 3.4", None, None),
]


@pytest.fixture(scope="module")
def planted_documents(spark):
    made = [(n, planted(n)) for n in range(300)] + [(i, t) for i, t, *_ in HIDDEN]
    made += [(n + 500, planted(n)) for n in range(40)] + [(None, planted(7)), (None, None), (9004, "")]
    return made


@pytest.fixture(scope="module")
def judge(spark, planted_documents):
    return pii.fit(spark.createDataFrame(planted_documents, "doc_id long, text string").repartition(3))


def test_spans_hold_the_base_and_add_hidden_ones(spark, planted_documents, judge):
    frame = spark.createDataFrame(planted_documents, "doc_id long, text string").repartition(3)
    got = pii.found(frame, judge).collect()
    assert sorted(judge.models) == [0, 1, 2, 3]
    texts = {}
    expected = Counter()
    for i, text in planted_documents:
        base = plain(text or "")
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        counts = [sum(k == n for k, *_ in base) for n in range(4)]
        expected[(i, *counts, hashlib.sha256(joined.encode()).hexdigest())] += 1
        texts[i] = (text, set(joined.split(",")) - {""})
    names = "doc_id n_email n_ip n_card n_phone base_sha256".split()
    assert Counter(tuple(r[n] for n in names) for r in got) == expected
    for r in got:
        if r["doc_id"] is not None:
            assert texts[r["doc_id"]][1] <= set(r["spans"].split(","))
    by_id = {r["doc_id"]: r["spans"] for r in got}
    for doc_id, text, kind, value in HIDDEN:
        if kind:
            start = text.index(value)
            assert f"{kind}:{start}:{start + len(value)}" in by_id[doc_id].split(",")
        else:
            assert by_id[doc_id] == ""


def test_fit_does_not_depend_on_the_partitions(spark, planted_documents, judge):
    again = pii.fit(spark.createDataFrame(planted_documents[::-1], "doc_id long, text string").repartition(7))
    sample = np.array([pii.features(planted(3), c) for c in pii.candidates(planted(3))], dtype=float)
    for kind in range(4):
        assert again.precisions(kind, sample).tolist() == judge.precisions(kind, sample).tolist()


def test_odd_rows_and_clashing_columns(spark, documents, judge):
    got = Counter((r["doc_id"], r["base_sha256"]) for r in pii.found(documents, judge).collect())
    digest = lambda t: hashlib.sha256(pii.written(plain(t or "")).encode()).hexdigest()
    assert got == Counter((i, digest(t)) for i, t, *_ in rows())
    own = documents.withColumns({n: F.lit("own") for n in ("spans", "n_email", "kind")})
    clean = pii.redacted(own, judge)
    assert clean.columns == [*[c for c in own.columns if c != "spans"], "spans"]
    assert {r["n_email"] for r in clean.collect()} == {"own"}


def test_empty_table_teaches_and_finds_nothing(spark, empty):
    judge = pii.fit(empty)
    assert judge.models == {} and pii.found(empty, judge).collect() == []
    assert judge.accepted(HIDDEN[0][1], []) == []


def test_redaction_merges_overlapping_spans():
    assert pii.redact("call +1 (743) 555-3824 or a@b.cd", [(3, 5, 22), (2, 8, 30), (0, 26, 32)]) == "call [PHONE]"
    assert pii.redact("x a@b.cd y", [(0, 2, 8)]) == "x [EMAIL] y"


def test_trees_learn_and_calibration_rises():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 5))
    truth = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(int)
    trees = pii.Trees(x[:1000], truth[:1000])
    right = (trees.scores(x[1000:]) > 0) == (truth[1000:] == 1)
    assert right.mean() > 0.95
    at, share = pii.isotonic(trees.scores(x[1000:]), truth[1000:])
    assert (np.diff(at) > 0).all() and (np.diff(share) >= 0).all() and 0 <= share[0] <= share[-1] <= 1


def test_spans_tell_overlaps():
    spans = pii.Spans()
    for span in [(0, 5, 9), (1, 20, 25), (2, 7, 12), (3, 1, 3)]:
        spans.add(span)
    covered = {*range(5, 12), *range(20, 25), *range(1, 3)}
    for start in range(0, 30):
        for end in range(start + 1, 31):
            assert spans.touch((0, start, end)) == bool(covered & set(range(start, end)))
