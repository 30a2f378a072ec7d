"""Groups, links and counts against a version that goes byte by byte."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from spendlake.llm import alignment
from tests.llm.conftest import rows, sentence

ODD = [
    (40, " leading and  double   spaces \n\n tabs\t\tend "),
    (41, "日本語のテキスト、漢字とかな。" * 60),
    (42, "🙂🙃 emoji ‍ joined 👩‍👩‍👧 ﬁ é é"),
    (43, "a real ▁ in the text"),
    (44, "<s> </s> <unk> <0x41> <|endoftext|>"),
    (45, "x" * 5000 + " " * 3000 + "ä" * 2000),
    (46, "\x00\x01\x7f control"),
    (47, sentence(40000, seed=8)),
]


def more_rows():
    return [(i, t) for i, t, *_ in rows()] + ODD


@pytest.fixture(scope="module")
def expected():
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    raw = alignment.Tokenizers(*alignment.default_paths()).a_bytes
    piece = lambda i: (
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    )
    documents, held = [], Counter()
    for doc_id, text in more_rows():
        text = text or ""
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        whole = (" " + text).encode()
        if not text or b"".join(map(piece, y)) != whole or b"".join(raw[i] for i in x) != whole:
            x, y = [], []
        ends = []
        for ids, size in ((x, lambda i: len(raw[i])), (y, lambda i: len(piece(i)))):
            ends.append(np.cumsum([size(i) for i in ids]).tolist())
        common, groups, at = set(ends[0]) & set(ends[1]), [], [0, 0]
        for cut in sorted(common):
            group = []
            for side, ids in enumerate((x, y)):
                start = at[side]
                while at[side] < len(ids) and ends[side][at[side]] <= cut:
                    at[side] += 1
                group.append(ids[start : at[side]])
            groups.append(group)
        links = Counter((i, j) for p, q in groups for i in p for j in q)
        held.update(links.keys())
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        documents.append((doc_id, len(x), len(y), len(groups), links, written))
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return Counter(
        (
            doc_id,
            n_a,
            n_b,
            n_groups,
            sum(links.values()),
            sum(n for pair, n in links.items() if held[pair] == best[pair[0]]),
            sum(n * held[pair] for pair, n in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if written else "",
        )
        for doc_id, n_a, n_b, n_groups, links, written in documents
    )


NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


@pytest.mark.parametrize("known", [alignment.KNOWN_PAIRS, 50, 0])
def test_links_equal_those_found_byte_by_byte(spark, expected, known, monkeypatch):
    """However many pair counts are broadcast; small lanes and blocks change nothing either."""
    monkeypatch.setattr(alignment, "KNOWN_PAIRS", known)
    documents = spark.createDataFrame(more_rows(), "doc_id long, text string")
    clashing = {n: F.lit("own") for n in "pair n row pairs times a best n_a _row".split()}
    got = alignment.linked(documents.withColumns(clashing).repartition(3)).select(*NAMES).collect()
    assert Counter(map(tuple, got)) == expected


def test_lanes_and_blocks_change_nothing(monkeypatch):
    both = alignment.Tokenizers(*alignment.default_paths())
    tokens = both.tokens([t for _, t in more_rows()])
    whole = alignment.Alignment(both, tokens)
    for name, value in (("LANE", 7), ("_LINKS", 5), ("_LARGE_GROUP", 3)):
        monkeypatch.setattr(alignment, name, value)
    cut = alignment.Alignment(both, tokens)
    assert cut.a_end.tolist() == whole.a_end.tolist() and cut.b_end.tolist() == whole.b_end.tolist()
    few = alignment.Alignment(both, tokens[:17])
    monkeypatch.undo()
    again = alignment.Alignment(both, tokens[:17])
    for small, large in zip(few.pairs(), again.pairs()):
        assert small.tolist() == large.tolist()


def test_both_ways_of_reading_give_the_same_ids(monkeypatch):
    both = alignment.Tokenizers(*alignment.default_paths())
    texts = [t or "" for _, t in more_rows()]
    fast = both.tokens(texts)
    monkeypatch.setattr(alignment, "_LONG_WORD", 1)
    assert both.tokens(texts) == fast


def test_aligned_returns_tokens_and_cuts(spark):
    documents = spark.createDataFrame([(1, "plain words"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in alignment.aligned(documents).collect()}
    assert found[1]["a_cuts"][-1] == found[1]["n_a"] and found[1]["b_cuts"][-1] == found[1]["n_b"]
    assert len(found[1]["a_cuts"]) == found[1]["n_groups"] == len(found[1]["b_cuts"])
    assert (found[2]["a_ids"], found[2]["n_links"], found[2]["groups_sha256"]) == ([], 0, "")


def test_linked_of_an_empty_table(spark, empty):
    assert alignment.linked(empty).collect() == []
