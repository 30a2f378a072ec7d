"""Alignment of two tokenizations of the same bytes, and how often tokens are linked.

Tokenizer A is a byte-level file of the ``tokenizers`` library whose ids rise with its merges (so
that ``tiktoken`` reads texts by it as well) and reads a space and the text; B is a
``sentencepiece`` model and reads the text, before which it puts a space itself.  Where a token
of A and one of B both end, a group is cut; every A token of a group is linked with every B token
of it.

The texts of a batch are laid end to end and merged in lockstep: one state vector holds, for each
lane, the A and the B token under way, and a step moves the pointer of the one that ends first, or
both at a cut, in all lanes at once; finished lanes are taken out.  The state at a byte does not
depend on where the merge began, so a long text is many lanes (``LANE`` bytes each) and the number
of steps is bounded whatever the texts' lengths.

Each document keeps the pairs of ids it links, each once with its number of links.  Counting in
how many documents a pair is linked is a map-side combine and one shuffle of distinct pairs.  The
counts of the ``KNOWN_PAIRS`` commonest pairs (some 8 MB) and the highest count of every A id (as
many numbers as A has ids) are broadcast; all other pairs are joined with their counts by pair, so
every count is exact and no join key is common.

Null and empty texts, and those that a tokenizer does not give back byte by byte, have no tokens.
Null, equal and repeated ids play no part: rows carry a number of their own.  Ties for the highest
count all count.  Empty tables give no rows.  Only ``doc_id`` and ``text`` are read, so further
columns may have any name.  A worker holds ``BATCH_BYTES`` of texts at once, or one longer text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.bpe import SPLIT, byte_characters
from spendlake.llm.common import commonest, map_arrow, ship, sliced_by_bytes, stored

LANE = 1024
BATCH_BYTES = 1_500_000
KNOWN_PAIRS = 1 << 19
#: Links expanded at once; larger groups are counted by distinct ids.
_LINKS = 1 << 20
_LARGE_GROUP = 1 << 16
#: Characters of a word from which tokenizer A itself reads the text.
_LONG_WORD = 1000
#: Distinct pairs a task gathers before it hands their counts on.
_GATHERED = 1 << 20


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Both tokenizers, and the bytes of their entries."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = {c: b for b, c in enumerate(byte_characters())}
        entries = sorted((i, token) for token, i in self.a.get_vocab(with_added_tokens=True).items())
        self.a_bytes = [b""] * (entries[-1][0] + 1)
        for i, token in entries:
            own = all(c in byte for c in token)
            self.a_bytes[i] = bytes(byte[c] for c in token) if own else token.encode()
        plain = self.a.get_vocab(with_added_tokens=False).values()
        ranks = {self.a_bytes[i]: i for i in plain if i not in self.a.get_added_tokens_decoder()}
        self.fast = tiktoken.Encoding("a", pat_str=SPLIT.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.a_length = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        size = max(len(self.a_bytes), len(self.b_bytes))
        #: Decimal ids followed by each separator: entry ``separator * size + id``.
        self.size = size
        self.written = [b"%d%b" % (i, s) for s in (b",", b"|", b";") for i in range(size)]

    def _a_tokens(self, text: str) -> list[int]:
        """Both ways give the same ids; the faster one takes quadratic time for one long word."""
        if " " * _LONG_WORD in text or len(max(text.split(" "), key=len)) > _LONG_WORD:
            return self.a.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """A and B ids of each text, none where a tokenizer does not give it back."""
        full = [t or "" for t in texts]
        a = [self._a_tokens(" " + t) for t in full]
        b = self.b.encode(full, num_threads=1)
        result = []
        for text, x, y in zip(full, a, b):
            raw = (" " + text).encode()
            own = (
                text
                and b"".join(map(self.a_bytes.__getitem__, x)) == raw
                and b"".join(map(self.b_bytes.__getitem__, y)) == raw
            )
            result.append((x, y) if own else ([], []))
        return result


@cache
def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """Loaded once in each Python worker."""
    return Tokenizers(a_path, b_path)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B tokens that end groups.

    ``a_ends`` and ``b_ends`` are the bytes at which tokens end, both up to the same last byte;
    lanes begin at ``starts``, which ascend from 0, and reach to the next one.
    """
    last = a_ends[-1] if len(a_ends) else 0
    stop = np.append(starts[1:], last)
    i, j = np.searchsorted(a_ends, starts, "right"), np.searchsorted(b_ends, starts, "right")
    beyond = np.iinfo(np.int64).max
    a_ends, b_ends = np.append(a_ends, beyond), np.append(b_ends, beyond)
    a_cuts, b_cuts = [], []
    while len(i):
        a, b = a_ends[i], b_ends[j]
        under_way = np.maximum(a, b) <= stop
        if not under_way.all():
            i, j, stop, a, b = (x[under_way] for x in (i, j, stop, a, b))
        cut = a == b
        a_cuts.append(i[cut])
        b_cuts.append(j[cut])
        i, j = i + (a <= b), j + (b <= a)
    if not a_cuts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.sort(np.concatenate(a_cuts)), np.sort(np.concatenate(b_cuts))


def _added(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their numbers."""
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, time = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, time = key[order], time[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(time, first) if len(first) else time


class Alignment:
    """Groups and links of some texts, given by the A and B ids of each."""

    def __init__(self, tokenizers: Tokenizers, tokens: list[tuple[list[int], list[int]]]) -> None:
        self.tokenizers, self.texts = tokenizers, len(tokens)
        self.a = np.array([i for a, _ in tokens for i in a], dtype=np.int64)
        self.b = np.array([i for _, b in tokens for i in b], dtype=np.int64)
        self.n_a = np.array([len(a) for a, _ in tokens], dtype=np.int64)
        self.n_b = np.array([len(b) for _, b in tokens], dtype=np.int64)
        a_ends = np.cumsum(tokenizers.a_length[self.a])
        b_ends = np.cumsum(tokenizers.b_length[self.b])
        #: The first token of each text, and one past the last.
        self.a_first, self.b_first = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        begin = np.concatenate([[0], a_ends])[self.a_first]
        lanes = [np.arange(s, e, LANE) for s, e in zip(begin[:-1].tolist(), begin[1:].tolist()) if e > s]
        a_cuts, b_cuts = lockstep(a_ends, b_ends, np.concatenate(lanes) if lanes else np.empty(0, np.int64))
        #: Of each group: one past its tokens, its numbers of tokens, its text.
        self.a_end, self.b_end = a_cuts + 1, b_cuts + 1
        self.p, self.q = np.diff(self.a_end, prepend=0), np.diff(self.b_end, prepend=0)
        self.text = np.searchsorted(self.a_first, a_cuts, "right") - 1

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of the groups' numbers, exact, by text."""
        before = np.concatenate([[0], np.cumsum(values)])
        first = np.searchsorted(self.text, np.arange(self.texts + 1))
        return before[first[1:]] - before[first[:-1]]

    def digests(self) -> list[str]:
        """SHA-256 of the written groups of each text, empty where there are none."""
        size = self.tokenizers.size
        codes = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        a_place = np.arange(len(self.a)) + np.repeat(self.b_end - self.q, self.p)
        b_place = np.arange(len(self.b)) + np.repeat(self.a_end, self.q)
        codes[a_place], codes[b_place] = self.a, self.b
        codes[a_place[self.a_end - 1]] += size
        codes[b_place[self.b_end - 1]] += 2 * size
        first, written = (self.a_first + self.b_first).tolist(), self.tokenizers.written.__getitem__
        return [
            hashlib.sha256(b"".join(map(written, codes[s:e].tolist()))[:-1]).hexdigest() if e > s else ""
            for s, e in zip(first, first[1:])
        ]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair (``a * |B| + b``) and number of links, for the distinct pairs of each text."""
        a_size, b_size = len(self.tokenizers.a_bytes), len(self.tokenizers.b_bytes)
        keys, times = [], []

        def take(key: np.ndarray, time: np.ndarray) -> None:
            key, time = _added([key], [time])
            keys.append(key)
            times.append(time)

        large = self.p * self.q > _LARGE_GROUP
        for g in np.flatnonzero(large).tolist():
            a, n = np.unique(self.a[self.a_end[g] - self.p[g] : self.a_end[g]], return_counts=True)
            b, m = np.unique(self.b[self.b_end[g] - self.q[g] : self.b_end[g]], return_counts=True)
            rows = max(1, _LINKS // len(b))
            for s in range(0, len(a), rows):
                key = ((self.text[g] * a_size + a[s : s + rows])[:, None] * b_size + b).ravel()
                take(key, (n[s : s + rows, None] * m).ravel())
        # Of the other groups, each A token meets the B tokens of its group.
        group = np.repeat(np.arange(len(self.p)), self.p)
        meets = np.where(large, 0, self.q)[group]
        reached = np.concatenate([[0], np.cumsum(meets)])
        own = self.text[group] * a_size + self.a
        first = (self.b_end - self.q)[group]
        start = 0
        while start < len(own):
            end = max(start + 1, int(np.searchsorted(reached, reached[start] + _LINKS, "right")) - 1)
            n = meets[start:end]
            at = np.arange(n.sum()) - np.repeat(reached[start:end] - reached[start], n)
            b = self.b[at + np.repeat(first[start:end], n)]
            take(np.repeat(own[start:end], n) * b_size + b, np.ones(len(b), dtype=np.int64))
            start = end
        key, time = _added(keys, times)
        return key // (a_size * b_size), key % (a_size * b_size), time


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Runs of 64-bit numbers as binary values."""
    ends = pa.py_buffer((first * 8).astype("<i4").tobytes())
    data = pa.py_buffer(values.astype("<i8").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, ends, data])


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()))


def aligned(documents: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``doc_id`` with the tokens, groups and linked pairs of each text.

    ``a_ids`` and ``b_ids``; ``a_cuts`` and ``b_cuts``, the numbers of tokens up to the end of each
    group; ``n_a, n_b, n_groups, n_links, groups_sha256``; ``pairs`` and ``times``, 64-bit numbers
    ``a * |B| + b`` of the distinct id pairs in order and how many links each has.
    """
    own_a, own_b = default_paths()
    paths = a_path or own_a, b_path or own_b

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizers = _tokenizers(*paths)
        found = Alignment(tokenizers, tokenizers.tokens(batch.column("text").to_pylist()))
        text, pair, time = found.pairs()
        first = np.searchsorted(text, np.arange(found.texts + 1))
        groups = np.searchsorted(found.text, np.arange(found.texts + 1))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                _lists(found.a, found.a_first),
                _lists(found.b, found.b_first),
                _lists(found.a_end - found.a_first[found.text], groups),
                _lists(found.b_end - found.b_first[found.text], groups),
                pa.array(found.n_a),
                pa.array(found.n_b),
                pa.array(np.diff(groups)),
                pa.array(found.per_text(found.p * found.q)),
                pa.array(found.digests(), pa.string()),
                _packed(pair, first),
                _packed(time, first),
            ],
            names="doc_id a_ids b_ids a_cuts b_cuts n_a n_b n_groups n_links groups_sha256 pairs times".split(),
        )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(
        rows,
        run,
        "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>,"
        " n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary",
        slices=sliced_by_bytes("text", BATCH_BYTES),
    )


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers of all rows, and how many each row has."""
    values = [np.frombuffer(v, "<i8") for v in column.to_pylist()]
    return np.concatenate([np.empty(0, np.int64), *values]), np.array([len(v) for v in values], np.int64)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit() -> pa.RecordBatch:
        key, n = _added(keys, times)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])

    keys, times, gathered = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 2048):
            pair, n = np.unique(_numbers(batch.column("pairs").slice(start, 2048))[0], return_counts=True)
            keys.append(pair)
            times.append(n)
            gathered += len(pair)
            if gathered > _GATHERED:
                pair, n = _added(keys, times)
                keys, times, gathered = [pair], [n], len(pair)
                if gathered > _GATHERED // 2:
                    yield emit()
                    keys, times, gathered = [], [], 0
    yield emit()


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n``: in how many documents each pair of ids is linked."""
    ship(rows.sparkSession)
    counted = rows.select("pairs").mapInArrow(_count_pairs, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def linked(documents: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document: its tokens, groups and links, and how common its links are.

    ``n_best`` links have the highest count of their A id, ``count_sum`` adds up the counts of all.
    """
    own_a, own_b = default_paths()
    b_size = len(_tokenizers(a_path or own_a, b_path or own_b).b_bytes)
    kept = aligned(documents, a_path, b_path).drop("a_ids", "b_ids", "a_cuts", "b_cuts")
    rows = stored(kept.withColumn("row", F.monotonically_increasing_id()))
    counts = stored(pair_counts(rows))
    best = counts.groupBy(F.expr(f"pair div {b_size}").alias("a")).agg(F.max("n").alias("best"))
    highest = best.toArrow()
    top = commonest(counts, "pair", KNOWN_PAIRS)
    a_best = np.zeros(max([0, *highest.column("a").to_pylist()]) + 1, dtype=np.int64)
    a_best[highest.column("a").to_numpy()] = highest.column("best").to_numpy()
    order = np.argsort(top.column("pair").to_numpy())
    known = tuple(top.column(name).to_numpy()[order] for name in ("pair", "n"))
    shared = documents.sparkSession.sparkContext.broadcast((a_best, *known))

    def seen(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Row, pair and times of all pairs, and their count, 0 where it is not known."""
        _, pairs, n = shared.value
        pair, size = _numbers(batch.column("pairs"))
        time, _ = _numbers(batch.column("times"))
        if not len(pairs):
            return np.repeat(np.arange(len(size)), size), pair, time, np.zeros(len(pair), np.int64)
        place = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        return np.repeat(np.arange(len(size)), size), pair, time, np.where(pairs[place] == pair, n[place], 0)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, pair, time, n = seen(batch)
        sums = np.zeros((2, batch.num_rows), dtype=np.int64)
        np.add.at(sums[0], row, np.where((n > 0) & (n == shared.value[0][pair // b_size]), time, 0))
        np.add.at(sums[1], row, time * n)
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], pa.array(sums[0]), pa.array(sums[1])],
            names=[*names, "_best", "_sum"],
        )

    def rare(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, pair, time, n = seen(batch)
        left = np.flatnonzero(n == 0)
        number = batch.column("row").to_numpy()[row[left]]
        return pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(pair[left]), pa.array(time[left])], names=["_row", "pair", "_times"]
        )

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    sums = map_arrow(rows, add, schema + ", _best long, _sum long", 2048)
    others = map_arrow(rows.select("row", "pairs", "times"), rare, "_row long, pair long, _times long", 2048)
    found = (
        others.join(counts.hint("merge"), "pair")
        .withColumn("a", F.expr(f"pair div {b_size}"))
        .join(F.broadcast(best), "a")  # at most one row for each id of A
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("_times")).otherwise(0)).alias("_rare_best"),
            F.sum(F.col("_times") * F.col("n")).alias("_rare_sum"),
        )
    )
    both = lambda x, y: F.col(x) + F.coalesce(y, F.lit(0))
    return sums.join(found, F.col("row") == F.col("_row"), "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        both("_best", "_rare_best").alias("n_best"),
        both("_sum", "_rare_sum").alias("count_sum"),
        "groups_sha256",
    )
