"""Which windows of a fixed number of symbols occur elsewhere, over all texts.

Shared by the two operators that remove repeated passages; they differ in what a symbol is (byte or
word), in how fingerprints meet (``Judge``), and in what is done with the spans found.

Every window is owned by the smallest ``gram`` symbols in it, by hash: its anchor.  Equal windows
have equal anchors at equal offsets, so only suffixes that start at anchors are indexed, one in
some fifty bytes.  An anchor's windows are a run of starts; the text they span is its cover.

1. Each anchor is posted with the fingerprints of its gram and of its cover.  If the cover occurs
   elsewhere all its windows do; if the gram does not, none does.
2. What is left, the edges of repeated passages, posts the fingerprints of its single windows,
   next to those of one witness for each cover that was found repeated.

Anchors meet by gram.  Hot grams, found on a sample of the texts, are known to occur twice; their
anchors meet by cover, and their windows each by its own fingerprint.  Copies inside a batch of
texts are settled before the shuffle but for one.  Fingerprints have 64 bits: two different
windows are taken for equal with a chance below one in a million at 100 TB for a given window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, mixed, ship, stored

#: Texts in the sample for hot grams, their share of it from which a gram is hot, and how many at most.
SAMPLE_TEXTS = 2000
HOT_SHARE = 0.005
MOST_HOT = 4096

_BASE = 0x9E3779B97F4A7C15
_LENGTH = np.uint64(0x632BE59BD9B4E019)

COVERED, ASKS, WITNESS = 1, 2, 3


class Judge(Protocol):
    """Collects fingerprints with the documents they come from, batch by batch."""

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None: ...

    def found(self) -> np.ndarray:
        """For each fingerprint added: does it occur elsewhere, in the operator's sense?"""


@dataclass(frozen=True)
class Windows:
    """``symbols`` of a text, the ``width`` of a window, the length of a ``gram``, the ``judge``."""

    symbols: Callable[[bytes], np.ndarray]
    width: int
    gram: int
    judge: Callable[[], Judge]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return out


class _Tables:
    """Powers of the base and of its inverse, as many as the longest text so far needs."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            cls.up, cls.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)


class Prints:
    """Fingerprints of ranges of one text, by prefix sums."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.n = len(symbols)
        _Tables.reach(self.n + 1)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(symbols * _Tables.down[: self.n], out=self.sums[1:])

    def windows(self, width: int) -> np.ndarray:
        """Of all windows of one width."""
        n = self.n - width + 1
        return mixed((self.sums[width:] - self.sums[:-width]) * _Tables.up[:n])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        values = (self.sums[end] - self.sums[start]) * _Tables.up[start]
        return mixed(values + (end - start).astype(np.uint64) * _LENGTH)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.int64).max)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(prints: Prints, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: fingerprint of its gram and of its cover, first window, number of windows."""
    grams = prints.windows(gram)
    places = (grams >> np.uint64(33)).astype(np.int64) << 32 | np.arange(len(grams))
    owner = _sliding_least(places, width - gram + 1) & 0xFFFFFFFF
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    end = np.append(first[1:], len(owner))
    at = owner[first]
    cover = mixed(prints.ranges(first, end - 1 + width) + (at - first).astype(np.uint64) * _LENGTH)
    return grams[at], cover, first, end - first


def identified(documents: DataFrame) -> DataFrame:
    """``row`` (names a text of an id), ``doc`` and the compressed ``text``; null texts are empty."""
    rows = documents.select(
        F.xxhash64("doc_id", "text").alias("row"),
        F.col("doc_id").cast("long").alias("doc"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=3)
        texts = [packer.compress(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc"), pa.array(texts, pa.binary())],
            names=["row", "doc", "text"],
        )

    return map_arrow(rows, pack, "row long, doc long, text binary")


def unpacked(column: pa.Array) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(t) for t in column.to_pylist()]


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.xxhash64("doc_id", "text").alias("row"),
        F.col("doc_id").cast("long").alias("doc"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _all_anchors(batch: pa.RecordBatch, kind: Windows) -> dict[str, np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in range(6)]
    docs = _numbers(batch.column("doc").fill_null(0))
    for row, doc, text in zip(_numbers(batch.column("row")), docs, batch.column("text").to_pylist()):
        symbols = kind.symbols(text)
        if len(symbols) >= kind.width:
            found = anchors(Prints(symbols), kind.width, kind.gram)
            n = len(found[0])
            for part, values in zip(parts, (*found, np.full(n, row), np.full(n, doc))):
                part.append(values)
    names = ("gram", "cover", "start", "count", "row", "doc")
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64)
    return {
        name: np.concatenate(part).astype(dtype) if part else np.empty(0, dtype)
        for name, part, dtype in zip(names, parts, kinds)
    }


def _hot_grams(documents: DataFrame, kind: Windows) -> np.ndarray:
    """Grams in a good share of a sample of the texts, sorted; a bounded number."""
    rows = documents.count()
    if not rows:
        return np.empty(0, dtype=np.uint64)
    sample = documents.sample(min(1.0, SAMPLE_TEXTS / rows), seed=3)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _all_anchors(batch, kind)
        pairs = np.unique(np.stack([found["gram"].view(np.int64), found["row"]], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0])], names=["gram"])

    least = max(8, int(HOT_SHARE * min(rows, SAMPLE_TEXTS)))
    counted = map_arrow(_plain(sample), run, "gram long").groupBy("gram").agg(F.count("*").alias("n"))
    top = counted.where(f"n >= {least}").orderBy(F.desc("n"), "gram").limit(MOST_HOT).collect()
    return np.sort(np.array([r["gram"] for r in top], dtype=np.int64).view(np.uint64))


def _is_in(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), dtype=bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _stands(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Marks one entry of each fingerprint, of its smallest document."""
    order = np.lexsort((docs, keys))
    first = np.zeros(len(keys), dtype=bool)
    if len(keys):
        first[order[np.append(True, np.diff(keys[order]) != 0)]] = True
    return first


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


_POSTED = "key long, gram long, cover long, row long, doc long, start int, count int, done boolean"
_FOUND = "row long, start int, count int, kind int"


def _post(batch: pa.RecordBatch, kind: Windows, hot: np.ndarray) -> pa.RecordBatch:
    """All anchors; those whose cover another one of the batch stands for are done."""
    a = _all_anchors(batch, kind)
    judge = kind.judge()
    judge.add(a["cover"], a["doc"])
    settled = judge.found()
    stands = _stands(a["cover"], a["doc"])
    done = settled & ~stands
    # What stands for copies in this batch is sent twice, so that it is found to be repeated.
    twice = np.flatnonzero(settled & stands)
    pick = np.concatenate([np.arange(len(done)), twice])
    done = np.append(done, np.zeros(len(twice), dtype=bool))
    a = {name: values[pick] for name, values in a.items()}
    key = np.where(_is_in(a["gram"], hot), a["cover"], a["gram"])
    key = np.where(done, mixed(a["row"].view(np.uint64) + a["start"].astype(np.uint64)), key)
    return pa.RecordBatch.from_arrays(
        [
            _signed(key),
            _signed(a["gram"]),
            _signed(a["cover"]),
            pa.array(a["row"]),
            pa.array(a["doc"]),
            pa.array(a["start"].astype(np.int32)),
            pa.array(a["count"].astype(np.int32)),
            pa.array(done),
        ],
        names=["key", "gram", "cover", "row", "doc", "start", "count", "done"],
    )


def _kinds(row: np.ndarray, start: np.ndarray, count: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(row), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(kind.astype(np.int32))],
        names=["row", "start", "count", "kind"],
    )


def _judge_anchors(batches: Iterator[pa.RecordBatch], kind: Windows, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One partition of anchors: which are covered, which must ask for single windows, and whom."""
    covers, grams = kind.judge(), kind.judge()
    parts = []
    for batch in batches:
        columns = {name: _numbers(batch.column(name)) for name in batch.schema.names}
        done = columns.pop("done").astype(bool)
        if done.any():
            yield _kinds(
                columns["row"][done], columns["start"][done], columns["count"][done], np.full(done.sum(), COVERED)
            )
        a = {name: values[~done] for name, values in columns.items()}
        covers.add(a["cover"].view(np.uint64), a["doc"])
        grams.add(a["gram"].view(np.uint64), a["doc"])
        parts.append(a)
    if not parts:
        return
    a = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
    known = _is_in(a["gram"].view(np.uint64), hot)
    settled = covers.found()
    asks = ~settled & (grams.found() | known)
    asked = np.unique(a["gram"][asks])
    # A gram met by cover may be asked about elsewhere, so its covers always have a witness.
    witness = ~asks & _stands(a["cover"], a["doc"]) & (known | _is_in(a["gram"], asked))
    for which, name in ((settled, COVERED), (asks, ASKS), (witness, WITNESS)):
        if which.any():
            yield _kinds(a["row"][which], a["start"][which], a["count"][which], np.full(which.sum(), name))


_WINDOWS = "key long, row long, doc long, start int, asks boolean, prints binary"


def _post_windows(batch: pa.RecordBatch, kind: Windows, hot: np.ndarray) -> pa.RecordBatch:
    """Fingerprints of single windows, a row for the windows of an anchor (of a hot one: for each)."""
    keys, rows, docs, starts, asks, prints = [], [], [], [], [], []
    wanted = batch.column("wanted").to_pylist()
    for row, doc, text, entries in zip(
        batch.column("row").to_pylist(), batch.column("doc").fill_null(0).to_pylist(), unpacked(batch.column("text")), wanted
    ):
        own = Prints(kind.symbols(text))
        if own.n < kind.width:
            continue  # a text of another row with the same hash
        windows = own.windows(kind.width)
        grams, _, first, _ = anchors(own, kind.width, kind.gram)
        by_start = dict(zip(first.tolist(), grams))
        for entry in entries:
            start, count = entry["start"], entry["count"]
            gram = by_start.get(start)
            if gram is None:
                continue
            values = windows[start : start + count]
            single = bool(_is_in(np.array([gram]), hot)[0])
            for offset in range(len(values)) if single else (0,):
                part = values[offset : offset + 1] if single else values
                keys.append(int((part[0] if single else gram).view(np.int64)))
                rows.append(row)
                docs.append(doc)
                starts.append(start + offset)
                asks.append(entry["kind"] == ASKS)
                prints.append(part.tobytes())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.int64()),
            pa.array(rows, pa.int64()),
            pa.array(docs, pa.int64()),
            pa.array(starts, pa.int32()),
            pa.array(asks, pa.bool_()),
            pa.array(prints, pa.binary()),
        ],
        names=["key", "row", "doc", "start", "asks", "prints"],
    )


def _judge_windows(batches: Iterator[pa.RecordBatch], kind: Windows) -> Iterator[pa.RecordBatch]:
    """One partition of windows: runs of those asked about that occur elsewhere."""
    judge, parts = kind.judge(), []
    for batch in batches:
        lengths = _numbers(pa.compute.binary_length(batch.column("prints"))) // 8
        keys = np.frombuffer(b"".join(batch.column("prints").to_pylist()), dtype="<u8")
        docs = np.repeat(_numbers(batch.column("doc")), lengths)
        judge.add(keys, docs)
        inside = np.arange(len(keys)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        parts.append(
            (
                np.repeat(_numbers(batch.column("row")), lengths),
                np.repeat(_numbers(batch.column("start")).astype(np.int64), lengths) + inside,
                np.repeat(_numbers(batch.column("asks")).astype(bool), lengths),
            )
        )
    if not parts:
        return
    row, start, asks = (np.concatenate(p) for p in zip(*parts))
    hit = np.flatnonzero(asks & judge.found())
    if not len(hit):
        return
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (np.diff(hit) > 1) | (np.diff(row[hit]) != 0) | (np.diff(start[hit]) != 1)
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(hit)))
    yield _kinds(row[hit[heads]], start[hit[heads]], counts, np.full(len(heads), COVERED))


def spans(documents: DataFrame, kind: Windows) -> DataFrame:
    """``row, spans``: for texts with windows that occur elsewhere, runs of them as (start, count)."""
    ship(documents.sparkSession)
    plain, hot = _plain(documents), _hot_grams(documents, kind)
    posted = map_arrow(plain, lambda batch: _post(batch, kind, hot), _POSTED)
    judged = stored(
        posted.repartition("key").drop("key").mapInArrow(lambda batches: _judge_anchors(batches, kind, hot), _FOUND)
    )
    wanted = (
        judged.where(f"kind <> {COVERED}")
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "count", "kind")).alias("wanted"))
    )
    asking = identified(documents).join(wanted.hint("merge"), "row")
    windows = map_arrow(asking, lambda batch: _post_windows(batch, kind, hot), _WINDOWS)
    settled = windows.repartition("key").drop("key").mapInArrow(lambda batches: _judge_windows(batches, kind), _FOUND)
    found = judged.where(f"kind = {COVERED}").union(stored(settled))
    return found.groupBy("row").agg(F.collect_set(F.struct("start", "count")).alias("spans"))


def with_spans(documents: DataFrame, kind: Windows) -> DataFrame:
    """``row, doc``, the compressed ``text`` and ``spans`` (null: none) of every document."""
    return identified(documents).join(spans(documents, kind).hint("merge"), "row", "left")


def covered(n: int, runs: list[dict] | None, width: int) -> np.ndarray:
    """Which of n symbols lie in a window that starts in one of the runs."""
    steps = np.zeros(n + 1, dtype=np.int64)
    if runs:
        start = np.array([r["start"] for r in runs])
        np.add.at(steps, start, 1)
        np.add.at(steps, start + np.array([r["count"] for r in runs]) - 1 + width, -1)
    return np.cumsum(steps[:n]) > 0
