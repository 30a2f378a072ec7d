"""Removal of byte strings that occur elsewhere, with a logarithmic family of suffix arrays.

Suffixes are sampled at anchors (see ``windows``), fingerprinted, and dealt out by fingerprint, so
each task keeps its own family of indexes for the suffixes with its prefixes.  A new batch gets a
suffix array: its fingerprints, sorted.  The array is merge-scanned against every level of the
family for matches, then joins the family; levels of about equal size merge, so there are
logarithmically many and each suffix is merged logarithmically often.

Every byte under a string of ``width`` bytes that starts anywhere else too is removed, in all
places, judged on the input.  Matches stay inside a document; rows that are equal count as two
places.  Null texts are empty, shorter texts keep everything, null ids take part like others, and
extra columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spendlake.llm.common import map_arrow
from spendlake.llm.windows import Windows, covered, unpacked, with_spans

WIDTH = 200
GRAM = 96

_BYTES = np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64)


class SuffixArrays:
    """A logarithmic family: sorted fingerprints with the numbers of their suffixes, by level."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.matched: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        """Index a batch of suffixes; ``docs`` is not needed: any other place counts."""
        order = np.argsort(keys, kind="stable")
        new = keys[order], order + self.size
        self.size += len(keys)
        hits = [new[1][_repeats(new[0])]]
        for level in self.levels:
            hits += _scan(new, level)
        self.matched += hits
        while self.levels and len(self.levels[-1][0]) <= len(new[0]):
            new = _merged(self.levels.pop(), new)
        self.levels.append(new)

    def found(self) -> np.ndarray:
        result = np.zeros(self.size, dtype=bool)
        for numbers in self.matched:
            result[numbers] = True
        return result


def _repeats(keys: np.ndarray) -> np.ndarray:
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[1:] == keys[:-1]
    return same[1:] | same[:-1]


def _scan(new: tuple[np.ndarray, np.ndarray], level: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Numbers of the suffixes of both arrays whose fingerprint is in the other."""
    low = np.searchsorted(level[0], new[0], "left")
    inside = np.flatnonzero(low < len(level[0]))
    hit = inside[level[0][low[inside]] == new[0][inside]]
    if not len(hit):
        return []
    # The matching run of the level, once for each distinct fingerprint.
    first = hit[np.append(True, np.diff(low[hit]) > 0)]
    start, end = low[first], np.searchsorted(level[0], new[0][first], "right")
    lengths = end - start
    places = np.repeat(start - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    return [new[1][hit], level[1][places]]


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, numbers = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(keys, kind="stable")
    return keys[order], numbers[order]


def byte_symbols(text: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(text, dtype=np.uint8)]


def repeated_bytes(documents: DataFrame, width: int = WIDTH, gram: int | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (binary) and its kept_sha256."""
    kind = Windows(byte_symbols, width, gram or max(1, min(GRAM, width // 2)), SuffixArrays)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, runs, kept = [], [], [], []
        for text, spans in zip(unpacked(batch.column("text")), batch.column("spans").to_pylist()):
            gone = covered(len(text), spans, width)
            sizes.append(len(text))
            removed.append(int(gone.sum()))
            runs.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            kept.append(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )

    return map_arrow(
        with_spans(documents, kind),
        cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
    )
