"""Removal of passages that start in an earlier document too, with prefix-partitioned suffix trees.

Suffixes of word sequences, sampled at anchors (see ``windows``), are split by prefix: the anchor's
gram, or where that is hot the longer prefix of all its windows, so that each partition holds a
memory-sized group of suffixes whatever the text repeats.  A task builds the subtree of its group
by sorting: suffixes that share a prefix are one node.  A node as deep as a window that spans
several documents is a repeat; the smallest doc_id below it keeps the passage, the others lose it.

A window is ``width`` words of one document.  Each word under a window whose words also start in a
document with a smaller doc_id is removed, judged on the input.  Words are unchanged and split at
ASCII white space.  Null texts have no words, shorter texts keep all of them.  Null ids neither
lose nor take away anything; rows that repeat an id do not affect each other.  Extra columns play
no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import WordHashes, map_arrow
from spendlake.llm.windows import Windows, covered, spans, identified, unpacked

WIDTH = 50
GRAM = 20

_HASHES = WordHashes()


class Subtree:
    """The nodes of one depth below a partition's prefixes, with the smallest document of each."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        self.keys.append(keys)
        self.docs.append(docs)

    def found(self) -> np.ndarray:
        """Is there a suffix of a smaller document below the same node?"""
        keys, docs = np.concatenate(self.keys), np.concatenate(self.docs)
        order = np.lexsort((docs, keys))
        heads = np.append(True, np.diff(keys[order]) != 0) if len(keys) else np.empty(0, dtype=bool)
        least = docs[order][np.flatnonzero(heads)][np.cumsum(heads) - 1]
        result = np.empty(len(keys), dtype=bool)
        result[order] = docs[order] > least
        return result


def word_symbols(text: bytes) -> np.ndarray:
    return _HASHES.of(text.split())


def repeated_passages(documents: DataFrame, width: int = WIDTH, gram: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (words joined by a space), kept_sha256."""
    kind = Windows(word_symbols, width, gram or max(1, min(GRAM, width // 2)), Subtree)
    found = spans(documents.where(F.col("doc_id").isNotNull()), kind)
    rows = identified(documents).join(found.hint("merge"), "row", "left")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, kept = [], [], []
        for text, runs in zip(unpacked(batch.column("text")), batch.column("spans").to_pylist()):
            words = text.split()
            gone = covered(len(words), runs, width)
            sizes.append(len(words))
            removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
        )

    return map_arrow(
        rows, cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    )
