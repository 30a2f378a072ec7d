"""Log probabilities of texts under a hashed maximum-entropy language model.

Tokens are words split at ASCII white space with A-Z in lower case, and one end per text.  The
probability of a token is that of its class times its own within the class.  The ``FREQUENT``
commonest words lie in classes of ``CLASS_WORDS``, the end is a class, and all other words are
classed by a hash of their last two bytes.  Classes, and words within the frequent classes, are
softmaxes over four features of the two words before: none, the last word (n-gram), the one before
it (skip), and both, hashed to a fixed number of rows.  History words outside the ``SYMBOLS`` are
hashed like the rare classes.  Words of a rare class have their smoothed share of its counts, with
one part for all words never seen, so the model sums to one.

Training uses every training text.  One pass counts tokens; one counts how often each target
follows each pair of history symbols, a table whose size is bounded by the model and not by the
corpus, and which holds all the gradient needs.  Every round, tasks turn their rows of that table
into gradients (observed less expected counts) and curvatures, and their sums move the weights.

Scoring is one pass in sparse numpy batches.  Counts of the ``KNOWN_WORDS`` commonest words are
broadcast; all rarer tokens are joined with their counts by word, so every count is exact.

Null texts are empty: their only token is the end.  Null ids are training rows.  Repeated rows
count and are scored each.  Without training rows all weights are zero.
"""

from __future__ import annotations

import secrets
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, ship, sliced_by_bytes, stored, utf8

FREQUENT = 1024
CLASS_WORDS = 32
SHAPES = 63
SYMBOLS = 192
#: Words whose counts are broadcast: some 10 MB.
KNOWN_WORDS = 1 << 17
ROUNDS = 10
#: Rows of the context table in a task of a round; a task shuffles one gradient, some 12 MB, and
#: the driver gets their sum.
GRADIENT_ROWS = 1_000_000

_CLASSES = FREQUENT // CLASS_WORDS
_ALL_CLASSES = _CLASSES + SHAPES + 1
_TARGETS = FREQUENT + SHAPES + 1
_START = SYMBOLS + SHAPES
_HISTORY = _START + 1
#: Rows for the hashed pair of history words, for classes and for words.
_PAIR_ROWS, _WORD_PAIR_ROWS = 4096, 512
_FLUSH = 300_000
_CHUNK_WORDS = 400_000
#: Texts of a batch that are decoded at once; a batch has up to 10,000.
_DECODED = 64
#: Bytes of texts that are scored at once: their words and sums are held together.
_SCORED_BYTES = 1 << 21
#: Contexts whose softmax is held at once.
_CONTEXTS = 16_384


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _shape(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SHAPES


def _shape_column(word: Column) -> Column:
    tail = F.when(F.octet_length(word) > 2, F.substring(word, -2, 2)).otherwise(word)
    return F.crc32(tail) % SHAPES


def _pair_row(context: np.ndarray, rows: int) -> np.ndarray:
    mixed = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % rows


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


class Softmax:
    """Rows of weights for the four features of a context, over ``width`` outcomes."""

    def __init__(self, groups: int, pair_rows: int, width: int) -> None:
        self.pair_rows = pair_rows
        shapes = [(groups, 1, width), (groups, _HISTORY, width), (groups, _HISTORY, width), (groups, pair_rows, width)]
        self.weights = [np.zeros(s, dtype=np.float32) for s in shapes]

    def _rows(self, context: np.ndarray) -> list[np.ndarray]:
        last, skip = context % _HISTORY, context // _HISTORY
        return [np.zeros_like(context), last, skip, _pair_row(context, self.pair_rows)]

    def log_probabilities(self, group: np.ndarray | int, context: np.ndarray) -> np.ndarray:
        return _log_softmax(sum(w[group, r] for w, r in zip(self.weights, self._rows(context))))

    def outcome_logs(self, group: np.ndarray, context: np.ndarray, outcome: np.ndarray) -> np.ndarray:
        """Log probabilities of outcomes; each pair of group and context once, a bounded number at once."""
        groups = len(self.weights[0])
        pairs, at = np.unique(context * groups + group, return_inverse=True)
        logs = np.empty(len(at), np.float32)
        for start in range(0, len(pairs), _CONTEXTS):
            some = pairs[start : start + _CONTEXTS]
            here = np.flatnonzero((at >= start) & (at < start + _CONTEXTS))
            logs[here] = self.log_probabilities(some % groups, some // groups)[at[here] - start, outcome[here]]
        return logs

    def add_gradient(self, sums: list[np.ndarray], group: int, context: np.ndarray, observed: np.ndarray) -> None:
        """Adds observed less expected counts to ``sums[0::2]`` and expected ones to ``sums[1::2]``."""
        expected = np.exp(self.log_probabilities(group, context)) * observed.sum(axis=1, keepdims=True)
        for i, rows in enumerate(self._rows(context)):
            order = np.argsort(rows, kind="stable")
            starts = np.flatnonzero(np.diff(rows[order], prepend=-1))
            at = rows[order][starts]
            sums[2 * i][group, at] += np.add.reduceat((observed - expected)[order], starts, axis=0)
            sums[2 * i + 1][group, at] += np.add.reduceat(expected[order], starts, axis=0)

    def empty_sums(self) -> list[np.ndarray]:
        return [np.zeros_like(w) for w in self.weights for _ in range(2)]

    def step(self, sums: list[np.ndarray], rate: float) -> None:
        """A gradient step scaled by curvature, with a weak pull to zero."""
        for i, w in enumerate(self.weights):
            gradient, expected = sums[2 * i], sums[2 * i + 1]
            pull = 0.0 if i == 0 else 0.5
            w += rate * np.clip((gradient - pull * w) / (expected + 2.0), -2.0, 2.0)


@dataclass
class Model:
    words: dict[bytes, int]  # the KNOWN_WORDS by rank
    counts: np.ndarray  # their training counts
    end_count: int
    tokens: int
    types: int
    shape_tokens: np.ndarray
    shape_types: np.ndarray
    classes: Softmax
    inner: Softmax

    def prepare(self) -> None:
        """Tables for scoring, made once in each Python worker."""
        contexts = np.arange(_HISTORY * _HISTORY)
        self.class_table = np.empty((len(contexts), _ALL_CLASSES), np.float32)
        for start in range(0, len(contexts), _CONTEXTS):
            some = slice(start, start + _CONTEXTS)
            self.class_table[some] = self.classes.log_probabilities(0, contexts[some])
        rank, shapes = np.arange(len(self.words)), np.arange(SHAPES)
        shape = np.fromiter((_shape(w) for w in self.words), dtype=np.int64, count=len(self.words))
        # Words by rank, then one entry for each shape of the words outside.
        self.symbol = np.append(np.where(rank < SYMBOLS, rank, SYMBOLS + shape), SYMBOLS + shapes)
        self.target = np.append(np.where(rank < FREQUENT, rank, FREQUENT + shape), FREQUENT + shapes)
        self.log_count = np.append(np.log10(self.counts + 1.0), np.zeros(SHAPES))
        self.lookup = _Lookup(self.words)
        self.shape_parts = np.log10(self.shape_tokens + self.shape_types + 1.0)


class _Lookup(dict):
    """Number of a word: its rank, or one for the shape of a word outside."""

    def __missing__(self, word: bytes) -> int:
        return len(self) + _shape(word)


def _sequences(
    texts: list[list[bytes]], lookup: dict[bytes, int], symbol: np.ndarray, target: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all words; contexts and targets of all tokens; the first token of each text."""
    lengths = np.array([len(t) for t in texts])
    n, total = len(texts), int(lengths.sum())
    numbers = np.fromiter((lookup[w] for t in texts for w in t), dtype=np.int64, count=total)
    word, text = np.arange(total), np.repeat(np.arange(n), lengths)
    first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    padded = np.full(total + 2 * n, _START)
    padded[word + 2 * text + 2] = symbol[numbers]
    targets = np.full(total + n, _TARGETS - 1)
    targets[word + text] = target[numbers]
    place = np.arange(total + n) + np.repeat(np.arange(n), lengths + 1)
    return numbers, padded[place] * _HISTORY + padded[place + 1], targets, first


def _class_of(target: np.ndarray) -> np.ndarray:
    return np.where(target < FREQUENT, target // CLASS_WORDS, target - FREQUENT + _CLASSES)


def _texts(column: pa.Array) -> Iterator[bytes]:
    """Texts in lower case, of which few are held beside the batch."""
    for start in range(0, len(column), _DECODED):
        for text in utf8(column.slice(start, _DECODED)):
            yield text.lower()


def _chunks(column: pa.Array) -> Iterator[list[list[bytes]]]:
    chunk, size = [], 0
    for text in _texts(column):
        chunk.append(text.split())
        size += len(chunk[-1])
        if size >= _CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in _texts(batch.column("text")):
            counts.update(text.split())
            if len(counts) >= _FLUSH:
                yield emit()
                counts.clear()
    yield emit()


def _count_contexts(training: DataFrame, model: Model) -> tuple[DataFrame, int]:
    """``key, n``: how often a target follows two history symbols, and into how many tasks it goes."""
    ranks = {w: r for w, r in model.words.items() if r < FREQUENT}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(ranks)
        rank, shapes = np.arange(len(ranks)), np.arange(SHAPES)
        shape = np.array([_shape(w) for w in ranks], dtype=np.int64)
        symbol = np.append(np.where(rank < SYMBOLS, rank, SYMBOLS + shape), SYMBOLS + shapes)
        target = np.append(rank, FREQUENT + shapes)
        for batch in batches:
            for texts in _chunks(batch.column("text")):
                _, contexts, targets, _ = _sequences(texts, lookup, symbol, target)
                keys, n = np.unique(contexts * _TARGETS + targets, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    ship(training.sparkSession)
    rows = training.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    rows = stored(rows)
    tasks = -(-rows.count() // GRADIENT_ROWS)
    # A context's rows together, in as many parts as there are gradients to add up.
    return stored(rows.repartition(tasks, F.expr(f"key div {_TARGETS}"))), tasks


def _gradients(table: DataFrame, model: Model, tasks: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums over all contexts for the classes and for the words within."""
    weights = table.sparkSession.sparkContext.broadcast((model.classes, model.inner))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, inner = weights.value
        sums = classes.empty_sums(), inner.empty_sums()
        parts = [[_numbers(batch.column(c)) for c in ("key", "n")] for batch in batches]
        keys, n = (np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2
        contexts, target = keys // _TARGETS, keys % _TARGETS
        group = _class_of(target)
        for part in range(-1, _CLASSES):
            own = np.arange(len(keys)) if part < 0 else np.flatnonzero(group == part)
            if not len(own):
                continue
            softmax, outcome = (classes, group) if part < 0 else (inner, target % CLASS_WORDS)
            seen, at = np.unique(contexts[own], return_inverse=True)
            width = softmax.weights[0].shape[2]
            for start in range(0, len(seen), _CONTEXTS):
                here = (at >= start) & (at < start + _CONTEXTS)
                rows, some = own[here], seen[start : start + _CONTEXTS]
                places = (at[here] - start) * width + outcome[rows]
                observed = np.bincount(places, n[rows], len(some) * width).astype(np.float32)
                softmax.add_gradient(sums[part >= 0], max(part, 0), some, observed.reshape(-1, width))
        arrays = [a.tobytes() for a in (*sums[0], *sums[1])]
        numbers = pa.array(range(len(arrays)), pa.int32())
        yield pa.RecordBatch.from_arrays([numbers, pa.array(arrays, pa.binary())], names=["number", "sums"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(part, np.float32) for part in parts["sums"])
        return pd.DataFrame({"number": parts["number"].iloc[:1], "sums": [total.tobytes()]})

    ship(table.sparkSession)
    totals = model.classes.empty_sums(), model.inner.empty_sums()
    arrays = [*totals[0], *totals[1]]
    parts = table.coalesce(tasks).mapInArrow(run, "number int, sums binary")
    for row in parts.groupBy("number").applyInPandas(add, "number int, sums binary").collect():
        arrays[row["number"]] += np.frombuffer(row["sums"], np.float32).reshape(arrays[row["number"]].shape)
    weights.destroy()
    return totals


def _commonest(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The ``KNOWN_WORDS`` commonest words with their counts, ties by word.

    A histogram of at most some hundred classes of counts first shows which words can be among
    them, so the driver never sees many more.
    """
    size = F.floor(F.log2("n") * 8)
    left, least = KNOWN_WORDS, 0
    for row in sorted(counts.groupBy(size.alias("size")).count().collect(), reverse=True):
        left, least = left - row["count"], row["size"]
        if left <= 0:
            break
    found = counts.where(size >= least).orderBy(F.desc("n"), "word").limit(KNOWN_WORDS).toArrow()
    pairs = zip(found.column("word").to_pylist(), found.column("n").to_pylist())
    return sorted(pairs, key=lambda pair: (-pair[1], pair[0]))


def train(training: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of the texts, and ``word, n`` of all their words."""
    texts = training.select("text")
    ship(texts.sparkSession)
    counted = texts.mapInArrow(_count_words, "word binary, n long")
    counts = stored(counted.groupBy("word").agg(F.sum("n").alias("n")))
    ends = texts.count()
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = _commonest(counts)
    shapes = np.zeros((2, SHAPES))
    by_shape = counts.groupBy(_shape_column(F.col("word")).cast("int").alias("shape"))
    for row in by_shape.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        shapes[:, row["shape"]] = row["n"], row["v"]
    for word, n in top[:FREQUENT]:
        shapes[:, _shape(word)] -= n, 1
    model = Model(
        words={word: rank for rank, (word, _) in enumerate(top)},
        counts=np.array([n for _, n in top], dtype=np.float64),
        end_count=ends,
        tokens=total + ends,
        types=types + (ends > 0),
        shape_tokens=shapes[0],
        shape_types=shapes[1],
        classes=Softmax(1, _PAIR_ROWS, _ALL_CLASSES),
        inner=Softmax(_CLASSES, _WORD_PAIR_ROWS, CLASS_WORDS),
    )
    frequent = np.zeros(FREQUENT)
    frequent[: len(top[:FREQUENT])] = model.counts[:FREQUENT]
    by_class = np.concatenate([frequent.reshape(_CLASSES, -1).sum(axis=1), shapes[0], [ends]])
    model.classes.weights[0][0, 0] = np.log(by_class + 0.5)
    model.inner.weights[0][:, 0] = np.log(frequent.reshape(_CLASSES, -1) + 0.5)
    if ends:
        table, tasks = _count_contexts(texts, model)
        for number in range(rounds):
            classes, inner = _gradients(table, model, tasks)
            rate = 0.6 if number < rounds - 3 else 0.3
            model.classes.step(classes, rate)
            model.inner.step(inner, rate)
    return model, counts


def _score(batch: pa.RecordBatch, model: Model) -> pa.RecordBatch:
    """Partial sums per text, and its words outside the known ones."""
    known, base, score, length, rare, times = [], [], [], [], [], []
    constant = np.log10(model.tokens + model.types + 1.0)
    end_log = np.log10(model.end_count + 1.0)
    ln10 = np.log(10.0)
    for texts in _chunks(batch.column("text")):
        numbers, contexts, targets, first = _sequences(texts, model.lookup, model.symbol, model.target)
        group = _class_of(targets)
        logs = model.class_table[contexts, group].astype(np.float64)
        inside = np.flatnonzero(group < _CLASSES)
        logs[inside] += model.inner.outcome_logs(group[inside], contexts[inside], targets[inside] % CLASS_WORDS)
        logs /= ln10
        outside = np.flatnonzero((group >= _CLASSES) & (group < _ALL_CLASSES - 1))
        logs[outside] -= model.shape_parts[group[outside] - _CLASSES]
        lengths = np.array([len(t) for t in texts])
        text = np.repeat(np.arange(len(texts)), lengths)
        count_logs = model.log_count[numbers]
        tail = np.where(model.target[numbers] >= FREQUENT, count_logs, 0.0)
        per_text = lambda values: np.bincount(text, values, len(texts))
        score += (np.add.reduceat(logs, first) + per_text(tail)).tolist()
        base += (per_text(count_logs) + end_log - (lengths + 1) * constant).tolist()
        in_known = per_text(numbers < len(model.words)).astype(np.int64) + (model.end_count > 0)
        known += in_known.tolist()
        length += (lengths + 1).tolist()
        ends = np.cumsum(lengths)
        for words, start, end, seen in zip(texts, ends - lengths, ends, in_known):
            far = numbers[start:end] >= len(model.words)
            found = Counter(words[i] for i in np.flatnonzero(far).tolist()) if far.any() else {}
            rare.append(list(found))
            times.append(list(found.values()))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(length, pa.int64()),
            pa.array(known, pa.int64()),
            pa.array(base, pa.float64()),
            pa.array(score, pa.float64()),
            pa.array(rare, pa.list_(pa.binary())),
            pa.array(times, pa.list_(pa.int64())),
        ],
        names=["doc_id", "n_tokens", "n_known", "base_score", "score", "rare", "times"],
    )


_PREPARED: dict[int, Model] = {}


def score(documents: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every text."""
    shared, key = documents.sparkSession.sparkContext.broadcast(model), secrets.randbits(63)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _PREPARED:
            _PREPARED.clear()
            shared.value.prepare()
            _PREPARED[key] = shared.value
        return _score(batch, _PREPARED[key])

    rows = stored(
        map_arrow(
            documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
            run,
            "doc_id long, n_tokens long, n_known long, base_score double, score double,"
            " rare array<binary>, times array<long>",
            slices=sliced_by_bytes("text", _SCORED_BYTES),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        F.col("row").alias("_row"), F.col("x.rare").alias("word"), "x.times"
    )
    found = (
        rare.join(counts.hint("merge"), "word")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("_logs"),
            F.sum("times").alias("_known"),
        )
    )
    logs = F.coalesce("_logs", F.lit(0.0))
    return rows.join(found, F.col("row") == F.col("_row"), "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
