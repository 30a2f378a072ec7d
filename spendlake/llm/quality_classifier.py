"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its lower-cased words without edge punctuation and its pairs of adjacent words
and, as a supplement, its words' shapes and endings and a few terms for how much of the text
repeats, each kind hashed to a fixed number of dimensions.  A bounded sample of labelled documents
gives the inverse document frequencies and, by truncated singular value decompositions, two latent
spaces, one of words and pairs and one of shapes; the vectors in each, at most ``SAMPLE`` of
``WORD_RANK`` and of ``RANK`` numbers, are broadcast.  Every document is compared with all of them,
block by block, and in each space its ``NEIGHBOURS`` nearest vote: the share of label 1 among them,
weighted by similarity.  The lower vote is the score, so that neither words nor shapes hide what
the other show; a space where a text is equally far from everything does not vote.

Labels, lang, source and doc_id never enter a score.  Null and empty texts have no terms, are
equally far from everything and get the sample's share of label 1.  Null ids or labels teach
nothing; rows that repeat an id are scored each; without any labelled row every score is 1.
Ties in similarity go to the neighbour with the smaller id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, mixed, ship, utf8, with_fields

#: Bounds of what is fitted: labelled documents and bytes of their whole texts, latent dimensions,
#: hashed terms.
SAMPLE = 4096
SAMPLE_BYTES = 48_000_000
RANK = 48
TERMS = 4096
#: The same for words and pairs of words; each has ``WORDS`` dimensions.
WORD_RANK = 64
WORDS = 1 << 16
NEIGHBOURS = 15
THRESHOLD = 0.3
#: Documents compared at once.
BLOCK = 512
#: Terms of words whose rows of a basis are held at once.
_ENTRIES = 1 << 16

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LETTERS = re.compile(rb"[a-z\x80-\xff]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _terms_of(word: bytes) -> tuple[int, ...]:
    """The hashed terms of one word: its shape and its last letters."""
    small = word.lower()
    letters = b"".join(_LETTERS.findall(small))
    kind = b"U" if word.isupper() and len(letters) > 1 else b"L"
    tail = small[len(small.rstrip(b"!#$%&*|<>=+@~^_-.,;:?/\\")) :][:3]
    shape = kind + b"%d" % min(len(letters), 12) + tail
    return tuple(xxhash.xxh3_64_intdigest(t) % TERMS for t in (b"s" + shape, b"t" + kind + tail, b"e" + letters[-2:]))


def _share_term(name: bytes, part: int, whole: int) -> int:
    return xxhash.xxh3_64_intdigest(b"%b|%d" % (name, 10 * part // max(whole, 1))) % TERMS


class Terms:
    """Terms of words, remembered: a number per word, its hashed terms and a hash of the word."""

    MOST = 250_000

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.table = np.empty((self.MOST, 3), dtype=np.int16)
        self.hashes = np.empty(self.MOST, dtype=np.uint64)

    def _number(self, word: bytes) -> int:
        number = self.numbers[word] = len(self.numbers)
        self.table[number] = _terms_of(word)
        small = word.lower()
        self.hashes[number] = xxhash.xxh3_64_intdigest(small.strip(_PUNCTUATION) or small)
        return number

    def of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the shape terms of some words, and the hash of each word."""
        counts, hashes = np.zeros(TERMS, dtype=np.int64), np.empty(len(words), dtype=np.uint64)
        for start in range(0, len(words), self.MOST // 4):
            part = words[start : start + self.MOST // 4]
            if len(self.numbers) + len(part) > self.MOST:
                self.numbers.clear()
            get = self.numbers.get
            numbers = [get(word, -1) for word in part]
            if -1 in numbers:
                numbers = [self._number(w) if get(w) is None else get(w) for w in part]
            counts += np.bincount(self.table[numbers].ravel(), minlength=TERMS)
            hashes[start : start + len(part)] = self.hashes[numbers]
        return counts, hashes


class Rows:
    """A sparse matrix of ``WORDS`` word and ``WORDS`` pair dimensions: row, term and value of its entries."""

    def __init__(self, hashes: list[np.ndarray]) -> None:
        terms, counts = [], []
        for words in hashes:
            pairs = mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
            both = np.concatenate([words % np.uint64(WORDS), pairs % np.uint64(WORDS) + np.uint64(WORDS)])
            term, count = np.unique(both.astype(np.int32), return_counts=True)
            terms.append(term)
            counts.append(count.astype(np.float32))
        self.size = len(hashes)
        self.row = np.repeat(np.arange(self.size, dtype=np.int32), [len(t) for t in terms])
        self.term = np.concatenate([np.empty(0, np.int32), *terms])
        self.value = np.log1p(np.concatenate([np.empty(0, np.float32), *counts]))

    def weigh(self, idf: np.ndarray) -> None:
        self.value *= idf[self.term]
        norm = np.sqrt(np.bincount(self.row, self.value**2, self.size))
        self.value /= np.maximum(norm, 1e-9)[self.row].astype(np.float32)

    def times(self, matrix: np.ndarray) -> np.ndarray:
        return _sums(self.row, self.term, self.value, matrix, self.size)

    def transposed(self) -> Callable[[np.ndarray], np.ndarray]:
        order = np.argsort(self.term, kind="stable")
        term, row, value = self.term[order], self.row[order], self.value[order]
        return lambda matrix: _sums(term, row, value, matrix, 2 * WORDS)


def _sums(to: np.ndarray, of: np.ndarray, value: np.ndarray, matrix: np.ndarray, size: int) -> np.ndarray:
    """Adds ``value`` times row ``of`` of the matrix to row ``to``, which ascends, of ``size`` rows."""
    result = np.zeros((size, matrix.shape[1]), dtype=np.float32)
    for start in range(0, len(to), _ENTRIES):
        here = slice(start, start + _ENTRIES)
        starts = np.flatnonzero(np.diff(to[here], prepend=-1))
        result[to[here][starts]] += np.add.reduceat(value[here, None] * matrix[of[here]], starts, axis=0)
    return result


def term_counts(texts: list[bytes], terms: Terms) -> tuple[np.ndarray, Rows]:
    """Shape term counts of each text, a row of ``TERMS`` numbers, and its words and pairs."""
    rows = np.zeros((len(texts), TERMS), dtype=np.float32)
    hashes = [np.empty(0, dtype=np.uint64)] * len(texts)
    for number, (row, text) in enumerate(zip(rows, texts)):
        words = text.split()
        if not words:
            continue
        row[:], hashes[number] = terms.of_words(words)
        lines = [line for line in text.split(b"\n") if line.strip()]
        again = sum(map(eq, words, words[1:]))
        row[_share_term(b"lines", len(lines) - len(set(lines)), len(lines))] += max(1, len(words) // 4)
        row[_share_term(b"again", again, len(words))] += max(1, len(words) // 4)
    return rows, Rows(hashes)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The counts, weighted and at length one, in place."""
    np.log1p(counts, out=counts)
    counts *= idf
    counts /= np.maximum(np.sqrt(np.einsum("ij,ij->i", counts, counts)), 1e-9)[:, None]
    return counts


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def _idf(texts: int, found: np.ndarray) -> np.ndarray:
    return np.log((1 + texts) / (1 + found)).astype(np.float32) + 1


def _orthonormal(basis: np.ndarray) -> np.ndarray:
    """Columns that span the same, by their small Gram matrix and in place; zero where they depend."""
    parts = [slice(start, start + _ENTRIES // 4) for start in range(0, len(basis), _ENTRIES // 4)]
    for _ in range(2):
        gram = sum(wide.T @ wide for wide in (basis[part].astype(np.float64) for part in parts))
        size, axes = np.linalg.eigh(gram)
        kept = size > max(size[-1], 1e-30) * 1e-12
        turn = (axes * np.where(kept, 1 / np.sqrt(np.where(kept, size, 1)), 0)).astype(np.float32)
        for part in parts:
            basis[part] = basis[part] @ turn
    return basis


def _basis(
    terms: int, texts: int, rank: int, times: Callable[[np.ndarray], np.ndarray], back: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """The leading right singular vectors of a matrix of texts and terms, given by its products."""
    basis = np.random.default_rng(1).standard_normal((terms, min(rank + 8, texts)), np.float32)
    for _ in range(4):
        basis = _orthonormal(back(times(basis)))
    _, _, turned = np.linalg.svd(times(basis), full_matrices=False)
    return basis @ turned[:rank].T


class Neighbours:
    """The fitted spaces: ``idf`` and ``basis`` of each, and the labelled vectors, all of bounded size."""

    def __init__(self, texts: list[bytes], labels: np.ndarray) -> None:
        counts, words = term_counts(texts, Terms())
        self.idf = _idf(len(texts), np.count_nonzero(counts, axis=0))
        self.word_idf = _idf(len(texts), np.bincount(words.term, minlength=2 * WORDS))
        words.weigh(self.word_idf)
        self.word_basis = _basis(2 * WORDS, len(texts), WORD_RANK, words.times, words.transposed())
        rows = _weighted(counts, self.idf)
        self.basis = _basis(TERMS, len(texts), RANK, lambda m: rows @ m, lambda m: rows.T @ m)
        self.vectors, self.labels = self._latent(rows, words), labels.astype(np.float32)

    def arrays(self) -> dict[str, np.ndarray]:
        shapes, lexical = self.vectors
        return {
            "idf": self.idf,
            "word_idf": self.word_idf,
            "basis": self.basis,
            "word_basis": self.word_basis,
            "shapes": shapes,
            "lexical": lexical,
            "labels": self.labels,
        }

    @classmethod
    def of(cls, parts: Iterable[Row]) -> Neighbours:
        """The space that rows of ``_fitted`` hold, in any order, each copied into its place."""
        found = {}
        for row in parts:
            if row["name"] not in found:
                found[row["name"]] = np.empty(row["shape"], row["kind"])
            raw = found[row["name"]].reshape(-1).view(np.uint8)
            start, content = row["part"] * _PART, row["content"]
            raw[start : start + len(content)] = np.frombuffer(content, np.uint8)
        model = cls.__new__(cls)
        model.vectors = [found.pop("shapes"), found.pop("lexical")]
        vars(model).update(found)
        return model

    def _latent(self, rows: np.ndarray, words: Rows) -> list[np.ndarray]:
        return [_unit(rows @ self.basis), _unit(words.times(self.word_basis))]

    def _votes(self, cosines: np.ndarray) -> np.ndarray:
        """The vote of the nearest of each text; not a number where none is near."""
        nearest = min(NEIGHBOURS, len(self.labels))
        order = np.argpartition(-cosines, nearest - 1, axis=1)[:, :nearest]
        weight = np.maximum(np.take_along_axis(cosines, order, axis=1), 0) ** 4
        vote = (weight * self.labels[order]).sum(axis=1) / np.maximum(weight.sum(axis=1), 1e-9)
        return np.where(weight.sum(axis=1) < 1e-9, np.nan, vote)

    def scores(self, texts: list[bytes], terms: Terms) -> np.ndarray:
        result = np.empty(len(texts))
        for start in range(0, len(texts), BLOCK):
            counts, words = term_counts(texts[start : start + BLOCK], terms)
            words.weigh(self.word_idf)
            places = self._latent(_weighted(counts, self.idf), words)
            shapes, lexical = (self._votes(place @ known.T) for place, known in zip(places, self.vectors))
            vote = np.fmin(shapes, lexical)
            result[start : start + BLOCK] = np.where(np.isnan(vote), self.labels.mean(), vote)
        return np.clip(result, 0, 1)


_TERMS = Terms()


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Neighbours | None:
    """The space of at most ``sample`` labelled documents outside the held-out ones.

    They are those with the smallest hashes of their ids, so a rerun takes the same, as many as
    have ``SAMPLE_BYTES`` of whole texts together, and one at least.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_label"))
        .where(~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    order = F.xxhash64("_id")
    chosen = known.orderBy(order, "_id").limit(sample)
    labelled = (
        documents.select(F.col("doc_id").cast("long").alias("_id"), "text")
        .join(F.broadcast(chosen), "_id")
        .select("*", order.alias("_order"), F.md5("text").alias("_print"))
    )
    rank = ["_order", "_id", "_print"]
    sizes = labelled.select(*rank, F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
    sizes = np.cumsum([r["n"] for r in sizes.orderBy(*rank).limit(sample).collect()])
    if not len(sizes):
        return None
    fitting = max(1, int(np.searchsorted(sizes, SAMPLE_BYTES, "right")))
    # Spark orders and cuts the sample; one task fits it, so the driver holds the result alone.
    ship(documents.sparkSession)
    rows = labelled.orderBy(*rank).limit(fitting).select("_id", "_label", "text")
    parts = rows.coalesce(1).mapInArrow(_fitted, "name string, part int, shape array<long>, kind string, content binary")
    # Dealt out and fetched one partition after the other: the driver's JVM holds a few parts, not
    # several copies of all.
    return Neighbours.of(parts.repartition(_PARTITIONS).toLocalIterator())


#: Bytes of a fitted array that come back in one row, and partitions that all rows come back in.
_PART = 4_000_000
_PARTITIONS = 16


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of the space that the rows fit, in parts."""
    columns: dict[str, list] = {"_id": [], "_label": [], "text": []}
    for batch in batches:
        for name, values in columns.items():
            values += batch.column(name).to_pylist()
    if not columns["_id"]:
        return
    texts, order = columns["text"], sorted(range(len(columns["_id"])), key=lambda n: columns["_id"][n])
    marks = np.array([columns["_label"][n] for n in order])
    model = Neighbours([(texts[n] or "").encode() for n in order], marks)
    for name, array in model.arrays().items():
        content = memoryview(np.ascontiguousarray(array)).cast("B")
        for part, start in enumerate(range(0, max(1, len(content)), _PART)):
            own = [[name], [part], [list(array.shape)], [array.dtype.str], [bytes(content[start : start + _PART])]]
            types = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(own, types)], names=["name", "part", "shape", "kind", "content"]
            )


def without_rejected(documents: DataFrame, model: Neighbours | None) -> DataFrame:
    """The documents that are not predicted to be bad, with their columns as they are.

    Names that begin with two underscores are kept for the inside.
    """
    names = {"score": "__score", "predicted": "__predicted"}
    own = [name for name in names if name in documents.columns]
    scored = quality_scores(documents.withColumnsRenamed({n: names[n] for n in own}), model)
    kept = scored.where("predicted = 1").drop("score", "predicted")
    return kept.withColumnsRenamed({names[n]: n for n in own}).select(*[f"`{c}`" for c in documents.columns])


def quality_scores(documents: DataFrame, model: Neighbours | None) -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (0 or 1)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        fitted = shared.value
        scores = np.ones(len(texts)) if fitted is None else fitted.scores(texts, _TERMS)
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(scores, pa.float64()),
                pa.array(scores >= THRESHOLD, pa.bool_()).cast(pa.int32()),
            ],
            names=[*batch.schema.names, "score", "predicted"],
        )

    rows = documents.drop("score", "predicted")
    return map_arrow(rows, run, with_fields(rows, "score double, predicted int"))
