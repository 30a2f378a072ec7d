"""Personal data in texts: exact patterns, and candidates that boosted trees accept.

The base are spans by pattern and check, for each kind by itself: e-mail addresses, IP addresses,
card numbers (Luhn) and telephone numbers.  They always stay.

High-recall generators propose further, overlapping spans: addresses with ``at`` and ``dot``
spelled out or letters outside ASCII, addresses of IP written with spaces, brackets or colons, and
every run of digit groups of a card's or a telephone's length.  Gradient-boosted trees, one set
for each kind, judge them by format and context.  They learn from candidates whose truth the base
gives away: a base span is one; what overlaps one without being it, or breaks a rule of its kind
(Luhn, parts over 255, a date, no domain), is none.  The plus sign that every base telephone number
has is hidden from the trees, so that they judge the rest.  The sample is bounded: at most
``SAMPLE`` candidates of each kind and truth, those with the smallest hashes of their own text and
surroundings, so that copies count once and a rerun takes the same.  A fifth is held out, and
isotonic regression on it turns scores into precisions; a candidate is accepted from ``PRECISION``
on, unless it overlaps a base span or a surer candidate.  A kind with fewer than ``FEW`` examples of
either truth on either side adds nothing.

Null texts are empty and have no spans.  Null, equal and repeated ids, and repeated rows, play no
part: every row is judged by its text alone.  Ties in score go to the longer span, then the earlier,
then the kind as listed.  Texts of any length are searched whole, in time in proportion to their
length, a bounded number of candidates at a time.  Empty tables give no rows, and teach nothing.
Of further columns, ``redacted`` keeps all but its own ``spans``; ``found`` reads none.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from heapq import nsmallest
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import map_arrow, ship, sliced_by_bytes, stored, with_fields

KINDS = ("email", "ip", "card", "phone")
#: Candidates of each kind and truth that are learned from.
SAMPLE = 4096
FEW = 20
PRECISION = 0.95
#: Texts, in bytes, and candidates of one text that a worker holds at once.
BATCH_BYTES = 4_000_000
_CHUNK = 4096

Span = tuple[int, int, int]  # kind, start, end

# Fixed by the contract of the base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return _NO_DIGITS.sub("", text)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign: letters to the left, up to the last match, and a domain to the right."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """The spans of the base patterns that pass their checks, by start, then kind."""
    spans = [(0, s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = digits_of(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(digits_of(m.group())) <= 15:
            spans.append((3, *m.span()))
    return sorted(spans, key=lambda s: (s[1], s[0]))


def written(spans: Iterable[Span]) -> str:
    """``kind:start:end``, by start and kind, with commas between."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0], x[2])))


# What the generators look for.
_AT = re.compile(r"@|\s?[(\[{<]\s?at\s?[)\]}>]\s?| at ", re.IGNORECASE)
_LABEL = r"[^\W_](?:[\w-]{0,62}[^\W_])?"
_DOT = r"(?:\.|\s?[(\[{<]\s?(?:dot|\.)\s?[)\]}>]\s?| dot )"
_ANY_DOMAIN = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL}){{0,4}}", re.IGNORECASE)
_SPELLED = re.compile(rf"{_LABEL}(?: dot |\s?[(\[{{<]\s?dot\s?[)\]}}>]\s?){_LABEL}(?:{_DOT}{_LABEL}){{0,3}}", re.IGNORECASE)
_WHOLE_DOMAIN = re.compile(rf"{_DOT}[^\W\d_]{{2,}}$", re.IGNORECASE)
_ANY_LOCAL = re.compile(r"[\w.%+-]{1,64}")
_ANY_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\s?\.\s?|\s?[(\[{]\s?(?:\.|dot)\s?[)\]}]\s?| dot )[0-9]{1,3}){3}(?![0-9])")
_COLONS = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_GROUP = re.compile(r"[0-9]+")
_BETWEEN = re.compile(r"[ ().\-/]{1,3}")
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-/. ][01]?[0-9][-/. ][0-3]?[0-9]|[0-3]?[0-9][-/. ][01]?[0-9][-/. ](?:19|20)[0-9]{2}")
_DIGIT = re.compile(r"[0-9]")
_ANYTHING = re.compile(r"[0-9@]| at |[(\[{<]\s?at\s?[)\]}>]", re.IGNORECASE)
#: Words before a value that name it, by kind.
_CUES = [
    re.compile(r"mail|contact|write|address", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|addr|address|ping", re.IGNORECASE),
    re.compile(r"card|visa|credit|master|account|pay", re.IGNORECASE),
    re.compile(r"phone|tel\b|tel[.:]|call|fax|mobile|cell|whatsapp", re.IGNORECASE),
]


def _email_like(text: str) -> Iterator[Span]:
    for m in _AT.finditer(text):
        spelled = m.group() == " at "
        domain = (_SPELLED if spelled else _ANY_DOMAIN).match(text, m.end())
        if not domain:
            continue
        start = m.start()
        while start > 0 and m.start() - start < 64 and _ANY_LOCAL.match(text[start - 1]):
            start -= 1
        if start < m.start():
            yield 0, start, domain.end()


def _digit_runs(text: str) -> Iterator[Span]:
    """Runs of up to six neighbouring digit groups with the digits of a card or a telephone."""
    groups: list[tuple[int, int]] = []

    def ending_here() -> Iterator[Span]:
        """The runs that end with the last group."""
        count, end = 0, groups[-1][1]
        for n, (start, stop) in enumerate(reversed(groups), 1):
            count += stop - start
            if count > 19:
                break
            if count >= 13:
                yield 2, start, end
            if 7 <= count <= 15 and (n > 1 or count >= 9):
                first = start - (text[start - 1 : start] == "(")
                yield 3, first - (text[first - 1 : first] == "+"), end

    for m in _GROUP.finditer(text):
        if groups:
            gap = text[groups[-1][1] : m.start()]
            if len(gap) > 3 or not _BETWEEN.fullmatch(gap):
                groups.clear()
        groups.append(m.span())
        del groups[:-6]
        yield from ending_here()


def candidates(text: str) -> Iterator[Span]:
    """Overlapping spans that may be personal data."""
    if not _ANYTHING.search(text):
        return
    yield from _email_like(text)
    if _DIGIT.search(text):
        yield from ((1, *m.span()) for m in _ANY_IP.finditer(text))
        yield from _digit_runs(text)
    yield from ((1, *m.span()) for m in _COLONS.finditer(text) if len(m.group()) > 8)


def _kind_of(character: str) -> int:
    if not character:
        return 0
    if character.isspace():
        return 1
    return 2 if character.isalpha() else 3 if character.isdigit() else 4


def _distance(text: str, digits_first: bool) -> int:
    """Characters up to the next digit, 20 at most."""
    found = _DIGIT.search(text if digits_first else text[::-1])
    return found.start() if found else 20


FEATURES = 27


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate, without the plus sign of a telephone number."""
    kind, start, end = span
    if kind == 3 and text[start] == "+":
        start += 1
    value, before, after = text[start:end], text[max(0, start - 41) : start], text[end : end + 40]
    before = before[:-1] if before.endswith("+") else before[1:]
    around, groups = before + after, _GROUP.findall(value)
    digits, size = "".join(groups), max(1, len(value))
    labels = re.split(r"[.\s]+", value.rpartition("@")[2])
    share = lambda test, of: sum(map(test, of)) / max(1, len(of))
    return [
        len(value),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        len(groups[-1]) if groups else 0,
        len(set(digits)),
        len(digits) / size,
        int(digits[0]) if digits else -1,
        luhn(digits) if len(digits) < 40 else 0,
        max((int(g) if len(g) < 6 else 99999 for g in groups), default=-1),
        len({c for c in value if not c.isalnum()}),
        value.count(" "),
        value.count("-"),
        value.count("."),
        value.count("("),
        value.count(":"),
        value.count("@"),
        len(labels),
        len(labels[-1]),
        share(str.isalpha, value),
        _kind_of(before[-1:]),
        _kind_of(after[:1]),
        _distance(before, False),
        _distance(after, True),
        share(str.isdigit, around),
        bool(_CUES[kind].search(before)) + 2 * bool(_DATE.search(value)),
    ]


def _broken(text: str, span: Span) -> bool:
    """Does the candidate break a rule of its kind?"""
    value = text[span[1] : span[2]]
    if span[0] == 0:
        return not _WHOLE_DOMAIN.search(value)
    if span[0] == 1:
        return ":" not in value and not all(map(_small, _GROUP.findall(value)))
    if span[0] == 2:
        return not luhn(digits_of(value))
    return bool(_DATE.search(value)) or len(digits_of(value)) < 7


class Spans:
    """Spans that do not overlap, for asking whether another one would."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.most = 0

    def add(self, span: Span) -> None:
        """Overlapping spans become one."""
        start, end = span[1:]
        low, high = bisect_left(self.ends, start + 1), bisect_left(self.starts, end)
        if low < high:
            start, end = min(start, self.starts[low]), max(end, self.ends[high - 1])
            del self.starts[low:high], self.ends[low:high]
        insort(self.starts, start)
        insort(self.ends, end)

    def touch(self, span: Span) -> bool:
        return bisect_left(self.ends, span[1] + 1) < bisect_left(self.starts, span[2])


def _truths(text: str, base: list[Span], taken: Spans, chunk: list[Span]) -> list[int]:
    """1, 0 or, where the base does not tell, -1."""
    own = set(base)
    return [1 if c in own else 0 if taken.touch(c) or _broken(text, c) else -1 for c in chunk]


class Trees:
    """Gradient-boosted trees of depth 3 for the log odds of a yes, over binned features."""

    ROUNDS, DEPTH, RATE, BINS = 60, 3, 0.2, 32

    def __init__(self, rows: np.ndarray, truth: np.ndarray) -> None:
        cuts = np.quantile(rows, np.linspace(0, 1, self.BINS + 1)[1:-1], axis=0, method="nearest").T
        self.cuts = [np.unique(c) for c in cuts]
        binned = self._binned(rows)
        share = (truth.sum() + 1) / (len(truth) + 2)
        self.start = float(np.log(share / (1 - share)))
        #: Of each tree: feature and bin by node, values by leaf; rows above the bin go right.
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        score = np.full(len(rows), self.start)
        for _ in range(self.ROUNDS):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, truth - p, p * (1 - p))
            self.trees.append(tree)
            score += self._values(binned, tree)

    def _binned(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(self.cuts)], axis=1)

    def _grow(self, binned: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> tuple:
        inner, n = 2**self.DEPTH - 1, binned.shape[1]
        feature, bin_ = np.zeros(inner, np.int64), np.full(inner, self.BINS + 1)
        node = np.zeros(len(binned), np.int64)
        for level in range(self.DEPTH):
            first, nodes = 2**level - 1, 2**level
            width = nodes * (self.BINS + 1)
            best = np.zeros(nodes)
            for f in range(n):
                at = (node - first) * (self.BINS + 1) + binned[:, f]
                g, h = (np.bincount(at, w, width).reshape(nodes, -1).cumsum(axis=1) for w in (slope, curve))
                gain = lambda a, b: a * a / (b + 1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                won = gain(g, h) + gain(all_g - g, all_h - h) - gain(all_g, all_h)
                top = won.argmax(axis=1)
                better = won[np.arange(nodes), top] > best + 1e-9
                best = np.where(better, won[np.arange(nodes), top], best)
                own = slice(first, first + nodes)
                feature[own], bin_[own] = np.where(better, f, feature[own]), np.where(better, top, bin_[own])
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > bin_[node])
        leaf, leaves = node - inner, inner + 1
        value = np.bincount(leaf, slope, leaves) / (np.bincount(leaf, curve, leaves) + 1)
        return feature, bin_, self.RATE * value

    def _values(self, binned: np.ndarray, tree: tuple) -> np.ndarray:
        feature, bin_, value = tree
        node = np.zeros(len(binned), np.int64)
        for _ in range(self.DEPTH):
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > bin_[node])
        return value[node - len(feature)]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        binned = self._binned(rows)
        return self.start + sum(self._values(binned, tree) for tree in self.trees)


def isotonic(scores: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores and the rising shares of yes they stand for, by pooling adjacent violators."""
    order = np.argsort(scores, kind="stable")
    at, first = np.unique(scores[order], return_index=True)
    weight = np.diff(np.append(first, len(order))).astype(float)
    pools: list[list[float]] = []  # share, weight, number of scores
    for share, w in zip(np.add.reduceat(truth[order].astype(float), first) / weight, weight):
        pools.append([share, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            (a, v, n), (b, w, m) = pools[-2:]
            pools[-2:] = [[(a * v + b * w) / (v + w), v + w, n + m]]
    return at, np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


class Judge:
    """Trees and calibration of each kind; kinds without enough examples accept nothing."""

    def __init__(self, kinds: np.ndarray, rows: np.ndarray, truth: np.ndarray, held_out: np.ndarray) -> None:
        self.models: dict[int, tuple[Trees, np.ndarray, np.ndarray]] = {}
        for kind in range(len(KINDS)):
            fit, test = (kinds == kind) & ~held_out, (kinds == kind) & held_out
            if all(np.sum(truth[part] == t) >= FEW for part in (fit, test) for t in (0, 1)):
                trees = Trees(rows[fit], truth[fit])
                self.models[kind] = (trees, *isotonic(trees.scores(rows[test]), truth[test]))

    def precisions(self, kind: int, rows: np.ndarray) -> np.ndarray:
        """The share of true ones among candidates like each."""
        if kind not in self.models:
            return np.zeros(len(rows))
        trees, at, share = self.models[kind]
        return np.interp(trees.scores(rows), at, share)

    def accepted(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates that are sure enough and overlap neither the base nor a surer one."""
        taken, sure = Spans(), []
        for span in base:
            taken.add(span)
        proposed = candidates(text) if self.models else iter(())
        while chunk := list(islice(proposed, _CHUNK)):
            chunk = [c for c in chunk if c[0] in self.models and not taken.touch(c)]
            for kind in {c[0] for c in chunk}:
                own = [c for c in chunk if c[0] == kind]
                shares = self.precisions(kind, np.array([features(text, c) for c in own], dtype=float))
                sure += [(-p, c[1] - c[2], c[1], c[0], c) for p, c in zip(shares, own) if p >= PRECISION]
        chosen = []
        for *_, span in sorted(sure):
            if not taken.touch(span):
                taken.add(span)
                chosen.append(span)
        return chosen


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's candidates with a known truth, at most ``SAMPLE`` of each kind and truth."""
    kept: dict[tuple[int, int], dict[int, list[float]]] = {
        (kind, truth): {} for kind in range(len(KINDS)) for truth in (0, 1)
    }
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text or not _ANYTHING.search(text):
                continue
            base, taken = base_spans(text), Spans()
            for span in base:
                taken.add(span)
            proposed = candidates(text)
            while chunk := list(islice(proposed, _CHUNK)):
                for span, truth in zip(chunk, _truths(text, base, taken, chunk)):
                    if truth < 0:
                        continue
                    kind, start, end = span
                    near = f"{kind}|{start - max(0, start - 20)}|{text[max(0, start - 20) : end + 20]}"
                    number = xxhash.xxh3_64_intdigest(near.encode()) >> 1
                    some = kept[kind, truth]
                    if number not in some:
                        some[number] = features(text, span)
                        if len(some) >= 2 * SAMPLE:
                            kept[kind, truth] = {n: some[n] for n in nsmallest(SAMPLE, some)}
    rows = [(k, t, n, some[n]) for (k, t), some in kept.items() for n in nsmallest(SAMPLE, some)]
    columns = [list(c) for c in zip(*rows)] or [[], [], [], []]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "truth", "number", "features"]
    )


def fit(documents: DataFrame) -> Judge:
    """The judge that a bounded sample of all documents' candidates makes."""
    ship(documents.sparkSession)
    found = stored(
        documents.select("text").mapInArrow(_examples, "kind int, truth int, number long, features array<double>")
    )
    rows = []
    for kind in range(len(KINDS)):
        for truth in (0, 1):
            own = found.where((F.col("kind") == kind) & (F.col("truth") == truth)).dropDuplicates(["number"])
            rows += own.orderBy("number").limit(SAMPLE).collect()
    numbers = np.array([r["number"] for r in rows], dtype=np.int64)
    return Judge(
        np.array([r["kind"] for r in rows], dtype=np.int64),
        np.array([r["features"] for r in rows], dtype=float).reshape(len(rows), FEATURES),
        np.array([r["truth"] for r in rows], dtype=np.int64),
        numbers % 5 == 0,
    )


def found(documents: DataFrame, judge: Judge) -> DataFrame:
    """One row per document: base spans by kind, their digest, and all spans."""
    shared = documents.sparkSession.sparkContext.broadcast(judge)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            counts.append([sum(k == kind for k, *_ in base) for kind in range(len(KINDS))])
            digests.append(hashlib.sha256(written(base).encode()).hexdigest())
            spans.append(written(base + shared.value.accepted(text or "", base)))
        by_kind = [pa.array(n, pa.int64()) for n in zip(*counts)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *by_kind, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            names=["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"],
        )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    schema = f"doc_id long, {counts}, base_sha256 string, spans string"
    return map_arrow(rows, run, schema, slices=sliced_by_bytes("text", BATCH_BYTES))


def redact(text: str, spans: Iterable[Span]) -> str:
    """The text with each span, or run of overlapping ones, as ``[KIND]`` of the first."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], x[0])):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(documents: DataFrame, judge: Judge) -> DataFrame:
    """The documents with all spans replaced in ``text``, null kept null, and ``spans``."""
    shared = documents.sparkSession.sparkContext.broadcast(judge)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            every = base + shared.value.accepted(text or "", base)
            texts.append(text and redact(text, every))
            spans.append(written(every))
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(spans, pa.string())], names=[*batch.schema.names, "spans"]
        )

    rows = documents.drop("spans")
    return map_arrow(rows, run, with_fields(rows, "spans string"), slices=sliced_by_bytes("text", BATCH_BYTES))
