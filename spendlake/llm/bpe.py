"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences BPE produces.  It starts with
one state that accepts every byte.  Each merge (a, b), in order, is one gadget: the state reached
by ``a`` is copied without its transition on ``b``, all transitions on ``a`` go to the copy, and
every state that has a transition on ``a`` gets one on the merged token, to where ``b`` led.  All
transitions with one label thus share a target, so a gadget adds one state, stored as the state it
was copied from and the label it lost; tokens made later reach older states through their left
part.  Whether a state has a transition is therefore read off the two tables, and remembered.

A pre-split word has one path through the automaton whose labels spell it.  The path grows from
left to right: among the tokens that end at a byte, exactly one is allowed by the state its start
was reached with.  All distinct words of a batch take their paths together, byte by byte, by
lookups in numpy tables; the tables are compiled once, in the driver, and broadcast.  Decoding
joins the arc labels.

Null text is empty and has no tokens; texts of any length are encoded whole, in time proportional
to their length.  Ids, repeated rows and extra columns play no part; empty tables stay empty.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from spendlake.llm.common import map_arrow, sliced_by_bytes, with_fields

#: Transitions of the automaton that a worker remembers: 2 to this power.
TABLE_BITS = 20
#: Texts, in bytes, that a worker encodes at once, or one longer text.
BATCH_BYTES = 2_000_000

#: Fixed by the tokenizer: how words are split before merging.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


#: White space before a space or at the end: a space there need not begin a word.
_SPACED = regex.compile(r"\s |\s\Z|^ ")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Fixed by the format: printable Latin-1 characters stand for themselves, the other bytes, in
    order, for the characters from 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _gathered(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, .. of ``size`` each, one run after the other."""
    before = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(first - before, size)


class Automaton:
    """States are numbers; state 0 accepts every byte and is the start.

    After construction all tables are arrays, of a size that only the vocabulary decides.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        self.target = {vocabulary[bytes([b])]: 0 for b in range(256)}
        #: Per token: the gadget that made it (0: a byte), its left part, and the state it led to.
        self.made: dict[int, tuple[int, int, int]] = {t: (0, -1, 0) for t in self.target}
        #: Per gadget, which is also the number of the state it adds: its left and right token.
        self.left, self.right = [-1], [-1]
        self.gadget: dict[tuple[int, int], int] = {}
        #: Per token: the gadgets in which it is the left one, in order.
        self.copies: dict[int, list[int]] = {}
        for left, right in merges:
            self._gadget(vocabulary[left], vocabulary[right], vocabulary[left + right])
        labels = {token: text for text, token in vocabulary.items()}
        self._tabulate(labels)
        self._spell({token: labels[token] for token in self.made})
        del self.made, self.gadget, self.copies

    def _gadget(self, left: int, right: int, merged: int) -> None:
        followed = self.has(self.target[left], right)
        number = len(self.left)
        self.left.append(left)
        self.right.append(right)
        self.gadget[left, right] = number
        if followed and merged not in self.made:
            self.made[merged] = (number, left, self.target[right])
            self.target[merged] = self.target[right]
        self.target[left] = number
        self.copies.setdefault(left, []).append(number)

    def has(self, state: int, token: int) -> bool:
        """Does the state have a transition on the token?  (While the gadgets are made.)

        A state of a later gadget than the token has it if the state it was copied from has it,
        unless it is the label lost; a state of an earlier one if it has the token's left part.
        The copies of one label's state are passed over together.
        """
        while True:
            gadget, left, _ = self.made[token]
            while state > gadget:
                label = self.left[state]
                if gadget < self.gadget.get((label, token), 0) <= state:
                    return False
                own = self.copies[label]
                earlier = bisect_right(own, gadget)
                state = own[earlier - 1] if earlier else self.made[label][2]
            if not gadget:
                return True
            if state == gadget and self.right[gadget] == left:
                return False  # the copy lost the left part itself: a pair of equal tokens
            token = left

    def _tabulate(self, labels: dict[int, bytes]) -> None:
        size = self.size = max(labels) + 1
        self.length = np.ones(size, dtype=np.int64)
        for token, label in labels.items():
            self.length[token] = len(label)
        made = np.zeros((3, size), dtype=np.int64)
        for token, row in self.made.items():
            made[:, token] = row
        self.made_by, self.made_left, self.made_to = made
        #: The state each token leads to; the entry past the last token is the start of a word.
        target = np.zeros(size + 1, dtype=np.int64)
        for token, state in self.target.items():
            target[token] = state
        self.target = target
        pairs = sorted((a * size + b, n) for (a, b), n in self.gadget.items())
        self.pair, self.pair_gadget = (np.array(c, dtype=np.int64) for c in zip(*pairs)) if pairs else (
            np.zeros(1, np.int64),
            np.zeros(1, np.int64),
        )
        self.left, self.right = np.array(self.left), np.array(self.right)
        #: The gadgets by left token; ``first_copy`` is where those of a token begin.
        self.gadgets = len(self.left)
        copies = sorted((token, n) for token, own in self.copies.items() for n in own)
        self.copy = np.array([token * self.gadgets + n for token, n in copies] or [0], dtype=np.int64)
        self.first_copy = np.searchsorted(self.copy, np.arange(size) * self.gadgets)

    def _spell(self, labels: dict[int, bytes]) -> None:
        """A trie of the labels with links to the longest shorter suffix that is in it too."""
        child: dict[int, int] = {}
        own, depth_of, parents = [-1], [0], [(0, 0)]
        for token, label in labels.items():
            node = 0
            for byte in label:
                key = node << 8 | byte
                if key not in child:
                    child[key] = len(own)
                    own.append(-1)
                    depth_of.append(depth_of[node] + 1)
                    parents.append((node, byte))
                node = child[key]
            own[node] = token
        fail, longest, shorter = [0] * len(own), own[:], np.full(self.size, -1, dtype=np.int64)
        for node in sorted(range(1, len(own)), key=depth_of.__getitem__):
            parent, byte = parents[node]
            at = parent
            while at:
                at = fail[at]
                if (at << 8 | byte) in child:
                    fail[node] = child[at << 8 | byte]
                    break
            if own[node] < 0:
                longest[node] = longest[fail[node]]
            else:
                shorter[own[node]] = longest[fail[node]]
        keys = np.array(sorted(child), dtype=np.int64)
        self.edge, self.child = keys, np.array([child[k] for k in keys.tolist()], dtype=np.int64)
        self.fail, self.longest, self.shorter = np.array(fail), np.array(longest), shorter

    def __getstate__(self) -> dict:
        return {name: value for name, value in vars(self).items() if name not in ("seen", "answer")}

    def _transitions(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``has`` for many states and tokens at once."""
        result, at = np.zeros(len(state), dtype=bool), np.arange(len(state))
        while len(at):
            made = self.made_by[token]
            later = state > made
            label = self.left[state]
            key = label * self.size + token
            place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            lost = np.where(self.pair[place] == key, self.pair_gadget[place], 0)
            refused = later & (made < lost) & (lost <= state)
            done = ~later & (made == 0)
            result[at[done]] = True
            refused |= ~later & (state == made) & (self.right[made] == self.made_left[token])
            earlier = np.searchsorted(self.copy, label * self.gadgets + made, "right")
            copied = np.where(
                earlier > self.first_copy[label], self.copy[earlier - 1] % self.gadgets, self.made_to[label]
            )
            state = np.where(later, copied, state)
            token = np.where(later, token, self.made_left[token])
            go = ~(done | refused)
            state, token, at = state[go], token[go], at[go]
        return result

    def follows(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """May the token follow another, ``size`` standing for none?

        Answers are kept in a table of a fixed size, where a later one takes an earlier one's place.
        """
        if not hasattr(self, "seen"):
            self.seen = np.full(1 << TABLE_BITS, -1, dtype=np.int64)
            self.answer = np.zeros(1 << TABLE_BITS, dtype=bool)
        key = before * self.size + token
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        result = self.answer[slot]
        new = np.flatnonzero(self.seen[slot] != key)
        if len(new):
            pairs, back = np.unique(key[new], return_inverse=True)
            found = self._transitions(self.target[pairs // self.size], pairs % self.size)
            result[new] = found[back]
            self.seen[slot[new]], self.answer[slot[new]] = key[new], found[back]
        return result

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The longest suffix in the trie after one more byte."""
        node, at = node.copy(), np.arange(len(node))
        while len(at):
            key = node[at] << 8 | byte[at]
            place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            found = self.edge[place] == key
            node[at[found]] = self.child[place[found]]
            at = at[~found]
            node[at] = self.fail[node[at]]
        return node

    def paths(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the only path that spells each word, and their number; no word is empty.

        All words advance together, a byte at a time.  Of the tokens that end at a byte, from the
        longest on, the one that may follow the token before it is on the path of what was read.
        """
        size = np.array([len(w) for w in words], dtype=np.int64)
        text = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        offset = np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")
        first, size = offset[order], size[order]
        last, node = np.empty(len(text), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        for i in range(size[0] if len(size) else 0):
            active = np.searchsorted(-size, -i)  # words with more than i bytes
            at = first[:active] + i
            node = self._step(node[:active], text[at])
            token = self.longest[node]
            left = np.arange(active)
            while len(left):
                own, here = token[left], at[left]
                length = self.length[own]
                before = np.where(length > i, self.size, last[np.maximum(here - length, 0)])
                left = left[~self.follows(before, own)]
                token[left] = self.shorter[token[left]]
            last[at] = token
        ends, at = np.zeros(len(text), dtype=np.int64), first + size - 1
        while len(at):
            ends[at] = 1
            at = at - self.length[last[at]]
            inside = at >= first
            at, first = at[inside], first[inside]
        counts = np.add.reduceat(ends, offset) if len(offset) else ends
        return last[ends == 1], counts


class _Numbers(dict):
    """Numbers things as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Codec:
    """Encodes and decodes texts with the tokenizer in a file of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        byte = {c: b for b, c in enumerate(byte_characters())}
        raw = lambda token: bytes(byte[c] for c in token)
        model = settings["model"]
        vocabulary = {raw(text): token for text, token in model["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.automaton = Automaton(vocabulary, [(raw(a), raw(b)) for a, b in pairs])
        self.special = {t["content"]: t["id"] for t in settings["added_tokens"]}
        self.labels = {token: text for text, token in vocabulary.items()}
        self.labels |= {token: text.encode() for text, token in self.special.items()}

    @cached_property
    def cut(self) -> regex.Pattern:
        return regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text.

        Every distinct run of pre-split words is split once, every distinct word takes its path
        once, all together; ids are then put together by number.
        """
        numbers = _Numbers()
        of_texts = [self._pieces(text, numbers) for text in texts]
        piece_ids, piece_size = self._encode_pieces([p for p in numbers])
        piece_first = np.cumsum(piece_size) - piece_size
        result = []
        for pieces in of_texts:
            own = np.array(pieces, dtype=np.int64)
            result.append(piece_ids[_gathered(piece_first[own], piece_size[own])])
        return result

    def _pieces(self, text: str, numbers: _Numbers) -> list[int]:
        """Numbers of the runs of whole pre-split words, and of special tokens, that make the text."""
        if not any(content in text for content in self.special):
            return [numbers[piece] for piece in self._runs(text)]
        pieces, start = [], 0
        for found in self.cut.finditer(text):
            pieces += [numbers[piece] for piece in self._runs(text[start : found.start()])]
            pieces.append(numbers[self.special[found.group()]])
            start = found.end()
        return pieces + [numbers[piece] for piece in self._runs(text[start:])]

    @staticmethod
    def _runs(text: str) -> list[str]:
        """A space after a character that is no white space always begins a pre-split word."""
        first, *others = text.split(" ")
        if not _SPACED.search(text):
            return [first, *[" " + other for other in others]] if text else []
        runs, held = [], ""
        for piece in [first, *[" " + other for other in others]]:
            held += piece
            if held and not held[-1].isspace():
                runs.append(held)
                held = ""
        return [*runs, held] if held else runs

    def _encode_pieces(self, pieces: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct runs of words, and how many each has; a number is a special token."""
        words = _Numbers()
        parts: list[list[int]] = [[]] * len(pieces)
        plain = []
        for n, piece in enumerate(pieces):
            if isinstance(piece, int):
                parts[n] = [-1 - piece]
            elif piece[0].isspace() and (piece[0] != " " or piece[1:2].isspace()) or piece[-1].isspace():
                parts[n] = [words[w] for w in SPLIT.findall(piece)]
            else:
                plain.append(n)
        # Runs that begin with a letter or one space, and end in no space, split alike with a line
        # end between: they are split in one go.
        whole = "\n".join([pieces[n] for n in plain])
        split = SPLIT.findall(whole)
        start = np.cumsum([0, *map(len, split)])[:-1]
        size = np.array([len(pieces[n]) for n in plain], dtype=np.int64)
        begin = np.cumsum(size + 1) - size - 1
        own = np.searchsorted(begin, start, "right") - 1
        inside = start < begin[own] + size[own] if len(own) else np.zeros(0, dtype=bool)
        number = np.array([words[w] for w in split], dtype=np.int64)[inside]
        counts = np.zeros(len(pieces), dtype=np.int64)
        counts[plain] = np.bincount(own[inside], minlength=len(plain))
        others = [n for n, part in enumerate(parts) if part]
        counts[others] = [len(parts[n]) for n in others]
        first = np.cumsum(counts) - counts
        of_piece = np.empty(counts.sum(), dtype=np.int64)
        of_piece[_gathered(first[plain], counts[plain])] = number
        for n in others:
            of_piece[first[n] : first[n] + counts[n]] = parts[n]
        # The ids of the words that came up, then those of special tokens.
        known = [w for w in words if w != "\n" or words[w] in of_piece]
        ids, n_ids = self._encode_words(words)
        special = sorted(self.special.values())
        ids = np.concatenate([ids, np.array(special, dtype=np.int64)]).astype("<u4")
        n_ids = np.concatenate([n_ids, np.ones(len(special), dtype=np.int64)])
        place = {token: len(words) + i for i, token in enumerate(special)}
        for at in np.flatnonzero(of_piece < 0).tolist():
            of_piece[at] = place[-1 - of_piece[at]]
        id_first = np.cumsum(n_ids) - n_ids
        per_word = n_ids[of_piece]
        sums = np.concatenate([[0], np.cumsum(per_word)])
        return ids[_gathered(id_first[of_piece], per_word)], sums[first + counts] - sums[first]

    def _encode_words(self, words: _Numbers) -> tuple[np.ndarray, np.ndarray]:
        return self.automaton.paths([w.encode() for w in words])

    def decode(self, ids: np.ndarray) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in ids.tolist()]).decode("utf-8", "replace")


@cache
def codec(path: str) -> Codec:
    """The codec of a file, made once in each process."""
    return Codec(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _shared(rows: DataFrame, path: str | None) -> Broadcast[Codec]:
    """The codec, compiled and sent to the workers: a few MB, whatever the texts; the driver keeps none."""
    return rows.sparkSession.sparkContext.broadcast(Codec(path or default_path()))


_DIGESTS = "n_tokens long, ids_sha256 string, decoded string, decoded_sha256 string"


def _ids_of(coder: Codec, batch: pa.RecordBatch) -> list[np.ndarray]:
    return coder.encode_all([t or "" for t in batch.column("text").to_pylist()])


def _token_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids).astype("<i4")))


def _digests(coder: Codec, ids: list[np.ndarray]) -> list[pa.Array]:
    """Number of tokens, digest of the ids, the text they spell and its digest."""
    texts = [coder.decode(i) for i in ids]
    return [
        pa.array([len(i) for i in ids], pa.int64()),
        pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
        pa.array(texts, pa.string()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
    ]


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """The documents with the tokens of their texts, ``ids array<int>``.

    ``path`` is a tokenizer file; it is read in the driver.
    """
    rows = documents.drop("ids")
    coder = _shared(rows, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _ids_of(coder.value, batch)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, _token_lists(ids)], names=[*batch.schema.names, "ids"]
        )

    return map_arrow(rows, run, with_fields(rows, "ids array<int>"), slices=sliced_by_bytes("text", BATCH_BYTES))


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """The rows with ``decoded``, the text that ``ids`` spell, and digests of both.

    ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the text in UTF-8).  Null ids are none.
    """
    rows = tokens.drop("n_tokens", "ids_sha256", "decoded", "decoded_sha256")
    coder = _shared(rows, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = batch.column("ids").flatten().to_numpy(zero_copy_only=False)
        ids = np.split(flat, np.cumsum(lengths)[:-1])
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *_digests(coder.value, ids)],
            names=[*batch.schema.names, "n_tokens", "ids_sha256", "decoded", "decoded_sha256"],
        )

    return map_arrow(rows, run, with_fields(rows, _DIGESTS), 512)


def round_trip(documents: DataFrame, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one step of one worker, without ``text`` and ``decoded``.

    The decoded texts stay in the worker; with ``keep_ids=False`` the ids do too.
    """
    added = ["ids"] * keep_ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
    rows = documents.drop("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")
    coder = _shared(rows, path)
    kept = [name for name in rows.columns if name != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _ids_of(coder.value, batch)
        count, digest, _, decoded = _digests(coder.value, ids)
        own = [_token_lists(ids)] * keep_ids + [count, digest, decoded]
        return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *own], names=[*kept, *added])

    digests = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema = with_fields(rows.drop("text"), "ids array<int>, " * keep_ids + digests)
    return map_arrow(rows, run, schema, slices=sliced_by_bytes("text", BATCH_BYTES))
