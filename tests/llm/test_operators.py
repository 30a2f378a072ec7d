"""Every operator against a brute-force version, on a small table with all the odd cases."""

import hashlib
import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendlake.llm import (
    bpe,
    exact_dedup,
    lm_score,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    suffix_dedup,
)
from tests.llm.conftest import rows, sentence

ROWS = rows()


def counted(frame, *names):
    return Counter(tuple(r[n] for n in names) for r in frame.collect())


def words(text):
    return (text or "").encode().split()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_quality_statistics(documents):
    got = quality_rules.with_statistics(documents)
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        w = words(text)
        windows = defaultdict(list)
        for i in range(len(w) - 2):
            windows[tuple(w[i : i + 3])].append(i)
        repeated = {i + o for at in windows.values() if len(at) > 1 for i in at for o in range(3)}
        lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
        expected[
            (
                doc_id,
                len(w),
                sum(len(x.decode()) for x in w),
                sum(c in "#*$%&|<>" for c in text or ""),
                len(lines) - len(set(lines)),
                len(repeated),
            )
        ] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert counted(got, *names) == expected


def test_quality_collisions_take_the_exact_way(documents):
    texts = documents.where("text IS NOT NULL").select("text")
    w = quality_rules.words(F.col("text"))
    both = texts.where(F.size(w) >= 4).select(
        quality_rules.let(w, quality_rules._repeated_exactly).alias("a"),
        quality_rules.STATISTICS["n_repeat_words"](F.col("text")).alias("b"),
    )
    assert both.where("a <> b").count() == 0 and both.where("b > 0").count() > 1


def test_cascade_order_never_changes_the_verdict(documents):
    forward = quality_rules.quality_cascade(documents, quality_rules.RULES)
    backward = quality_rules.quality_cascade(documents, quality_rules.RULES[::-1])
    verdict = F.col("rejected_by").isNull().alias("kept")
    assert counted(forward.select("doc_id", verdict), "doc_id", "kept") == counted(
        backward.select("doc_id", verdict), "doc_id", "kept"
    )
    kept = {r["doc_id"] for r in forward.where(verdict).collect()}
    assert {1, 2, 10, 11} <= kept and not kept & {4, 5, 6, 7, 12, 13}
    assert "rejected_by" in forward.columns and "lang" in forward.columns
    reported = quality_rules.judged_with_statistics(documents).select("doc_id", verdict)
    assert counted(reported, "doc_id", "kept") == counted(forward.select("doc_id", verdict), "doc_id", "kept")


def components_of(percent):
    sets = []
    for doc_id, text, *_ in ROWS:
        w = words((text or "").encode().lower().decode())
        if len(w) >= 5:
            sets.append((doc_id, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))))
        else:
            sets.append((doc_id, frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(sets)):
        groups[top(i)].append(sets[i][0])
    result = Counter()
    for i, (doc_id, s) in enumerate(sets):
        ids = [x for x in groups[top(i)] if x is not None]
        least = min(ids) if ids else None
        result[(doc_id, len(s), least, doc_id == least)] += 1
    return result


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_near_duplicates(documents, percent):
    got = near_dedup.near_duplicates(documents, percent)
    assert counted(got, "doc_id", "n_shingles", "component_id", "kept") == components_of(percent)


@pytest.mark.parametrize("longest", [2, 64])
def test_near_duplicates_in_a_large_group(spark, monkeypatch, longest):
    """A chain of near copies whose ends differ, with short and with long posting lists."""
    monkeypatch.setattr(near_dedup, "SHORT_LIST", longest)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    texts = []
    base = sentence(150, seed=9).split()
    for n in range(60):
        base[(n * 7) % 150] = f"edit{n}"
        texts.append(" ".join(base))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for t in texts]
    parent = list(range(60))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame, 85).collect()}
    assert got == {i: top(i) for i in range(60)}


def test_suffix_dedup(documents):
    seen = Counter()
    for _, text, *_ in ROWS:
        data = (text or "").encode()
        seen.update(data[i : i + 200] for i in range(len(data) - 199))
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - 199):
            if seen[data[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        expected[(doc_id, len(data), int(gone.sum()), runs, sha(kept))] += 1
    got = suffix_dedup.repeated_bytes(documents)
    assert counted(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


def test_suffix_arrays_find_what_repeats_across_batches():
    family, rng = suffix_dedup.SuffixArrays(), np.random.default_rng(2)
    batches = [rng.integers(0, 400, n).astype(np.uint64) for n in (50, 3, 70, 1, 1, 200, 0, 9)]
    for batch in batches:
        family.add(batch, batch)
    keys = np.concatenate(batches)
    counts = Counter(keys.tolist())
    assert family.found().tolist() == [counts[k] > 1 for k in keys.tolist()]
    sizes = [len(level[0]) for level in family.levels]
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == len(sizes)


def test_substring_dedup(documents):
    first = {}
    for doc_id, text, *_ in ROWS:
        w = words(text)
        for i in range(len(w) - 49 if doc_id is not None else 0):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, doc_id), doc_id)
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if doc_id is not None and first[tuple(w[i : i + 50])] < doc_id:
                gone[i : i + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        expected[(doc_id, len(w), sum(gone), sha(kept))] += 1
    got = substring_dedup.repeated_passages(documents)
    assert counted(got, "doc_id", "n_words", "n_removed", "kept_sha256") == expected


def test_hot_grams_change_nothing(documents, monkeypatch):
    """With every gram hot, anchors meet by cover and windows one by one."""
    from spendlake.llm import windows

    plain = counted(substring_dedup.repeated_passages(documents), "doc_id", "kept_sha256")
    bytes_ = counted(suffix_dedup.repeated_bytes(documents), "doc_id", "kept_sha256")
    every = lambda docs, kind: np.sort(
        np.unique(
            np.concatenate(
                [
                    windows.anchors(windows.Prints(kind.symbols(r[1].encode())), kind.width, kind.gram)[0]
                    for r in ROWS
                    if r[1] and len(kind.symbols(r[1].encode())) >= kind.width and r[0] in (1, 2, 3, 9)
                ]
            )
        )
    )
    monkeypatch.setattr(windows, "_hot_grams", every)
    assert counted(substring_dedup.repeated_passages(documents), "doc_id", "kept_sha256") == plain
    assert counted(suffix_dedup.repeated_bytes(documents), "doc_id", "kept_sha256") == bytes_


def test_language_model(documents):
    training = documents.where(~lm_score.held_out(F.col("doc_id")))
    model, counts = lm_score.train(training, rounds=3)
    got = lm_score.score(documents, model, counts).collect()
    seen = Counter()
    for doc_id, text, *_ in ROWS:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2:
            seen.update([*(text or "").encode().lower().split(), None])
    total, types = sum(seen.values()), len(seen)
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(math.log10((seen[t] + 1) / (total + types + 1)) for t in tokens)
        expected[(doc_id, len(tokens), sum(seen[t] > 0 for t in tokens), total, round(base, 6))] += 1
    assert expected == Counter(
        (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got
    )
    assert all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_language_model_sums_to_one(documents):
    model, _ = lm_score.train(documents, rounds=2)
    model.prepare()
    assert np.allclose(np.exp(model.class_table).sum(axis=1), 1, atol=1e-4)
    contexts = np.array([0, 5, 70000 % lm_score._HISTORY**2])
    for group in (0, 1):
        inner = model.inner.log_probabilities(np.full(3, group), contexts)
        assert np.allclose(np.exp(inner).sum(axis=1), 1, atol=1e-4)


def test_language_model_keeps_its_size(documents, monkeypatch):
    rounds, gradients = [], lm_score._gradients
    monkeypatch.setattr(lm_score, "_gradients", lambda *a: rounds.append(1) or gradients(*a))
    model, _ = lm_score.train(documents)
    assert len(rounds) == 10
    contexts = np.arange(lm_score._HISTORY**2)
    for softmax, most in ((model.classes, 32), (model.inner, 200)):
        assert np.bincount(lm_score._pair_row(contexts, softmax.pair_rows)).max() <= most


def test_language_model_holds_few_texts_and_contexts_at_once(monkeypatch):
    decoded, utf8 = [], lm_score.utf8
    monkeypatch.setattr(lm_score, "utf8", lambda column: decoded.append(len(column)) or utf8(column))
    texts = [None, "", *[f"A {n} b" for n in range(1000)]]
    chunks = list(lm_score._chunks(pa.array(texts)))
    assert [words for chunk in chunks for words in chunk] == [words((t or "").lower()) for t in texts]
    assert sum(decoded) == len(texts) and max(decoded) <= 64
    softmax, contexts = lm_score.Softmax(2, 8, 32), np.arange(lm_score._HISTORY**2)
    for weights in softmax.weights:
        weights += np.random.default_rng(1).standard_normal(weights.shape).astype(np.float32)
    whole = softmax.log_probabilities(contexts % 2, contexts)[contexts, contexts % 32]
    tracemalloc.start()
    got = softmax.outcome_logs(contexts % 2, contexts, contexts % 32)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, whole) and peak < 20e6


def test_bpe_equals_the_library(documents):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    got = bpe.decode(bpe.encode(documents))
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert decoded == (text or "")
        expected[(doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode()))] += 1
    assert counted(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected
    assert got.where("decoded <> coalesce(text, '')").count() == 0 and "lang" in got.columns
    for keep_ids in (True, False):
        at_once = bpe.round_trip(documents, keep_ids=keep_ids)
        assert counted(at_once, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected
        assert not {"text", "decoded"} & set(at_once.columns) and ("ids" in at_once.columns) == keep_ids


def test_bpe_on_odd_words():
    tokenizers = pytest.importorskip("tokenizers")
    library, own = tokenizers.Tokenizer.from_file(bpe.default_path()), bpe.codec(bpe.default_path())
    rng = np.random.default_rng(3)
    alphabet = list("aaabcdeehino \n\t'sÅ²½१éß中😀.-!") + ["<|endoftext|>", "  ", "'ll", "\x85", "　"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet, size=rng.integers(1, 120)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    for text in ("a" * 3000, " " * 3000, "-=" * 2000, "\n" * 50 + "x", "", " ", "<|endoftext|>", "x" + " y" * 200_000):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    texts = ["", "one", " two  three ", "one two", "", "\x1f x\n\n y"] * 3
    together = own.encode_all(texts)
    assert [t.tolist() for t in together] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_automaton_tables_answer_as_the_gadgets():
    """The vectorised transitions, whatever the table has forgotten, against gadgets made anew."""
    automaton = bpe.codec(bpe.default_path()).automaton
    rng = np.random.default_rng(5)
    tokens = np.unique(automaton.longest[1:])
    before, after = rng.choice(tokens, 4000), rng.choice(tokens, 4000)
    found = automaton._transitions(automaton.target[before], after)
    table = bpe.Automaton.__new__(bpe.Automaton)
    table.__dict__.update(automaton.__getstate__())
    for _ in range(2):
        assert table.follows(before, after).tolist() == found.tolist()
    vocabulary = {bytes([c]): 10 + c for c in range(256)} | {b"a": 0, b"b": 1, b"ab": 2, b"aba": 3}
    small = bpe.Automaton(vocabulary, [(b"a", b"b"), (b"ab", b"a")])
    for word, path in ((b"ababa", [2, 3]), (b"abab", [2, 2]), (b"baab", [1, 0, 2]), (b"aba", [3])):
        ids, counts = small.paths([word])
        assert (ids.tolist(), counts.tolist()) == (path, [len(path)])


def test_mixture(documents):
    settings = {"block_words": 8, "shard_blocks": 16}
    mix = mixing.Mixture(documents, **settings)
    got = mix.taken().collect()
    sizes = Counter((r[0], len(words(r[1]))) for r in ROWS)
    assert Counter((r["doc_id"], r["size"]) for r in got) == sizes
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by_source = defaultdict(int)
    for r in got:
        by_source[(r["source_size"], r["target"])] += r["taken"]
    for (size, target), taken in by_source.items():
        assert abs(taken - target) <= 8 and target <= 2 * size
    assert math.isclose(sum(t for _, t in by_source), 1.5 * sum(n for _, n in sizes.elements()))
    again = mixing.Mixture(documents, **settings).taken().collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    slots = mix.slots.collect()
    full = Counter(s["shard"] for s in slots)
    assert sorted(full) == list(range(len(full))) and set(list(full.values())[:-1]) <= {16, len(slots) % 16}
    assert all(n <= 2 for n in Counter((s["number"], s["block"]) for s in slots).values())


def test_mixture_texts(documents):
    got = mixing.mixed_documents(documents, block_words=8)
    assert got.columns == documents.columns
    texts = defaultdict(set)
    for doc_id, text, *_ in ROWS:
        texts[doc_id].add(text)
    for r in got.collect():
        own = [set(words(t)) for t in texts[r["doc_id"]]]
        assert any(set(words(r["text"])) <= w for w in own) and r["n_chars"] == len(r["text"])


def test_waterfilling():
    assert mixing.targets([100, 100, 100], [3, 1, 2], 1.5, 2) == [200, 250 / 3, 500 / 3]
    assert mixing.targets([0, 10], [3, 1], 1.5, 2) == [0, 15]
    assert mixing.targets([], [], 1.5, 2) == []


def test_permutation_is_one():
    for n in (1, 2, 3, 10, 1000):
        images = mixing.permuted(np.arange(n), n, "k")
        assert sorted(images.tolist()) == list(range(n))
        assert n < 10 or images.tolist() != mixing.permuted(np.arange(n), n, "l").tolist()


def test_exact_groups(documents):
    groups = defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[text or ""].append(doc_id)
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        expected[(doc_id, keep, len(ids), doc_id == keep, sha((text or "").encode()))] += 1
    got = exact_dedup.exact_groups(documents)
    assert counted(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected
    left = exact_dedup.without_copies(documents)
    assert left.columns == documents.columns
    assert sorted((r["text"] or "") for r in left.collect()) == sorted(groups)


def test_exact_groups_despite_equal_fingerprints(spark, monkeypatch):
    """Chunks whose fingerprints collide are told apart by their bytes."""
    frame = spark.createDataFrame(
        [(1, "same text"), (2, "same text"), (3, "also nine"), (4, "also nine"), (5, "third one")],
        "doc_id long, text string",
    )
    recipes = spark.createDataFrame(
        [(i, 9, "x", [7]) for i in range(1, 6)],
        "doc_id long, n_bytes long, text_sha256 string, recipe array<long>",
    )

    chunk_rows = exact_dedup._chunk_rows

    def same_print(batch):
        found = chunk_rows(batch)
        columns = [found.column(0), found.column(1), pa.array([7] * found.num_rows), found.column(3)]
        return pa.RecordBatch.from_arrays(columns, names=found.schema.names)

    monkeypatch.setattr(exact_dedup, "_chunk_rows", same_print)
    got = exact_dedup.verified_recipes(frame, recipes)
    numbers = {r["doc_id"]: tuple(r["numbers"]) for r in got.collect()}
    assert numbers[1] == numbers[2] != numbers[3] == numbers[4] != numbers[5] != numbers[1]


def test_shards(documents):
    got = sharding.stratified_shards(documents.select("doc_id", "source", "text"), shards=4).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ROWS)
    sizes = Counter(r["shard"] for r in got)
    assert sorted(sizes) == [0, 1, 2, 3] and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    for source, n in Counter(r["source"] for r in got).items():
        inside = Counter(r["shard"] for r in got if r["source"] == source)
        assert all(abs(inside[s] - n / 4) <= 2 for s in range(4))


def test_classifier(spark, documents):
    good = [(i, sentence(80 + i % 40, seed=i), 1) for i in range(100, 300)]
    bad = [(i, " ".join(w + "$$$" for w in sentence(60, seed=i).split()), 0) for i in range(300, 400)]
    made = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, q) for i, _, q in good + bad] + [(None, 1), (100, None)], "doc_id long, quality int"
    )
    model = quality_classifier.fit(made, labels)
    taught = [i for i, _, _ in good + bad if i != 100 and zlib.crc32(str(i).encode()) % 5]
    assert len(model.labels) in (len(taught), len(taught) + 1)
    scored = quality_classifier.quality_scores(made, model).collect()
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 30
    assert all(r["predicted"] == (r["doc_id"] < 300) for r in held)
    odd = quality_classifier.quality_scores(documents, model).collect()
    assert len(odd) == len(ROWS) and all(0 <= r["score"] <= 1 for r in odd)
    assert odd[0]["lang"] in ("en", None) and isinstance(odd[0]["score"], float)
    none = quality_classifier.fit(made, labels.limit(0))
    assert {r["score"] for r in quality_classifier.quality_scores(made, none).collect()} == {1.0}


def test_classifier_knows_words(spark):
    """Good and bad words have the same lengths, endings and punctuation."""
    ends, rng = ("ned", "ted", "ing", "ers", "est"), np.random.default_rng(5)
    kinds = [[a + b for a in starts for b in ends] for starts in (("spa", "che", "vig"), ("gra", "ste", "plo"))]
    made = [(i, " ".join(rng.choice(kinds[i % 3 > 0], 60)), int(i % 3 > 0)) for i in range(1, 301)]
    frame = spark.createDataFrame(made, "doc_id long, text string, quality int")
    model = quality_classifier.fit(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    scored = quality_classifier.quality_scores(frame, model).collect()
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 30 and all(r["predicted"] == r["quality"] for r in held)


def test_classifier_knows_pairs():
    """The same words in all texts, paired otherwise."""
    rng = np.random.default_rng(7)
    pairs = [b"%c%c%c" % (97 + i, 97 + i, 97 + i) for i in range(20)]
    good = [b"%s %s" % p for p in zip(pairs[::2], pairs[1::2])]
    bad = [b"%s %s" % p for p in zip(pairs[1::2], [*pairs[2::2], pairs[0]])]
    made = [(b" ".join(rng.permutation(kind * 6).tolist()), label) for kind, label in ((good, 1), (bad, 0)) * 60]
    texts, labels = [t for t, _ in made], np.array([q for _, q in made])
    model = quality_classifier.Neighbours(texts[:80], labels[:80])
    found = model.scores(texts[80:], quality_classifier.Terms()) >= quality_classifier.THRESHOLD
    assert (found == labels[80:]).all()


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    results = [
        quality_rules.quality_cascade(empty),
        near_dedup.near_duplicates(empty),
        suffix_dedup.repeated_bytes(empty),
        substring_dedup.repeated_passages(empty),
        lm_score.score(empty, *lm_score.train(empty)),
        bpe.decode(bpe.encode(empty)),
        mixing.Mixture(empty).taken(),
        mixing.mixed_documents(empty),
        exact_dedup.exact_groups(empty),
        exact_dedup.without_copies(empty),
        sharding.stratified_shards(empty),
        quality_classifier.quality_scores(empty, quality_classifier.fit(empty, labels)),
    ]
    assert [r.count() for r in results] == [0] * len(results)


