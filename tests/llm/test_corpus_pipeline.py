"""The pipeline, stage by stage, against what each stage promises for its own input."""

import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from spendlake.llm import bpe, mixing, queries
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean texts, junk, copies, near copies and a text without id, with labels for half."""
    base = tmp_path_factory.mktemp("corpus")
    rows, labels = [], []
    for i in range(120):
        rows.append((i, sentence(80 + i % 30, seed=i), "en", f"s{i % 3}", 0))
        labels.append((i, 1, 0))
    for i in range(120, 160):
        rows.append((i, " ".join(w + "$$$" for w in sentence(60, seed=i).split()), "en", "s0", 0))
        labels.append((i, 0, 0))
    for i in range(160, 170):
        rows.append((i, rows[i - 160][1], None, None, None))
    for i in range(170, 180):
        words = rows[i - 150][1].split()
        words[40] = "edited"
        rows.append((i, " ".join(words), "en", "s1", 0))
    rows += [(None, sentence(90, seed=500), "en", "s2", 0), rows[3], (180, None, "en", "s2", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What goes into and comes out of each stage, collected."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results, columns = [docs.collect()], docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stored(stage(spark, docs, folder))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        results.append(docs.collect())
    return results


def test_junk_goes_and_clean_documents_stay(stages):
    kept = {r["doc_id"] for r in stages[1]}
    assert set(range(120)) <= kept and not kept & set(range(120, 160)) and None in kept


def test_one_of_equal_texts_stays(stages):
    largest = defaultdict(lambda: None)
    for r in stages[1]:
        ids = [i for i in (largest[r["text"] or ""], r["doc_id"]) if i is not None]
        largest[r["text"] or ""] = max(ids, default=None)
    assert Counter((r["text"] or "", r["doc_id"]) for r in stages[2]) == Counter(largest.items())


def test_one_of_near_copies_stays(stages):
    sets = [
        (r["doc_id"], {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
        for r in stages[2]
        for w in [(r["text"] or "").lower().split()]
    ]
    gone = {
        i
        for i, a in sets
        for j, b in sets
        if a and i is not None and j is not None and j < i and 100 * len(a & b) >= 80 * len(a | b)
    }
    assert len(gone) == 10
    assert {r["doc_id"] for r in stages[3]} == {i for i, _ in sets} - gone


def test_the_mix_meets_its_targets(stages):
    size, taken = Counter(), Counter()
    for r in stages[3]:
        size[r["source"]] += len((r["text"] or "").split())
    for r in stages[4]:
        taken[r["source"]] += len(r["text"].split())
    weights = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), (3, 1, 2, 3)))
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) < 4 * 128
    assert all(taken[s] <= 2 * size[s] for s in size) and len(weights) >= 3
    whole = {(r["doc_id"], r["text"]) for r in stages[3]}
    assert any((r["doc_id"], r["text"]) in whole for r in stages[4])


def test_tokens_spell_the_texts(stages):
    coder = bpe.codec(bpe.default_path())
    texts = Counter((r["doc_id"], r["text"]) for r in stages[4])
    spelt = Counter((r["doc_id"], coder.decode(np.array(r["ids"]))) for r in stages[5])
    assert texts == spelt and all(r["n_tokens"] == len(r["ids"]) for r in stages[5])


def test_run_applies_all_stages(spark, folder, stages):
    rows = corpus_pipeline.run(spark, folder).collect()
    key = lambda r: (r["doc_id"], r["ids_sha256"])
    assert Counter(map(key, rows)) == Counter(map(key, stages[-1]))


def test_an_empty_table_gives_no_rows(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert queries.ORACLES.items() <= entry.oracle_sql().items()


CLASHING = (
    "score predicted _text _words _id _print _size _taken _ranges number first turn row_key node root kept "
    "component_id text_key size target source_size block start end slot shard"
).split()


def test_own_columns_and_rows_without_ids_go_through(spark, folder, tmp_path):
    """Columns named as inner ones keep their values; rows with null or equal ids are not mixed up."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    more = [
        (None, sentence(300, seed=900), "en", "s0", 1),
        (None, sentence(300, seed=901), "en", "s0", 1),
        (None, sentence(300, seed=902), "en", "s1", 1),
        (7, sentence(300, seed=903), "en", "s1", 1),
        (7, sentence(300, seed=904), "en", "s1", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = docs.unionByName(spark.createDataFrame(more, schema))
    print_ = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("doc_id", "source", "text")])
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} of "), F.md5(print_)) for name in CLASHING})
    columns, given = docs.columns, Counter()
    own = lambda r: tuple(r[c] for c in CLASHING)
    before = {own(r): r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder))
        assert docs.columns == columns, name
        rows = docs.collect()
        given[name] = len(rows)
        for r in rows:
            source = before[own(r)]
            assert (r["doc_id"], r["source"], r["lang"]) == (source["doc_id"], source["source"], source["lang"])
            if name != "mixing sources":
                assert r["text"] == source["text"]
            else:
                words, whole = r["text"].split(), source["text"].split()
                assert words and set(words) <= set(whole) and len(words) <= len(whole), "words of its own text"
    assert all(given.values())


def test_equal_rows_each_have_their_share(spark):
    rows = [(1, sentence(400, seed=31), "a")] * 3 + [(1, sentence(400, seed=32), "a"), (None, None, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(2)
    settings = {"share": 1.0, "most": 1.0, "block_words": 16, "shard_blocks": 8}
    got = Counter(r["text"] for r in mixing.mixed_documents(frame, **settings).collect())
    assert got == Counter(t for _, t, _ in rows if t)


def test_a_stage_takes_the_place_of_the_one_before(spark, folder, monkeypatch):
    """What a stage kept is deleted when the next one is written; the input stays."""
    tables, write = [], corpus_pipeline.stored

    def remember(rows):
        tables.append(write(rows))
        return tables[-1]

    def shorter(spark, docs, folder):
        return docs.where("doc_id IS NOT NULL").where(F.col("doc_id") % 7 != len(tables))

    monkeypatch.setattr(corpus_pipeline, "stored", remember)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(n), shorter) for n in range(4)])
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == {n for n in range(181) if n % 7 > 3}
    assert [os.path.exists(t._scratch_folder) for t in tables] == [False, False, True]
    assert spark.read.parquet(f"{folder}/documents.parquet").count() == 183
