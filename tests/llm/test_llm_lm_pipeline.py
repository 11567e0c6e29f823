import collections
import math
import random
import re

import numpy as np
import pytest
from llm_cases import FOLDER, documents, frame, given, remainder, write_tables
from pyspark.sql import functions as F

import corpus_pipeline
from tunedata.llm import lm, stages
from tunedata.llm.common import id_remainder
from tunedata.llm.queries import default_tokenizer, llm_oracles, llm_queries


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower()) + [b""]


def check(rows, found):
    counts = collections.Counter(t for r in rows if remainder(r[0], 7) != 2 for t in tokens(r[1]))
    total, norm = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    expected = collections.Counter()
    for row in rows:
        own = tokens(row[1])
        base = sum(math.log10((counts[t] + 1) / norm) for t in own)
        known = sum(counts[t] > 0 for t in own)
        expected[row[0], remainder(row[0], 7) == 2, len(own), known, total, round(base, 5)] += 1
    assert expected == collections.Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found
    )


@pytest.mark.parametrize("head", [1 << 16, 50])
def test_scores(spark, head):
    rows = documents()
    found = lm.score(frame(spark, rows), id_remainder(7) == 2, head=head, samples=2, burn_in=1).collect()
    check(rows, found)
    assert all(r.score < 0 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = lm.score(frame(spark, rows, 2), id_remainder(7) == 2, head=head, samples=2, burn_in=1).collect()
    one, two = (sorted((str(r.doc_id), r.score) for r in x) for x in (found, again))
    assert [k for k, _ in one] == [k for k, _ in two]
    assert np.allclose([s for _, s in one], [s for _, s in two])


def test_scores_without_rows_or_training(spark):
    assert lm.score(frame(spark, []), id_remainder(7) == 2).collect() == []
    rows = [r for r in documents() if remainder(r[0], 7) == 2]
    found = lm.score(frame(spark, rows), id_remainder(7) == 2).collect()
    assert len(found) == len(rows) and all(r.train_tokens == 0 and r.n_known == 0 for r in found)


def test_a_sweep_adds_customers_up_once(monkeypatch):
    """each floor's customers once per sweep and note, probabilities only where there are customers."""
    random = np.random.default_rng(4)
    floors = lm.Floors(random.poisson(0.4, (8, 60)) * random.integers(1, 90, (8, 60)))
    calls = []
    merged = lm.Floors.merged
    monkeypatch.setattr(lm.Floors, "merged", staticmethod(lambda low: calls.append(1) or merged(low)))
    totals = None
    for turn in range(3):
        row = {"sums": lm.pack_arrays([0], [floors.sums()]).column(1)[0].as_py()}
        totals = lm._totals([row], 8, 60, totals.discounts if totals else None)
        for floor, cells in enumerate(floors.cells()):
            place, dish = np.divmod(cells, 60)
            whole = floors.predictive(totals)[floor]
            assert floors.predictive_at(totals, floor, place, dish).tolist() == whole.flat[cells].tolist()
        calls.clear()
        floors.sweep(totals, np.random.default_rng(turn))
        floors.sums(), floors.pack()
        assert len(calls) == 1
        low, middle, _ = floors.tables
        assert (floors.eaten(1) == low.reshape(4, 2, 60).sum(axis=1)).all()
        assert (floors.eaten(2)[0] == middle.sum(axis=0)).all()
        again = lm.Floors.unpack(floors.leaves, floors.pack())
        assert all((a == b).all() for a, b in zip(again.tables + again.customers, floors.tables + floors.customers, strict=True))


def test_predictive_probabilities_sum_to_one():
    random = np.random.default_rng(2)
    leaves = random.poisson(0.7, (8, 40)) * random.integers(1, 60, (8, 40))
    floors = lm.Floors(leaves)
    totals = None
    for turn in range(4):
        row = {"sums": lm.pack_arrays([0], [floors.sums()]).column(1)[0].as_py()}
        totals = lm._totals([row], 8, 40, totals.discounts if totals else None)
        for level in floors.predictive(totals):
            assert np.allclose(level.sum(axis=1), 1) and (level > 0).all()
        for customers, tables in zip(floors.customers, floors.tables, strict=True):
            assert ((tables >= (customers > 0)) & (tables <= customers)).all()
        floors.sweep(totals, np.random.default_rng(turn))


def test_unknown_words_are_one_symbol(spark):
    """Invented words score below any text of known ones, and the gain over the base is not theirs."""
    rows = [(r[0], r[1], "en", "s", 1, *"abcdefg") for r in given()]
    known = [r for r in rows if remainder(r[0], 7) != 2]
    words = " ".join(r[1] for r in known[:40]).split()
    draw = random.Random(3)
    probes = {
        9001: " ".join(words[200:212]),
        9002: " ".join(f"qz{draw.randrange(10**9)}x" for _ in range(12)),
        9003: " ".join(words[200:206] + [f"qz{draw.randrange(10**9)}x" for _ in range(6)]),
    }
    docs = frame(spark, rows + [(k, t, "en", "s", 1, *"abcdefg") for k, t in probes.items()])
    held = (id_remainder(7) == 2) | (F.col("doc_id") > 9000)
    for head in (50, lm.HEAD):
        found = {r.doc_id: r for r in lm.score(docs, held, head=head).collect()}
        real, invented, half = (found[k] for k in (9001, 9002, 9003))
        assert real.n_known == 13 and invented.n_known == 1 and half.n_known == 7
        assert invented.score < half.score < real.score
        # The unknown symbol is about as rare as a word seen once.
        assert invented.score / 13 < -3
        held_rows = [r for r in found.values() if r.held_out and r.doc_id < 9000]
        whole = [r for r in held_rows if r.n_known == r.n_tokens and r.n_tokens > 20]
        assert len(whole) >= 2 and (head < lm.HEAD or sum(r.score for r in whole) > sum(r.base_score for r in whole))
        trained = [r for r in found.values() if not r.held_out]
        mean = [sum(r.score for r in rows) / sum(r.n_tokens for r in rows) for rows in (held_rows, trained)]
        assert mean[0] < mean[1]


def test_seating_follows_the_process():
    """Mean number of tables against customers seated one at a time."""
    random = np.random.default_rng(4)
    discount, opening, step, customers = 0.4, 1.5, 0.3, 60

    def plain():
        tables = 1
        for n in range(1, customers):
            new, old = opening + step * tables, n - discount * tables
            tables += random.random() < new / (new + old)
        return tables

    expected = np.mean([plain() for _ in range(3000)])
    shape = (3000,)
    found = lm.seat(np.full(shape, customers), np.full(shape, opening), np.full(shape, step), discount, random)
    assert abs(found.mean() - expected) < 0.05 * expected
    assert lm.seat(np.array([0, 1, 10**9]), np.full(3, 1e-12), np.full(3, 1e-12), 0.5, random).tolist() == [0, 1, 1]


def test_context_is_the_latest_anchor():
    words = np.array([5, 7, 9], np.uint64)
    vocabulary = lm.Vocabulary(words, np.array([3, 2, 1]), np.array([1, 0, 2]))
    dish, leaf = vocabulary.places(np.array([7, 5, 7, 8, 9, 9, 5], np.uint64))
    assert dish.tolist() == [1, 0, 1, 3, 2, 2, 0]
    # Leaf 2a + 1: anchor a stands directly before; 2a: further back; 0: none yet.
    assert leaf.tolist() == [0, 0, 3, 2, 2, 5, 5]


def test_pipeline(spark, tmp_path):
    folder = write_tables(spark, tmp_path / "tables")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [f for _, f in corpus_pipeline.STAGES] == [
        stages.language_stage,
        stages.near_duplicate_stage,
        stages.decontamination_stage,
        stages.mixing_stage,
        stages.token_stage,
    ]
    columns, seen = docs.columns, []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage{n}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs)
        assert n == 4 or docs.columns == columns, name
    texts = [[r.text for r in d.select("text").collect()] for d in seen[:4]]
    assert all(t and re.search(r"[^\W\d_]", t) for t in texts[0])
    assert len(set(texts[1])) == len(texts[1]) < len(texts[0]) <= docs.count() * 3
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert any(i in t for t in texts[1] for i in items)
    assert not any(i in t for t in texts[2] for i in items)
    assert set(texts[3]) <= set(texts[2])
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    lengths = collections.Counter(
        (r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in seen[3].collect()
    )
    assert collections.Counter((r.doc_id, r.n_tokens) for r in seen[4].collect()) == lengths
    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, run.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_pipeline_of_empty_tables(spark, tmp_path):
    folder = write_tables(spark, tmp_path / "tables", [])
    assert corpus_pipeline.run(spark, folder).collect() == []


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_queries_match_their_sql(spark, name):
    import duckdb

    for table in ("documents", "pages", "labels", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = llm_queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    expected = duckdb.sql(llm_oracles()[name]).df()
    assert sorted(expected.columns) == columns
    rows = found.toPandas()[columns].sort_values(columns).reset_index(drop=True)
    expected = expected[columns].sort_values(columns).reset_index(drop=True)
    assert len(rows) == len(expected) and (rows.astype(str) == expected.astype(str)).all().all()


def test_words_outside_the_head_are_dishes(spark):
    """Which words are broadcast changes no score, and rare words are scored by their contexts."""
    rows = documents()
    # "wolf" follows "the", "lamb" follows "of": equally rare, and told apart by their contexts only.
    rows += [(8000 + i, t, "en", "s", 1, *"abcdefg") for i in range(6) for t in ["see the wolf", "out of lamb"]]
    probes = {9001: "see the wolf", 9002: "see the lamb", 9003: "out of lamb", 9004: "out of wolf"}
    docs = frame(spark, rows + [(k, t, "en", "s", 1, *"abcdefg") for k, t in probes.items()])
    held = F.col("doc_id").isNotNull() & (F.col("doc_id") > 9000)
    scores = []
    for head in (0, 50, lm.HEAD):
        found = lm.score(docs, held, head=head, samples=2, burn_in=1).collect()
        scores.append(sorted((str(r.doc_id), r.n_known, r.score) for r in found))
        own = {r.doc_id: r.score for r in found}
        assert own[9001] > own[9002] and own[9003] > own[9004]
    for other in scores[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in scores[0]]
        assert np.allclose([r[2] for r in other], [r[2] for r in scores[0]], rtol=1e-5)


def test_model_rows_hold_a_distribution(spark):
    """Probabilities of all words and of the unknown one, per leaf, sum to one; rows and head agree."""
    texts = frame(spark, [r for r in documents() if r[1]]).select(F.col("text").cast("binary").alias("text"))
    counts = lm.count_words(texts)
    words = counts.count()
    vocabulary = lm._vocabulary(counts, words, 5)
    edges = lm._block_edges(counts, words)
    model, samples, head = lm.sample_contexts(texts, vocabulary, edges, words, 1, 2)
    unknown = samples.from_root @ samples.unknown
    assert np.allclose(head.sum(axis=0, dtype=float) + unknown, 1, atol=1e-6)
    leaves = spark.range(vocabulary.leaves).select(F.col("id").cast("int").alias("leaf"))
    rows = model.crossJoin(leaves).select("word", "leaf", lm._probability(samples).alias("p")).collect()
    place = {int(np.int64(w)): i for i, w in enumerate(vocabulary.words.view(np.int64))}
    assert len(rows) == words * vocabulary.leaves
    assert np.allclose([r.p for r in rows], [head[place[r.word], r.leaf] for r in rows], rtol=1e-4)
