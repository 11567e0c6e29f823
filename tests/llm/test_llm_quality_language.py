import pytest
from llm_cases import FOLDER, frame, given, write_tables
from pyspark.sql import functions as F

from tunedata.llm import language, quality
from tunedata.llm.common import id_remainder
from tunedata.llm.queries import op3_quality, op7_language


def test_language_accuracy_on_held_out_rows(spark):
    truth = dict(given(columns="doc_id, lang"))
    found = [r for r in op7_language(spark, FOLDER).collect() if r.held_out]
    right = [r.lang_pred == truth[r.doc_id] for r in found]
    assert len(right) > 40 and sum(right) / len(right) >= 0.95
    accepted = [r.lang_pred == truth[r.doc_id] for r in found if r.accepted]
    assert len(accepted) / len(right) > 0.9 and sum(accepted) / len(accepted) >= 0.97


def test_language_of_odd_rows(spark, tmp_path):
    found = op7_language(spark, write_tables(spark, tmp_path)).collect()
    by_id = {r.doc_id: r for r in found}
    for doc in (1001, 1002, 1003, 1009, 1012):
        assert (by_id[doc].lang_pred, by_id[doc].score, by_id[doc].accepted) == ("und", 0.0, False)
    assert all(0 <= r.score <= 1 for r in found)
    assert by_id[1004].lang_pred in {"en", "de", "fr", "es"}


def test_language_ties_and_narrow_margins_are_rejected():
    import numpy as np

    best, score, margin = language.judge(np.array([50.0, 50.0, 80.0]))
    assert best == 0 and margin == 0 and 0.4 < score < 0.51
    assert language.judge(np.array([50.0])) == (0, 1.0, 1.0)


def test_language_without_training(spark):
    docs = frame(spark)
    assert language.learn_dictionaries(docs.filter("false")) == {}
    found = language.identify(docs, {}).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in found] == ["und"]
    assert language.identify(frame(spark, []), {"en": b"the and of"}).collect() == []


def test_dictionaries_are_bounded_and_repeatable(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    one = language.learn_dictionaries(docs, samples=5, piece=50)
    two = language.learn_dictionaries(docs.repartition(7), samples=5, piece=50)
    assert one == two and all(len(v) <= 5 * 50 * 4 for v in one.values())


def test_names_must_not_clash(spark):
    docs = frame(spark)
    with pytest.raises(ValueError):
        language.identify(docs, {}, names=("KEY", "a", "b"))
    with pytest.raises(ValueError):
        quality.with_statistics(docs, name="Size")


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [r for r in op3_quality(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in found) / len(found) >= 0.95
    good = [r.score for r in found if labels[r.doc_id]]
    bad = [r.score for r in found if not labels[r.doc_id]]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) >= 0.97


def test_quality_of_odd_rows(spark, tmp_path):
    found = op3_quality(spark, write_tables(spark, tmp_path)).collect()
    assert len(found) == frame(spark).count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


def test_quality_without_labels(spark):
    rows = quality.with_statistics(frame(spark).select("doc_id", "text"))
    empty = rows.filter("false").select("statistics", F.lit(1.0).alias("label"), F.lit(True).alias("fold"))
    assert quality.fit(empty) is None
    assert {r.s for r in quality.with_scores(rows, None, "statistics", "s").collect()} == {0.5}


def test_isotonic_is_monotone():
    import numpy as np

    random = np.random.default_rng(3)
    labels = random.random(200)
    knots, levels = quality.isotonic(np.arange(200.0), labels, np.ones(200))
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    # Pools of 3, 1 and 2, 2.
    knots, levels = quality.isotonic(np.array([1.0, 2, 3]), np.array([0.9, 0.1, 1.0]), np.ones(3))
    assert levels.tolist() == [0.5, 1.0] and knots.tolist() == [1.5, 3.0]


def test_hold_out_ignores_null_ids(spark):
    rows = spark.createDataFrame([(None,), (5,)], "doc_id bigint").select(id_remainder(4).alias("r")).collect()
    import zlib

    assert [r.r for r in rows] == [zlib.crc32(b"") % 4, zlib.crc32(b"5") % 4]
