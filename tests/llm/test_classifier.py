"""The classifier on held-out rows, and its score against the model written out."""

import zlib

import numpy as np
import pytest

from govlake.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_rows_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.predictions(docs, labels, 300).collect()}
    assert len(got) == docs.count()
    marked = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(got[r.doc_id].held_out for r in marked)
    right = [got[r.doc_id].predicted == r.quality for r in marked]
    assert np.mean(right) > .95
    zeros = [got[r.doc_id].predicted == 0 for r in marked if r.quality == 0]
    assert np.mean(zeros) > .85


def test_labels_of_held_out_rows_do_not_matter(spark, docs_of, prose):
    docs = docs_of(enumerate(prose), extra=True)
    rows = [(i, i % 2, 0) for i in range(len(prose))]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 1) for i, q, _ in rows]
    kind = "doc_id long, quality int, toxic int"
    a, b = (quality.predictions(docs, spark.createDataFrame([*x, (None, 1, 0), (1, None, 0), (2, 7, 0)], kind)).collect()
            for x in (rows, turned))
    assert [r.score for r in a] == [r.score for r in b]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in a)


def test_table_score_is_the_softmax_of_the_average(prose):
    rows = [(*quality.features(t), i % 2) for i, t in enumerate(prose)]
    model = quality.train(rows, epochs=1)
    words = quality._Words(model.table())
    for t in prose:
        buckets, counts = quality.features(t)
        logits = model.layer @ ((counts / counts.sum()) @ model.vectors[buckets])
        assert words.logit(t) == pytest.approx(logits[1] - logits[0], abs=1e-3)


def test_without_labels_and_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.predictions(docs_of([(1, "a"), (1, "a"), (None, None)]), none).collect()
    assert [r.score for r in rows] == [.5] * 3
    docs = docs_of([(1, "a"), (None, None)], extra=True)
    assert quality.keep_good(docs, none).columns == docs.columns
    assert quality.predictions(docs_of([]), none).collect() == []


def test_one_text_of_a_labelled_doc_id_is_learnt(spark, docs_of, prose, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows: seen.append(rows) or quality.Model(
        np.zeros((quality.BUCKETS, 2), np.float32), np.zeros((2, 2), np.float32)))
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    docs = [(0, t) for t in prose] + [(1, "a b"), (1, "a b")]
    quality.fit(docs_of(docs), labels, 3)
    quality.fit(docs_of(docs[::-1]), labels, 3)
    first, again = seen
    assert [x[2] for x in first] == [1, 0]
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(first, again, strict=True))


def test_small_memory_gives_the_same(monkeypatch, prose):
    table = quality.train([(*quality.features(t), i % 2) for i, t in enumerate(prose)], epochs=1).table()
    whole = quality._Words(table)
    monkeypatch.setattr(quality, "_REMEMBERED", 4)
    small = quality._Words(table)
    assert [small.logit(t) for t in prose] == pytest.approx([whole.logit(t) for t in prose])


def test_long_words_count_by_their_ngrams():
    a, b = "数字と文字" * 40, "ゆきのはら" * 40
    short = [w * 20 for w in ("数字と文字", "ゆきのはら")]
    model = quality.train([(*quality.features(t), i % 2) for i, t in enumerate(short * 10)], epochs=3)
    words = quality._Words(model.table())
    assert words.logit(a) < 0 < words.logit(b)
    assert words.logit(f"{a} {a}") == pytest.approx(quality._Words(model.table()).logit(f"{a} {a}"))
    assert all(len(k) <= quality._CHARS for k in words)
    long = "ab" * 100_000
    assert sum(map(len, quality.subwords(long))) == 1 + 2 * (len(long) + 2) - 5
    buckets, counts = quality.features(long)
    logits = model.layer @ ((counts / counts.sum()) @ model.vectors[buckets])
    assert words.logit(long) == pytest.approx(logits[1] - logits[0], abs=1e-3)


def test_training_stays_bounded_on_texts_of_few_features():
    """Texts that are one word again and again must not drive the vectors up without end."""
    rnd = np.random.default_rng(3)
    words = ["".join(rnd.choice(list("abcdefgh"), 4)) for _ in range(40)]
    rows = [(" ".join([words[i % 40]] * 30), 0) if i % 4 == 0 else (" ".join(rnd.choice(words, 12)), 1) for i in range(1200)]
    model = quality.train([(*quality.features(t), y) for t, y in rows], rate=30.0)
    assert np.isfinite(model.vectors).all() and np.abs(model.vectors).max() < 1e4 and np.isfinite(model.layer).all()
