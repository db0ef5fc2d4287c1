from __future__ import annotations

import zlib

import numpy as np
import pytest

from petitionlens.llm import toxicity as X

from corpus_cases import SF


@pytest.fixture(scope="module")
def model():
    r = np.random.default_rng(1)
    words = [f"w{i}" for i in range(800)]
    texts, toxic = [], []
    for i in range(900):
        t = list(r.choice(words, r.integers(20, 90)))
        bad = i % 4 == 0
        if bad:
            t.insert(int(r.integers(0, len(t))), f"nasty{r.integers(0, 50)}")  # forms share their beginning
        texts.append(X.buckets(" ".join(t).encode()))
        toxic.append(bad)
    m = X.train(texts[:600], np.array(toxic[:600]))
    X.calibrate(m, texts[600:], np.array(toxic[600:]))
    return m


def test_learns_words_and_their_forms(model):
    clean = " ".join(f"w{i}" for i in range(60))
    for bad in ("nasty7", "nasty999", "nastyish"):
        assert model.logit(X.buckets(f"{clean} {bad} w1 w2".encode())) > model.threshold[-1]
    assert model.logit(X.buckets(clean.encode())) < model.threshold[-1]


def test_stretches_give_the_value_of_the_whole(model, monkeypatch):
    ids = X.buckets((" ".join(f"w{i}" for i in range(500)) + " nasty3").encode())
    whole = model.pooled(ids)
    for size in (1, 2, 7, 100, 501):
        monkeypatch.setattr(X, "STRETCH", size)
        assert np.allclose(model.pooled(ids), whole, atol=1e-5)


def test_threshold_lies_between_the_classes():
    assert 1 < X.best_threshold(np.array([0.0, 1.0, 3.0, 4.0]), np.array([False, False, True, True])) < 3


def test_awkward_rows(spark, docs, empty, model):
    got = X.toxicity(docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    blank = {r.score for r in got if r.doc_id in (0, 1, 2)}
    assert len(blank) == 1  # null, empty and blank
    assert X.toxicity(empty, model).count() == 0


def test_without_labels_nothing_is_toxic(spark, docs):
    labels = spark.createDataFrame([(1, None), (2, 0), (None, 1)], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    assert model is None and {r.score for r in X.toxicity(docs, model).collect()} == {0.0}


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r.score, labels[r.doc_id]) for r in X.op8_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    score, toxic = np.array([s for s, _ in rows]), np.array([t for _, t in rows])
    assert ((score >= 0.5) == toxic).mean() > 0.97
    pos, neg = score[toxic == 1], score[toxic == 0]
    assert (pos[:, None] > neg[None, :]).mean() > 0.97


def test_every_labelled_row_of_the_fold_calibrates(spark):
    """A rare language gets its own threshold once the table has enough labels, however small the sample for the fit."""
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(4000):
        bad, spanish = i % 2 == 0, i % 10 < 2
        t = ["los", "las", "del"] if spanish else ["the", "of", "and"]
        t += list(r.choice(words, 12)) + ([f"nasty{r.integers(0, 9)}"] if bad else [])
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    m = X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), rows=60)
    common = m.threshold[X.LANGUAGES.index("other")]
    assert m.threshold[X.LANGUAGES.index("es")] != common != m.threshold[X.LANGUAGES.index("en")]
