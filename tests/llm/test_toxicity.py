from __future__ import annotations

import random
import zlib

import numpy as np

from drapekit.llm import toxicity as op
from tests.llm.helpers import SCHEMA

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n=1600, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        words = [f"w{min(rng.randrange(900), rng.randrange(900))}" for _ in range(rng.randrange(20, 120))]
        toxic = int(k % 8 == 0)
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(["Vile!", "nasty", f"grubb{rng.choice('aeiou')}{rng.choice('klmnp')}"])
        docs.append((k, " ".join(words), "en", "s", 1, "k", 1))
        labels.append((k, 1, toxic, "clash"))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    docs += [(5000, None, None, None, None, None, None), (5001, "", None, None, None, None, None), (None, "vile nasty", None, None, None, None, None), (7, docs[7][1], "x", "y", 1, "z", 1)]
    rows = op.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels + [(None, 1, 1, ""), (3, None, None, "")], LABELS)).collect()
    assert len(rows) == len(docs)
    truth = {r[0]: r[2] for r in labels}
    held = [r for r in rows if r.doc_id in truth and r.held_out]
    assert len(held) > 300 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    wrong = sum(r.predicted != truth[r.doc_id] for r in held)
    assert wrong <= 0.02 * len(held)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.doc_id is None:
            assert r.held_out is None and r.predicted == 1
    assert {r.score for r in rows if r.doc_id == 5000} == {r.score for r in rows if r.doc_id == 5001}


def test_same_scores_whatever_the_batches():
    docs, _ = corpus(50)
    rng = np.random.default_rng(1)
    raw = [d[1].encode() for d in docs]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    units, _ = op.words_of(data, offsets)
    vocab = np.unique(np.concatenate([units[-1][:300], units[0]]))
    v = len(vocab) + 2
    pair = np.sort(rng.choice(v * v, 5000, replace=False))
    model = op.Model(vocab, rng.normal(size=v - 1), rng.normal(size=v), pair, rng.normal(size=5000))
    whole = model.evidence(data, offsets)
    alone = [model.evidence(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0] for r in raw]
    assert np.allclose(whole, alone)


def test_lower_order_is_a_distribution():
    # root -> two stems -> words; log probabilities of all numbers add up to one
    parent = np.array([0, 0, 0, 1, 1, 2])
    level = np.array([0, 1, 1, 2, 2, 2])
    counts = [np.array([7, 3, 0, 50, 2, 9]), np.array([1, 0, 90, 0, 30, 12])]
    for p in op._lower_order(parent, level, counts, np.array([2.0, 1, 3, 9, 4, 2])):
        assert abs(np.exp(p).sum() - 1) < 1e-9


def test_labels_outside_the_rule_are_not_learned(spark):
    docs, labels = corpus(200)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t, x) for i, q, t, x in labels]
    df = spark.createDataFrame(docs, SCHEMA)
    a, b = ({r.doc_id: r.score for r in op.toxicity(df, spark.createDataFrame(x, LABELS)).collect()} for x in (labels, flipped))
    assert a == b


def test_empty_tables_and_one_class(spark):
    docs, labels = corpus(40)
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(docs, SCHEMA)
    assert op.toxicity(none, spark.createDataFrame(labels, LABELS)).count() == 0
    assert {r.score for r in op.toxicity(some, spark.createDataFrame([], LABELS)).collect()} == {0.0}
    assert {r.score for r in op.toxicity(some, spark.createDataFrame([r for r in labels if r[2]], LABELS)).collect()} == {1.0}


def test_very_long_text(spark):
    docs, labels = corpus(400)
    docs.append((9000, " ".join(d[1] for d in docs if d[0] % 8), "en", "s", 1, "k", 1))
    rows = {r.doc_id: r for r in op.toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(rows) == 401 and 0 <= rows[9000].score <= 1


def test_calibration_without_a_class_compares_likelihoods(spark):
    """All toxic documents in the folds that are counted: toxic words still score higher."""
    docs, labels = corpus(600)
    df = spark.createDataFrame(docs, SCHEMA)
    fold = {r.doc_id: r.f for r in df.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {op.FOLDS}) as f").collect()}
    labels = [r for r in labels if not (r[2] and fold[r[0]] == 0)]
    score = {r.doc_id: r.score for r in op.toxicity(df, spark.createDataFrame(labels, LABELS)).collect()}
    toxic = [score[i] for i, _, t, _ in labels if t]
    clean = [score[i] for i, _, t, _ in labels if not t]
    assert np.mean(toxic) > np.mean(clean) + 0.01 and max(clean) < 0.3


def test_every_unit_of_the_sample_is_in_the_model(spark):
    docs, labels = corpus(300)
    df, marks = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    model = op.learn(df, marks)
    fold = {r.doc_id: r.f for r in df.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {op.FOLDS}) as f").collect()}
    raw = [d[1].encode() for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2 and fold[d[0]]]
    units, _ = op.words_of(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    assert set(model.vocab.tolist()) == set(np.concatenate(units).tolist())
    assert len(op.learn(df, marks, max_bytes=20_000).vocab) < len(model.vocab)
