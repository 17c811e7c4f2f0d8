from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from drapekit.llm import suffix_dedup as op
from tests.llm.helpers import SCHEMA, frame, prose


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def corpus():
    rng = random.Random(5)
    passage, other = prose(1, 90), prose(2, 120)
    texts = [None, "", "short", "a" * 700, "ab" * 300, prose(3, 400)]
    for k in range(12):
        texts.append(prose(10 + k, 60) + " " + passage[k : 300 + 5 * k] + " " + prose(40 + k, 50))
    near = list(prose(99, 300))
    for k in range(6):
        edited = list(near)
        for _ in range(k):
            edited[rng.randrange(len(edited))] = "#"
        texts.append("".join(edited))
    texts += [other, other, other + "é" + other, prose(3, 400), passage[:199], passage[:200], "日本" * 200]
    return texts


@pytest.mark.parametrize("length,group", [(200, 8192), (200, 2), (131, 3)])
def test_matches_brute_force(spark, monkeypatch, length, group):
    monkeypatch.setattr(op, "GROUP", group)
    texts = corpus()
    got = {r.doc_id: tuple(r)[1:] for r in op.suffix_dedup(frame(spark, texts), length=length).collect()}
    want = brute(texts, length)
    assert [got[k] for k in range(len(texts))] == want
    assert sum(w[1] for w in want) > 2000


def test_long_texts_in_pieces():
    import numpy as np

    text = np.frombuffer(prose(4, 60000).encode(), np.uint8)
    whole = op._runs(text, np.array([0, len(text)]), 200)
    starts = set()
    for _, shift, piece, cuts in op._pieces(np.tile(text, 8), np.array([0, 8 * len(text)]), 200):
        first, last, _ = op._runs(piece, cuts, 200)
        for a, b in zip(first + shift, last + shift):
            starts.update(range(a, b + 1))
    assert starts == set(range(8 * len(text) - 199))
    assert sum(whole[1] - whole[0] + 1) == len(text) - 199


def test_repeated_rows_null_ids_and_empty(spark):
    t = prose(8, 100)
    rows = [(1, t), (1, t), (1, "other " + prose(9, 80)), (None, t), (None, None)]
    df = spark.createDataFrame([(i, x, "en", "s", 1, "k", 1) for i, x in rows], SCHEMA)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in op.suffix_dedup(df).collect())
    n = len(t)
    assert got == sorted([(False, 1, n, n), (False, 1, n, n), (False, 1, len(rows[2][1]), 0), (True, 0, n, n), (True, 0, 0, 0)])
    assert op.suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_without_repeats_keeps_the_columns(spark):
    texts = corpus()
    df = frame(spark, texts)
    out = op.without_repeats(df)
    assert out.columns == df.columns
    want = {}
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    for k, b in enumerate(raw):
        gone = {i + j for i in range(len(b) - 199) if seen[b[i : i + 200]] > 1 for j in range(200)}
        want[k] = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == want
    assert all((r.lang, r.key, r.id) == ("en", "key", 7) for r in rows)
