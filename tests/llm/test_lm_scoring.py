from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from drapekit.llm import lm_scoring as op
from tests.llm.helpers import SCHEMA, frame, prose


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", low)


def slow(docs, target, word_share, pair_share):
    sides = [[words(t) for t in target], [words(t) for t in docs]]
    uni = [Counter(w for t in s for w in t) for s in sides]
    total = [sum(u.values()) for u in uni]
    vocab = {w for u, n in zip(uni, total) for w, c in u.items() if c >= word_share * n}
    cut = [[["<s>"] + [w if w in vocab else "<unk>" for w in t] for t in s] for s in sides]
    pairs = [Counter(p for t in s for p in zip(t, t[1:])) for s in cut]
    n_pairs = [sum(p.values()) for p in pairs]
    explicit = {p for c, n in zip(pairs, n_pairs) for p, k in c.items() if k >= pair_share * n}

    def loss(k, text):
        out = 0.0
        counts = Counter({w: uni[k][w] for w in vocab})
        counts["<unk>"] = total[k] - sum(counts.values())
        for u, w in zip(text, text[1:]):
            after = sum(n for p, n in pairs[k].items() if p[0] == u)
            taken = sum(max(pairs[k][p] - 0.75, 0) for p in explicit if p[0] == u)
            low = (counts[w] + 1) / (total[k] + len(vocab) + 1)
            p = (1 - taken / after if after else 1) * low
            if (u, w) in explicit and after:
                p += max(pairs[k][u, w] - 0.75, 0) / after
            out -= math.log(p)
        return out / (len(text) - 1)

    return [(len(t) - 1, loss(0, t), loss(1, t)) if len(t) > 1 else (0, 0.0, 0.0) for t in cut[1]]


@pytest.mark.parametrize("word_share,pair_share", [(2.0**-18, 2.0**-20), (0.01, 0.004)])
def test_matches_brute_force(spark, monkeypatch, word_share, pair_share):
    monkeypatch.setattr(op, "WORD_SHARE", word_share)
    monkeypatch.setattr(op, "PAIR_SHARE", pair_share)
    docs = [None, "", "!!", "One two, ONE two.", "É é 日本"] + [prose(k, 30, 40) for k in range(25)]
    target = [prose(100 + k, 20, 15) for k in range(10)] + [None, "one two"]
    rows = op.lm_scores(frame(spark, docs), frame(spark, target)).collect()
    want = slow(docs, target, word_share, pair_share)
    assert len(rows) == len(docs)
    for r in rows:
        n, t, b = want[r.doc_id]
        assert r.n_words == n
        assert (r.target_loss, r.background_loss, r.score) == pytest.approx((t, b, t - b), abs=1e-9)


def test_target_like_documents_score_lower(spark):
    docs = [prose(k, 60, 30) for k in range(20)] + [prose(k, 60, 2000) for k in range(20)]
    rows = {r.doc_id: r.score for r in op.lm_scores(frame(spark, docs), frame(spark, [prose(50 + k, 60, 30) for k in range(20)])).collect()}
    assert max(rows[k] for k in range(20)) < min(rows[k] for k in range(20, 40))


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b", "", "", 1, "", 1), (1, "a", "", "", 1, "", 1), (1, "a", "", "", 1, "", 1)], SCHEMA)
    none = spark.createDataFrame([], SCHEMA)
    assert sorted((r.doc_id or 0, r.n_words) for r in op.lm_scores(df, none).collect()) == [(0, 2), (1, 1), (1, 1)]
    assert op.lm_scores(none, df).count() == 0


def test_very_long_text_counts_like_its_parts(spark):
    parts = [prose(k, 2000) for k in range(30)]
    (long,) = op.lm_scores(frame(spark, [" ".join(parts)]), frame(spark, parts)).collect()
    assert long.n_words == 60_000 and abs(long.target_loss - long.background_loss) < 0.01


def whole(docs, target, asked):
    """Losses of some texts by all counts of both collections."""
    sides = [[["<s>", *words(t)] for t in s] for s in (target, docs)]
    pairs = [Counter(p for t in s for p in zip(t, t[1:])) for s in sides]
    vocab = len({w for c in pairs for _, w in c})
    out = []
    for text in (["<s>", *words(t)] for t in asked):
        loss = []
        for c in pairs:
            total, value = sum(c.values()), 0.0
            for u, w in zip(text, text[1:]):
                after = sum(n for p, n in c.items() if p[0] == u)
                left = 1 - sum(n - 0.75 for p, n in c.items() if p[0] == u) / after if after else 1
                low = (sum(n for p, n in c.items() if p[1] == w) + 1) / (total + vocab + 1)
                value -= math.log(max(c[u, w] - 0.75, 0) / max(after, 1) + left * low)
            loss.append(value / max(len(text) - 1, 1))
        out.append((len(text) - 1, *loss))
    return out


@pytest.mark.parametrize("frequent", [2.0**-20, 1e-4, 2.0])
def test_rare_words_and_pairs_are_in_the_model(spark, monkeypatch, frequent):
    """Over 2 ** 18 words, where a share of 2 ** -18 would leave out words that occur once."""
    monkeypatch.setattr(op, "FREQUENT_PAIR", frequent, raising=False)
    monkeypatch.setattr(op, "FREQUENT_WORD", 4 * frequent, raising=False)
    docs = ["alpha beta", "gamma beta", None, "w1 w2 w3 alpha"] + [prose(k, 9_000, 60) for k in range(30)]
    target = ["alpha beta alpha"]
    rows = {r.doc_id: r for r in op.lm_scores(frame(spark, docs), frame(spark, target)).collect()}
    for k, (n, t, b) in enumerate(whole(docs, target, docs[:4])):
        assert rows[k].n_words == n
        assert (rows[k].target_loss, rows[k].background_loss) == pytest.approx((t, b), abs=1e-9)
    assert rows[0].score < rows[1].score


@pytest.mark.parametrize("route", [1_000, 7])
def test_many_chunks_and_routes_hold_one_frequent_pair(spark, monkeypatch, route):
    """Each partition is a chunk; "the cat" is in all of them, most routes answer several chunks."""
    monkeypatch.setattr(op, "ROUTE", route)
    docs = ["the cat " * (k % 5 + 1) + prose(k, 12, 30) for k in range(120)] + [None, "", "the cat"]
    target = ["the cat sat", None, *[prose(500 + k, 8, 30) for k in range(20)]]
    out = op.lm_scores(frame(spark, docs).repartition(9), frame(spark, target).repartition(4))
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(docs)
    for k, (n, t, b) in enumerate(whole(docs, target, docs)):
        assert rows[k].n_words == n
        assert (rows[k].target_loss, rows[k].background_loss) == pytest.approx((t, b), abs=1e-9)
