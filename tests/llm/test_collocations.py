from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from drapekit.llm import collocations as op
from tests.llm.helpers import SCHEMA, frame, prose


def slow(rows, least=10, max_words=3, top=2000):
    """Phrase by phrase from the contract."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            if any(100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in often.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in op.collocations(df, **kw).collect())


def texts():
    rng = random.Random(9)
    out = [None, "", " \t\n", "One", "a b. a b, a b; a b: a b! a b? a\x0bb a b\rc", "x\ty  x\ty " * 12, "Ünï cödé \x1c " * 15, "É é " * 20, "same " * 4000]
    out += [prose(k, 400, 12) for k in range(20)]
    out += ["new york city is big. new york city" + rng.choice([" is", ".", " hall"]) for _ in range(40)]
    return out


def rows_of(values):
    langs = ["en", "de", None, "und", "en"]
    return [(langs[k % 5], t) for k, t in enumerate(values)]


def langs_frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "s", 1, "key", 7) for k, (lang, t) in enumerate(rows)], SCHEMA)


def test_matches_brute_force(spark):
    rows = rows_of(texts())
    want = slow(rows)
    assert len(want) > 200
    assert found(langs_frame(spark, rows).repartition(5)) == want


@pytest.mark.parametrize("least,max_words,top", [(3, 2, 50), (5, 4, 2000), (20, 3, 7)])
def test_other_parameters(spark, least, max_words, top):
    rows = rows_of(texts())
    assert found(langs_frame(spark, rows), least=least, max_words=max_words, top=top) == slow(rows, least, max_words, top)


def test_a_hot_beginning_is_split_and_added_up(spark):
    """Two words that lead half of all suffixes: dealt by whole suffixes, same counts."""
    rng = random.Random(4)
    rows = [("en", " ".join(w for _ in range(300) for w in ("of", "the", f"n{rng.randrange(40)}"))) for _ in range(12)]
    df = langs_frame(spark, rows)
    blocks = df.select("lang", "text").mapInArrow(op._routed(8, {"en": [b"of", b"the"]}, 3), op._BLOCK_SQL)
    assert blocks.select("route").distinct().count() > 4
    assert found(df) == slow(rows)


@pytest.mark.parametrize("seed", range(6))
def test_quicksort_counts_every_frequent_prefix(seed):
    rng = np.random.default_rng(seed)
    n, depth = int(rng.integers(1, 4000)), int(rng.integers(1, 5))
    keys = np.sort(rng.zipf(1.5, (depth, n)) % 50, axis=0)[::-1].astype(np.int64)  # zeros last
    weight = rng.integers(1, 4, n)
    want = Counter()
    for column, w in zip(keys.T.tolist(), weight.tolist()):
        for d in range(depth):
            if column[d] == 0:
                break
            want[tuple(column[: d + 1])] += w
    for least in (1, 10):
        got = Counter()
        for d, pointer, total in op.three_way(np.ascontiguousarray(keys), weight, least):
            for p, t in zip(pointer.tolist(), total.tolist()):
                got[tuple(keys[: d + 1, p].tolist())] += t
        assert got == {k: v for k, v in want.items() if v >= least}


def test_repeated_rows_and_empty(spark):
    rows = [(None, "a b c", None, "b", 1, "c", 1)] * 12 + [(4, None, "und", "b", 1, "c", 1)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [("und", 1, "a b c", 12, 12, 12, 36, 10**6)]
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(frame(spark, [None, "", " "])) == []


def test_very_long_text(spark):
    text = prose(5, 80_000, 60)
    assert found(frame(spark, [text])) == slow([("en", text)])


def test_counts_beyond_64_bit_products(spark):
    """a * a * 1000000 passes 64 bits from some four million occurrences on."""
    a = 5_000_000_000
    df = spark.createDataFrame([(a, a + 3, 2 * a)], "a long, l long, r long")
    (row,) = df.selectExpr("cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)) as o", "cast(l as decimal(15,0)) * cast(r as decimal(15,0)) as u").selectExpr("o div u as s").collect()
    assert row.s == 10**6 * a * a // ((a + 3) * 2 * a)
