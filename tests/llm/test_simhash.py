from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from drapekit.llm import simhash as op
from drapekit.llm.components import components
from tests.llm.helpers import SCHEMA, below, frame, prose
from tests.test_plans import recorded


def slow_print(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(ids, prints, bits):
    group = {k: k for k in range(len(ids))}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                group[root(a)] = root(b)
    least = {}
    for k, i in enumerate(ids):
        least[root(k)] = min(least.get(root(k), i), i)
    return [least[root(k)] for k in range(len(ids))]


def corpus():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "one", "One two THREE", "one two three", "a b c d", "É é \x0b\x1c x\xa0y z", prose(1, 30)]
    for k in range(40):
        base = prose(100 + k, 400).split()
        texts.append(" ".join(base))
        for _ in range(3):
            base[rng.randrange(len(base))] = f"x{rng.random()}"
            texts.append(" ".join(base))
    return texts + texts[:4]


def test_matches_brute_force(spark):
    texts = corpus()
    rows = op.simhash_groups(frame(spark, texts)).collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    prints = [slow_print(t) for t in texts]
    groups = slow_groups(list(range(len(texts))), prints, 4)
    assert len(rows) == len(texts)
    assert got == {k: (f"{p:016x}", g) for k, (p, g) in enumerate(zip(prints, groups))}


@pytest.mark.parametrize("bits,seed", [(0, 1), (1, 2), (4, 3), (6, 4)])
def test_every_plan_finds_every_link(spark, bits, seed):
    rng = random.Random(seed)
    prints = [0, (1 << 64) - 1]
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.append(p)
        for _ in range(4):
            for b in rng.sample(range(64), rng.randrange(4)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(op._signed(p),) for p in prints], "fp long")
    want = {tuple(sorted((op._signed(a), op._signed(b)))) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= bits}
    for n in (10, 10**6, 10**9):
        parts = op.plan_parts(np.array(prints, np.uint64), n, bits)
        assert sum(p.radius + 1 for p in parts) == bits + 1
        assert sorted(b for p in parts for b in p.bits) == sorted({b for p in parts for b in p.bits})
    assert {(r.a, r.b) for r in op.near_pairs(df, bits).collect()} == want


def test_components_of_a_chain(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_null_ids_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(None, "x y z", "a", "b", 1, "c", 1), (None, None, "a", "b", 1, "c", 1), (4, "x y z", "a", "b", 1, "c", 1), (4, "x y z", "a", "b", 1, "c", 1)], SCHEMA)
    rows = op.simhash_groups(df).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 4), (4, 4), (4, 4)]
    assert op.simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text():
    text = prose(5, 70_000, 50_000)
    assert op.fingerprint(text.encode()) == slow_print(text)


def slow_labels(prints, bits):
    ids = sorted(prints, key=op._signed)
    return dict(zip(ids, slow_groups([op._signed(p) for p in ids], ids, bits)))


@pytest.mark.parametrize("bits,seed", [(0, 1), (1, 2), (4, 3), (4, 5), (6, 4)])
def test_groups_equal_brute_force(spark, bits, seed):
    """Chains, clusters, chance meetings: the same groups as from every link."""
    rng = random.Random(seed)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(12):
            q = p
            for b in rng.sample(range(64), rng.randrange(bits + 2)):
                q ^= 1 << b
            prints.add(q)
            p = rng.choice([p, q])
    df = spark.createDataFrame([(op._signed(p),) for p in prints], "fp long")
    got = {r.node: r.label for r in op.groups(df, bits).collect()}
    want = {op._signed(p): g for p, g in slow_labels(prints, bits).items()}
    assert {n: got.get(n, n) for n in want} == want


def test_a_large_cluster_is_joined_by_few_links(spark):
    """5,000 prints within two bits of one: all pairs would be 12 million links."""
    rng = random.Random(8)
    base, prints = rng.getrandbits(64), set()
    while len(prints) < 2000:
        p = base
        for b in rng.sample(range(64), rng.randrange(3)):
            p ^= 1 << b
        prints.add(p)
    while len(prints) < 5000:
        p = base
        for b in rng.sample(range(64), rng.randrange(3, 5)):
            p ^= 1 << b
        prints.add(p)
    df = spark.createDataFrame([(op._signed(p),) for p in prints], "fp long").repartition(4)
    links = sum(op.star_links(df, 4, k).count() for k in range(op.STAR_TURNS))
    assert links < 20 * len(prints)
    got = op.groups(df, 4).collect()
    assert len(got) == len(prints) and len({r.label for r in got}) == 1


def test_exploded_prints_are_not_broadcast(spark, monkeypatch):
    """The planner takes a print's dozens of values for one row, so any table here is small to it."""
    plans = recorded(monkeypatch)
    rng = random.Random(9)
    df = spark.createDataFrame([(op._signed(rng.getrandbits(64)),) for _ in range(300)], "fp long")
    op.groups(op.written(df, "prints"), 4)
    op.near_pairs(df, 4).collect()
    assert not any(below(plan, "BroadcastExchange", "Generate explode") for plan in plans)
    assert sum(below(plan, "SortMergeJoin", "Generate explode") for plan in plans) >= op.STAR_TURNS + 2
