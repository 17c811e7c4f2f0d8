from __future__ import annotations

import random

import numpy as np
import pytest

from drapekit.llm import decontaminate as op
from tests.llm.helpers import SCHEMA, frame, prose

ITEMS = "item_id long, text string, doc_id long"


def slow(item, text):
    """(distance, start) of the stretch of ``text`` nearest to ``item`` (Sellers)."""
    row = [(0, j) for j in range(len(text) + 1)]
    for i, c in enumerate(item, 1):
        new = [(i, 0)]
        for j in range(1, len(text) + 1):
            a, b, d = row[j - 1], row[j], new[j - 1]
            new.append(min((a[0] + (text[j - 1] != c), a[1]), (b[0] + 1, b[1]), (d[0] + 1, d[1])))
        row = new
    return min(row)


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[k : k + 1] = [] if kind == 0 else ["#"] if kind == 1 else [out[k], "é"]
    return "".join(out)


def corpus(seed=2):
    rng = random.Random(seed)
    items = [prose(100 + k, 12 + k) for k in range(8)] + ["tiny", None, "Short item 1", "a", "b c", "", " ", "x y z w", "wwwwwww", "eightchr", "ten char 1", "fifteen chars 1", "twenty one chars item", "thirty one characters in a item", "naïve  CAFÉ\nand 日本 mixed up text item"]
    texts = [None, "", "tiny", "short item 1", prose(1, 50)]
    for k, item in enumerate(items):
        if item and len(item) > 11:
            for edits in (0, 1, 3, len(item) // 10, len(item) // 10 + 1, len(item) // 5):
                texts.append(prose(k, 20) + " " + edited(rng, item, edits) + " " + prose(50 + k, 10))
            texts += [item, item.upper().replace(" ", "\n  "), item[: len(item) // 2] + " " + prose(9, 30)]
    texts += ["aa a", "b  C", "c b ab c", "x y z wx", "X\ty z w", "eightchX", "xeightchry", "ten chaX 1", "ten chXX 1", "sixteen chars 1", "fiftXen chars 1 and", "tweXty one Xhars item", "thirty oXe chaXacters in X item", "thirty oXe chaXacters iX X item"]
    texts.append(" ".join(t for t in items if t))
    return items, texts


@pytest.mark.parametrize("q,rate,block", [(8, 0.1, 4_000_000), (8, 0.1, 300), (4, 0.2, 4_000_000)])
def test_matches_brute_force(spark, q, rate, block):
    items, texts = corpus()
    bench = spark.createDataFrame([(k, t, 1) for k, t in enumerate(items)], ITEMS)
    rows = op.leaks(frame(spark, texts), bench, q=q, rate=rate, block_bytes=block).collect()
    got = {(r.doc_id, r.item_id): (r.distance, r.start) for r in rows}
    assert len(got) == len(rows)
    want = {}
    for a, item in enumerate(items):
        item = op.plain(item or "")
        edits = int(rate * len(item) + 1e-9)
        for b, text in enumerate(texts):
            if len(item) < 8:
                at = f" {op.plain(text or '')} ".find(f" {item} ")
                if item and at >= 0:
                    want[b, a] = (0, at)
                continue
            near = slow(item, op.plain(text or ""))
            if near[0] <= edits:
                want[b, a] = near
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1] == want[k][1] for k in want if want[k][0] == 0)
    assert len(want) > 50
    clean = {r.doc_id for r in op.without_leaks(frame(spark, texts), bench, q=q, rate=rate, block_bytes=block).collect()}
    assert clean == set(range(len(texts))) - {b for b, _ in want}


def test_alignment_reports_the_stretch():
    text, item = "xxxxabcdefghijyyyy", "abXdefghij"
    distance, start, end = op.align(op.points(item), op.points(text), -5, 20)
    assert (distance, text[start:end]) == (1, "abcdefghij")
    assert op.align(op.points(item), op.points(""), -12, 3)[0] == len(item)


def test_places_in_a_batch_do_not_matter():
    items, texts = corpus()
    index = op.build(list(enumerate(items)))
    own = [op.plain(t or "") for t in texts]
    whole = op.matches(own, index)
    assert whole == {(k, i): v for k, t in enumerate(own) for (_, i), v in op.matches([t], index).items()}
    assert all(np.all(part.bound >= 1) for _, part in index.parts)


def test_null_ids_repeats_and_empty(spark):
    item = prose(5, 30)
    df = spark.createDataFrame([(None, item, "", "", 1, "", 1), (1, item, "", "", 1, "", 1), (1, item, "", "", 1, "", 1)], SCHEMA)
    bench = spark.createDataFrame([(1, item, 1), (1, item, 1), (None, item, 1)], ITEMS)
    assert op.leaks(df, bench).count() == 9
    none, no_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    assert op.leaks(none, bench).count() == 0 and op.leaks(df, no_items).count() == 0
    assert op.without_leaks(df, no_items).count() == 3 and op.without_leaks(df, bench).count() == 0


def test_very_long_text(spark):
    item = prose(5, 30)
    text = prose(1, 40_000) + " " + item.replace("w1", "w2", 1) + " " + prose(2, 40_000)
    (hit,) = op.leaks(frame(spark, [text, "x"]), spark.createDataFrame([(7, item, 1)], ITEMS)).collect()
    assert (hit.doc_id, hit.item_id) == (0, 7) and hit.distance <= 1 and hit.start == len(prose(1, 40_000)) + 1
