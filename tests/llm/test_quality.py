from __future__ import annotations

import re
from collections import Counter

import numpy as np

from drapekit.llm import quality as op
from tests.llm.helpers import SCHEMA, frame, prose

TEXTS = [
    None, "", " \n\t", "one", "a b c a b c", "### a*b |", "x\n\nx\n y\nx\n \n y", "é\xa0b\x1cc d\x0be", "日本 語 " * 60,
    prose(1, 200), prose(2, 60, 3), "same line here\n" * 30, prose(3, 5000, 50), "a | " * 80, "w w w w w", prose(4, 100) + "\n" + prose(4, 100),
]


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    cover = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    alpha = sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in w) for w in words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), len(lines), alpha)


def test_measures_match_brute_force(spark):
    got = {r.doc_id: tuple(r[m] for m in op.MEASURES) for r in op.ledger(frame(spark, TEXTS)).collect()}
    assert got == {k: slow(t) for k, t in enumerate(TEXTS)}


def test_bits_policies_and_ablations(spark):
    rows = op.apply_policy(op.ledger(frame(spark, TEXTS))).collect()
    for r in rows:
        n, chars, symbols, dup, rep, lines, alpha = slow(TEXTS[r.doc_id])
        fails = [n < 50, 100 * rep > 50 * n, 100 * symbols > 10 * chars, 100 * alpha < 70 * n, 100 * dup > 40 * lines, chars < 2 * n or chars > 15 * n]
        assert r.fail_bits == sum(1 << k for k, f in enumerate(fails) if f)
        assert r.base_failed == (fails[0] or fails[1]) and r.kept == (not any(fails))
    got = {(r.version, r.rule): (r.documents, r.kept, r.failing, r.kept_without) for r in op.ablations(op.ledger(frame(spark, TEXTS))).collect()}
    for version, mask in op.POLICIES.items():
        for k, rule in enumerate(op.RULES):
            if mask >> k & 1:
                bits = [r.fail_bits & mask for r in rows]
                assert got[version, rule] == (len(rows), bits.count(0), sum(b >> k & 1 for b in bits), bits.count(1 << k))


def test_null_ids_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(None, "a", None, None, None, None, None), (1, "a", "", "", 1, "", 1), (1, "a", "", "", 1, "", 1)], SCHEMA)
    assert sorted(r.doc_id or 0 for r in op.ledger(df).collect()) == [0, 1, 1]
    assert op.apply_policy(op.ledger(spark.createDataFrame([], SCHEMA))).count() == 0


def test_very_long_text(spark):
    texts = [prose(1, 60_000, 5000), "x", prose(2, 40_000, 30) + "\nline" * 500]
    got = {r.doc_id: tuple(r[m] for m in op.MEASURES) for r in op.ledger(frame(spark, texts)).collect()}
    assert got == {k: slow(t) for k, t in enumerate(texts)}


def test_lines_that_a_polynomial_takes_for_equal():
    """A Thue-Morse line and its complement: 1,024 characters on, equal modulo 2 ** 64 in any base."""
    line = "a"
    while len(line) < 4096:
        line += line.translate(str.maketrans("ab", "ba"))
    other = line.translate(str.maketrans("ab", "ba"))
    for size in (1024, 2048, 4096):
        text = f"{line[:size]}\n{other[:size]}\n{line[:size]}".encode()
        found = dict(zip(op.MEASURES, (x.tolist() for x in op.measure(np.frombuffer(text, np.uint8), np.array([0, len(text)])))))
        assert found["n_dup_lines"] == [1]
