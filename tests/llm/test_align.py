from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from drapekit.llm import align as op
from tests.llm.helpers import SCHEMA, frame, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of():
    """The public rule of byte-level vocabularies, read from the tokenizer itself."""
    from tokenizers.pre_tokenizers import ByteLevel

    out, split = {}, ByteLevel(add_prefix_space=False, use_regex=False)
    for code in [*range(0x80), *range(0xA0, 0x800)]:
        raw, shown = chr(code).encode(), split.pre_tokenize_str(chr(code))[0][0]
        out |= dict(zip(shown, raw))
    # bytes that no short character holds
    for code in (0x800, 0xFFFD, 0x1F600, 0x10FFFF, *range(0x1000, 0x10000, 0x1000)):
        if not 0xD800 <= code < 0xE000:
            out |= dict(zip(split.pre_tokenize_str(chr(code))[0][0], chr(code).encode()))
    return out


def slow(texts):
    """Token by token, pair by pair."""
    bytes_of = byte_of()
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    entry = {i: e for e, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs, total, held = [], Counter(), defaultdict(set)
    for d, text in enumerate(texts):
        if not text:
            docs.append(None)
            continue
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
        raw = [[bytes(bytes_of[c] for c in entry[i]) for i in ids[0]], [piece(i) for i in ids[1]]]
        if any(b"".join(x) != b" " + text.encode() for x in raw):
            docs.append(None)
            continue
        ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
        place = [{end: k + 1 for k, end in enumerate(e)} for e in ends]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, links, at = [], [], [0, 0]
        for end in both:
            upto = [p[end] for p in place]
            groups.append("|".join(",".join(map(str, ids[k][at[k] : upto[k]])) for k in (0, 1)))
            links.append((ids[0][upto[0] - 1], ids[1][upto[1] - 1]))
            at = upto
        total.update(links)
        for x in links:
            held[x].add(d)
        docs.append((len(ids[0]), len(ids[1]), groups, links))
    best = Counter()
    for (_, y), n in total.items():
        best[y] = max(best[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, "", 0))
            continue
        n_a, n_b, groups, links = d
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(links), sum(total[x] == best[x[1]] for x in links), sum(total[x] for x in links), digest, sum(len(held[x]) for x in links)))
    return out


TEXTS = [
    None, "", " ", "  ", "\n", "a", "the the the the the the the", "Hello world, hello  world!", "  leading and trailing  ", "tabs\tand\nlines\r\n",
    "<|endoftext|> and <s> or </s> and <unk>", "▁ is no space", "naïve café Ünï 中文字符 \U0001f600\U0001f9d1‍\U0001f680", "\x00\x01 control", "a" * 700,
    "the " * 3000, prose(1, 300), prose(1, 300), "ﬁ ligature ½ ² Å é", "mixed 123456 3.14 foo_bar fooBar()", "﻿bom", "​zero­soft",
]
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "docs_sum")


def check(spark, texts):
    rows = sorted(op.alignment(frame(spark, texts).repartition(3), A, B).collect())
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    want = slow(texts)
    for r, w in zip(rows, want):
        assert tuple(r[f] for f in FIELDS) == w, (r, w)


def test_matches_brute_force(spark):
    check(spark, TEXTS)


def test_small_containers(spark, monkeypatch):
    """Containers that close after each document or two give the same totals."""
    found, postings = op.alignment_index(frame(spark, TEXTS).coalesce(1), A, B)
    whole = {(r.a, r.b): (r.links, r.docs) for r in op.pair_counts(postings).collect()}
    totals: Counter = Counter()
    docs: Counter = Counter()
    for text in TEXTS:
        box = op.Container()
        (one,) = op.align([(text or "").encode()], A, B)
        if len(one.a):
            box.add((one.a[one.last_a] << 32) + one.b[one.last_b], 0)
            for r in box.rows(0).to_pylist():
                pair = (r["pair"] >> 32, r["pair"] & 0xFFFFFFFF)
                totals[pair] += r["links"]
                docs[pair] += r["docs"]
    assert whole == {p: (totals[p], docs[p]) for p in totals}


def test_planes_lists_and_bits():
    """A pair in many documents is kept as bits, others as lists, and both give back their slots."""
    box, rng = op.Container(), np.random.default_rng(3)
    want = defaultdict(dict)
    for slot in range(9000):
        pairs = np.concatenate([np.full(1 + slot % 5, 7), rng.integers(100, 400, 3)])
        for p in pairs.tolist():
            want[p][slot] = want[p].get(slot, 0) + 1
        box.add(pairs, slot)
    rows = box.rows(5)
    assert rows.num_rows == len(want)
    for r in rows.to_pylist():
        got: Counter = Counter()
        slot, plane = op.slots(pa.array(r["planes"], pa.binary()))
        for s, p in zip(slot.tolist(), plane.tolist()):
            got[s] += 1 << p
        assert got == want[r["pair"]] and r["links"] == sum(got.values()) and r["docs"] == len(got)
        assert {len(x) == 8192 for x in r["planes"]} <= {True, False} and all(len(x) <= 8192 for x in r["planes"])


def test_null_ids_repeated_rows_and_empty(spark):
    rows = [(None, "one two", "a", "b", 1, "c", 1), (None, "one two", "a", "b", 1, "c", 1), (4, None, "a", "b", 1, "c", 1), (4, "one", "a", "b", 1, "c", 1)]
    out = op.alignment(spark.createDataFrame(rows, SCHEMA), A, B).collect()
    want = slow([r[1] for r in rows])
    assert sorted(tuple(r[f] for f in FIELDS) for r in out) == sorted(want)
    assert sorted(r.doc_id or -1 for r in out) == [-1, -1, 4, 4]
    assert op.alignment(spark.createDataFrame([], SCHEMA), A, B).count() == 0


def test_very_long_text(spark):
    check(spark, [prose(1, 60_000, 3000), "w1 w2"])
