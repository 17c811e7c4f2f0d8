from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from drapekit.llm import bpe as op
from tests.llm.helpers import SCHEMA, frame, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  a   b\n\n c \t\t", "I'll we've it's 'S 's", "a<|endoftext|>b <|endoftext|> <|endoftext|><|endoftex", "aaaaaaaaaaaaaaaaaaaaaa" * 9,
    "naïve café 日本語 😀 ½ ٣ x y z \x1c\x85​﻿", "!!! ### ***", "\r\n \r\n", "1234567890 12 3.14", prose(1, 300), "e" * 3000, "\x00\x01\x7f", "ǅ ᾳ ⅷ ²  　 a",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return op.Bpe(f.read())


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_matches_the_library(spark, library):
    rows = op.round_trip(frame(spark, TEXTS), PATH).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {k: want(library, t) for k, t in enumerate(TEXTS)}


def test_random_texts(own, library):
    rng = random.Random(7)
    pool = [*"abcdefghijklmnopqrstuvwxyz  \n\t'.!?0189", "é", "ß", "日", "😀", "́", "ا", "the", "tion", "ing", " th", " ", "\x1f", "᠎"]
    for _ in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(60)))
        assert np.frombuffer(own.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_space_and_category(own, library):
    import sys

    points = [c for c in range(0, 0x3100) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 64):
        text = "".join(f"a{chr(c)}{chr(c)} {chr(c)}b " for c in points[at : at + 64])
        assert np.frombuffer(own.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, hex(points[at])
    assert sys.maxunicode == 0x10FFFF


def test_words_shared_cache_and_bound(own, library, monkeypatch):
    monkeypatch.setattr(op, "CACHE", 5)
    text = prose(9, 500)
    assert np.frombuffer(own.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_and_texts(spark, library):
    df = frame(spark, TEXTS)
    ids = op.round_trip(df, PATH, with_ids=True)
    assert {r.doc_id: r.ids for r in ids.collect()} == {k: library.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in op.decode_ids(ids, PATH).collect()} == {k: t or "" for k, t in enumerate(TEXTS)}


def test_null_ids_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(None, "a b", "", "", 1, "", 1), (1, "a", "", "", 1, "", 1), (1, "a", "", "", 1, "", 1)], SCHEMA)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in op.round_trip(df, PATH).collect()) == [(0, 2), (1, 1), (1, 1)]
    assert op.round_trip(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_very_long_text(own, library):
    text = prose(3, 80_000, 20_000) + "a" * 20_000
    ids = own.encode(text)
    assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids).decode() == text
