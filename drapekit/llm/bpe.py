"""Operator 7, byte-pair encoding and decoding by dynamic programming over prefixes.

Byte-pair encoding merges the lowest-ranked neighbours first.  Its result can be built from
left to right: every prefix of a word has exactly one possible last token, namely the token
that ends there and is compatible with the last token of what comes before it.  Two tokens are
compatible if encoding their concatenation gives those two tokens again, which follows from
the merge ranks along the border alone.

* All vocabulary entries that end at a position come from an Aho-Corasick automaton, the
  suffix-link automaton of the vocabulary, longest first.
* ``last[i]`` is the one compatible token; the ids follow from the back-pointers.
* Words (the pieces the tokenizer's pattern makes) repeat, so each task keeps the ids of the
  words it has met, up to a bound; the bound changes speed only.

The tokenizer file is a parameter.  It is read on the driver and handed to the tasks; its size
is that of the vocabulary.  Supported are byte-level BPE files with the pattern split.  Special
tokens written out in a text get their own id, as the tokenizers library does by default.

Null text: empty (no ids).  Null ids and repeated rows: kept.  Empty table: empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drapekit.llm.common import slices, texts

CACHE = 400_000  # words whose ids a task keeps at a time
BLOCK = 1 << 20  # ids that are decoded at a time

#: fixed value: the pattern of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level file: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder for one byte-level BPE file.  Tokens are numbered by age inside:
    the bytes first, then the merges by rank; ``ids`` turns ages into vocabulary ids."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model, split = data["model"], data.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or data.get("normalizer"):
            raise ValueError("only byte-level BPE without prefix space or normalizer is supported")
        letters, vocab = byte_letters(), model["vocab"]
        age: dict[str, int] = {c: b for c, b in letters.items()}
        self.left, self.right = list(range(256)), list(range(256))
        self.pair: dict[tuple[int, int], int] = {}
        names = [""] * 256
        for c, b in letters.items():
            names[b] = c
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pair[age[a], age[b]] = age.setdefault(a + b, len(names))
            if age[a + b] == len(names):
                names.append(a + b)
                self.left.append(age[a])
                self.right.append(age[b])
        self.ids = np.array([vocab[n] for n in names], np.uint32)
        raw = [bytes(letters[c] for c in n) for n in names]
        self.size = [len(r) for r in raw]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.pattern = regex.compile(PATTERN)
        self.outside = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.ends = ahocorasick.Automaton()
        for k, r in enumerate(raw):
            self.ends.add_word(r.decode("latin-1"), k)
        self.ends.make_automaton()
        table = {int(i): r for i, r in zip(self.ids, raw)} | {i: c.encode() for c, i in self.special.items()}
        known = [table.get(i, b"") for i in range(max(table) + 1)]
        self.lengths = np.array([len(x) for x in known], np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(known), np.uint8)
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding (bytes of a + bytes of b) keeps the border between them.  The merges
        at the border are undone from the youngest on (of two equal ones the right one is
        younger); a merge across the border that is older than the one just undone would
        have come first."""
        known = self.fits.get((a, b))
        if known is not None:
            return known
        x, y, before = a, b, 1 << 62
        while True:
            across = self.pair.get((x, y))
            if across is not None and across < before:
                fits = False
                break
            if max(x, y) < 256:
                fits = True
                break
            if x > y:
                before, x = x, self.right[x]
            else:
                before, y = y + 1, self.left[y]
        if len(self.fits) >= 4 * CACHE:
            self.fits.clear()
        self.fits[a, b] = fits
        return fits

    def word(self, piece: bytes) -> bytes:
        """Ids of one word, as little-endian 32-bit integers."""
        last = [-1] * len(piece)
        size, compatible = self.size, self.compatible
        at, found = -1, False
        for end, token in self.ends.iter(piece.decode("latin-1")):
            if end != at:
                at, found = end, False
            if found:
                continue
            start = end - size[token]
            if start < 0 or compatible(last[start], token):
                last[end], found = token, True
        out, at = [], len(piece) - 1
        while at >= 0:
            out.append(last[at])
            at -= size[last[at]]
        return self.ids[out[::-1]].tobytes()

    def plain(self, text: str) -> list[bytes]:
        words = self.words
        out = []
        for piece in self.pattern.findall(text):
            ids = words.get(piece)
            if ids is None:
                if len(words) >= CACHE:
                    words.clear()
                ids = words[piece] = self.word(piece.encode())
            out.append(ids)
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian 32-bit integers."""
        if self.outside is None or not self.outside.search(text):
            return b"".join(self.plain(text))
        out = []
        for piece in self.outside.split(text):
            out += [np.uint32(self.special[piece]).tobytes()] if piece in self.special else self.plain(piece)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text of the ids in UTF-8; bytes that are no UTF-8 become U+FFFD."""
        own, out = np.frombuffer(ids, np.uint32), []
        for at in range(0, len(own), BLOCK):
            part = own[at : at + BLOCK]
            n = self.lengths[part]
            ends = np.cumsum(n)
            out.append(self.bytes[np.arange(ends[-1]) + np.repeat(self.places[part] - (ends - n), n)].tobytes())
        return b"".join(out).decode("utf-8", "replace").encode()


_READY: dict[str, Bpe] = {}


def ready(spec: str) -> Bpe:
    """The encoder for a file's content, made once per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _READY:
        _READY.clear()
        _READY[key] = Bpe(spec)
    return _READY[key]


def _round_trip(spec, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ready(spec.value)
        for batch in slices(batches, "text"):
            n, ids_sha, text_sha, all_ids = [], [], [], []
            for text in texts(batch.column("text")):
                ids = bpe.encode(text.decode("utf-8", "replace"))
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                all_ids.append(ids)
            columns = [batch.column("id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            if with_ids:
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(all_ids), np.int32))))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return run


def _decode(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ready(spec.value)
        for batch in batches:
            out = [None if row is None else bpe.decode(np.array(row, np.uint32).tobytes()).decode() for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], ["id", "text"])

    return run


def _shared(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def decode_ids(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of every row of ids."""
    source = rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_decode(_shared(rows, path)), f"id {id_type}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes every row and decodes its ids again: id, n_tokens, ids_sha256, decoded_sha256,
    with ``with_ids`` also ids (array of int)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    kind = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return source.mapInArrow(_round_trip(_shared(docs, path), with_ids), kind).withColumnRenamed("id", id_col)
