"""Operator 12, cross-tokenizer alignment by inverted pair bitmaps.

A text is encoded twice: with a leading space by a byte-level tokenizer (A), and by a piece
tokenizer that adds that space itself (B).  Both cut the same bytes, so the offsets where an A and
a B token both end cut the tokens into groups, and the two tokens that end there are linked.

* **Bitmaps.** Documents get slots of containers: a container is filled by one task with up to 65,536
  documents or about a million postings.  For every id pair a container holds compressed bitmaps of
  slots, one per binary digit of the pair's links in a document (multiplicity planes).  A plane is a
  sorted list of 16-bit slots, or 8 kB of bits from 4,096 slots on.
* **Counts.** The OR of a pair's planes, popcounted, is its number of documents; the planes' popcounts
  times their powers of two are its number of links.  Containers hold different documents, so the OR
  over containers is their union side by side, and Spark adds the popcounts up.
* **Scores.** Rows of bitmaps meet their pair's totals in a window over the pair, go back to their
  container, and each posting adds its score to its slot.

Documents and bitmaps are written once, so slots stay what they are when tasks are repeated.  A pair
has at most one row a container, however frequent it is.  What a B id's best pair counts is a table
of at most one row per id of B's vocabulary; it is the only thing handed to all tasks.

Null or empty texts, and texts whose joined token bytes of A or B are not the text's: no tokens, all
zeros, empty digest.  Null ids and repeated rows: kept, each a document of its own.  Empty table:
empty result.  Other columns are ignored.  A text is encoded whole by one task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drapekit.llm.common import slices, texts, utf8, written

#: a container is closed at so many documents (slots are 16-bit) or postings
MAX_DOCS = 1 << 16
MAX_POSTINGS = 1 << 20
#: from so many slots on, 8 kB of bits are smaller than a list
DENSE = 4096
SPACE = "▁"


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def _encoder_a(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        entries = json.load(f)["model"]["vocab"]
    alphabet = _byte_alphabet()
    pieces = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        pieces[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    return tokenizer, pieces, _lengths(pieces), _ranked(tokenizer, pieces, entries)


def _ranked(tokenizer, pieces: list[bytes], entries: dict[str, int]):
    """The same vocabulary as merge ranks: a quicker encoder with the same ids.  It is used for texts
    without characters from U+0250 on, whose classes the two libraries cannot see differently."""
    import public_tokenizers
    import tiktoken

    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ranks = {pieces[i]: i for entry, i in entries.items() if entry not in added}
    return tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def _encoder_b(path: str):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace(SPACE, " ").encode())
    return processor, pieces, _lengths(pieces)


def _lengths(pieces: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, pieces), np.int64, len(pieces))


class Aligned:
    """Both encodings of one text: token ids and the offsets where tokens and groups end."""

    def __init__(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray):
        self.a, self.b = a, b
        self.last_a = np.flatnonzero(np.isin(end_a, end_b, assume_unique=True))
        self.last_b = np.flatnonzero(np.isin(end_b, end_a, assume_unique=True))

    def digest(self) -> str:
        """SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``."""
        if not len(self.a):
            return ""
        n, m = len(self.a), len(self.b)
        # a group's A tokens stand after the B tokens of the groups before it, and its B tokens
        # after the A tokens up to and with its own
        group_a = np.searchsorted(self.last_a, np.arange(n))
        group_b = np.searchsorted(self.last_b, np.arange(m))
        words = np.empty(n + m, np.int64)
        words[np.arange(n) + np.append(0, self.last_b + 1)[group_a]] = 3 * self.a + _ends(n, self.last_a, 1)
        words[np.arange(m) + (self.last_a + 1)[group_b]] = 3 * self.b + _ends(m, self.last_b, 2)
        top = max(int(self.a.max()), int(self.b.max())) | 0xFFFF
        return hashlib.sha256(b"".join(map(_decimals(1 << top.bit_length()).__getitem__, words.tolist()))[:-1]).hexdigest()


def _ends(n: int, last: np.ndarray, sign: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[last] = sign
    return out


@cache
def _decimals(n: int) -> list[bytes]:
    """Each id below n in decimal, followed by each of the three separators."""
    return [b"%d%c" % (i, c) for i in range(n) for c in b",|;"]


NONE = Aligned(*[np.zeros(0, np.int64)] * 4)


def align(values: list[bytes], path_a: str, path_b: str) -> Iterator[Aligned]:
    """Both encodings of each text, without tokens where either does not give the text's bytes."""
    encode_a, pieces_a, size_a, ranked = _encoder_a(path_a)
    encode_b, pieces_b, size_b = _encoder_b(path_b)
    for value in values:
        if not value:
            yield NONE
            continue
        text, whole = value.decode(), b" " + value
        if np.frombuffer(value, np.uint8).max() < 0xC9:  # the first byte of U+0250
            ids_a = ranked.encode_ordinary(" " + text)
        else:
            ids_a = encode_a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        ids_b = encode_b.encode(text, num_threads=1)
        if b"".join(map(pieces_a.__getitem__, ids_a)) != whole or b"".join(map(pieces_b.__getitem__, ids_b)) != whole:
            yield NONE
            continue
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        yield Aligned(a, b, np.cumsum(size_a[a]), np.cumsum(size_b[b]))


class Container:
    """Postings of one container: for each (pair, slot) the number of links."""

    def __init__(self):
        self.docs, self.found, self.size = 0, [], 0

    def add(self, pairs: np.ndarray, slot: int) -> None:
        pair, links = np.unique(pairs, return_counts=True)
        self.found.append((pair, np.full(len(pair), slot, np.uint16), links))
        self.size += len(pair)

    def rows(self, name: int) -> pa.RecordBatch:
        """One row per pair: links, documents and planes."""
        pair = np.concatenate([x[0] for x in self.found])
        slot = np.concatenate([x[1] for x in self.found])
        links = np.concatenate([x[2] for x in self.found])
        order = np.argsort(pair, kind="stable")  # slots stay ascending
        pair, slot, links = pair[order], slot[order], links[order]
        head = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        own = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(pair))))
        most = int(links.max()).bit_length()
        sets = [np.flatnonzero(links >> p & 1) for p in range(most)]
        counts = np.stack([np.bincount(own[x], minlength=len(head)) for x in sets], 1)
        depth = most - np.argmax(counts[:, ::-1] > 0, axis=1)
        # (pair, plane) in the order of the rows; planes above a pair's last one are left out
        at = np.concatenate(sets)
        plane = np.repeat(np.arange(most), [len(x) for x in sets])
        order = np.lexsort((plane, own[at]))
        content = slot[at[order]]
        held = counts[np.arange(most)[None, :] < depth[:, None]]
        blobs = _planes(content, held)
        planes = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(depth)).astype(np.int32)), blobs)
        total = counts @ (1 << np.arange(most))
        docs = np.bincount(own).astype(np.int64)  # every posting is in a plane: the size of their OR
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(head), name)), pa.array(pair[head]), pa.array(total), pa.array(docs), planes], ["container", "pair", "links", "docs", "planes"])


def _planes(content: np.ndarray, held: np.ndarray) -> pa.Array:
    """The slots of each plane as bytes; ``held`` is how many slots each has."""
    end = np.cumsum(held)
    dense = np.flatnonzero(held >= DENSE)
    raw = content.astype("<u2").tobytes()
    if not len(dense):
        return pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(np.append(0, 2 * end).astype(np.int32)), pa.py_buffer(raw)])
    parts, at, size = [], 0, 2 * held
    for k in dense.tolist():
        bits = np.zeros(MAX_DOCS, np.uint8)
        bits[content[end[k] - held[k] : end[k]]] = 1
        parts += [raw[2 * at : 2 * (end[k] - held[k])], np.packbits(bits).tobytes()]
        at, size[k] = end[k], MAX_DOCS // 8
    parts.append(raw[2 * at :])
    return pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)), pa.py_buffer(b"".join(parts))])


def slots(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(slot, plane row) of every posting of the planes."""
    data, offsets = utf8(blobs)
    size = np.diff(offsets)
    dense = np.flatnonzero(size == MAX_DOCS // 8)
    if not len(dense):
        return data.view("<u2"), np.repeat(np.arange(len(size)), size // 2)
    found, rows, at = [], [], 0
    for k in [*dense.tolist(), len(size)]:
        found.append(data[offsets[at] : offsets[k]].view("<u2"))
        rows.append(np.repeat(np.arange(at, k), size[at:k] // 2))
        if k < len(size):
            found.append(np.flatnonzero(np.unpackbits(data[offsets[k] : offsets[k + 1]])).astype("<u2"))
            rows.append(np.full(len(found[-1]), k))
        at = k + 1
    return np.concatenate(found), np.concatenate(rows)


_POSTING = "container long, pair long, links long, docs long, planes array<binary>"
_OWN = "slot int, n_a long, n_b long, n_groups long, groups_sha256 string"


def _indexed(path_a: str, path_b: str, schema: pa.Schema):
    """Rows of documents (kind 0) and of bitmaps (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, closed, own = TaskContext.get().partitionId(), 0, Container()

        def filled(batch: pa.RecordBatch | dict, kind: int, n: int) -> pa.RecordBatch:
            have = {f: batch.column(f) for f in batch.schema.names} if isinstance(batch, pa.RecordBatch) else batch
            have = {"kind": pa.array(np.full(n, kind, np.int32))} | have
            return pa.RecordBatch.from_arrays([have[f.name].cast(f.type) if f.name in have else pa.nulls(n, f.type) for f in schema], schema=schema)

        for batch in slices(batches, "text"):
            rows: list[tuple] = []
            ids = batch.column("id")
            at = 0

            def documents(upto: int) -> pa.RecordBatch:
                cols = list(zip(*rows))
                names = ["container", "slot", "n_a", "n_b", "n_groups", "groups_sha256"]
                return filled({"id": ids.slice(at, upto - at)} | {c: pa.array(v) for c, v in zip(names, cols)}, 0, len(rows))

            for k, found in enumerate(align(texts(batch.column("text")), path_a, path_b)):
                name = (task << 32) + closed
                if len(found.a):
                    own.add((found.a[found.last_a] << 32) + found.b[found.last_b], own.docs)
                rows.append((name, own.docs, len(found.a), len(found.b), len(found.last_a), found.digest()))
                own.docs += 1
                if own.docs == MAX_DOCS or own.size >= MAX_POSTINGS:
                    yield documents(k + 1)
                    if own.found:
                        done = own.rows(name)
                        yield filled(done, 1, done.num_rows)
                    rows, at, closed, own = [], k + 1, closed + 1, Container()
            if rows:
                yield documents(batch.num_rows)
        if own.found:
            done = own.rows((task << 32) + closed)
            yield filled(done, 1, done.num_rows)

    return run


def _scored(best: np.ndarray, id_type: pa.DataType):
    """The documents of a container with the scores that its postings return."""

    def run(docs: pa.Table, postings: pa.Table) -> pa.Table:
        scores = np.zeros((3, MAX_DOCS), np.int64)
        for batch in postings.to_batches():
            planes = batch.column("planes")
            slot, row = slots(planes.flatten())
            depth = np.diff(planes.offsets.to_numpy())
            pair_row = np.repeat(np.arange(batch.num_rows), depth)
            weight = (1 << (np.arange(len(pair_row)) - np.repeat(np.cumsum(depth) - depth, depth)))[row]
            row = pair_row[row]
            count, among = (batch.column(c).to_numpy() for c in ("count", "among"))
            own = best[batch.column("pair").to_numpy() & 0xFFFFFFFF]
            np.add.at(scores[0], slot, weight * (count == own)[row])
            np.add.at(scores[1], slot, weight * count[row])
            np.add.at(scores[2], slot, weight * among[row])
        at = docs.column("slot").to_numpy()
        out = [docs.column("id").combine_chunks().cast(id_type), *[docs.column(c) for c in ("n_a", "n_b", "n_groups")], docs.column("n_groups")]
        out += [pa.array(scores[0][at]), pa.array(scores[1][at]), docs.column("groups_sha256"), pa.array(scores[2][at])]
        return pa.table(out, names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "docs_sum"])

    return run


def alignment_index(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, postings), both written: documents with their slot, counts and digest; postings
    with one row per (container, pair): links, docs and planes."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    empty = source.sparkSession.createDataFrame([], f"kind int, id {id_type}, {_OWN}, {_POSTING}")
    made = source.mapInArrow(_indexed(path_a, path_b, to_arrow_schema(empty.schema)), empty.schema)
    table = written(made, "op12-index")
    documents = table.where("kind = 0").select("id", "container", "slot", "n_a", "n_b", "n_groups", "groups_sha256")
    return documents, table.where("kind = 1").select("container", "pair", "links", "docs", "planes")


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, links, docs): corpus-wide counts of each linked id pair."""
    totals = postings.groupBy("pair").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    return totals.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "links", "docs")


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, and docs_sum (each link's number of documents that link its pair)."""
    from pyspark.sql.pandas.types import to_arrow_type

    documents, postings = alignment_index(docs, path_a, path_b, id_col, text_col)
    best = np.zeros(len(_encoder_b(path_b)[1]), np.int64)
    # at most one row per id of B
    for r in pair_counts(postings).groupBy("b").agg(F.max("links").alias("links")).collect():
        best[r.b] = r.links
    whole = Window.partitionBy("pair")
    scored = postings.select("container", "pair", "planes", F.sum("links").over(whole).alias("count"), F.sum("docs").over(whole).alias("among"))
    id_type = docs.schema[id_col].dataType
    columns = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, docs_sum long"
    out = documents.groupBy("container").cogroup(scored.groupBy("container")).applyInArrow(_scored(best, to_arrow_type(id_type)), f"id {id_type.simpleString()}, {columns}")
    return out.withColumnRenamed("id", id_col)
