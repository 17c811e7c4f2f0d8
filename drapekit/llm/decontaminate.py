"""Operator 8, benchmark decontamination by the q-gram lemma.

A text holds a benchmark item if some stretch of it turns into the item with at most
``rate`` * m edits, where m is the item's length.  Items and texts are compared in lower case
with white space collapsed, character by character.

* **Lemma.** A stretch within e edits of an item shares at least m - q + 1 - q * e of the item's
  q-grams with it, and all of them lie on neighbouring diagonals (place in the text minus place
  in the item), at most e apart.
* **Count.** Shared q-grams are counted per text, item and diagonal band.  Bands are 2 (e + 1)
  diagonals wide and overlap by half, so every e + 1 neighbouring diagonals lie in one of them.
* **Verify.** Bands that reach the bound are aligned with the item, within the band and e
  diagonals on either side.

The benchmark is a stated query set: it is dealt to blocks of about ``block_bytes``, each block's
q-gram index goes to all tasks, and the texts are read once per block.  Nothing is shuffled.

q is halved for items so short that their edit budget would leave no shared q-gram, so every item
keeps its budget.  Items under ``SHORT`` characters are found as whole words, unchanged: with a
budget of nothing, a stretch inside a word says nothing.  Empty items are found nowhere.  Null texts: empty.  Null ids, repeated rows and repeated items: each
reported.  Empty tables: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drapekit.llm.common import mix, slices, texts

Q = 8
RATE = 0.1
SHORT = 8
BLOCK_BYTES = 4_000_000

_U = np.uint64
_ROLL = 0x100000001B3
_COST = 1 << 32  # one edit; a place in a text is below it
_FAR = 1 << 60
_BREAK = "\U0010ffff"  # between texts; no q-gram of an item holds it


def plain(text: str) -> str:
    """Lower case, white space collapsed to single spaces."""
    return " ".join(text.lower().replace(_BREAK, " ").split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit name of the q characters from each place on; q is a power of two."""
    h = codes.astype(_U) + _U(1)
    width, power = 1, _ROLL
    while width < q:
        h = h[:-width] * _U(power) + h[width:] if len(h) > width else h[:0]
        power = power * power % (1 << 64)
        width *= 2
    return mix(h)


@dataclass
class Index:
    """The q-grams of items that share a q."""

    q: int
    items: list[str]
    edits: np.ndarray
    bound: np.ndarray  # q-grams that a match shares at least
    gram: np.ndarray  # sorted names
    first: np.ndarray  # where each name's places begin, and the end of the last
    item: np.ndarray  # item and place of each occurrence, by name
    place: np.ndarray
    shift: int
    table: np.ndarray  # which leading bits some name has


@dataclass
class Block:
    """The items of a block: an index for each q, the first item of each index, and the short items
    by their number of words."""

    ids: list
    parts: list[tuple[int, Index]]
    short: dict[int, dict[str, list[int]]]


def budget(size: int, rate: float) -> int:
    return int(size * rate + 1e-9)


def own_q(size: int, q: int, rate: float) -> int:
    """The largest halving of q that leaves a q-gram which edits cannot break."""
    while q > 1 and q * (budget(size, rate) + 1) > size:
        q //= 2
    return q


def build(rows: list[tuple], q: int = Q, rate: float = RATE) -> Block:
    rows = [(i, plain(t)) for i, t in rows if t is not None]
    rows = [(i, t) for i, t in rows if t]
    rows.sort(key=lambda r: 0 if len(r[1]) < SHORT else own_q(len(r[1]), q, rate))
    short: dict[int, dict[str, list[int]]] = {}
    by_q: dict[int, list[int]] = {}
    for k, (_, t) in enumerate(rows):
        if len(t) < SHORT:
            short.setdefault(t.count(" ") + 1, {}).setdefault(t, []).append(k)
        else:
            by_q.setdefault(own_q(len(t), q, rate), []).append(k)
    parts = [(own[0], _index([rows[k][1] for k in own], size, rate)) for size, own in by_q.items()]
    return Block([i for i, _ in rows], parts, short)


def _index(items: list[str], q: int, rate: float) -> Index:
    size = np.array([len(t) for t in items], np.int64)
    edits = np.array([budget(len(t), rate) for t in items], np.int64)
    own = [grams(points(t), q) for t in items]
    name = np.concatenate([*own, np.zeros(0, _U)])
    item = np.repeat(np.arange(len(items)), [len(g) for g in own])
    place = np.concatenate([*[np.arange(len(g)) for g in own], np.zeros(0, np.int64)])
    order = np.argsort(name, kind="stable")
    gram, first = np.unique(name[order], return_index=True)
    bits = min(27, max(16, int(len(gram) * 16).bit_length()))
    table = np.zeros(1 << bits, bool)
    table[(gram >> _U(64 - bits)).astype(np.int64)] = True
    return Index(q, items, edits, size - q + 1 - q * edits, gram, np.append(first, len(name)), item[order], place[order], 64 - bits, table)


def bands(codes: np.ndarray, starts: np.ndarray, index: Index) -> tuple[np.ndarray, ...]:
    """(text, item, band, shared) of the bands that reach the bound; ``starts`` are the places
    where the texts begin in ``codes``."""
    none = (np.zeros(0, np.int64),) * 4
    h = grams(codes, index.q)
    at = np.flatnonzero(index.table[(h >> _U(index.shift)).astype(np.int64)])
    if not len(at) or not len(index.gram):
        return none
    known = np.minimum(np.searchsorted(index.gram, h[at]), len(index.gram) - 1)
    same = index.gram[known] == h[at]
    at, known = at[same], known[same]
    n = index.first[known + 1] - index.first[known]
    hit = np.repeat(index.first[known] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    item = index.item[hit]
    text = np.searchsorted(starts, at, side="right") - 1
    diagonal = np.repeat(at - starts[text], n) - index.place[hit]
    width = index.edits[item] + 1
    longest = max(map(len, index.items))
    wide = len(codes) + 2 * longest + 4
    key = (np.repeat(text, n) * len(index.items) + item) * wide + (diagonal + longest) // width + 1
    half, shared = np.unique(key, return_counts=True)
    follows = np.flatnonzero(half[1:] == half[:-1] + 1)
    shared[follows] += shared[follows + 1]  # uses the old count of the right neighbour only
    half = half[shared >= index.bound[half // wide % len(index.items)]]
    if not len(half):
        return none
    # a q-gram of the item counts once, however often the text repeats it
    seen = []
    for k in range(2):
        to = np.minimum(np.searchsorted(half, key - k), len(half) - 1)
        own = half[to] == key - k
        seen.append(to[own] * longest + index.place[hit[own]])
    shared = np.bincount(np.unique(np.concatenate(seen)) // longest, minlength=len(half))
    enough = shared >= index.bound[half // wide % len(index.items)]
    pair, band = half[enough] // wide, half[enough] % wide - 1
    item = pair % len(index.items)
    return pair // len(index.items), item, band * (index.edits[item] + 1) - longest, shared[enough]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(distance, start, end) of the stretch of ``text`` nearest to ``item``, over the paths
    whose diagonals stay within low..high; of equally near ones the leftmost start."""
    diagonal = np.arange(low, high + 1)
    ramp = (diagonal - low) * _COST
    padded = np.concatenate([text.astype(np.int64), [-1]])
    row = np.where((diagonal >= 0) & (diagonal <= len(text)), diagonal, _FAR)
    for i, c in enumerate(item.tolist(), 1):
        end = diagonal + i  # place in the text after this row
        inside = (end >= 0) & (end <= len(text))
        last = padded[np.clip(end - 1, -1, len(text))]
        step = np.where(end >= 1, row + np.where(last == c, 0, _COST), _FAR)
        step[:-1] = np.minimum(step[:-1], row[1:] + _COST)
        step = np.where(inside, step, _FAR)
        row = np.minimum.accumulate(step - ramp) + ramp
        row = np.where(inside, row, _FAR)
    best = int(np.argmin(row))
    value = int(row[best])
    return value // _COST, value % _COST, int(diagonal[best]) + len(item)


def matches(own: list[str], block: Block) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """(text, item) -> (distance, start, end, shared) of the nearest stretch, where it is within
    the item's edits; places count characters of the plain text.  Of a short item, shared counts its
    characters."""
    found = {(t, first + k): v for first, index in block.parts for (t, k), v in _near(own, index).items()}
    for t, text in enumerate(own if block.short else []):
        words = text.split(" ")
        for n, table in block.short.items():
            for k in range(len(words) - n + 1):
                phrase = words[k] if n == 1 else " ".join(words[k : k + n])
                for item in table.get(phrase, ()):
                    if (t, item) not in found:
                        at = len(" ".join(words[:k])) + (k > 0)
                        found[t, item] = (0, at, at + len(phrase), len(phrase))
    return found


def _near(own: list[str], index: Index) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    codes = points(_BREAK.join([*own, ""]))
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in own])])[:-1]
    found: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for text, item, low, shared in zip(*(x.tolist() for x in bands(codes, starts, index))):
        known = found.get((text, item))
        if known is not None and known[0] == 0:
            continue
        edits, query = int(index.edits[item]), index.items[item]
        at = own[text].find(query, max(0, low))
        if at >= 0:
            value = (0, at, at + len(query), shared)
        else:
            begin = max(0, low - edits)
            end = low + 3 * edits + 2 + len(query)  # the last diagonal is low + 2 * edits + 1
            part = points(own[text][begin:end])
            distance, start, stop = align(points(query), part, low - edits - begin, low + 3 * edits + 1 - begin)
            if distance > edits:
                continue
            value = (distance, start + begin, stop + begin, shared)
        if known is None or value[:2] < known[:2]:
            found[text, item] = value
    return found


def _plain_texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [plain(t.decode("utf-8", "replace")) for t in texts(batch.column(batch.schema.get_field_index(column)))]


def _pairs(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = matches(_plain_texts(batch, "text"), index.value)
            if found:
                row, item = zip(*found)
                distance, start, end, shared = zip(*found.values())
                numbers = [pa.array(x, pa.int64()) for x in (start, end, distance, shared)]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(item, pa.int32()), *numbers], ["id", "item", "start", "end", "distance", "n_shared"])

    return run


def _clean(index, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            held = {row for row, _ in matches(_plain_texts(batch, text_col), index.value)}
            yield batch.take(pa.array([k for k in range(batch.num_rows) if k not in held], pa.int64()))

    return run


def blocks(items: DataFrame, item_col: str, text_col: str, q: int, rate: float, block_bytes: int) -> Iterator[Block]:
    """The indexes of the benchmark's blocks.  A block is collected by itself; its expected size
    is at most ``block_bytes``, whatever the size of the benchmark."""
    source = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, ceil(total / block_bytes))
    source = source.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    for k in range(count):
        rows = source.where(F.col("block") == k).orderBy("item", "text").select("item", "text").collect()
        yield build([tuple(r) for r in rows], q, rate)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", q: int = Q, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` and benchmark item that it holds: id, item id, start and end
    (in the plain text) of the nearest stretch, distance, n_shared."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType
    out = None
    for index in blocks(benchmark, item_col, item_text_col, q, rate, block_bytes):
        found = source.mapInArrow(_pairs(spark.sparkContext.broadcast(index)), f"id {id_type}, item int, start long, end long, distance long, n_shared long")
        own = F.array(*[F.lit(i).cast(item_type) for i in index.ids]) if index.ids else F.array(F.lit(None).cast(item_type))
        part = found.select(F.col("id").alias(id_col), own[F.col("item")].alias(item_col), "start", "end", "distance", "n_shared")
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", q: int = Q, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    for index in blocks(benchmark, item_col, item_text_col, q, rate, block_bytes):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(index), text_col), docs.schema)
    return docs
