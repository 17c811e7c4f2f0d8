"""Operator 2, language-model scoring by cross-entropy difference.

Two bigram models, one of a target text collection and one of a background collection, share one
vocabulary and one smoothing.  Each document is scored by its loss per word under either model;
the difference (target minus background) is low for documents that look like the target.

* **Counts** cover every word and every pair of both collections, and all of them are the model.
* **Chunks.** Both collections are read once and written as chunks of some megabytes of text: the
  texts' ids, the chunk's own vocabulary, and the words as places in it.  A chunk asks for what it
  holds and is answered, so no pair of words ever is a row:
  1. each chunk sends its distinct pairs with their counts to routes (ranges of pair names);
     a route adds them up, and sends every chunk the whole counts of its own pairs.  One chunk of
     those that hold a pair is told that it is the first;
  2. words and histories go the same way.  A history's number of pairs is a sum over the
     chunks that hold a pair first;
  3. with both answers a chunk adds up the losses of its texts.
* **Size.** Routes grow in number with the words of both collections, so a route is bounded.  A pair
  is at most one entry of each chunk, however frequent it is, so none weighs on one route.
* **Smoothing.** Interpolated absolute discounting: what the pairs of a history give up goes to the
  lower order, which adds one to every count of the shared vocabulary and one for unknown words.
* ``WORD_SHARE`` and ``PAIR_SHARE`` are 0.  Above it, words that make up less of either collection
  share the unknown word, and pairs that do use the lower order.

Words and pairs go by 64-bit names.  Words are runs of letters, digits and bytes beyond ASCII,
lower-cased.  A text without words (null, empty) has no losses: n_words 0, all three values 0.
Null ids and repeated rows: kept and counted.  Empty documents: empty result.  An empty
collection counts nothing, so its model is uniform over the vocabulary.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drapekit.llm.common import Names, mix, slices, spans, utf8, word_bytes, written

WORD_SHARE = 0.0
PAIR_SHARE = 0.0
DISCOUNT = 0.75
#: bytes of text in a chunk, words of both collections per route
CHUNK = 4_000_000
ROUTE = 2_000_000

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
# names that no word has: the start of a text, the unknown word
START, UNKNOWN = 0, 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name, text) of every word."""
    data = word_bytes()[data]
    start, end, text = spans(data != 0x20, offsets)
    return Names(data).of(start, end), text


def _packed(values: np.ndarray) -> bytes:
    """Numbers by byte planes, so that bytes that are zero throughout take no room."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _packed_names(names: np.ndarray) -> bytes:
    """Ascending names by their steps."""
    return _packed(np.diff(names, prepend=_U(0)))


def _unpacked_names(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob, _U), dtype=_U)


_WORDS = "chunk long, ids array<{id}>, n binary, target binary, vocabulary binary, words binary, t long, b long"


def _chunk_row(chunk: int, ids: pa.Array, n: np.ndarray, target: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
    vocabulary, at = np.unique(np.append(names, _U(START)), return_inverse=True)
    size = len(vocabulary)
    place = at[:-1].astype(np.uint16 if size <= 1 << 16 else np.uint32)
    t = int(n[target].sum())
    columns = {
        "chunk": pa.array([chunk]),
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        "n": pa.array([_packed(n.astype(np.int64))], pa.binary()),
        "target": pa.array([_packed(target)], pa.binary()),
        "vocabulary": pa.array([_packed_names(vocabulary)], pa.binary()),
        "words": pa.array([_packed(place.astype(np.uint32))], pa.binary()),
        "t": pa.array([t]),
        "b": pa.array([int(n.sum()) - t]),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    for batch in slices(batches, "text", CHUNK):
        name, text = words_of(*utf8(batch.column("text")))
        ids = pa.concat_arrays([batch.column("id")])
        yield _chunk_row(chunk, ids, np.bincount(text, minlength=batch.num_rows), batch.column("target").to_numpy(zero_copy_only=False), name)
        chunk += 1


class _Chunk:
    """A chunk's texts: of every word its text, history and pair; the distinct pairs by name."""

    def __init__(self, row: pa.Table):
        blob = {c: row.column(c)[0].as_py() for c in ("n", "target", "vocabulary", "words")}
        self.id = row.column("chunk")[0].as_py()
        self.n, self.target = _unpacked(blob["n"], np.int64), _unpacked(blob["target"], bool)
        self.vocabulary = _unpacked_names(blob["vocabulary"])
        self.words = _unpacked(blob["words"], np.uint32).astype(np.int64)
        self.text = np.repeat(np.arange(len(self.n)), self.n)
        before = np.zeros(len(self.words), np.int64)  # START is the least name
        same = self.text[1:] == self.text[:-1]
        before[1:][same] = self.words[:-1][same]
        pair = mix(self.vocabulary[before] * _ODD + self.vocabulary[self.words])
        self.name, at, self.pair = np.unique(pair, return_index=True, return_inverse=True)
        self.u, self.w = before[at], self.words[at]

    def by_side(self, of: np.ndarray, size: int) -> np.ndarray:
        """How many words of the target and of the background have each value of ``of``."""
        target = self.target[self.text]
        return np.stack([np.bincount(of[side], minlength=size) for side in (target, ~target)])


def _split(chunk: int, names: np.ndarray, values: np.ndarray, routes: int) -> pa.Table:
    """What a chunk asks each route: ascending names, and their values on rows."""
    route = ((names >> _U(32)) * _U(routes)) >> _U(32)
    of, at = np.unique(route, return_index=True)
    ends = np.append(at[1:], len(names))
    return pa.table({
        "route": pa.array(of.astype(np.int64)),
        "chunk": pa.array(np.full(len(of), chunk, np.int64)),
        "names": pa.array([_packed_names(names[a:e]) for a, e in zip(at, ends)], pa.binary()),
        "v": pa.array([_packed(values[:, a:e].astype(np.int64)) for a, e in zip(at, ends)], pa.binary()),
    })


_ASKED = "route long, chunk long, names binary, v binary"
_ANSWER = "chunk long, route long, words boolean, v binary, found long"


def _answer(words: bool) -> Callable[[pa.Table], pa.Table]:
    """Adds up a route's values by name and sends each chunk the sums at its own names.  For pairs
    two more rows say where a name has its first value above zero, by side."""

    def run(asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("chunk")
        names = [_unpacked_names(x.as_py()) for x in asked.column("names")]
        values = np.concatenate([_unpacked(x.as_py(), np.int64).reshape(-1, len(k)) for x, k in zip(asked.column("v"), names)], axis=1)
        known, of = np.unique(np.concatenate(names), return_inverse=True)
        sums = np.zeros((len(values), len(known)), np.int64)
        for total, own in zip(sums, values):
            np.add.at(total, of, own)
        out = [row[of] for row in sums]
        if not words:
            for own in values:
                first = np.zeros(len(of), np.int64)
                some = np.flatnonzero(own)
                first[some[np.unique(of[some], return_index=True)[1]]] = 1
                out.append(first)
        ends = np.cumsum([len(k) for k in names])
        out = np.split(np.stack(out), ends[:-1], axis=1)
        found = np.count_nonzero((sums[0] + sums[1] > 0) & (known != UNKNOWN)) if words else 0
        return pa.table({
            "chunk": asked.column("chunk"),
            "route": asked.column("route"),
            "words": pa.array(np.full(len(names), words)),
            "v": pa.array([_packed(x) for x in out], pa.binary()),
            "found": pa.array([found] + [0] * (len(names) - 1)),
        })

    return run


def _answers(answers: pa.Table, words: bool, rows: int) -> np.ndarray:
    """A chunk's answers, in the order of its names."""
    answers = answers.filter(pc.equal(answers.column("words"), words)).sort_by("route")
    parts = [_unpacked(x.as_py(), np.int64).reshape(rows, -1) for x in answers.column("v")]
    return np.concatenate([np.zeros((rows, 0), np.int64), *parts], axis=1)


def _ask_words(routes: int) -> Callable[[pa.Table], pa.Table]:
    def run(row: pa.Table) -> pa.Table:
        c = _Chunk(row)
        return _split(c.id, c.vocabulary, c.by_side(c.words, len(c.vocabulary)), routes)

    return run


def _ask_pairs(routes: int) -> Callable[[pa.Table], pa.Table]:
    def run(row: pa.Table) -> pa.Table:
        c = _Chunk(row)
        return _split(c.id, c.name, c.by_side(c.pair, len(c.name)), routes)

    return run


def _each(by: Callable[[pa.Table], pa.Table]) -> Callable:
    """``by`` on one chunk after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from by(pa.Table.from_batches([batch.slice(k, 1)])).to_batches()

    return run


def _seen(counts: np.ndarray, total: tuple[int, int], share: float) -> np.ndarray:
    """Four times what is left of pairs' counts (t, b) after the discount; 0 where the pair does not
    make up the share of either side."""
    explicit = np.any([(n > 0) & (n >= share * every) for n, every in zip(counts, total)], axis=0)
    return np.where(explicit, np.maximum(4 * counts - int(4 * DISCOUNT), 0), 0)


def _ask_histories(routes: int, total: tuple[int, int], share: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of each word: its count, how often it is a history, what the pairs keep that are first seen
    here; each for the target and the background."""

    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        if not row.num_rows:
            return _split(0, np.zeros(0, _U), np.zeros((6, 0)), routes)
        c = _Chunk(row)
        size = len(c.vocabulary)
        got = _answers(answers, False, 4)
        kept = _seen(got[:2], total, share) * got[2:]
        taken = [np.bincount(c.u, weights=k, minlength=size) for k in kept]
        return _split(c.id, c.vocabulary, np.concatenate([c.by_side(c.words, size), c.by_side(c.u[c.pair], size), taken]), routes)

    return run


def _losses(total: tuple[int, int], size: int, share: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        ids = row.column("ids").combine_chunks().flatten()
        if not row.num_rows:
            return pa.table({"id": ids, "n_words": pa.array([], pa.int64()), "t": pa.array([], pa.float64()), "b": pa.array([], pa.float64())})
        c = _Chunk(row)
        seen = _seen(_answers(answers, False, 4)[:2], total, share) / 4
        got = _answers(answers, True, 6)
        sums = []
        for side in (0, 1):
            count, after, taken = got[side], got[2 + side], got[4 + side] / 4
            low = (count + 1) / (total[side] + size + 1)
            left = np.where(after > 0, 1 - taken / np.maximum(after, 1), 1.0)
            loss = -np.log(seen[side] / np.maximum(after, 1)[c.u] + left[c.u] * low[c.w])
            sums.append(np.bincount(c.text, weights=loss[c.pair], minlength=len(c.n)).astype(float))
        docs = pa.array(~c.target)
        return pa.table({"id": ids, "n_words": pa.array(c.n), "t": pa.array(sums[0]), "b": pa.array(sums[1])}).filter(docs)

    return run


def _without_rare(total: tuple[int, int], share: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The chunk with words under the share replaced by the unknown word."""

    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        if not row.num_rows:
            return row
        c = _Chunk(row)
        kept = _seen(_answers(answers, True, 2), total, share).any(axis=0)
        names = np.where(kept, c.vocabulary, _U(UNKNOWN))[c.words]
        return pa.Table.from_batches([_chunk_row(c.id, row.column("ids").combine_chunks().flatten(), c.n, c.target, names)])

    return run


def _settled(df: DataFrame, name: str) -> DataFrame:
    """``written``; the shuffle files behind it go as soon as the table stands."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return written(df.select("*"), name)
    finally:
        conf.set(key, before)


def lm_scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """id, n_words, target_loss, background_loss (nats per word), score (their difference) of
    every row of ``docs``, which are the background as well."""
    both = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(False).alias("target"))
    id_type = both.schema["id"].dataType.simpleString()
    both = both.unionByName(target.select(F.lit(None).cast(id_type).alias("id"), F.col(target_text_col).alias("text"), F.lit(True).alias("target")))
    chunks = _settled(both.mapInArrow(_chunks, _WORDS.format(id=id_type)), "op2-chunks")
    total = tuple(chunks.agg(*[F.coalesce(F.sum(k), F.lit(0)) for k in "tb"]).first())
    routes = 1 + sum(total) // ROUTE

    def asked(of: DataFrame, by: Callable) -> DataFrame:
        return of.mapInArrow(_each(by), _ASKED)

    def answered(asks: DataFrame, words: bool, name: str) -> DataFrame:
        return _settled(asks.groupBy("route").applyInArrow(_answer(words), _ANSWER), name)

    def meet(answers: DataFrame, by: Callable, schema: str) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(by, schema)

    if WORD_SHARE:
        counts = answered(asked(chunks, _ask_words(routes)), True, "op2-counts")
        chunks = _settled(meet(counts, _without_rare(total, WORD_SHARE), _WORDS.format(id=id_type)), "op2-chunks")
    pairs = answered(asked(chunks, _ask_pairs(routes)), False, "op2-pairs")
    words = answered(meet(pairs, _ask_histories(routes, total, PAIR_SHARE), _ASKED), True, "op2-words")
    size = words.agg(F.coalesce(F.sum("found"), F.lit(0))).first()[0]
    out = meet(pairs.unionByName(words), _losses(total, size, PAIR_SHARE), f"id {id_type}, n_words long, t double, b double")
    mean = {k: F.when(F.col("n_words") > 0, F.col(k) / F.col("n_words")).otherwise(0.0) for k in "tb"}
    return out.select(F.col("id").alias(id_col), "n_words", mean["t"].alias("target_loss"), mean["b"].alias("background_loss")).withColumn("score", F.col("target_loss") - F.col("background_loss"))
