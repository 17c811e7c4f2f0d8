"""Operator 1, suffix-array dedup by prefix-free parsing.

A byte goes if a string of ``length`` bytes that covers it also starts somewhere else in the
corpus.  In suffix-array terms: two corpus suffixes share their first ``length`` bytes.

* **Parse.** A rolling hash runs over all 16-byte windows.  The smallest of every ``SPAN``
  consecutive hashes is a trigger; triggers cut a text into phrases.  Every string of
  ``length`` bytes holds the trigger of its first ``SPAN`` windows, and equal strings hold
  the same trigger at the same place, so a phrase is never longer than ``SPAN + 16`` bytes
  and no repeat can hide between triggers.
* **Dictionary and parse order.** A corpus suffix is (the end of a phrase up to its trigger,
  what follows the trigger).  Only equality of the first ``length`` bytes is asked, so both
  halves are ordered by their 64-bit name (a polynomial hash) in place of the lexicographic
  rank: equal neighbours in that order are the repeats, and no text is compared pairwise.
* **Merging the two.** Suffixes that share a trigger form a run of neighbouring starts.  Runs
  are combined map-side, and one row per different run goes through Spark: first the name of the ``core`` (what every suffix of the
  run holds after its trigger), then, for cores found twice, the name of the whole run.  A
  run found twice is repeated throughout.  Only runs whose core repeats while the run does
  not (the edges of repeats) are opened suffix by suffix, grouped by core, beside one member
  of each repeated run of that core; a core with very many of them is dealt to several
  groups, whose leftovers meet by suffix name.

Rows with the same id and the same text share a key and a result; each still counts as a copy
of the other.  Null text: empty.  Null id: kept, as an id of its own.  Texts shorter than
``length``: nothing is removed.  Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drapekit.llm.common import CHUNK_BYTES, Names, mix, row_key, slices, utf8, written

GRAM = 16  # bytes under the rolling hash
CORE = 64  # bytes after a trigger that name its run's core
GROUP = 8192  # runs of one core that a group opens; more are dealt to further groups
POS_BITS = 27  # of a piece; pieces are far shorter

MARK_BITS = 24  # of a mark, for the number of further starts
MORE = (1 << MARK_BITS) - 1

RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
RESULT_TYPES = [T.StructField(c, T.StringType() if c == "kept_sha256" else T.LongType()) for c in RESULT]

_U = np.uint64
_ROLL = 0x100000001B3


def _triggers(data: np.ndarray, span: int) -> np.ndarray:
    """For every start, the trigger of the ``span`` windows from there: the smallest hash, and
    of equal ones the last."""
    h = data.astype(_U) + _U(1)
    width, power = 1, _ROLL
    while width < GRAM:
        h = h[:-width] * _U(power) + h[width:]
        power = power * power % (1 << 64)
        width *= 2
    low = _U((1 << POS_BITS) - 1)
    key = (mix(h) & ~low) | (low - np.arange(len(h), dtype=_U))
    width = 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if span > width:
        key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
    return (low - (key & low)).astype(np.int64)


def _runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start and trigger of each run of the texts between ``offsets``."""
    span = length - CORE + 1
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    trigger = _triggers(data, span)
    starts, ends = offsets[:-1], offsets[1:]
    long = ends - starts >= length
    inside = np.zeros(len(data) + 2, np.int8)
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    inside = np.cumsum(inside)[: len(trigger)] > 0
    cut = np.flatnonzero((trigger[1:] != trigger[:-1]) | (inside[1:] != inside[:-1])) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(trigger) - 1]])
    kept = inside[first]
    first, last = first[kept], last[kept]
    return first, last, trigger[first]


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, shift within it, bytes, offsets): all texts at once or, for a text beyond
    the chunk size, overlapping pieces that hold every start once."""
    if len(data) <= 2 * CHUNK_BYTES:
        yield 0, 0, data, offsets
        return
    for k in range(len(offsets) - 1):
        for at in range(int(offsets[k]), int(offsets[k + 1]), CHUNK_BYTES):
            end = min(at + CHUNK_BYTES + length - 1, int(offsets[k + 1]))
            yield k, at - int(offsets[k]), data[at:end], np.array([0, end - at])


def _run_rows(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(core, run name, key, mark) of each run, in order; a mark packs the first start and the
    number of further starts."""
    keys = np.asarray(batch.column("key"))
    data, offsets = utf8(batch.column("text"))
    for k, shift, piece, cuts in _pieces(data, offsets, length):
        first, last, trigger = _runs(piece, cuts, length)
        if not len(first):
            continue
        names = Names(piece)
        core = names.of(trigger, trigger + CORE)
        shape = (trigger - first) * 256 + (last - first)
        whole = mix(names.raw(first, last + length) + shape.astype(_U) * _U(0x9E3779B97F4A7C15))
        text = np.searchsorted(cuts, first, side="right") - 1
        yield core, whole, keys[k + text], ((first - cuts[text] + shift) << MARK_BITS) | (last - first)


def _cores(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for core, *_ in _run_rows(batch, length):
                value, n = np.unique(core.view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], ["core", "n"])

    return run


def _joined(key: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of one text that follow each other become one."""
    start, more = mark >> MARK_BITS, mark & MORE
    head = np.ones(len(mark), bool)
    head[1:] = (key[1:] != key[:-1]) | (start[1:] != (start + more)[:-1] + 1)
    at = np.flatnonzero(head)
    tail = np.append(at[1:], len(mark)) - 1
    return key[at], (start[at] << MARK_BITS) | (start + more)[tail] - start[at]


def _combined(length: int):
    """Runs combined map-side: one row for each different run of a chunk, with its count, and
    the marks of those that the chunk holds more than once (n = 0; their core matches none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for core, whole, key, mark in _run_rows(batch, length):
                _, at, back, n = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
                own = n[back] > 1
                known_key, known = _joined(key[own], mark[own]) if own.any() else (key[:0], mark[:0])
                none = np.zeros(len(known), np.int64)
                columns = [
                    np.concatenate([core[at].view(np.int64), mix(known_key.astype(_U)).view(np.int64)]),
                    np.concatenate([whole[at].view(np.int64), none]),
                    np.concatenate([key[at], known_key]),
                    np.concatenate([mark[at], known]),
                    np.concatenate([n, none]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["core", "run", "key", "mark", "n"])

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and flat values of a list column; a null list is empty."""
    length = np.nan_to_num(np.asarray(pc.list_value_length(column).fill_null(0))).astype(np.int64)
    return np.concatenate([[0], np.cumsum(length)]), column.flatten()


def _covered(n: int, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Which of n bytes the strings that start at first..last cover."""
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, first, 1)
    np.add.at(mark, last + length, -1)
    return np.cumsum(mark)[:n] > 0


def _result(text: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed stretches, what is left."""
    if not len(first):
        return len(text), 0, 0, text.tobytes()
    gone = _covered(len(text), first, last, length)
    cuts = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return len(text), int(gone.sum()), cuts, text[~gone].tobytes()


def _settle(length: int, keep_open: bool, with_text: bool):
    """Result of each text from its repeated runs.  With ``keep_open``, a text that still has
    open runs passes through with its text instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            at, flat = _lists(batch.column("runs"))
            flat = np.asarray(flat, dtype=np.int64)
            first = flat >> MARK_BITS
            last = first + (flat & MORE)
            wait = np.diff(_lists(batch.column("open"))[0]) > 0 if keep_open else np.zeros(batch.num_rows, bool)
            found = []
            for k in range(batch.num_rows):
                own = data[offsets[k] : offsets[k + 1]]
                if wait[k]:
                    found.append((None, None, None, None, own.tobytes().decode()))
                    continue
                *numbers, left = _result(own, first[at[k] : at[k + 1]], last[at[k] : at[k + 1]], length)
                # a cut inside a character leaves bytes that are no text
                found.append((*numbers, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            done = [pa.array(x, t) for x, t in zip(zip(*found), kinds)]
            columns = [batch.column("rest"), *done]
            names = ["rest", *RESULT, "text"]
            if keep_open:
                kept = pa.array(np.arange(batch.num_rows), mask=~wait)  # null where settled
                columns += [batch.column("key"), *[batch.column(c).take(kept) for c in ("runs", "open")]]
                names += ["key", "runs", "open"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _contexts(length: int):
    """The bytes of each open run, from its first start to the end of its last string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            at, flat = _lists(batch.column("open"))
            if not at[-1]:
                continue
            rows = np.repeat(np.arange(batch.num_rows), np.diff(at))
            for k in range(0, len(rows), 4096):
                row, part = rows[k : k + 4096], flat.slice(k, 4096)
                mark = np.asarray(part.field("mark"), dtype=np.int64)
                start = offsets[row] + (mark >> MARK_BITS)
                size = (mark & MORE) + length
                cuts = np.concatenate([[0], np.cumsum(size)])
                gathered = data[np.arange(cuts[-1]) - np.repeat(cuts[:-1] - start, size)]
                ctx = pa.Array.from_buffers(pa.binary(), len(mark), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(gathered)])
                key = pa.array(np.asarray(batch.column("key"))[row])
                yield pa.RecordBatch.from_arrays([part.field("core"), part.field("groups"), key, part.field("mark"), ctx], ["core", "groups", "key", "mark", "ctx"])

    return run


def _open_runs(length: int):
    """Per group (a core, or a share of a hot core's runs): runs of repeated starts as
    (key, mark), and for shares of a hot core the starts that are still single, by name."""

    def opened(groups, key, mark, ctx) -> pa.RecordBatch:
        data, cuts = ctx
        count = (mark & MORE) + 1
        row = np.repeat(np.arange(len(mark)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = cuts[row] + step
        names = Names(data)
        # the suffix's two halves: up to its trigger, and from there on
        name = names.of(start, start + length)
        order = np.argsort(name, kind="stable")
        ranked = name[order]
        same = ranked[1:] == ranked[:-1]
        again = np.zeros(len(name), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        place = (mark[row] >> MARK_BITS) + step
        # neighbouring repeated starts of one run become one row
        begins = again & ~(np.concatenate([[False], again[:-1]]) & (step > 0))
        head = np.flatnonzero(begins)
        size = np.add.reduceat(again.astype(np.int64), head) if len(head) else np.zeros(0, np.int64)
        shared = groups[row] > 1
        lone = np.flatnonzero(shared & ~again)
        firsts = np.zeros(len(name), bool)
        firsts[order[np.concatenate([[True], ~same])]] = True
        proxy = np.flatnonzero(shared & again & firsts)
        none = np.zeros(len(proxy), np.int64)
        kind = np.concatenate([np.zeros(len(head), np.int64), np.ones(len(lone), np.int64), none + 2])
        out = [
            kind,
            np.concatenate([np.zeros(len(head), np.int64), name[lone].view(np.int64), name[proxy].view(np.int64)]),
            np.concatenate([key[row[head]], key[row[lone]], none]),
            np.concatenate([(place[head] << MARK_BITS) | (size - 1), place[lone] << MARK_BITS, none]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["kind", "name", "key", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(parts):
            t = pa.Table.from_batches(parts).combine_chunks()
            col = {c: np.asarray(t[c]) for c in ("groups", "key", "mark")}
            ctx = t["ctx"].combine_chunks()
            ctx = ctx.chunk(0) if isinstance(ctx, pa.ChunkedArray) else ctx
            return opened(*col.values(), utf8(ctx))

        for batch in batches:  # sorted by group: cut where a group ends
            group = np.asarray(batch.column("group"))
            ends = np.flatnonzero(group[1:] != group[:-1]) + 1
            if held and len(group) and held[-1].column("group")[-1].as_py() != group[0] and size > CHUNK_BYTES:
                yield flush(held)
                held, size = [], 0
            at = 0
            for end in [*ends.tolist(), len(group)]:
                part = batch.slice(at, end - at)
                if held and at and size > CHUNK_BYTES:
                    yield flush(held)
                    held, size = [], 0
                held.append(part)
                data, cuts = utf8(part.column("ctx"))
                size += len(data)
                at = end
        if held:
            yield flush(held)

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256.  ``length``
    is between 2 * CORE and CORE + 255 (a run's starts fit 8 bits)."""
    return _settled(docs, [id_col], id_col, text_col, length, False).select(F.col("rest.c0").alias(id_col), *RESULT)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """The rows of ``docs``, all columns, with the repeated bytes removed from their texts; of a
    character that a cut splits, nothing is left."""
    others = [c for c in docs.columns if c != text_col]
    found = _settled(docs, others, id_col, text_col, length, True)
    own = {c: F.col(f"rest.c{k}") for k, c in enumerate(others)} | {text_col: F.col("text")}
    return found.select(*[own[c].alias(c) for c in docs.columns])


def _marks(keyed: DataFrame, length: int) -> DataFrame:
    """Per key of (key, text) its repeated runs and its open runs."""
    if not 2 * CORE <= length <= CORE + 255:
        raise ValueError(f"length must be between {2 * CORE} and {CORE + 255}")
    source = keyed.select("key", "text")
    cores = source.mapInArrow(_cores(length), "core long, n long").groupBy("core").agg(F.sum("n").alias("c")).where("c > 1").select("core", F.lit(True).alias("again"))
    runs = source.mapInArrow(_combined(length), "core long, run long, key long, mark long, n long").join(cores, "core", "left").where("again or n = 0").drop("again")
    runs = written(runs, "op1-runs")
    found_here = runs.where("n = 0").select("key", "mark")
    runs = runs.where("n > 0")
    # one member stands for a run's copies: it is the partner that open suffixes may have there
    found = runs.groupBy("run").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("core", "key", "mark")])
    found = written(found, "op1-found")
    single, member = found.where("n = 1").select("core", "key", "mark"), found.where("n > 1")
    member_open = member.select("core", "key", "mark").join(single.select("core").distinct(), "core", "left_semi")
    opened = single.unionByName(member_open)
    hot = opened.groupBy("core").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > GROUP)
    hot = hot.select("core", F.ceil(F.col("c") / GROUP).cast("long").alias("groups"))
    opened = opened.join(hot, "core", "left").select("key", F.struct("core", "mark", F.coalesce("groups", F.lit(1)).alias("groups")).alias("o"), F.lit(None).cast("long").alias("r"))
    whole = runs.where("n = 1").select("run", "key", "mark").join(member.select("run"), "run").select("key", "mark").unionByName(found_here)
    whole = whole.select("key", F.lit(None).cast(opened.schema["o"].dataType).alias("o"), F.col("mark").alias("r"))
    return whole.unionByName(opened).groupBy("key").agg(F.collect_set("r").alias("runs"), F.collect_set("o").alias("open"))


def _settled(docs: DataFrame, others: list[str], id_col: str, text_col: str, length: int, with_text: bool) -> DataFrame:
    """(rest, the RESULT, text): ``rest`` holds the columns ``others`` as c0, c1, ..."""
    rest = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(others)])
    keyed = docs.select(rest.alias("rest"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), row_key(id_col, text_col).alias("key"))
    marks = _marks(keyed, length)
    done = T.StructType([keyed.schema["rest"], *RESULT_TYPES, T.StructField("text", T.StringType())])
    waiting = T.StructType([*done, T.StructField("key", T.LongType()), *[T.StructField(c, marks.schema[c].dataType) for c in ("runs", "open")]])
    first = written(keyed.join(marks, "key", "left").mapInArrow(_settle(length, True, with_text), waiting), "op1-first")
    pending = first.where("open is not null")
    ctx = pending.select("key", "text", "open").mapInArrow(_contexts(length), "core long, groups long, key long, mark long, ctx binary")
    ctx = ctx.withColumn("group", F.xxhash64("core", F.pmod(F.xxhash64("key", "mark"), F.col("groups"))))
    ctx = ctx.repartition("group").sortWithinPartitions("group")
    found = written(ctx.mapInArrow(_open_runs(length), "kind long, name long, key long, mark long"), "op1-open")
    late = found.where("kind > 0").groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    late = found.where("kind = 1").join(late, "name").select("key", "mark")
    more = found.where("kind = 0").select("key", "mark").unionByName(late).groupBy("key").agg(F.collect_set("mark").alias("more"))
    last = pending.join(more, "key", "left").select("rest", "text", F.concat("runs", F.coalesce("more", F.array().cast("array<long>"))).alias("runs"))
    return first.where("open is null").select(*done.names).unionByName(last.mapInArrow(_settle(length, False, with_text), done))
