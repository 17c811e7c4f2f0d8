"""Operator 11, phrase collocations by multikey three-way quicksort of suffix pointers.

Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and 0x0A-0x0D, pieces into words at 0x20
and 0x09.  Every word starts a suffix; only its first ``max_words`` words within the piece matter.

* **Words** of each language are counted first.  They give the totals, the single words' counts, and
  the words that make up more than a route's even share of all words: fewer than there are routes.
* **Routes.** Suffixes are summed up in each task and dealt by language and leading two words, those
  led by two frequent words by all their words, so that no frequent beginning meets in one task.
  What a task sends to a route is one compressed block.
* **Sort.** A route sorts pointers to its suffixes by multikey three-way quicksort: a range is split
  by a pivot word into less, equal and greater; equal goes on with the next word, down to
  ``max_words``.  The weight of an equal range is the phrase's count.  Ranges under ``least`` are
  abandoned whole.  All ranges of a round are split in the same array operations.
* **Scores.** A phrase's count is set against its two parts for every cut, in exact decimals, by joins
  of the table of frequent phrases with itself.  A phrase that stands in a longer one at least half
  as frequent is dropped, and the best of each language are ranked in two steps, salted first.

Null language: ``und``, together with rows that say so.  Null and empty texts: no words.  Repeated
rows: counted each.  Null ids do not matter.  Ties in score go to the more frequent phrase, then to the
smaller in byte order; ties of cuts to the earliest.  Empty table: empty result.  Other columns are
ignored.  A text is cut into words by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drapekit.llm.common import mix, slices, spans, utf8, written

LEAST = 10
MAX_WORDS = 3
TOP = 2000
#: a phrase goes if a longer one around it has at least this share of its count, in hundredths
CONTAINED = 50
#: bytes of text that a task sums up at a time
BLOCK_BYTES = 8_000_000
SALTS = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def _mask(*values: int) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(values)] = True
    return mask


LOWER = _lower()
#: fixed values: what ends a piece, and what else ends a word
ENDS = _mask(*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D)
GAPS = _mask(0x20, 0x09)


class Block:
    """The words of some texts: ids into ``words``, the language of each, and whether the next word
    follows in the same piece."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = utf8(batch.column("text"))
        data = LOWER[data]
        ends = ENDS[data]
        inside = ~(ends | GAPS[data])
        start, end, text = spans(inside, offsets)
        before = np.concatenate([[0], np.cumsum(ends)])
        self.joined = np.zeros(len(start), bool)
        self.joined[:-1] = (text[1:] == text[:-1]) & (before[start[1:]] == before[end[:-1]])
        at = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data[inside])]).dictionary_encode()
        self.ids, self.words = found.indices.to_numpy(), found.dictionary
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy()[text]

    def suffixes(self, depth: int) -> list[np.ndarray]:
        """Language and ``depth`` words (id + 1; 0 past the piece's end) of every suffix of two
        words or more."""
        n = len(self.ids)
        own = np.flatnonzero(self.joined)
        columns = [self.lang[own], self.ids[own] + 1]
        whole = np.ones(len(own), bool)
        for d in range(1, depth):
            whole = whole & self.joined[np.minimum(own + d - 1, n - 1)]
            columns.append(np.where(whole, self.ids[np.minimum(own + d, n - 1)] + 1, 0))
        return columns


def _heads(columns: list[np.ndarray]) -> np.ndarray:
    """Where a run of equal rows starts."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BLOCK_BYTES):
        block = Block(batch)
        key, count = np.unique(block.lang.astype(np.int64) * max(1, len(block.words)) + block.ids, return_counts=True)
        lang, word = np.divmod(key, max(1, len(block.words)))
        yield pa.RecordBatch.from_arrays([block.langs.take(pa.array(lang)), block.words.take(pa.array(word)).cast(pa.string()), pa.array(count)], ["lang", "phrase", "n"])


def _hashes(values: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(v) for v in values.to_pylist()], np.uint64)


def _routed(routes: int, frequent: dict[str, list[bytes]], depth: int):
    """One row per route of each block of texts: its suffixes with their numbers, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            block = Block(batch)
            columns = block.suffixes(depth)
            if not len(columns[0]):
                continue
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            head = _heads(columns)
            count = np.diff(np.append(head, len(order)))
            columns = [c[head] for c in columns]
            hot = np.zeros((len(block.langs), len(block.words) + 1), bool)
            for k, lang in enumerate(block.langs.to_pylist()):
                if lang in frequent:
                    hot[k, 1:] = pc.is_in(block.words, value_set=pa.array(frequent[lang], pa.binary())).to_numpy(zero_copy_only=False)
            split = hot[columns[0], columns[1]] & hot[columns[0], columns[2]]
            name = np.append(np.uint64(0), _hashes(block.words))
            route = _hashes(block.langs)[columns[0]]
            for d in range(1, depth + 1):
                step = mix(route * _ODD + name[columns[d]])
                route = step if d <= 2 else np.where(split, step, route)
            route = (route >> np.uint64(7)) % np.uint64(routes)
            order = np.argsort(route, kind="stable")
            route, columns, count, split = route[order], [c[order] for c in columns], count[order], split[order]
            at = np.append(_heads([route]), len(route))
            yield pa.RecordBatch.from_pylist(
                [{"route": int(route[a])} | _packed(block, [c[a:b] for c in columns], count[a:b], split[a:b]) for a, b in zip(at, at[1:])],
                schema=_BLOCK,
            )

    return run


_BLOCK = pa.schema([("route", pa.int64()), ("langs", pa.list_(pa.string())), ("n_words", pa.int64()), ("n_rows", pa.int64()), ("words", pa.binary()), ("body", pa.binary())])
_BLOCK_SQL = "route long, langs array<string>, n_words long, n_rows long, words binary, body binary"


def _packed(block: Block, columns: list[np.ndarray], count: np.ndarray, split: np.ndarray) -> dict:
    used = np.unique(np.concatenate([[0], *columns[1:]]))
    words = block.words.take(pa.array(used[1:] - 1))
    data, offsets = utf8(words)
    body = np.stack([columns[0], *[np.searchsorted(used, c) for c in columns[1:]], count, split]).astype("<i4")
    body[1, 1:] -= body[1, :-1].copy()  # sorted: small steps
    zstd = pa.Codec("zstd")
    return {
        "langs": block.langs.to_pylist(),
        "n_words": len(used) - 1,
        "n_rows": len(count),
        # bytes of equal weight side by side
        "words": zstd.compress(np.diff(offsets).astype("<i4").tobytes() + data.tobytes(), asbytes=True) + len(data).to_bytes(8, "little"),
        "body": zstd.compress(np.ascontiguousarray(body.reshape(-1).view(np.uint8).reshape(-1, 4).T).tobytes(), asbytes=True),
    }


def _unpacked(row: dict, depth: int) -> tuple[pa.Array, np.ndarray]:
    """The block's words, and its columns: language, words, count, split."""
    zstd, n, rows = pa.Codec("zstd"), row["n_words"], row["n_rows"]
    raw = zstd.decompress(row["words"][:-8], 4 * n + int.from_bytes(row["words"][-8:], "little"), asbytes=True)
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<i4", n))]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[4 * n :])])
    size = (depth + 3) * rows
    body = np.frombuffer(zstd.decompress(row["body"], 4 * size, asbytes=True), np.uint8).reshape(4, size)
    body = np.ascontiguousarray(body.T).view("<i4").reshape(depth + 3, rows)
    body[1] = np.cumsum(body[1])
    return words, body


def three_way(keys: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to the columns of ``keys`` (depth x pointers; 0 ends
    a key).  Yields (depth, pointers, weights): one pointer into each equal range of that depth
    whose weight is at least ``least``."""
    depths, n = keys.shape
    pointer = np.arange(n)
    size = np.array([n] if weight.sum() >= least else [], np.int64)
    if not len(size):
        return
    depth = np.zeros(1, np.int64)
    flat = keys.reshape(-1)
    while len(size):
        start = np.cumsum(size) - size
        own = np.repeat(np.arange(len(size)), size)
        key = flat[(depth * n)[own] + pointer]
        pivot = key[start + size // 2]
        side = np.sign(key - pivot[own]) + 1
        part = 3 * own + side
        sizes = np.bincount(part, minlength=3 * len(size))
        weights = np.bincount(part, weights=weight[pointer], minlength=3 * len(size))
        goes_on = (weights >= least).reshape(-1, 3)
        # the equal range is a phrase, and goes on with the next word
        goes_on[:, 1] &= pivot > 0
        equal = np.flatnonzero(goes_on[:, 1])
        done = depth[equal]
        at = start + size // 2
        for d in np.unique(done).tolist():
            ranges = equal[done == d]
            yield d, pointer[at[ranges]], weights[3 * ranges + 1].astype(np.int64)
        goes_on[:, 1] &= depth < depths - 1
        goes_on = goes_on.reshape(-1)
        pointer = _by_part(pointer, side, sizes, goes_on)
        size = sizes[goes_on]
        depth = (np.repeat(depth, 3) + np.tile([0, 1, 0], len(depth)))[goes_on]


def _by_part(pointer: np.ndarray, side: np.ndarray, sizes: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """The kept pointers, range by range and within a range side by side.  Those of one side are in
    the order of their ranges already, so each moves by a distance that its part has in common."""
    to = np.cumsum(sizes * goes_on) - sizes * goes_on
    out = np.empty(int((sizes * goes_on).sum()), pointer.dtype)
    for s in range(3):
        kept = np.where(goes_on[s::3], sizes[s::3], 0)
        shift = to[s::3] - (np.cumsum(kept) - kept)
        own = pointer[(side == s) & np.repeat(goes_on[s::3], sizes.reshape(-1, 3).sum(1))]
        out[np.arange(len(own)) + np.repeat(shift, kept)] = own
    return out


def _frequent(depth: int, least: int):
    """The phrases of a route: language, words joined by spaces, number of words, count."""

    def run(blocks: pa.Table) -> pa.Table:
        rows = blocks.to_pylist()
        parts = [_unpacked(r, depth) for r in rows]
        words = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
        langs = pa.array([x for r in rows for x in r["langs"]], pa.string()).dictionary_encode()
        word_at, lang_at, at_w, at_l = words.indices.to_numpy(), langs.indices.to_numpy(), 0, 0
        columns = []
        for r, (own, body) in zip(rows, parts):
            to = np.concatenate([[0], word_at[at_w : at_w + len(own)] + 1]).astype(np.int32)
            columns.append(np.vstack([lang_at[at_l : at_l + len(r["langs"])][body[0]] + 1, *to[body[1 : depth + 1]], body[depth + 1 :]]))
            at_w, at_l = at_w + len(own), at_l + len(r["langs"])
        found = np.concatenate(columns, axis=1)
        keys, weight, split = np.ascontiguousarray(found[: depth + 1]), found[depth + 1].astype(np.int64), found[depth + 2] > 0
        picked: list[tuple[int, np.ndarray, np.ndarray]] = []
        for d, pointer, total in three_way(keys, weight, least):
            if d >= 2:
                # where the leading two words do not keep suffixes together, only whole ones are all here
                here = (d == depth) | ~split[pointer]
                picked.append((d, pointer[here], total[here]))
        spread = np.flatnonzero(split)
        for d in range(2, depth):  # shares of a count, to be added up
            own = spread[keys[d, spread] > 0]
            own = own[np.lexsort(keys[d::-1, own])] if len(own) else own
            if len(own):
                head = _heads([keys[k, own] for k in range(d + 1)])
                picked.append((d, own[head], np.add.reduceat(weight[own], head)))
        out = []
        for d, pointer, total in picked:
            own = [words.dictionary.take(pa.array(keys[k, pointer] - 1)) for k in range(1, d + 1)]
            phrase = pc.binary_join_element_wise(*own, pa.scalar(b" ", pa.binary())).cast(pa.string())
            out.append(pa.table([langs.dictionary.take(pa.array(keys[0, pointer] - 1)), phrase, pa.array(np.full(len(total), d, np.int32)), pa.array(total)], names=["lang", "phrase", "size", "f"]))
        return pa.concat_tables(out) if out else _PHRASES.empty_table()

    return run


_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])


def phrase_counts(docs: DataFrame, lang_col: str, text_col: str, least: int, max_words: int) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): phrases of up to ``max_words`` words with their count if that is at least
    ``least`` (lang, phrase, size, f), and the words of each language (lang, n)."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    counted = source.mapInArrow(_word_counts, "lang string, phrase string, n long")
    words = written(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f")), "op11-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    routes = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = words.agg(F.sum("f")).first()[0] or 0
    # no more than ``routes`` words can have that share
    frequent: dict[str, list[bytes]] = {}
    for r in words.where(F.col("f") * routes >= n).collect():
        frequent.setdefault(r.lang, []).append(r.phrase.encode())
    blocks = source.mapInArrow(_routed(routes, frequent, max_words), _BLOCK_SQL)
    found = blocks.groupBy("route").applyInArrow(_frequent(max_words, least), "lang string, phrase string, size int, f long")
    longer = found.groupBy("lang", "phrase").agg(F.max("size").alias("size"), F.sum("f").alias("f"))
    every = words.select("lang", "phrase", F.lit(1).alias("size"), "f").unionByName(longer)
    return written(every.where(F.col("f") >= least), "op11-phrases"), totals


def _sub_phrases(size: int) -> list[tuple[int, int]]:
    """(start, words) of what lies inside a phrase of ``size`` words, of two words or more."""
    return [(s, k) for k in range(2, size) for s in range(size - k + 1)]


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases."""
    phrases, totals = phrase_counts(docs, lang_col, text_col, least, max_words)
    words = F.split("phrase", " ")

    def joined(start, size):
        return F.array_join(F.slice(words, start, size), " ")

    several = phrases.where("size > 1")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(k.alias("k"), joined(F.lit(1), k).alias("head"), joined(k + 1, F.col("size") - k).alias("rest")),
    )
    cut = several.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    a, one = F.col("a").cast("decimal(15,0)"), F.lit(1_000_000).cast("decimal(7,0)")
    both = cut.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    both = both.withColumn("over", a * a * one).withColumn("under", F.col("l").cast("decimal(15,0)") * F.col("r").cast("decimal(15,0)"))
    score = F.expr("over div under")
    lowest = both.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))

    inside = [F.when(F.col("size") == m, F.array(*[joined(s + 1, k) for s, k in _sub_phrases(m)])) for m in range(3, max_words + 1)]
    scored = lowest.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    if inside:
        around = phrases.where("size > 2").select("lang", F.explode(F.coalesce(*inside)).alias("phrase"), "f")
        around = around.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
        scored = scored.join(around, ["lang", "phrase"], "left").where(f"around is null or 100 * around < {CONTAINED} * a").drop("around")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
