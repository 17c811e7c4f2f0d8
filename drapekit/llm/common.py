"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drapekit.session import scratch_path, ship_package

# Bytes of text that a Python task works on at a time; bounds its memory, not its input.
CHUNK_BYTES = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back: later steps read the
    shared files and neither recompute it nor depend on the executors that made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(col: Column | str) -> Column:
    """A-Z to a-z and nothing else (``lower`` would change other letters too)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(col: Column | str, between: str) -> Column:
    """How many runs of other characters the text has, where ``between`` is the character class
    of what separates them (0x20 included).  Much cheaper than collecting the matches."""
    joined = F.trim(F.regexp_replace(col, f"[{between}]+", " "))
    gaps = F.length(joined) - F.length(F.replace(joined, F.lit(" "), F.lit("")))
    return F.when(F.length(joined) > 0, gaps + 1).otherwise(0)


def row_key(id_col: str, text_col: str) -> Column:
    """A key for a row made of its id and its text, so rows that repeat an id stay apart and
    rows that repeat both share one key (and one result)."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about ``limit`` bytes of ``column`` or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def texts(column: pa.Array) -> list[bytes]:
    """The column's values as UTF-8 bytes; null counts as empty."""
    data, offsets = utf8(column)
    whole = data.tobytes()
    at = offsets.tolist()
    return [whole[a:b] for a, b in zip(at, at[1:])]


_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}
# Polynomials modulo 2 ** 64 take some texts of 1,024 bytes and more for equal, whatever the base.
_LONG = 512


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; one to one."""
    x = x ^ (x >> _U(31))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(29)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base ** (0..n-1) modulo 2 ** 64, kept for the next chunk."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 2 * CHUNK_BYTES), base, _U)
        known[0] = 1
        np.cumprod(known, out=known)
        if len(known) <= 4 * CHUNK_BYTES:
            _POWERS[base] = known
    return known[:n]


class Names:
    """64-bit names of substrings: equal substrings have equal names.  A polynomial hash from
    prefix sums, shifted back to position zero; XXH3 for substrings over 512 bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.data = data
        self.sums = np.zeros(n + 1, _U)
        values = data.astype(_U)
        values += _U(1)
        values *= _powers(_BASE, n + 1)[:n]
        np.cumsum(values, out=self.sums[1:])
        self.back = _powers(pow(_BASE, -1, 1 << 64), n + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = mix(self.raw(start, end))
        for k in np.flatnonzero(end - start > _LONG).tolist():
            out[k] = xxhash.xxh3_64_intdigest(self.data[start[k] : end[k]].tobytes())
        return out


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each run of True; no run crosses from one text to the next."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (~before | head[:n]))
    after = np.concatenate([inside[1:], [False]])
    end = np.flatnonzero(inside & (~after | head[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def space_mask() -> np.ndarray:
    """Which byte values are white space to the word patterns: 0x20 and 0x09-0x0D."""
    mask = np.zeros(256, bool)
    mask[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return mask


def word_bytes() -> np.ndarray:
    """Byte -> lower-case byte of a word (letters, digits, bytes beyond ASCII), else 0x20."""
    table = np.full(256, 0x20, np.uint8)
    for k in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 256)]:
        table[k] = k
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table
