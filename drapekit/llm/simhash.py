"""Operator 3, SimHash near-duplicates by the generalised pigeonhole principle.

The fingerprint of a text is the bitwise majority of the XXH64 hashes of its word shingles.
Two fingerprints within ``max_bits`` bits link; components of links are near-duplicate groups.

* **Pigeonhole.** The 64 bits are dealt to m parts with radii r_1..r_m, where the sum of
  (r_i + 1) is ``max_bits`` + 1.  Two fingerprints within ``max_bits`` bits are then within
  r_i bits in at least one part, whatever the radii.
* **Plan.** On a bounded sample of fingerprints, correlated bits are grouped into the same part,
  pair counts are estimated for each part and radius, and dynamic programming picks the radii
  that cost the fewest probe rows and candidates; the best m wins.  The sample only steers
  cost: every plan finds every link.
* **Probe and verify.** Distinct fingerprints only.  Each is indexed and probed under the values
  of a part within half the radius each; an equi-join on the value meets the two, and the bit
  distance is checked in the join itself, so candidates are never stored.
* **Stars first.** Groups do not need every link.  In a few rounds each fingerprint meets one
  representative of each of its values only, so a large cluster is joined up by a bounded number of
  rows a fingerprint.  Of the full join then only links between different groups come out, once
  for each two groups.

Null or wordless text: fingerprint zero, linked like any other.  Null id: kept; it takes part
in groups, and a group of null ids only has a null component id.  Repeated rows: kept.  Empty
table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drapekit.llm.common import row_key, slices, texts, written
from drapekit.llm.components import components

BITS = 64
SAMPLE = 4000  # fingerprints that the cost estimate looks at
MAX_PARTS = 6
STAR_TURNS = 3  # more only save rows of the last join
SEED = 42


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Majority bits over the XXH64 of the text's word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, cut at 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int.from_bytes(xxhash.xxh64_digest(joined, SEED), "big")
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(words) - shingle + 1].tolist()
    digest, votes = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    end = end[shingle - 1 :].tolist()
    for at in range(0, len(start), 65536):  # bounds memory on very long texts
        own = b"".join([digest(joined[a:b], SEED) for a, b in zip(start[at : at + 65536], end[at : at + 65536])])
        votes += np.unpackbits(np.frombuffer(own, np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(start)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = np.array([fingerprint(t, shingle) for t in texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(own.view(np.int64))], ["id", "fp"])

    return run


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    radius: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def flips(self, radius: int) -> list[int]:
        """All ways to change up to ``radius`` bits of the part."""
        return [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(self.bits, k)]


def _ball(size: int, radius: int) -> int:
    return sum(comb(size, k) for k in range(min(size, radius) + 1))


def _grouped(sample: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """m parts of nearly equal size; each grows by the bit most correlated with it."""
    bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    x = bits - bits.mean(0, keepdims=True)
    scale = np.sqrt((x * x).sum(0))
    with np.errstate(invalid="ignore", divide="ignore"):
        link = np.abs(np.nan_to_num(x.T @ x / np.outer(scale, scale)))
    left, parts = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        own = [min(left)] if k == m - 1 else [max(sorted(left), key=lambda b: link[b, sorted(left - {b})].max(initial=0))]
        left -= set(own)
        while len(own) < size:
            own.append(max(sorted(left), key=lambda b: link[b, own].sum()))
            left.discard(own[-1])
        parts.append(tuple(sorted(own)))
    return parts


def _cost(part: tuple[int, ...], radius: int, n: int, sample: np.ndarray) -> float:
    """Estimated rows for one part and radius: index and probe rows, and candidate pairs."""
    if radius < 0:
        return 0.0
    size, low = len(part), radius // 2
    rows = _ball(size, low) + _ball(size, radius - low)
    own = sample & np.uint64(sum(1 << b for b in part))
    near = sum(int((np.bitwise_count(own[a : a + 500, None] ^ own) <= radius).sum()) for a in range(0, len(own), 500)) - len(own)
    share = max(near / max(1, len(own) * (len(own) - 1)), _ball(size, radius) / 2.0**size)
    return n * rows + n * n / 2 * share * (1 + radius)


def plan_parts(sample: np.ndarray, n: int, max_bits: int) -> list[Part]:
    """The cheapest parts and radii for n fingerprints, as estimated on ``sample``."""
    best: tuple[float, list[Part]] | None = None
    for m in range(1, MAX_PARTS + 1):
        groups = _grouped(sample, m)
        budget = max_bits + 1  # to spend as radius + 1 over the parts
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for part in groups:
            price = [_cost(part, r, n, sample) if r <= 2 or m == 1 else float("inf") for r in range(-1, budget)]
            table = {
                total: min((table[total - r][0] + price[r], [*table[total - r][1], r - 1]) for r in range(total + 1) if total - r in table)
                for total in range(budget + 1)
                if any(total - r in table for r in range(total + 1))
            }
        cost, radii = table[budget]
        if best is None or cost < best[0]:
            best = cost, [Part(g, r) for g, r in zip(groups, radii) if r >= 0]
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(fps: DataFrame, parts: list[Part], half: str) -> DataFrame:
    """(key, fp) and what other columns there are, under every value of each part that is within the
    half radius.  The planner sizes these rows as ``fps``, not counting the explode, and would take
    many times its limit for a broadcast through the driver: whatever joins them is hinted to merge."""
    rows = [(k, p.mask, f) for k, p in enumerate(parts) for f in p.flips(p.radius // 2 if half == "index" else p.radius - p.radius // 2)]
    ways = F.array(*[F.struct(F.lit(k).alias("part"), F.lit(_signed(m)).cast("long").alias("mask"), F.lit(_signed(f)).cast("long").alias("flip")) for k, m, f in rows])
    key = F.xxhash64(F.col("w.part"), F.col("fp").bitwiseAND(F.col("w.mask")).bitwiseXOR(F.col("w.flip")))
    return fps.select("*", F.explode(ways).alias("w")).select(key.alias("key"), *fps.columns)


def _sides(fps: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(index, probe): (key, b) and (key, a), with their other columns, of the distinct fingerprints
    ``fps`` (fp)."""
    sample = np.array([r.fp for r in fps.limit(SAMPLE).collect()], np.int64).view(np.uint64)
    parts = plan_parts(sample, fps.count(), max_bits) if len(sample) > 1 else [Part(tuple(range(BITS)), 0)]
    return _keys(fps, parts, "index").withColumnRenamed("fp", "b"), _keys(fps, parts, "probe").withColumnRenamed("fp", "a")


def _close(max_bits: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits


def near_pairs(fps: DataFrame, max_bits: int) -> DataFrame:
    """Every link (a, b) with a < b between the distinct fingerprints ``fps`` (fp)."""
    index, probe = (side.alias(name) for side, name in zip(_sides(fps, max_bits), "ip"))
    return probe.hint("merge").join(index, (F.col("p.key") == F.col("i.key")) & (F.col("a") < F.col("b")) & _close(max_bits)).select("a", "b").distinct()


def star_links(fps: DataFrame, max_bits: int, turn: int) -> DataFrame:
    """Links of each fingerprint with one representative of each of its values; another one each
    turn.  Values are those of ``max_bits`` + 1 plain parts: one row a part."""
    size = -(-BITS // (max_bits + 1))
    plain = [Part(tuple(range(at, min(at + size, BITS))), 0) for at in range(0, BITS, size)]
    own = _keys(fps, plain, "index")
    chosen = own.groupBy("key").agg(F.min(F.struct(F.xxhash64("fp", F.lit(turn)), "fp")).alias("r"))
    met = own.withColumnRenamed("fp", "a").hint("merge").join(chosen.select("key", F.col("r.fp").alias("b")), "key")
    return met.where((F.col("a") != F.col("b")) & _close(max_bits)).select("a", "b").distinct()


def groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """(node, label) of all distinct fingerprints ``fps`` (fp) that have a link: label is the smallest
    fingerprint that can be reached."""
    links = star_links(fps, max_bits, 0)
    for turn in range(1, STAR_TURNS):
        links = links.unionByName(star_links(fps, max_bits, turn))
    stars = written(components(links), "op3-stars")
    labelled = fps.join(stars, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("label", "fp").alias("of"))
    labelled = written(labelled, "op3-labelled")
    left, right = _sides(labelled, max_bits)
    left, right = left.alias("p"), right.alias("i")
    across = left.hint("merge").join(right, (F.col("p.key") == F.col("i.key")) & (F.col("p.of") != F.col("i.of")) & _close(max_bits))
    across = across.select(F.greatest("p.of", "i.of").alias("a"), F.least("p.of", "i.of").alias("b")).distinct()
    return components(across.unionByName(stars.select(F.col("node").alias("a"), F.col("label").alias("b"))))


def hex16(col: str) -> Column:
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def _groups(firsts: DataFrame, max_bits: int) -> DataFrame:
    """(fp, label): the smallest fingerprint that each distinct one reaches."""
    labels = groups(firsts.select("fp"), max_bits)
    return firsts.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    prints = written(source.mapInArrow(_fingerprints(shingle), f"id {id_type}, fp long"), "op3-prints")
    firsts = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "op3-firsts")
    groups = _groups(firsts, max_bits)
    least = groups.groupBy("label").agg(F.min("first").alias("component_id"))
    found = groups.join(least, "label").select("fp", "component_id")
    return prints.join(found, "fp").select(F.col("id").alias(id_col), hex16("fp").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs``, all columns, of each near-duplicate group: that with the smallest id
    (a null id only if there is no other); of rows that repeat id and text, any."""
    key = next(f"key{k}" for k in range(len(docs.columns) + 1) if f"key{k}" not in docs.columns)
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    source = keyed.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(key).alias("key")).alias("id"), F.col(text_col).alias("text"))
    kind = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("fp", T.LongType())])
    prints = source.mapInArrow(_fingerprints(shingle), kind)
    firsts = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "op3-firsts")
    kept = _groups(firsts, max_bits).groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.key").alias(key))
    return keyed.dropDuplicates([key]).join(kept, key, "left_semi").drop(key)
