"""Operator 10, quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one integer
whose bit k is set if rule k failed.  A policy is a version and a mask of the rules it heeds,
so applying one, comparing two, or asking what a policy would keep without one of its rules is
bitwise work over the ledger and never reads a text again.

Words are runs of characters other than 0x20 and 0x09-0x0D.  Ratios are compared as integers.
Null or empty text: no words, so only the length rule fails.  Null ids and repeated rows: kept,
one ledger row each.  Empty table: empty ledger.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drapekit.llm.common import Names, mix, slices, space_mask, spans, utf8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alpha_words")

#: name -> failure condition, in bit order; new rules go to the end so that old bits stay
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "not_alphabetic": "100 * n_alpha_words < 70 * n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}


def mask_of(*names: str) -> int:
    return sum(1 << list(RULES).index(n) for n in names)


#: version -> mask of the rules that it heeds
POLICIES: dict[str, int] = {"v1": mask_of("short", "repeated_windows"), "v2": mask_of(*RULES)}
CURRENT = "v2"

_U = np.uint64


def _repeats(group: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per element: is (group, name) found again; and is it found again later in the order
    (all but one of each)."""
    key = mix(name + mix(group.astype(_U) + _U(1)))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again, copy = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    copy[order[1:]] = same
    return again, copy


def _count(text: np.ndarray, n: int, hit: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(text if hit is None else text[hit], minlength=n)


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The MEASURES of the texts between ``offsets``."""
    n = len(offsets) - 1
    space, symbol, letter = space_mask(), np.zeros(256, bool), np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    word = ~space[data]

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[offsets[1:]] - total[offsets[:-1]]

    chars, symbols = per_text(word & ((data & 0xC0) != 0x80)), per_text(symbol[data])
    names = Names(data)
    start, end, text = spans(word, offsets)
    letters = np.concatenate([[0], np.cumsum(letter[data])])
    alpha = letters[end] > letters[start]
    # windows of three words within one text
    name = names.of(start, end)
    repeat = np.zeros(len(start), bool)
    if len(start) > 2:
        whole = text[2:] == text[:-2]
        window = name[:-2] * _U(0x9E3779B97F4A7C15) + name[1:-1] * _U(0xC2B2AE3D27D4EB4F) + name[2:] * _U(0x165667B19E3779F9)
        again, _ = _repeats(text[:-2][whole], window[whole])
        at = np.flatnonzero(whole)[again]
        for k in range(3):
            repeat[at + k] = True
    # lines with a word
    line_start, line_end, line_text = spans(data != 0x0A, offsets)
    words = np.concatenate([[0], np.cumsum(word)])
    full = words[line_end] > words[line_start]
    line_start, line_end, line_text = line_start[full], line_end[full], line_text[full]
    _, copy = _repeats(line_text, names.of(line_start, line_end))
    return [
        _count(text, n),
        chars,
        symbols,
        _count(line_text, n, copy),
        _count(text, n, repeat),
        _count(line_text, n),
        _count(text, n, alpha),
    ]


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = measure(*utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(x.astype(np.int64)) for x in found]], ["id", *MEASURES])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the MEASURES, fail_bits (bit k: rule k failed)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(_measures, f"id {id_type}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " + ".join(f"case when {rule} then {1 << k} else 0 end" for k, rule in enumerate(RULES.values()))
    return found.withColumn("fail_bits", F.expr(bits).cast("long")).withColumnRenamed("id", id_col)


def passes(mask: int) -> Column:
    """The verdict of a policy on a ledger row."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0


def ablations(rows: DataFrame, policies: dict[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule: documents, how many the policy keeps, how many fail the rule, and
    how many more it would keep without the rule (those that fail nothing else).  The ledger
    is first counted by its bits, so at most 2 ** len(RULES) rows meet the policies."""
    counts = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = [(v, m, name, 1 << k) for v, m in policies.items() for k, name in enumerate(RULES) if m >> k & 1]
    each = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(("version", "mask", "rule", "bit"), case)]) for case in cases]))
    heeded = F.col("fail_bits").bitwiseAND(F.col("mask"))
    table = counts.select("fail_bits", "n", each.alias("c")).select("fail_bits", "n", "c.*")

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(0))

    return table.groupBy("version", "rule").agg(
        F.sum("n").alias("documents"),
        total(heeded == 0).alias("kept"),
        total(heeded.bitwiseAND(F.col("bit")) != 0).alias("failing"),
        total(heeded == F.col("bit")).alias("kept_without"),
    )


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with base_failed (either rule of v1) and kept (the policy's verdict)."""
    return rows.withColumn("base_failed", ~passes(POLICIES["v1"])).withColumn("kept", passes(POLICIES["v1"] | POLICIES[version]))
