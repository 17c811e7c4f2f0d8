"""Operator 6, toxicity by class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary documents, share a vocabulary and the
Kneser-Ney lower order: how many different words a word follows, counted over both classes.
So an expression that one class never showed backs off to the same estimate as in the other,
and rare expressions say little.  Below the single word the back-off goes on down a word's
stems (its first 6, 5 and 4 bytes) to one unknown word, so new forms of a known stem are
recognised.  A document's evidence is its log-likelihood under the toxic model minus that
under the ordinary one, per word, over the whole text, over its most toxic stretch and for its
most toxic words; a logistic fit on labelled documents that were kept out of the counts turns
that evidence into a score.

Learning uses a bounded sample of the labelled rows (at most ``max_docs`` of them and ``max_bytes``
of text, in the order of a hash of the id).  Every word, stem and pair that the sample shows is in
the model, so what is handed to the tasks is bounded by the sample.  Scoring reads every whole text once and needs no shuffle.  Neither id, language,
source nor label is an input of a score.

Null text: empty; an empty text scores the fit at zero evidence.  Null ids: kept, never
learned from, held out is null for them.  Repeated rows: kept.  An id with several labels counts as toxic if
any of them is 1.  No labels or only one class: the score is the share of toxic labels, 0
without any.  If only the calibrating documents lack a class, the score is the unfitted comparison
of the two likelihoods.  Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drapekit.llm.common import Names, mix, slices, spans, utf8, word_bytes, written

MAX_DOCS = 10_000  # labelled documents that are learned from
MAX_BYTES = 50_000_000  # bytes of their texts
DISCOUNT = 4.0  # what a class's count gives up to the shared lower order
FOLDS = 4  # one of them calibrates, the others are counted
STEMS = (4, 5, 6)  # bytes of a word's stems
STRETCH = 16  # words in a stretch

_U = np.uint64


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(names, texts): the names of every word's stems, shortest first, and of the word; a word
    that is no longer than a stem stands for it."""
    data = word_bytes()[data]
    start, end, text = spans(data != 0x20, offsets)
    names = Names(data)
    full = names.of(start, end)
    stems = [np.where(end - start > k, mix(names.of(start, np.minimum(end, start + k)) + _U(k)), full) for k in STEMS]
    return [*stems, full], text


def in_order(column: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted column, or -1."""
    if not len(column):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(column, values), len(column) - 1)
    return np.where(column[at] == values, at, -1)


def numbered(vocab: np.ndarray, units: list[np.ndarray]) -> np.ndarray:
    """Word numbers: 1 + place of the word, else of its longest known stem, else 0 (unknown)."""
    out = np.full(len(units[0]), -1, np.int64)
    for own in reversed(units):
        lost = np.flatnonzero(out < 0)
        out[lost] = in_order(vocab, own[lost])
    return out + 1


def sequence(vocab: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, number before it or that of a text's start, text, is first) of every word."""
    units, text = words_of(data, offsets)
    number = numbered(vocab, units)
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    before = np.full(len(text), len(vocab) + 1, np.int64)
    before[1:] = np.where(first[1:], before[1:], number[:-1])
    return number, before, text, first


@dataclass
class Model:
    """Log ratios toxic : ordinary, and the logistic fit on top of them."""

    vocab: np.ndarray  # sorted names
    word: np.ndarray  # log ratio of the lower order, by word number
    weight: np.ndarray  # log ratio of the weights that a history gives the lower order
    pair: np.ndarray  # sorted codes history * (V + 2) + word
    ratio: np.ndarray  # log ratio of each pair
    fit: np.ndarray | None = None
    share: float = 0.0

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: mean log ratio per word, the same over the most toxic stretch, the two most
        toxic words, log of words."""
        out = np.zeros((len(offsets) - 1, 5))
        number, before, text, first = sequence(self.vocab, data, offsets)
        if not len(number):
            return out
        score = self.word[number] + self.weight[before]
        known = in_order(self.pair, before * (len(self.vocab) + 2) + number)
        hit = known >= 0
        score[hit] = self.ratio[known[hit]]
        head = np.flatnonzero(first)
        size = np.diff(np.append(head, len(text)))
        own = text[head]
        total = np.concatenate([[0.0], np.cumsum(score)])
        end = np.minimum(np.arange(len(score)) + STRETCH, np.repeat(head + size, size))
        out[own, 0] = (total[head + size] - total[head]) / size
        out[own, 1] = np.maximum.reduceat(total[end] - total[:-1], head) / STRETCH
        best = np.maximum.reduceat(score, head)
        out[own, 2] = best
        group = np.repeat(np.arange(len(head)), size)
        top = np.flatnonzero(score == best[group])
        top = top[np.unique(group[top], return_index=True)[1]]
        score[top] = 0.0
        out[own, 3] = np.maximum.reduceat(score, head)
        out[own, 4] = np.log1p(size)
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.fit is None:
            return np.full(len(evidence), self.share)
        x = np.column_stack([np.ones(len(evidence)), evidence])
        return 1 / (1 + np.exp(-np.clip(x @ self.fit, -30, 30)))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, name of the next shorter stem or 0, level) of words and stems."""
    for batch in slices(batches, "text"):
        units, text = words_of(*utf8(batch.column("text")))
        parent = np.zeros(len(text), _U)
        for level, own in enumerate(units):
            new = np.flatnonzero(own != parent)
            value, at = np.unique(own[new], return_index=True)
            columns = [value.view(np.int64), parent[new][at].view(np.int64), np.full(len(value), level, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["name", "parent", "level"])
            parent = own


def _pair_counts(vocab):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            toxic = np.asarray(batch.column("toxic")).astype(np.int64)
            number, before, text, _ = sequence(vocab.value, *utf8(batch.column("text")))
            code, n = np.unique((before * (len(vocab.value) + 2) + number) * 2 + toxic[text], return_counts=True)
            own = [pa.array(x) for x in (code >> 1, np.where(code & 1, n, 0), np.where(code & 1, 0, n))]
            yield pa.RecordBatch.from_arrays(own, ["code", "t", "o"])

    return run


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    """The columns of a table that the sample bounds; Arrow's copies are given back."""
    table = df.toArrow()
    out = {c: table.column(c).to_numpy().copy() for c in table.column_names}
    del table
    pa.default_memory_pool().release_unused()
    return out


def _by_number(rows: dict[str, np.ndarray], size: int, *columns: str) -> list[np.ndarray]:
    out = [np.zeros(size) for _ in columns]
    for o, c in zip(out, columns):
        o[rows["k"]] = rows[c]
    return out


def _lower_order(parent: np.ndarray, level: np.ndarray, own: list[np.ndarray], types: np.ndarray) -> list[np.ndarray]:
    """Log probability of every word number in each class, down the tree of stems: a node's
    discounted count in the class, and what the discounts freed shared out by the number of
    different words that come before (``types``, over both classes).  A node stands for itself
    among its children: the words under it that have no number of their own.  Node 0 is the
    root (unknown words); ``parent`` and ``level`` start with it."""
    deep = int(level.max(initial=0))
    below = types + 0.5
    for k in range(deep, 0, -1):
        at = np.flatnonzero(level == k)
        np.add.at(below, parent[at], below[at])
    out = []
    for n in own:
        n = n.astype(float)
        under = n.copy()
        for k in range(deep, 0, -1):
            at = np.flatnonzero(level == k)
            np.add.at(under, parent[at], under[at])
        child = np.flatnonzero(level > 0)
        kept = np.maximum(n - DISCOUNT, 0)
        np.add.at(kept, parent[child], np.maximum(under[child] - DISCOUNT, 0))
        with np.errstate(invalid="ignore", divide="ignore"):
            free = np.where(under > 0, 1 - kept / under, 1.0)
            free = np.maximum(free, 1e-6)

            def step(count, of, share, free=free, under=under):
                seen = np.where(under[of] > 0, np.maximum(count - DISCOUNT, 0) / under[of], 0.0)
                return np.log(seen + free[of] * share)

            node = np.zeros(len(n))
            for k in range(1, deep + 1):
                at = np.flatnonzero(level == k)
                node[at] = node[parent[at]] + step(under[at], parent[at], below[at] / below[parent[at]])
            itself = np.arange(len(n))
            out.append(node + step(n, itself, (types + 0.5) / below))
    return out


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a slight pull to zero."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.01 * np.eye(len(w)), x.T @ (y - p) - 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learnable(id_col: Column) -> Column:
    """Ids whose labels may be learned: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 != 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Model:
    spark = docs.sparkSession
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic is not null")
    marks = marks.where(learnable(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("id"), "id").limit(max_docs)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # an id that repeats without bound adds one of its texts
    sample = source.join(F.broadcast(marks), "id").groupBy("id", "toxic").agg(F.max("text").alias("text"))
    # a running sum over at most max_docs rows
    upto = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.orderBy(F.xxhash64("id"), "id"))
    sample = written(sample.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(FOLDS))).withColumn("upto", upto), "op6-sample")
    sample = sample.where(F.col("upto") <= max_bytes).drop("upto")
    counted = sample.where("fold <> 0")
    classes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = classes.get(1, 0) / max(1, sum(classes.values()))
    none = np.zeros(0)
    if len(classes) < 2:
        return Model(none.astype(_U), np.zeros(1), np.zeros(2), none.astype(np.int64), none, None, share)
    units = counted.select("text").mapInArrow(_units, "name long, parent long, level int")
    units = _columns(units.select("name", "parent", "level").distinct())
    name = units["name"].view(_U)
    order = np.argsort(name)
    vocab = name[order]
    parent = in_order(vocab, units["parent"].view(_U)[order]) + 1
    level = units["level"][order].astype(np.int64) + 1
    del units, name, order  # the driver holds the model once
    v = len(vocab) + 2  # the unknown word, the units, the start of a text
    pairs = counted.select("text", "toxic").mapInArrow(_pair_counts(spark.sparkContext.broadcast(vocab)), "code long, t long, o long")
    pairs = written(pairs.groupBy("code").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "op6-pairs")
    heads = pairs.groupBy(F.expr(f"cast(code div {v} as int)").alias("k"))
    heads = _columns(heads.agg(*[f for c in "to" for f in (F.sum(c).alias(c), F.sum(F.least(F.col(c), F.lit(DISCOUNT))).alias(f"{c}_free"))]))
    tails = _columns(pairs.groupBy((F.col("code") % v).cast("int").alias("k")).agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.count(F.lit(1)).alias("types")))
    # others give all their counts to the lower order
    kept = _columns(pairs.where(F.greatest("t", "o") > DISCOUNT))
    by_code = np.argsort(kept["code"])
    kept = {c: x[by_code] for c, x in kept.items()}
    t, o, types = _by_number(tails, v - 1, "t", "o", "types")
    del tails
    low = _lower_order(np.concatenate([[0], parent]), np.concatenate([[0], level]), [t, o], types)
    code = kept["code"]
    h, w = code // v, code % v
    counts = _by_number(heads, v, "t", "t_free", "o", "o_free")
    del heads
    weight, ratio = [], []
    for total, free, p, own in ((*counts[:2], low[0], "t"), (*counts[2:], low[1], "o")):
        back = np.where(total > 0, free / np.maximum(total, 1), 1.0)
        seen = np.maximum(kept[own].astype(float) - DISCOUNT, 0) / np.maximum(total[h], 1)
        weight.append(np.log(back))
        ratio.append(np.log(seen + back[h] * np.exp(p[w])))
    model = Model(vocab, low[0] - low[1], weight[0] - weight[1], code, ratio[0] - ratio[1], None, share)
    judged = sample.where("fold = 0").select("text", "toxic").mapInArrow(_evidence(spark.sparkContext.broadcast(model)), "toxic int, e array<double>").toPandas()
    y = judged["toxic"].to_numpy(float)
    if len(set(y)) == 2:
        model.fit = _fit(np.array(judged["e"].tolist()), y)
    else:  # the evidence per word, and the odds of the labels
        model.fit = np.array([np.log(share / (1 - share)), 1.0, 0, 0, 0, 0])
    return model


def _evidence(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = model.value.evidence(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(list(found), pa.list_(pa.float64()))], ["toxic", "e"])

    return run


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = model.value.evidence(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.value.score(found))], ["id", "score"])

    return run


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """id, held_out, score, predicted for every row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = source.mapInArrow(_scores(shared), f"id {id_type}, score double")
    return found.select(F.col("id").alias(id_col), (~learnable(F.col("id"))).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _ordinary(model, text_col: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            found = model.value.evidence(*utf8(batch.column(batch.schema.get_field_index(text_col))))
            yield batch.filter(pa.array(model.value.score(found) < threshold))

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, id_col, text_col))
    return docs.mapInArrow(_ordinary(model, text_col, threshold), docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from the labelled rows that may be learned from, scores every row."""
    return scored(docs, learn(docs, labels, id_col, text_col), id_col, text_col)
