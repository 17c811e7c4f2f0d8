"""Operator 9, token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are additive, so no change ever recounts the
corpus.  A change carries the text that was counted before and the text that counts now: an
insert has only the new one, a delete only the old one, a revision both.  Each side becomes a
signed row per tokenizer version, and a batch of changes is reduced to one small delta per
(source, lang, version), combined map-side before the shuffle.

* **Commit.** A batch's deltas are written to a folder of their own; then one log row names the
  folder.  Totals join the folders with the log, so a commit that died half-way leaves nothing behind.
* **Idempotent.** A batch id that is known already is not applied again, whatever its content, so a
  retried or replayed batch changes nothing.  The id is looked up with a pushed-down filter.
* **Compaction** starts a new generation: the totals as its first folder, a log of one row, and a
  table of all ids known so far, sorted so that a lookup skips all but a few row groups.  It counts
  once its marker file stands; one that died before is never seen.  So neither commits nor
  totals read more log than was written since, and no log row comes to the driver.  One writer at a
  time is assumed; readers may come at any time, as earlier generations stay.

A null side counts as absent, an empty text as a document with no tokens.  Null sources or
languages form groups of their own.  Repeated changes are separate changes.  An empty batch
commits and changes nothing; an empty store has no totals.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drapekit.llm.common import word_count


def _words(text: Column) -> Column:
    """Runs of characters other than white space."""
    return word_count(text, r"\x20\x09-\x0D")


def _pieces(text: Column) -> Column:
    """Runs of ASCII letters and digits, runs of characters beyond ASCII, single punctuation marks:
    either kind of run becomes one character, and what is left between is dropped."""
    runs = F.regexp_replace(F.regexp_replace(text, "[0-9A-Za-z]+", "a"), r"[^\x00-\x7F]+", "b")
    return F.length(F.regexp_replace(runs, r"[\x00-\x20\x7F]+", ""))


#: tokenizer versions: how many tokens a text has
VERSIONS: dict[str, Callable[[Column], Column]] = {"words-1": _words, "pieces-2": _pieces}

KEYS = ("source", "lang", "version")
LOG = "batch string, folder string"
KNOWN = "batch string"
READY = "_READY"
DELTA = "source string, lang string, version string, n_docs long, n_tokens long"


def deltas(changes: DataFrame, versions: dict[str, Callable[[Column], Column]] = VERSIONS) -> DataFrame:
    """One signed row per (source, lang, version) of a batch: n_docs and n_tokens.  ``changes``
    has source, lang, old_text, new_text; groups whose changes cancel out are left out."""

    def side(text: str, sign: int) -> list[Column]:
        return [
            F.struct(F.lit(v).alias("version"), F.when(F.col(text).isNotNull(), F.lit(sign)).alias("sign"), (sign * count(F.col(text))).cast("long").alias("tokens"))
            for v, count in versions.items()
        ]

    rows = changes.select("source", "lang", F.explode(F.array(*side("old_text", -1), *side("new_text", 1))).alias("c"))
    rows = rows.select("source", "lang", "c.*").where("sign is not null")
    out = rows.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
    return out.where("n_docs <> 0 or n_tokens <> 0")


class Rollup:
    """The totals under one folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, path: str):
        """A path and its file system."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _generation(self) -> str:
        """Folder of the newest generation that is complete."""
        place, files = self._place(self.path)
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        for name in sorted((n for n in names if n[:9].isdigit()), reverse=True):
            marker, _ = self._place(f"{self.path}/{name}/{READY}")
            if files.exists(marker):
                return name
        return f"{0:09d}"

    def _read(self, name: str, schema: str) -> DataFrame:
        """A table of the current generation, empty where nothing was written yet."""
        path = f"{self.path}/{self._generation()}/{name}"
        place, files = self._place(path)
        return self.spark.read.schema(schema).parquet(path) if files.exists(place) else self.spark.createDataFrame([], schema)

    def _known(self) -> DataFrame:
        log = self._read("log", LOG).select("batch").where("batch is not null")
        return self._read("known", KNOWN).unionByName(log)

    def batches(self) -> set[str]:
        """All ids, for reports and tests; commits look up one."""
        return {r.batch for r in self._known().toLocalIterator()}

    def _append(self, rows: DataFrame, batch: str | None, generation: str) -> None:
        base, folder = f"{self.path}/{generation}", f"f{uuid.uuid4().hex}"
        rows.write.parquet(f"{base}/data/folder={folder}")
        self.spark.createDataFrame([(batch, folder)], LOG).coalesce(1).write.mode("append").parquet(f"{base}/log")

    def commit(self, batch: str, changes: DataFrame, versions: dict[str, Callable[[Column], Column]] = VERSIONS) -> bool:
        """Adds a batch; False if its id is known already."""
        if not self._known().where(F.col("batch") == F.lit(batch)).isEmpty():
            return False
        self._append(deltas(changes, versions), batch, self._generation())
        return True

    def compact(self) -> None:
        """From now on one folder holds the totals of all batches so far."""
        new = f"{int(self._generation()[:9]) + 1:09d}-{uuid.uuid4().hex}"
        self._known().sort("batch").write.parquet(f"{self.path}/{new}/known")
        self._append(self.totals(), None, new)
        marker, files = self._place(f"{self.path}/{new}/{READY}")
        files.create(marker).close()

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens: the sums of all committed batches."""
        rows = self._read("data", f"{DELTA}, folder string").join(self._read("log", LOG).select("folder"), "folder", "left_semi")
        out = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return out.where("n_docs <> 0 or n_tokens <> 0")
