"""From raw documents to token ids: five stages, each one operator over all that its
predecessor kept.

    toxicity            documents that the toxicity model rejects go
    simhash_near_dedup  one document of each near-duplicate group stays
    suffix_dedup        passages of 200 bytes or more that repeat anywhere are cut from the texts
    decontamination     documents that hold a benchmark item go
    bpe                 token ids, with digests of the ids and of the text decoded from them

A stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of
``documents``.  ``run`` writes each stage's result as Parquet into the shared folder and reads
it back, so a lost executor costs at most one stage's tasks.

Null and empty texts have no words, so they share the fingerprint zero: one of them stays.  They
hold no benchmark item and come out with no token ids; from suffix_dedup on a null text is empty.  Of rows that repeat a text the one
with the smallest id stays; null ids, labels, languages and sources are kept as they are.  Very
long texts go through whole.  Empty documents give an empty result; without labels toxicity
rejects nothing, and without benchmark items nothing is dropped as a leak.  Extra columns pass
through to the stage before the last, whatever their names, and do not change a result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drapekit.llm.bpe import round_trip
from drapekit.llm.common import table, written
from drapekit.llm.decontaminate import without_leaks
from drapekit.llm.simhash import one_per_group
from drapekit.llm.suffix_dedup import without_repeats
from drapekit.llm.toxicity import without_toxic
from drapekit.session import ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs, shingle=4, max_bits=4)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs, length=200).withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: SQL has neither the toxicity model nor the tokenizer; tests/llm/test_pipeline.py compares
#: the result with a brute-force version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
