from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from drapekit.llm import toxicity
from tests.llm.helpers import below, frame, prose
from tests.llm.test_decontaminate import slow as nearest
from tests.llm.test_simhash import slow_groups, slow_print
from tests.test_plans import recorded

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder):
    rng = random.Random(6)
    docs, labels = [], []

    def add(text, toxic=0):
        docs.append((len(docs), text, "en", "s", None if text is None else len(text)))
        labels.append((len(docs) - 1, 1, toxic))

    items = [prose(900 + k, 25) for k in range(4)]
    passage = prose(77, 70)
    for k in range(240):
        words = prose(k, 40 + k % 30, 700).split()
        if k % 6 == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vile", "nasty"])
        if k % 10 == 1:
            words[5:5] = [passage]
        if k % 12 == 5:
            words[9:9] = [items[k % 4]]
        add(" ".join(words), int(k % 6 == 0))
        if k % 15 == 2:
            add(" ".join(words))
            add(" ".join(words[:-1]))
    for t in (None, "", "", "é"):
        add(t)
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def slow(docs, items, model):
    rows = {i: t or "" for i, t, *_ in docs}
    raw = [t.encode() for t in rows.values()]
    score = model.score(model.evidence(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])))
    rows = {i: t for (i, t), s in zip(rows.items(), score) if s < 0.3}
    n_ordinary = len(rows)
    groups = slow_groups(list(rows), [slow_print(t) for t in rows.values()], 4)
    rows = {i: t for (i, t), g in zip(rows.items(), groups) if i == g}
    n_single = len(rows)
    seen = Counter(b[k : k + 200] for b in (t.encode() for t in rows.values()) for k in range(len(b) - 199))
    cut = {}
    for i, t in rows.items():
        b = t.encode()
        gone = {k + j for k in range(len(b) - 199) if seen[b[k : k + 200]] > 1 for j in range(200)}
        cut[i] = bytes(x for k, x in enumerate(b) if k not in gone).decode("utf-8", "ignore")
    changed = sum(cut[i] != rows[i] for i in rows)
    kept = {}
    for i, t in cut.items():
        words = " ".join(t.lower().split())
        if all(q not in words and nearest(q, words)[0] > min(len(q) // 10, (len(q) - 8) // 8) for q in items):
            kept[i] = t
    assert n_ordinary < len(docs) - 30 and n_single < n_ordinary and changed > 5 and len(kept) < n_single
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {}
    for i, t in kept.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        out[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), ids)
    return out


def test_matches_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    docs, items = tables(spark, folder)
    model = toxicity.learn(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in rows} == slow(docs, items, model)


def test_stages_keep_the_columns_and_bear_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    docs, _ = tables(spark, folder)
    odd = [(None, None, None, None, None), (None, docs[0][1], "en", "s", 1), (6, docs[6][1], "x", "y", 0), (6, docs[6][1], "x", "y", 0), (6, "other", "x", "y", 0)]
    for rows in (docs + odd, []):
        frame = spark.createDataFrame(rows, DOCS)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, folder)
            assert frame.columns == [c.split()[0] for c in DOCS.split(", ")], name
            frame = spark.createDataFrame(frame.collect(), DOCS)
            if name == "simhash_near_dedup" and rows:
                assert frame.where("doc_id = 6").count() == 2
        assert corpus_pipeline.bpe(spark, frame, folder).count() == frame.count()


def test_without_labels_and_benchmark_nothing_is_rejected(spark, tmp_path):
    """Null and empty texts share one fingerprint, so one of them stays; a clashing column stays too."""
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    texts = {0: None, 1: "", 2: "a plain sentence about rivers and hills", 3: "quite another one, of trains that run late", 4: "", 5: None}
    rows = [(i, t, None, None, None, "fp", 7) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, f"{DOCS}, fp string, id int")
    stages = dict(corpus_pipeline.STAGES)
    assert stages["toxicity"](spark, docs, folder).count() == len(rows)
    single = stages["simhash_near_dedup"](spark, docs, folder)
    assert sorted(r.doc_id for r in single.collect()) == [0, 2, 3] and single.columns == docs.columns
    clean = stages["decontamination"](spark, stages["suffix_dedup"](spark, single, folder), folder)
    assert sorted((r.doc_id, r.text, r.fp, r.id) for r in clean.collect()) == [(0, "", "fp", 7), (2, texts[2], "fp", 7), (3, texts[3], "fp", 7)]
    assert {r.doc_id: r.n_tokens > 0 for r in stages["bpe"](spark, clean, folder).collect()} == {0: False, 2: True, 3: True}


def test_near_dedup_stage_broadcasts_no_exploded_table(spark, monkeypatch):
    plans = recorded(monkeypatch)
    docs = frame(spark, [prose(k, 60) for k in range(80)])
    out = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert not any(below(plan, "BroadcastExchange", "Generate explode") for plan in plans)
    assert any(below(plan, "SortMergeJoin", "Generate explode") for plan in plans)
