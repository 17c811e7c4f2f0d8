from __future__ import annotations

import random
import re
from collections import Counter

from drapekit.llm import token_counts as op
from tests.llm.helpers import prose

CHANGE = "source string, lang string, old_text string, new_text string, version int"


def tokens(version, text):
    pattern = r"[^\x20\x09-\x0D]+" if version == "words-1" else r"[0-9A-Za-z]+|[^\x00-\x7F]+|[!-/:-@\[-`{-~]"
    return len(re.findall(pattern, text))


def slow(batches):
    docs, total = Counter(), Counter()
    for changes in batches:
        for source, lang, old, new, _ in changes:
            for version in op.VERSIONS:
                for sign, text in ((-1, old), (1, new)):
                    if text is not None:
                        docs[source, lang, version] += sign
                        total[source, lang, version] += sign * tokens(version, text)
    return {k: (docs[k], total[k]) for k in docs if docs[k] or total[k]}


def state(rollup):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def batches():
    rng = random.Random(1)
    texts = [prose(k, 20) + " it's é日 x_y!" for k in range(12)] + ["", " \n"]
    first = [(rng.choice(["a", "b", None]), rng.choice(["en", None]), None, t, 1) for t in texts]
    second = [(s, g, t, None, 1) for s, g, _, t, _ in first[:4]] + [(s, g, t, t + " more words, now", 1) for s, g, _, t, _ in first[4:9]]
    return [first, second, [], [(None, None, None, None, 1), *second[:0], *first[:2], *first[:2]]]


def test_batches_replays_and_compaction(spark, tmp_path):
    rollup, done = op.Rollup(spark, str(tmp_path / "r")), []
    assert state(rollup) == {} and rollup.batches() == set()
    for k, changes in enumerate(batches()):
        df = spark.createDataFrame(changes, CHANGE)
        assert rollup.commit(f"b{k}", df)
        done.append(changes)
        assert state(rollup) == slow(done)
        assert not rollup.commit(f"b{k}", df) and state(rollup) == slow(done)
        if k in (1, 2):
            rollup.compact()
            assert state(rollup) == slow(done)
            assert not rollup.commit("b0", df) and state(rollup) == slow(done)


def test_a_commit_that_died_leaves_nothing(spark, tmp_path):
    rollup = op.Rollup(spark, str(tmp_path / "r"))
    changes = spark.createDataFrame(batches()[0], CHANGE)
    op.deltas(changes).write.parquet(f"{rollup.path}/data/unfinished")
    op.deltas(changes).write.parquet(f"{rollup.path}/{rollup._generation()}/data/folder=unfinished")
    assert state(rollup) == {}
    assert rollup.commit("b", changes) and state(rollup) == slow(batches()[:1])


def test_compaction_shortens_the_log_and_a_dead_one_is_not_seen(spark, tmp_path):
    rollup = op.Rollup(spark, str(tmp_path / "r"))
    done = batches()[:2]
    for k, changes in enumerate(done):
        assert rollup.commit(f"b{k}", spark.createDataFrame(changes, CHANGE))
    rollup.totals().write.parquet(f"{rollup.path}/000000001-dead/data/folder=f0")  # without its marker
    assert state(rollup) == slow(done) and rollup._read("log", op.LOG).count() == 2
    rollup.compact()
    assert state(rollup) == slow(done)
    assert rollup._read("log", op.LOG).count() == 1 and rollup.batches() == {"b0", "b1"}
    assert rollup.commit("b2", spark.createDataFrame(done[0], CHANGE)) and state(rollup) == slow([*done, done[0]])
    rollup.compact()
    assert rollup._generation().startswith("000000002") and rollup.batches() == {"b0", "b1", "b2"}
    assert not rollup.commit("b1", spark.createDataFrame(done[0], CHANGE)) and state(rollup) == slow([*done, done[0]])


def test_what_cancels_out_is_gone(spark):
    t = prose(1, 5)
    df = spark.createDataFrame([("a", "en", None, t, 1), ("a", "en", t, None, 1)], CHANGE)
    assert op.deltas(df).count() == 0 and op.deltas(spark.createDataFrame([], CHANGE)).count() == 0


def test_very_long_text(spark):
    t = prose(1, 100_000) + " é!" * 1000
    rows = {r.version: r.n_tokens for r in op.deltas(spark.createDataFrame([("a", "en", None, t, 1)], CHANGE)).collect()}
    assert rows == {v: tokens(v, t) for v in op.VERSIONS}
