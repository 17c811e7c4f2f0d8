"""FeatureCollections and objects read in byte ranges."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from drapekit.sources import features as fc
from drapekit.sources.object_ranges import block_digests, object_digests, read_ranges

NASTY = ['plain', 'quote " inside', "back\\slash", 'ends with \\', '\\"', '\\\\"', "}]{[", '","type":"Feature"', "é 日本", "\\" * 9, '"' * 7, ""]


def collection(seed=1, n=40):
    rng = random.Random(seed)

    def thing(depth=0):
        kind = rng.randrange(5 if depth < 3 else 2)
        if kind == 0:
            return rng.choice(NASTY)
        if kind == 1:
            return rng.choice([1, -2.5, None, True])
        if kind == 2:
            return [thing(depth + 1) for _ in range(rng.randrange(4))]
        return {rng.choice(NASTY) + str(k): thing(depth + 1) for k in range(rng.randrange(4))}

    items = [{"type": "Feature", "id": f"i{k}", "properties": thing(), "geometry": None, rng.choice(NASTY): thing()} for k in range(n)]
    return {"type": "FeatureCollection", "links": [{"href": rng.choice(NASTY), "type": "application/json"}], "crs": {"a": {"type": "name"}}, "features": items, "after": [{"x": thing()}]}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("step", [1, 7, 64, 1 << 20])
def test_every_feature_begins_in_one_range(seed, step):
    whole = collection(seed, 12)
    raw = json.dumps(whole, ensure_ascii=bool(seed % 2), indent=None if seed < 2 else 1).encode()
    in_string = depth = 0
    got = []
    for start in range(0, len(raw), step):
        data = np.frombuffer(raw[start : start + step], np.uint8)
        escaped = (len(raw[:start]) - len(raw[:start].rstrip(b"\\"))) % 2 == 1
        rest = iter([raw[a : a + 5] for a in range(start + step, len(raw), 5)] if step < 1 << 20 else [])
        got += [(start + a, x) for a, x in fc.features(data, escaped, in_string, depth, lambda rest=rest: next(rest, b""))]
        quotes, plain, quoted = fc.summary(data, escaped)
        depth += quoted if in_string else plain
        in_string = (in_string + quotes) % 2
    assert (in_string, depth) == (0, 0)
    assert [json.loads(x) for _, x in got if json.loads(x).get("type") == "Feature"] == whole["features"]
    assert all(raw[a : a + len(x)] == x for a, x in got)


@pytest.mark.parametrize("range_bytes", [97, 1 << 20])
def test_collections_in_a_folder(spark, tmp_path, range_bytes):
    wholes = [collection(s, 15) for s in (11, 12)]
    (tmp_path / "in").mkdir()
    for k, w in enumerate(wholes):
        (tmp_path / "in" / f"c{k}.json").write_text(json.dumps(w))
    (tmp_path / "in" / "empty.json").write_text("")
    (tmp_path / "in" / "none.json").write_text('{"type":"FeatureCollection","features":[]}')
    (tmp_path / "in" / "_SUCCESS").write_text("")
    got = [json.loads(r.value) for r in fc.read_features(spark, str(tmp_path / "in"), range_bytes).collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(got, key=key) == sorted((f for w in wholes for f in w["features"]), key=key)
    one = fc.read_features(spark, str(tmp_path / "in" / "c0.json"), range_bytes)
    assert one.count() == 15 and one.select("place").distinct().count() == 15


def test_one_large_collection_is_read_by_many_tasks(spark, tmp_path):
    """40 MB in one file: more than four tasks give out features."""
    item = json.dumps({"type": "Feature", "id": "x", "properties": {"text": "y" * 2000}})
    with open(tmp_path / "large.json", "w") as f:
        f.write('{"type":"FeatureCollection","features":[' + ",".join([item] * 20_000) + "]}")
    found = fc.read_features(spark, str(tmp_path / "large.json"), range_bytes=4 << 20)
    per_task = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == 20_000 and len(per_task) > 4


def test_ranges_and_digests(spark, tmp_path):
    rng = random.Random(2)
    contents = {"a.bin": rng.randbytes(100_003), "b.bin": b"", "c.bin": rng.randbytes(4096), "d.bin": rng.randbytes(1)}
    for n, c in contents.items():
        (tmp_path / n).write_bytes(c)
    (tmp_path / "other.txt").write_text("not asked for")
    ranges = read_ranges(spark, str(tmp_path), "*.bin", block_bytes=4096, task_bytes=20_000)
    rows = ranges.collect()
    for n, c in contents.items():
        own = sorted((r.place, bytes(r.content)) for r in rows if r.path.endswith(n))
        assert b"".join(x for _, x in own) == c and all(r.size == len(c) for r in rows if r.path.endswith(n))
    assert ranges.where("path like '%a.bin'").select(F.spark_partition_id().alias("p")).distinct().count() > 4
    got = {r.path.rpartition("/")[2]: (r.bytes, r.md5) for r in object_digests(ranges).collect()}
    assert got == {n: (len(c), hashlib.md5(c).hexdigest()) for n, c in contents.items()}
    tree = {r.path.rpartition("/")[2]: (r.blocks, r.digest) for r in block_digests(ranges).collect()}
    for n, c in contents.items():
        blocks = [c[a : a + 4096] for a in range(0, len(c), 4096)] or [b""]
        assert tree[n] == (len(blocks), hashlib.sha256("".join(hashlib.sha256(b).hexdigest() for b in blocks).encode()).hexdigest())
    assert read_ranges(spark, str(tmp_path), "*.none").count() == 0
