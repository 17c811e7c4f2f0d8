"""Small frames for the tests of drapekit.llm."""

from __future__ import annotations

import random
from itertools import takewhile

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id int"


def frame(spark, texts, start=0):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(start + k, t, "en", "s", None if t is None else len(t), "key", 7) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def below(plan, upper, lower):
    """How many nodes of the plan are named ``upper`` and have one named ``lower`` below them."""
    lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in plan.splitlines()]
    under = [(x, takewhile(lambda y, d=d: y[0] > d, lines[k:])) for k, (d, x) in enumerate(lines, 1)]
    return sum(upper in x and any(lower in y for _, y in nodes) for x, nodes in under)
