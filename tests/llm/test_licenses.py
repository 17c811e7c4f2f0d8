from __future__ import annotations

import random
import re
from dataclasses import replace
from unittest.mock import ANY

from drapekit.llm import licenses as op
from tests.llm.helpers import SCHEMA, frame, prose

TEXTS = [
    None, "", "  ", "MIT License", "mit\n-License; MIT LICENSE mit license", "emit license mit licenses", "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0. See LICENSE file", "GNU General Public License version 2 or any later version, General Public License",
    "Éa MIT é License", "é mit license é", "SPDX-License-Identifier: BSD-3-Clause\nall rights reserved copyright (c) 2021",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and the MIT license",
    "released under the terms of the gnu lesser general public license version 2.1 or later", "license: mit", "K mit license K",
    "This is free and unencumbered software released into the public domain. cc by sa 4.0 and mit license apache license", "licence license mit 0",
    "is in the public domain is placed in the public domain", "mit license mit license mit license " * 40,
]

#: a clause of a license's body, with its usual signs, and the label it stands for
BODIES = {
    "THE ABOVE copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.": "mit",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer": "bsd",
    "a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license": "apache-2.0",
    "as published by the Free Software Foundation; either version 3 of the License": "gpl-3.0",
    "with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts": "gfdl",
    "If a copy of the MPL was not distributed with this file, You can obtain one at": "mpl-2.0",
    "The origin of this software must not be misrepresented;": "zlib",
    "You may not rent, lease, or decompile it": "proprietary",
}


def test_clauses_are_found_within_prose(spark):
    texts = [f"{prose(k, 12)} {body} {prose(k + 100, 12)}" for k, body in enumerate(BODIES)]
    got = {r["doc_id"]: r["labels"].split(",") for r in op.license_scan(frame(spark, texts)).collect()}
    assert all(label in got[k] for k, label in enumerate(BODIES.values()))


def slow(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in op.BASE.items():
        p = phrase.split(" ")
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    joined = " " + " ".join(words) + " "
    found = []
    for at, rule in enumerate(op.rules()):
        if rule.keyword in words:
            for m in re.finditer(f" (?:{rule.pattern})(?= )", joined):
                start = joined[: m.start()].count(" ")
                found.append((start, start + m.group().count(" "), rule.priority, at, rule.label, rule.weight))
    kept = []
    for d in found:
        for e in found:
            over = e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2]
            if e is not d and over and (e[:3] != d[:3] or e[3] < d[3]):
                break
        else:
            kept.append(d)
    own = {label for _, label in places}
    starts = [i for i, _ in places]
    score = max([0.0, *[d[5] for d in kept], *[0.6 for _ in places[:1]]])
    labels = own | {d[4] for d in kept}
    detections = sorted((d[0], d[1], d[4], d[2], d[5]) for d in kept)
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(labels)), score, detections


def test_matches_brute_force(spark):
    rng = random.Random(4)
    rules = op.rules()
    assert len(rules) > 300 and all(re.search(f"(^| |\\(|\\|){r.keyword}", r.pattern) for r in rules)
    texts = list(TEXTS)
    for k in range(60):
        parts = [prose(k, 10)]
        for _ in range(4):
            r = rng.choice(rules)
            plain = re.sub(r"\[\^ \]\+", "word", re.sub(r"\{.*?\}|\?:|\?|[()]", "", r.pattern)).replace("|", " ")
            parts += [plain.title() if rng.random() < 0.5 else plain, rng.choice([". ", "\n", ", the ", " "])]
            if rng.random() < 0.5:
                parts.append(f"{rng.choice(['Licensed', 'released'])} under the {rng.choice(rng.choice(op.FAMILIES)[1].split('|'))}; {prose(k, 3)}")
        texts.append(" ".join(parts))
    rows = op.license_scan(frame(spark, texts)).collect()
    got = {r.doc_id: (*tuple(r)[1:-1], sorted(tuple(d) for d in r.detections or [])) for r in rows}
    want = {k: slow(t) for k, t in enumerate(texts)}
    assert got == want
    assert sum(1 for w in want.values() if len(w[5]) > len(w[4])) > 30


def test_null_ids_repeats_empty_and_plan(spark):
    df = spark.createDataFrame([(None, "mit license", "", "", 1, "", 1), (1, "x", "", "", 1, "", 1), (1, "x", "", "", 1, "", 1)], SCHEMA)
    out = op.license_scan(df)
    assert sorted((r.doc_id or 0, r.n_base) for r in out.collect()) == [(0, 1), (1, 0), (1, 0)]
    assert op.license_scan(spark.createDataFrame([], SCHEMA)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_very_long_text(spark):
    text = "the MIT License and " * 3000 + prose(1, 30_000)
    (r,) = op.license_scan(frame(spark, [text])).collect()
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (42_000, 3000, 1, 11_997) and len(r.detections) == 3000


def test_keywords_hide_no_match(spark, monkeypatch):
    """Every rule on every text, with no gate before it."""
    texts = ["see the file COPYING", "See COPYING file; all is well", "see license copying, see copying", "the file copying", *TEXTS]
    rows = op.license_scan(frame(spark, texts)).collect()
    rules = [replace(r, keyword=ANY) for r in op.rules()]
    monkeypatch.setattr(op, "rules", lambda: rules)
    got = {r.doc_id: (*tuple(r)[1:-1], sorted(tuple(d) for d in r.detections or [])) for r in rows}
    assert got == {k: slow(t) for k, t in enumerate(texts)}
    assert [rows[k].labels for k in range(4)] == ["reference", "reference", "reference", ""] and rows[0].score == 0.3
