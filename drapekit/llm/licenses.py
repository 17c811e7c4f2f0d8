"""Operator 4, license scans by ordered signature rules.

A text becomes its words: lower-case ASCII letters, digits and everything beyond ASCII.  Rules
are regular expressions over the words, joined by single spaces.  Each rule has a keyword, so a
rule runs only on texts that hold its keyword, and texts without any keyword run none.  A
detection is an interval of words with its rule's label, priority and weight.  A detection goes
if an interval of the same or a higher priority contains it; of equal intervals with equal
priority the first rule stays.

Beside the rules stand three base phrases, whose places are all counted and whose labels always
stay.  Everything is built-in column functions over one row at a time: no shuffle, no Python.

Null or empty text: no words, no labels, score 0.  Null ids and repeated rows: kept.  Empty
table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drapekit.llm.common import lower_ascii, word_count

#: fixed values: phrase -> label
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Rule:
    keyword: str  # a word of every match
    pattern: str  # over words joined by single spaces
    label: str
    priority: int
    weight: float


#: fixed values: label, the names it goes by (as words), the words of its identifier
FAMILIES: list[tuple[str, str, str]] = [
    ("mit", "mit license|expat license|x11 license", "mit"),
    ("mit-0", "mit no attribution license|mit no attribution", "mit 0"),
    ("apache-1.1", "apache software license version 1 1|apache license version 1 1", "apache 1 1"),
    ("apache-2.0", "apache license version 2 0|apache license 2 0|apache software license version 2 0|apache 2 0 license", "apache 2 0"),
    ("apache", "apache license|apache software license", "apache"),
    ("gpl-1.0", "gnu general public license version 1|gnu gpl version 1|gplv1", "gpl 1 0"),
    ("gpl-2.0", "gnu general public license version 2|general public license version 2|general public license v2|gnu gpl version 2|gnu gpl v2|gplv2|gpl v2", "gpl 2 0"),
    ("gpl-3.0", "gnu general public license version 3|general public license version 3|general public license v3|gnu gpl version 3|gnu gpl v3|gplv3|gpl v3", "gpl 3 0"),
    ("gpl", "gnu general public license|general public license|gnu gpl", "gpl"),
    ("lgpl-2.0", "gnu library general public license|library general public license version 2", "lgpl 2 0"),
    ("lgpl-2.1", "gnu lesser general public license version 2 1|lesser general public license version 2 1|lgplv2 1|lgpl v2 1", "lgpl 2 1"),
    ("lgpl-3.0", "gnu lesser general public license version 3|lesser general public license version 3|lgplv3|lgpl v3", "lgpl 3 0"),
    ("lgpl", "gnu lesser general public license|lesser general public license|gnu lgpl", "lgpl"),
    ("agpl-3.0", "gnu affero general public license version 3|affero general public license version 3|agplv3|agpl v3", "agpl 3 0"),
    ("agpl", "gnu affero general public license|affero general public license|gnu agpl", "agpl"),
    ("gfdl", "gnu free documentation license|free documentation license", "gfdl"),
    ("bsd-2-clause", "bsd 2 clause license|2 clause bsd license|two clause bsd license|simplified bsd license|freebsd license", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause license|3 clause bsd license|three clause bsd license|new bsd license|modified bsd license|revised bsd license", "bsd 3 clause"),
    ("bsd-4-clause", "bsd 4 clause license|4 clause bsd license|four clause bsd license|original bsd license", "bsd 4 clause"),
    ("0bsd", "zero clause bsd license|bsd zero clause license|0 clause bsd license", "0bsd"),
    ("bsd", "bsd license|berkeley software distribution license", "bsd"),
    ("mpl-1.1", "mozilla public license version 1 1|mozilla public license 1 1|mpl 1 1 license", "mpl 1 1"),
    ("mpl-2.0", "mozilla public license version 2 0|mozilla public license v 2 0|mozilla public license 2 0", "mpl 2 0"),
    ("mpl", "mozilla public license", "mpl"),
    ("epl-1.0", "eclipse public license version 1 0|eclipse public license v1 0|eclipse public license 1 0", "epl 1 0"),
    ("epl-2.0", "eclipse public license version 2 0|eclipse public license v2 0|eclipse public license 2 0", "epl 2 0"),
    ("epl", "eclipse public license", "epl"),
    ("eupl", "european union public licence|european union public license", "eupl 1 2"),
    ("cddl", "common development and distribution license", "cddl 1 0"),
    ("cpl-1.0", "common public license version 1 0|common public license", "cpl 1 0"),
    ("isc", "isc license|internet systems consortium license", "isc"),
    ("zlib", "zlib license|zlib libpng license", "zlib"),
    ("libpng", "libpng license|png reference library license", "libpng"),
    ("bsl-1.0", "boost software license version 1 0|boost software license", "bsl 1 0"),
    ("unlicense", "the unlicense|unlicense license", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license|wtfpl license", "wtfpl"),
    ("artistic-1.0", "artistic license version 1 0|artistic license 1 0", "artistic 1 0"),
    ("artistic-2.0", "artistic license version 2 0|artistic license 2 0", "artistic 2 0"),
    ("artistic", "perl artistic license|artistic license", "artistic"),
    ("psf", "python software foundation license|psf license", "psf 2 0"),
    ("php", "php license version 3 01|php license", "php 3 01"),
    ("ruby", "ruby license", "ruby"),
    ("openssl", "openssl license", "openssl"),
    ("ofl-1.1", "sil open font license version 1 1|sil open font license|open font license", "ofl 1 1"),
    ("ms-pl", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "ms rl"),
    ("ncsa", "university of illinois ncsa open source license|ncsa open source license", "ncsa"),
    ("upl-1.0", "universal permissive license", "upl 1 0"),
    ("postgresql", "postgresql license", "postgresql"),
    ("odbl", "open database license|open data commons open database license", "odbl 1 0"),
    ("cc0-1.0", "cc0 1 0 universal|creative commons zero|cc0 license", "cc0 1 0"),
    ("cc-by", "creative commons attribution license|creative commons attribution 4 0|cc by license|cc by 4 0", "cc by 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike license|creative commons attribution share alike|creative commons attribution sharealike|cc by sa license|cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial|creative commons attribution non commercial|cc by nc license|cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd", "creative commons attribution noderivatives|creative commons attribution no derivatives|cc by nd license|cc by nd 4 0", "cc by nd 4 0"),
]

#: fixed values: sentences that stand for a whole license, notice or reservation
SENTENCES: list[Rule] = [
    Rule("permission", "permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 5, 1.0),
    Rule("permission", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted", "isc", 5, 1.0),
    Rule("redistribution", "redistribution and use in source and binary forms with or without modification are permitted", "bsd", 5, 0.95),
    Rule("endorse", "neither the name of (the )?[^ ]+( [^ ]+){0,8} nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause", 5, 1.0),
    Rule("acknowledgment", "all advertising materials mentioning features or use of this software must display the following acknowledgment", "bsd-4-clause", 5, 1.0),
    Rule("redistribute", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", 5, 1.0),
    Rule("redistribute", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl", 5, 1.0),
    Rule("unencumbered", "this is free and unencumbered software released into the public domain", "unlicense", 5, 1.0),
    Rule("express", "provided as is without any express or implied warranty in no event will the authors be held liable", "zlib", 5, 0.95),
    Rule("boost", "boost software license version 1 0 august 17th 2003", "bsl-1.0", 5, 1.0),
    Rule("waived", "to the extent possible under law the author has waived all copyright", "cc0-1.0", 5, 1.0),
    Rule("domain", "(is|are) (hereby )?(in|placed in|released into|dedicated to) the public domain", "public-domain", 3, 0.9),
    Rule("reserved", "all rights reserved", "proprietary", 1, 0.4),
    Rule("proprietary", "(proprietary and confidential|confidential and proprietary)", "proprietary", 3, 0.9),
    Rule("prohibited", "unauthorized (copying|use|distribution)( [^ ]+){0,6} is strictly prohibited", "proprietary", 3, 0.9),
    Rule("license", "see (the )?(file )?(license|license txt|license md)( file)?", "reference", 1, 0.3),
    Rule("copying", "see (the )?(file )?(copying)( file)?", "reference", 1, 0.3),
    Rule("copyright", "copyright( c)? (19|20)[0-9]{2}", "copyright", 0, 0.2),
]

#: fixed values: later clauses of common licenses and notices
CLAUSES: list[Rule] = [
    Rule("sublicense", "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit", 4, 0.95),
    Rule("copies", "the above copyright notice and this permission notice( including the next paragraph)? shall be included in all copies or substantial portions of the software", "mit", 4, 0.95),
    Rule("noninfringement", "warranties of merchantability fitness for a particular purpose and noninfringement", "mit", 2, 0.7),
    Rule("tort", "in an action of contract tort or otherwise arising from out of or in connection with the software", "mit", 3, 0.85),
    Rule("disclaims", "the author disclaims all warranties with regard to this software", "isc", 4, 0.9),
    Rule("tortious", "in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software", "isc", 4, 0.9),
    Rule("redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd", 4, 0.95),
    Rule("redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", "bsd", 4, 0.95),
    Rule("disclaimed", "(any express or implied warranties including but not limited to the )?implied warranties of merchantability and fitness for a particular purpose are disclaimed", "bsd", 3, 0.85),
    Rule("exemplary", "direct indirect incidental special exemplary or consequential damages", "bsd", 2, 0.7),
    Rule("acknowledgement", "(all )?advertising materials mentioning features or use of this software must display the following acknowledgement", "bsd-4-clause", 5, 1.0),
    Rule("licensor", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide( [^ ]+){0,20} licensor", "apache-2.0", 4, 0.9),
    Rule("irrevocable", "perpetual worldwide non exclusive no charge royalty free irrevocable( except as stated in this section)? (copyright|patent) license", "apache-2.0", 4, 0.95),
    Rule("conditions", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", "apache-2.0", 4, 0.95),
    Rule("compliance", "you may not use this file except in compliance with the license", "apache-2.0", 4, 0.9),
    Rule("acknowledgments", "(the )?end user documentation included with the redistribution( [^ ]+){0,8} must include the following acknowledgments?( [^ ]+){0,8} acknowledgments", "apache-1.1", 4, 0.9),
    Rule("foundation", "as published by the free software foundation either version 2 of the license", "gpl-2.0", 4, 0.95),
    Rule("foundation", "as published by the free software foundation either version 3 of the license", "gpl-3.0", 4, 0.95),
    Rule("foundation", "as published by the free software foundation either version 2 1 of the license", "lgpl-2.1", 4, 0.95),
    Rule("merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose", "gpl", 3, 0.8),
    Rule("copyleft", "is a free copyleft license for software and other kinds of works", "gpl", 4, 0.95),
    Rule("franklin", "free software foundation inc 51 franklin", "gpl", 2, 0.6),
    Rule("temple", "free software foundation inc 59 temple place", "gpl", 2, 0.6),
    Rule("verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "gpl", 3, 0.8),
    Rule("network", "all users interacting with it remotely through a computer network", "agpl-3.0", 4, 0.95),
    Rule("invariant", "with no invariant sections no front cover texts and no back cover texts", "gfdl", 5, 1.0),
    Rule("incompatible", "incompatible with secondary licenses as defined by the mozilla public license", "mpl-2.0", 4, 0.95),
    Rule("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at", "mpl-2.0", 5, 1.0),
    Rule("accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license", "epl", 5, 1.0),
    Rule("misrepresented", "the origin of this software must not be misrepresented", "zlib", 4, 0.95),
    Rule("altered", "altered source versions must be plainly marked as such", "zlib", 4, 0.95),
    Rule("executable", "machine executable object code generated by a source language processor", "bsl-1.0", 4, 0.95),
    Rule("relinquish", "(dedicate|relinquish) any and all copyright interest in the software to the public domain( [^ ]+){0,40} relinquish", "unlicense", 4, 0.9),
    Rule("perpetuity", "relinquishment in perpetuity of all present and future rights to this software under copyright law", "unlicense", 5, 1.0),
    Rule("fuck", "you just do what the fuck you want to", "wtfpl", 5, 1.0),
    Rule("artistic", "the intent of this document is to state the conditions( [^ ]+){0,60} artistic", "artistic", 3, 0.8),
    Rule("reserved", "reserved font name", "ofl-1.1", 3, 0.9),
    Rule("affirmer", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives", "cc0-1.0", 5, 1.0),
    Rule("neighboring", "copyright and related or neighboring rights", "cc0-1.0", 3, 0.8),
    Rule("attribution", "you must give appropriate credit( [^ ]+){0,30} attribution", "cc-by", 2, 0.6),
    Rule("sharealike", "(adapt|remix|transform)( [^ ]+){0,30} sharealike", "cc-by-sa", 2, 0.6),
    Rule("noncommercial", "for noncommercial purposes only", "noncommercial", 3, 0.8),
    Rule("commercial", "not for commercial use", "noncommercial", 2, 0.6),
    Rule("confidential", "(contains|this is) confidential (and proprietary )?(information|property) of", "proprietary", 3, 0.85),
    Rule("disclosure", "use duplication or disclosure( [^ ]+){0,6} is subject to restrictions", "proprietary", 3, 0.85),
    Rule("decompile", "(may|shall|must) not( [^ ]+){0,8} decompile", "proprietary", 3, 0.85),
    Rule("spdx", "spdx license identifier [^ ]+", "spdx-other", 1, 0.5),
    Rule("generated", "(automatically|auto) generated( [^ ]+){0,4} do not (edit|modify)", "generated", 1, 0.2),
]

_GRANT = "(?:licensed|released|distributed|available|provided|published|covered|governed)(?: [^ ]+)? (?:under|by|subject to)(?: the)?(?: terms of)?(?: the)?"
_LATER = "(?: (?:or|and) (?:any |at your option any )?later(?: version)?)?"


def rules() -> list[Rule]:
    """All rules in order: sentences, clauses, then per family its identifier line, a grant that names
    it, a heading with its identifier and its bare name, one rule per name."""
    out = SENTENCES + CLAUSES
    for label, names, identifier in FAMILIES:
        out.append(Rule("spdx", f"spdx license identifier {identifier}(?: only| or later)?", label, 4, 1.0))
        out.append(Rule("license", f"license {identifier}", label, 2, 0.7))
        for name in names.split("|"):
            keyword = max(name.split(" "), key=len)
            out.append(Rule(keyword, f"{_GRANT} {name}{_LATER}", label, 3 + len(name.split(" ")) // 6, 0.95))
            out.append(Rule(keyword, f"{name}{_LATER}", label, 1 + (len(name.split(" ")) > 3), 0.6))
    return out


def _words_in(col: Column) -> Column:
    """Spaces of a stretch, each of which begins a word."""
    return F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))


def _places(joined: Column, pattern: Column) -> tuple[Column, Column]:
    """(stretches between the matches, matches) of a pattern that starts at a word's space and
    ends before the next word's."""
    bound = F.concat(F.lit(" (?:"), pattern, F.lit(")(?= )"))
    return F.split(joined, bound, -1), F.regexp_extract_all(joined, bound, F.lit(0))


def _found(joined: Column, keywords: list[str], by_keyword: Column) -> Column:
    """All detections, ordered so that a containing interval comes before what it contains."""

    def of_rule(rule: Column) -> Column:
        between, match = _places(joined, rule["pattern"])
        # a match starts after the words between and within the matches before it
        steps = F.transform(F.arrays_zip(F.slice(between, 1, F.size(match)).alias("b"), match.alias("m")), lambda x: F.struct(_words_in(x["b"]).alias("b"), _words_in(x["m"]).alias("m")))
        none = F.struct(F.lit(0).alias("words"), F.array().cast("array<int>").alias("starts"))
        begin = F.aggregate(steps, none, lambda a, x: F.struct((a["words"] + x["b"] + x["m"]).alias("words"), F.concat(a["starts"], F.array(a["words"] + x["b"])).alias("starts")))["starts"]
        spans = F.transform(F.arrays_zip(begin.alias("b"), F.transform(match, lambda m: _words_in(m)).alias("n")), lambda s: F.struct(s["b"].alias("start"), (-s["b"] - s["n"]).alias("end"), (-rule["priority"]).alias("rank"), rule["at"].alias("at"), rule["label"].alias("label"), rule["weight"].alias("weight")))
        return F.when(F.size(match) > 0, spans)

    gates = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(joined, F.concat(F.lit(" "), k, F.lit(" "))))
    run = F.flatten(F.transform(gates, lambda k: by_keyword[k]))
    return F.array_sort(F.flatten(F.filter(F.transform(run, of_rule), lambda x: x.isNotNull())))


def _kept(found: Column, priorities: list[int]) -> Column:
    """Detections that no interval of the same or a higher priority contains: one sweep that
    holds, per priority, how far the intervals so far reach."""
    first = F.struct(F.array(*[F.lit(-1) for _ in priorities]).alias("reach"), F.filter(found, lambda _: F.lit(False)).alias("kept"))

    def step(state: Column, d: Column) -> Column:
        at = F.array_position(F.array(*[F.lit(-p) for p in priorities]), d["rank"]).cast("int")
        inside = F.exists(F.slice(state["reach"], 1, at), lambda r: r >= -d["end"])
        reach = F.transform(state["reach"], lambda r, k: F.when(k + 1 == at, F.greatest(r, -d["end"])).otherwise(r))
        return F.struct(reach.alias("reach"), F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(d))).alias("kept"))

    return F.aggregate(found, first, step)["kept"]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (the largest weight of what stays; base places weigh 0.6), detections (start,
    end, label, priority, weight)."""
    table = rules()
    priorities = sorted({r.priority for r in table}, reverse=True)
    keywords = sorted({r.keyword for r in table})

    def literal(at: int, r: Rule) -> Column:
        return F.struct(F.lit(at).alias("at"), F.lit(r.pattern).alias("pattern"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.weight).alias("weight"))

    by_keyword = F.create_map(*[x for k in keywords for x in (F.lit(k), F.array(*[literal(i, r) for i, r in enumerate(table) if r.keyword == k]))])
    other = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    either = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # between words before lower-casing
    # no keyword, no rule and no base phrase: such texts are only counted
    gate = "(?i)(?<![a-z0-9])(?:" + "|".join(keywords) + ")(?![a-z0-9])"
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = source.withColumn("n_words", word_count("text", either).cast("long"))
    words = F.trim(F.regexp_replace(lower_ascii("text"), other, " "))
    joined = F.when(F.col("text").rlike(gate), F.concat(F.lit(" "), words, F.lit(" ")))
    source = source.select("id", "n_words", joined.alias("joined"))
    base = []
    for phrase, label in BASE.items():
        size = len(phrase.split(" "))
        between = F.split("joined", f" {phrase}(?= )", -1)
        hit = F.size(between) > 1
        base.append(F.struct(
            F.when(hit, F.size(between) - 1).otherwise(0).cast("long").alias("n"),
            F.when(hit, _words_in(between[0])).cast("long").alias("first"),
            F.when(hit, F.col("n_words") - size - (_words_in(F.element_at(between, -1)) - 1)).cast("long").alias("last"),
            F.when(hit, F.lit(label)).alias("label"),
        ))
    source = source.withColumn("base", F.when(F.col("joined").isNotNull(), F.array(*base)))
    found = F.when(F.col("joined").isNotNull(), _found(F.col("joined"), keywords, by_keyword))
    source = source.withColumn("found", found)
    source = source.withColumn("kept", F.when(F.size("found") > 0, _kept(F.col("found"), priorities)))
    none = F.array().cast("array<string>")
    own = F.coalesce(F.filter(F.transform("base", lambda b: b["label"]), lambda x: x.isNotNull()), none)
    more = F.coalesce(F.transform("kept", lambda d: d["label"]), none)
    n_base = F.coalesce(F.aggregate("base", F.lit(0).cast("long"), lambda a, b: a + b["n"]), F.lit(0).cast("long"))
    score = F.greatest(F.coalesce(F.array_max(F.transform("kept", lambda d: d["weight"])), F.lit(0.0)), F.when(n_base > 0, 0.6).otherwise(0.0))
    shown = F.transform("kept", lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("end"), d["label"].alias("label"), (-d["rank"]).alias("priority"), d["weight"].alias("weight")))
    return source.select(
        F.col("id").alias(id_col),
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(own, more))), ",").alias("labels"),
        score.alias("score"),
        shown.alias("detections"),
    )
