"""License scans: windows of a normalised text against licence templates, by Dice coefficient over word bigrams."""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence notices as their authors ask to place them (fixed values): template, family, text.
TEMPLATES = [
    ("apache-2.0-short", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "permissive", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("mit-short", "permissive", "Released under the MIT License."),
    ("mit-text", "permissive", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-warranty", "permissive", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."),
    ("isc-text", "permissive", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-3-clause-short", "permissive", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd-text", "permissive", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-conditions", "permissive", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-warranty", "permissive", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed."),
    ("unlicense", "permissive", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("gpl-3.0-short", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-warranty", "copyleft", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("lgpl-notice", "copyleft", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mpl-2.0-notice", "copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-4.0-short", "attribution", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "sharealike", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0-short", "noncommercial", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "reserved", "Copyright. All rights reserved. No part of this publication may be reproduced without written permission."),
    ("all-rights-reserved-short", "reserved", "All rights reserved."),
    ("agpl-notice", "copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("cc0-1.0", "public-domain", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("zlib-warranty", "permissive", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("epl-2.0-notice", "copyleft", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    *[(f"spdx-{x.lower()}", family, f"SPDX-License-Identifier: {x}") for family, ids in (
        ("permissive", "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC Zlib"), ("copyleft", "GPL-2.0-only GPL-3.0-or-later LGPL-2.1-or-later AGPL-3.0-or-later MPL-2.0 EPL-2.0"), ("public-domain", "CC0-1.0 Unlicense")) for x in ids.split()],
]


@dataclass(frozen=True)
class Template:
    """A template's normalised words, its different bigrams, and those of them of which every window that is like it has one."""

    name: str
    family: str
    words: tuple[str, ...]
    bigrams: tuple[str, ...]
    anchors: tuple[str, ...]


def normal_words(text: str) -> list[str]:
    """The template side of the normalisation: lower case, anything but a-z and 0-9 separates words."""
    return "".join(x if x in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for x in text.lower()).split()


def prepared(templates: list[tuple[str, str, str]] = TEMPLATES, least: float = 0.8) -> list[Template]:
    """Templates of two words or more, with their anchors.

    A window with the bigrams W meets a template with the bigrams B at ``least`` only if 2 |W and B| >= least (|W| + |B|); as
    |W| >= |W and B|, it has least / (2 - least) of B at least, two thirds at 0.8. So of any more than a third of B it has
    one. The anchors are that many: those that share the fewest words, long ones first, so that few words of a text tell
    whether it can have any."""
    out = []
    for name, family, text in templates:
        words = normal_words(text)
        pairs = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
        if not pairs:
            continue
        enough = len(pairs) - ceil(len(pairs) * least / (2 - least) - 1e-9) + 1
        anchors: dict[str, None] = {}
        while len(anchors) < enough:
            left = [p for p in pairs if p not in anchors]
            word = max(sorted({w for p in left for w in p.split()}), key=lambda w: (min(len(w), 6), sum(w in p.split() for p in left)))
            anchors.update(dict.fromkeys([p for p in left if word in p.split()][: enough - len(anchors)]))
        out.append(Template(name, family, tuple(words), tuple(sorted(pairs)), tuple(anchors)))
    return out


def gate_words(known: list[Template]) -> list[str]:
    """Words of which every anchor has one: a text without any of them meets no template."""
    left, out = {a for t in known for a in t.anchors}, []
    while left:
        word = max(sorted({w for a in left for w in a.split()}), key=lambda w: (min(len(w), 6), sum(w in a.split() for a in left)))
        out.append(word)
        left = {a for a in left if word not in a.split()}
    return sorted(out)


def scan(docs: DataFrame, least: float = 0.8, templates: list[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, template, family, dice, n_templates, templates: one row per row of ``docs`` (doc_id, text).

    The whole text is normalised to words, across line ends and comment marks. Every run of as many words as a template has
    is a window, also those that the ends of the text cut off. templates are the names of those that some window meets with
    a Dice coefficient over word bigrams, 2 |A and B| / (|A| + |B|), of ``least`` or more, joined by commas in order; dice,
    template and family are of the best one (ties: the first by name); null, 0 and an empty text where there is none.

    No window is lost by what is left out: it must hold one of a template's anchors (prepared()), so only windows around
    these are compared, in texts that have a word of one, and only if their number of bigrams lies between
    least / (2 - least) and (2 - least) / least of the template's.

    All in expressions over the row: no shuffle, no join, no Python; the templates are literals of fixed size. Null and empty
    texts have no windows. Null doc_id stays null, repeated rows are scanned each, an empty table gives no rows. Columns
    other than doc_id and text are not read.
    """
    low, high, known = least / (2 - least), (2 - least) / least, prepared(templates, least)
    rows = [{"template": t.name, "family": t.family, "bigrams": t.bigrams, "n": len(t.bigrams), "length": len(t.words) - 1, "anchors": t.anchors} for t in known]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<template:string,family:string,bigrams:array<string>,n:int,length:int,anchors:array<string>>>")
    listed = lambda words: F.from_json(F.lit(json.dumps(words)), "array<string>")
    normal = F.trim(F.regexp_replace(F.lower(docs["text"].cast("string")), "[^a-z0-9]+", " "))
    found = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.split(normal, " ").alias("words"))
    found = found.select("doc_id", F.when(F.arrays_overlap("words", listed(gate_words(known))), F.col("words")).alias("words"))
    pairs = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1), lambda a, b: F.concat_ws(" ", a, b))
    found = found.select("doc_id", F.when(F.size("words") > 1, pairs).alias("pairs"))
    anchored = F.arrays_overlap("pairs", listed(sorted({a for t in known for a in t.anchors})))
    there = F.filter(table, lambda t: F.arrays_overlap(F.col("pairs"), t["anchors"]))
    found, count = found.select("doc_id", "pairs", F.when(anchored, there).alias("there")), F.size("pairs")

    def best(t: Column) -> Column:
        """The largest Dice coefficient of any window of the row with a template."""
        at = F.filter(F.sequence(F.lit(1), count), lambda p: F.array_contains(t["anchors"], F.element_at("pairs", p)))
        # the windows around each anchor that the one before it is not in
        around = F.transform(at, lambda p, k: F.sequence(F.greatest(p - t["length"] + 1, F.coalesce(F.get(at, k - 1) + 1, F.lit(-(1 << 30)))), p))
        windows = F.transform(F.flatten(around), lambda s: F.array_distinct(F.slice(F.col("pairs"), F.greatest(s, F.lit(1)), F.least(s + t["length"] - 1, count) - F.greatest(s, F.lit(1)) + 1)))
        fitting = F.filter(windows, lambda w: F.size(w).between(t["n"] * low, t["n"] * high))
        return F.array_max(F.transform(fitting, lambda w: F.lit(2.0) * F.size(F.array_intersect(w, t["bigrams"])) / (F.size(w) + t["n"])))

    # the text has to hold as many of a template's bigrams as a window would
    candidates = F.filter("there", lambda t: F.size(F.array_intersect("pairs", t["bigrams"])) >= t["n"] * low)
    scored = F.transform(candidates, lambda t: F.struct(best(t).alias("dice"), t["template"].alias("template"), t["family"].alias("family")))
    hits = found.select("doc_id", F.filter(scored, lambda x: x["dice"] >= least).alias("hits"))
    first = hits.select("doc_id", "hits", F.array_max(F.transform("hits", lambda x: x["dice"])).alias("dice"))
    chosen = F.array_min(F.transform(F.filter("hits", lambda x: x["dice"] == F.col("dice")), lambda x: F.struct(x["template"].alias("template"), x["family"].alias("family"))))
    names = F.coalesce(F.array_join(F.array_sort(F.transform("hits", lambda x: x["template"])), ","), F.lit(""))
    flat = first.select("doc_id", chosen.alias("chosen"), "dice", F.coalesce(F.size("hits"), F.lit(0)).alias("n"), names.alias("templates"))
    return flat.select("doc_id", F.col("chosen.template").alias("template"), F.col("chosen.family").alias("family"), "dice", F.greatest("n", F.lit(0)).alias("n_templates"), "templates")


def oracle(least: float = 0.8, templates: list[tuple[str, str, str]] = TEMPLATES) -> str:
    """The same scan over ``documents`` in SQL, without anchors: every window that holds any bigram of a template has its share
    counted; those that could reach ``least`` if they held nothing else are measured."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = prepared(templates, least)
    rows = lambda it: ", ".join(f"({', '.join(quote(x) if isinstance(x, str) else str(x) for x in row)})" for row in it)
    return f"""
WITH t AS (SELECT * FROM (VALUES {rows((t.name, t.family, len(t.bigrams), len(t.words) - 1) for t in known)}) v(template, family, n, length)),
b AS (SELECT * FROM (VALUES {rows((t.name, gram) for t in known for gram in t.bigrams)}) v(template, gram)),
d AS (SELECT row_number() OVER () AS r, doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM documents),
p AS (SELECT r, words, unnest(range(1, len(words))) AS pos FROM d),
g AS (SELECT r, pos, words[pos] || ' ' || words[pos + 1] AS gram FROM p),
x AS (SELECT r, pos, gram, template, n, length FROM g JOIN b USING (gram) JOIN t USING (template)),
e AS (SELECT r, template FROM x GROUP BY r, template, n HAVING 2.0::DOUBLE * count(DISTINCT gram) / (count(DISTINCT gram) + n) >= {least}::DOUBLE),
s AS (SELECT r, template, n, length, unnest(range(pos - length + 1, pos + 1)) AS start, gram FROM x SEMI JOIN e USING (r, template)),
m AS (SELECT r, template, n, length, start, count(DISTINCT gram) AS same FROM s GROUP BY ALL HAVING 2.0::DOUBLE * same / (same + n) >= {least}::DOUBLE),
c AS (SELECT m.r, m.template, m.start, m.same, m.n, count(DISTINCT g.gram) AS size FROM m JOIN g ON g.r = m.r AND g.pos BETWEEN m.start AND m.start + m.length - 1 GROUP BY ALL),
h AS (SELECT r, template, max(2.0::DOUBLE * same / (size + n)) AS dice FROM c GROUP BY ALL HAVING max(2.0::DOUBLE * same / (size + n)) >= {least}::DOUBLE),
k AS (SELECT r, max(dice) AS dice, count(*) AS n, string_agg(template, ',' ORDER BY template) AS templates FROM h GROUP BY r),
f AS (SELECT r, min(template) AS template FROM h JOIN k USING (r, dice) GROUP BY r)
SELECT doc_id, f.template, t.family, k.dice, CAST(coalesce(k.n, 0) AS INTEGER) AS n_templates, coalesce(k.templates, '') AS templates
FROM d LEFT JOIN k USING (r) LEFT JOIN f USING (r) LEFT JOIN t ON t.template = f.template
"""
