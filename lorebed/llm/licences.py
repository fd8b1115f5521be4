"""License scans: known licence sentences, then ordered rules over their sequence. DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .job import ascii_lower

# Sentences of public licences and notices, as published.
SENTENCES: dict[str, str] = {
    "mit-notice": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "bsd-redistribute": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-the": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-obtain": "You may obtain a copy of the License at",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-sa-4-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "gpl2-only-of": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-free": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl3-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "epl1-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http",
    "epl2-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https",
    "epl2-made-http": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http",
    "cc0-author": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "cc0-authors": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "cc0-notice": "Licensed under CC0 1.0",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}

# The rules in order; sentences that a rule has matched are no longer there for later ones.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-grant", "mit-keep", "as-is"]),
    ("MIT", ["mit-grant", "mit-keep"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-the", "apache-comply", "apache-obtain"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-copy"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("Apache-2.0", ["apache-the"]),
    ("Apache-2.0", ["apache-notice"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-licensed"]),
    ("MPL-2.0", ["mpl-subject"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-work"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-4.0", ["cc-by-4-work"]),
    ("Unlicense", ["unlicense"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-copy"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("GPL-2.0-only", ["gpl2-only"]),
    ("GPL-2.0-only", ["gpl2-only-of"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("LGPL-3.0-or-later", ["lgpl3-program"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    ("EPL-1.0", ["epl1-made"]),
    ("EPL-2.0", ["epl2-made"]),
    ("EPL-2.0", ["epl2-made-http"]),
    ("CC0-1.0", ["cc0-author"]),
    ("CC0-1.0", ["cc0-authors"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("BSL-1.0", ["bsl-notice"]),
]

#: A sentence ends at a line's end, or with its mark before white space.
SENTENCE_END = r"[.!?]+[ \t]+|[ \t]*[\r\n]+"
# Marks in a text's words: a place where a sentence ends or begins for certain, one where it may, and a separator that n_sentences counts.
HARD, SOFT, COUNTED = "|", "~", "^"
#: What becomes of a text before its words are taken, in order. A line's end, ``;`` and ``:`` may end a sentence or stand within one; the mark in ``v. 2.0``
#: stands within one; marks before white space, and lines without a letter or digit, end one. Every separator of SENTENCE_END leaves one COUNTED.
STEPS: list[tuple[str, str]] = [
    (r"[|~^]", ","),
    (r"\bv\.[ \t]+(?=[^a-z0-9.!?]*[0-9])", f"v{COUNTED}"),
    (r"\bv\.(?=[\r\n][^a-z0-9.!?]*[0-9])", "v"),
    (r"[.!?]+[ \t]+", HARD + COUNTED),
    (r"[.!?]+(?=[\r\n]|$)", HARD),
    (r"(?:\r\n|\n|\r(?!\n)){2,}+|[\r\n]++(?=[^a-z0-9\r\n]++[\r\n])", HARD + COUNTED),
    (r"[\r\n]+", SOFT + COUNTED),
    (r"[;:]", SOFT),
    (r"[^a-z0-9|~^]+", " "),
    (r" ?([|~^]) ?", "$1"),
]
#: A sentence of so many words is told by them alone: on one line, a grant follows the holder's name without a mark.
LONG = 15
#: Every known sentence has one of these; a text with none has no known sentence.
CUES = ["licen", "permission", "redistribution", "warrant", "unencumbered", "neighboring"]


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def known() -> dict[str, str]:
    """Normalised sentence to identifier."""
    return {normalised(s): i for i, s in SENTENCES.items()}


def _sentence_pattern() -> str:
    """A known sentence between two marks, over line ends and other places where a sentence may end; the longest first. One of LONG words may begin at any word."""
    found = sorted(known(), key=len, reverse=True)
    any_of = lambda some: "(?:" + "|".join(s.replace(" ", "[ ~^]++") for s in some) + ")(?=[|~^])"
    return f"(?<=[|~^]){any_of(found)}|(?<= ){any_of(s for s in found if s.count(' ') + 1 >= LONG)}"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The licences of every text.

    Returns the id; licences (the matched rules' names, each once, in the rules' order, joined by ``;``); sentence_ids (the known
    sentences in the text's order, joined by ``;``); n_sentences (all of the text, ended at line ends too); first_sentence (the place of
    the first known one's beginning, from 0, else null). A known sentence may go over line ends. A rule matches if its sentences stand in a row among the known sentences. Whole texts are read in one pass without
    a shuffle. A null text counts as empty, with one empty sentence. Repeated rows give as many equal rows; columns other than the id and the text
    aren't read.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    marked = text
    for pattern, mark in STEPS:
        marked = F.regexp_replace(marked, pattern, mark)
    marked = F.when(_cued(text), F.concat(F.lit(HARD), marked, F.lit(HARD))).otherwise("")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.size(F.split(text, SENTENCE_END)).cast("long").alias("n_sentences"), marked.alias("marked"))
    lookup = F.create_map(*[F.lit(x) for pair in known().items() for x in pair])
    pattern = F.lit(_sentence_pattern())
    ids = F.transform(F.regexp_extract_all("marked", pattern, F.lit(0)), lambda s: F.try_element_at(lookup, F.regexp_replace(s, "[^a-z0-9]+", " ")))
    before = F.substring(F.col("marked"), F.lit(1), F.regexp_instr("marked", pattern) - 1)
    first = F.when(F.size("ids") > 0, F.char_length(before) - F.char_length(F.replace(before, F.lit(COUNTED), F.lit(""))))
    rows = rows.withColumn("ids", ids).select("doc_id", "n_sentences", "ids", first.cast("int").alias("first_sentence"))
    rows = rows.withColumn("rest", F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">")))
    matched = []
    for k, (name, sequence) in enumerate(RULES):
        wanted = "".join(f"<{i}>" for i in sequence)
        rows = rows.withColumns(
            {f"match_{k}": F.when(F.contains(F.col("rest"), F.lit(wanted)), F.lit(name)), "rest": F.replace(F.col("rest"), F.lit(wanted), F.lit("<>"))}
        )
        matched.append(F.col(f"match_{k}"))
    licences = F.array_join(F.array_distinct(F.array_compact(F.array(*matched))), ";")
    return rows.select("doc_id", licences.alias("licences"), F.array_join("ids", ";").alias("sentence_ids"), "n_sentences", "first_sentence")


def _cued(column):
    out = F.contains(column, F.lit(CUES[0]))
    for cue in CUES[1:]:
        out = out | F.contains(column, F.lit(cue))
    return out


def duckdb_sql(table: str = "documents") -> str:
    """The same in DuckDB, without the shortcut by cues."""
    values = ", ".join(f"('{s}', '{i}')" for s, i in known().items())
    end = SENTENCE_END.replace("\\r\\n", "\r\n").replace("\\t", "\t")
    steps, last = [], "joined"
    for k, (name, sequence) in enumerate(RULES):
        wanted = "".join(f"<{i}>" for i in sequence)
        steps.append(
            f"r{k} AS (SELECT *, CASE WHEN contains(rest{k}, '{wanted}') THEN '{name}' END AS m{k}, replace(rest{k}, '{wanted}', '<>') AS rest{k + 1} FROM {last})"
        )
        last = f"r{k}"
    names = list(dict.fromkeys(n for n, _ in RULES))
    each = ", ".join("CASE WHEN " + " OR ".join(f"m{k} IS NOT NULL" for k, (x, _) in enumerate(RULES) if x == n) + f" THEN '{n}' END" for n in names)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH known(sentence, id) AS (VALUES {values}),
split AS (SELECT doc_id, string_split_regex({lower}, '{end}') AS s FROM {table}),
each AS (SELECT doc_id, unnest(s) AS sentence, unnest(range(len(s))) AS pos FROM split),
named AS (SELECT doc_id, pos, id FROM each JOIN known ON trim(regexp_replace(each.sentence, '[^a-z0-9]+', ' ', 'g'), ' ') = known.sentence),
by_doc AS (SELECT doc_id, string_agg(id, ';' ORDER BY pos) AS ids, min(pos) AS first_sentence FROM named GROUP BY doc_id),
joined AS (
  SELECT doc_id, len(s)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids, first_sentence, '<' || replace(coalesce(ids, ''), ';', '><') || '>' AS rest0
  FROM split LEFT JOIN by_doc USING (doc_id)
),
{", ".join(steps)}
SELECT doc_id, array_to_string(list_filter([{each}], lambda x: x IS NOT NULL), ';') AS licences, sentence_ids, n_sentences, first_sentence FROM {last}
"""
