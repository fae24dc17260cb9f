"""License scans by sentence rules.

Sentences of a text are normalised to their words and looked up among known license sentences. What
is found gives a sequence of identifiers; ordered rules are matched against it, the longest first,
and tell which license the text names or holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspan.llm.ship import let_go, ship

ROWS = 256
LEAD = " \t*#/\"'(-"  # may stand between the beginning of a line or clause and its first word

# Known sentences of public licenses.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-notice-the": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-released": "Released under the Apache License 2.0",
    "mit-notice": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-include": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-licensed": "Licensed under the GNU General Public License, version 3",
    "gpl-redistribute": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "bsd-allowed": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
}
RULES = (
    ("Apache-2.0", ("apache-notice-the", "apache-comply", "apache-copy")),
    ("Apache-2.0", ("apache-notice-the",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-released",)),
    ("Apache-2.0", ("spdx-apache",)),
    ("MIT", ("mit-permission", "mit-include", "mit-warranty")),
    ("MIT", ("mit-permission", "mit-include")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("spdx-mit",)),
    ("GPL-3.0-or-later", ("gpl-redistribute", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-redistribute",)),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0", ("gpl3-licensed",)),
    ("GPL-3.0", ("spdx-gpl3",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("BSD-3-Clause", ("bsd-allowed", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-allowed", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-permission",)),
    ("MPL-2.0", ("mpl-notice",)),
    ("Unlicense", ("unlicense",)),
)

BEGIN = re.compile(r"(?:\A|\n|[.!?;:][ \t]|[,(*#][ \t]*)")
WORD = re.compile(r"[a-z0-9]+")
ENDED = re.compile(r"[^\sa-z0-9]*(?:\s|\Z)")

Found = tuple[str, int, int]  # identifier, start, end


def words(sentence: str) -> list[str]:
    return WORD.findall(sentence.lower())


class Scanner:
    """Knows sentences as a tree of words, and rules from the longest to the shortest."""

    def __init__(self, sentences: dict[str, str], rules: tuple[tuple[str, tuple[str, ...]], ...]):
        self.tree: dict = {}
        for name, sentence in sentences.items():
            node = self.tree
            for word in words(sentence):
                node = node.setdefault(word, {})
            node[""] = name
        self.rules = sorted(rules, key=lambda rule: -len(rule[1]))
        self.first = set(self.tree)

    def sentences(self, text: str) -> list[Found]:
        """The known sentences, each from the beginning of a sentence, clause or line, the longest
        that fits. Case, punctuation and line breaks inside a sentence do not matter."""
        low = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
        found: list[Found] = []
        free = 0
        word, clear, tried = None, 0, False
        for begin in BEGIN.finditer(low):
            at = begin.end()
            if at < free:
                continue
            if word is None or word.start() < at:
                word, tried = WORD.search(low, at), False
                if word is None:
                    break
                clear = at + len(low[at : word.start()].rstrip(LEAD))
            if tried or at < clear or word.group() not in self.first:
                continue
            tried = True  # many beginnings may stand before one word
            match, node, start, best = word, self.tree, word.start(), None
            while match and match.group() in node:
                node = node[match.group()]
                at = match.end()
                if "" in node and ENDED.match(low, at):
                    best = (node[""], start, at)
                match = WORD.search(low, at)
            if best:
                found.append(best)
                free = best[2]
        return found

    def licenses(self, text: str) -> list[tuple[str, int, int]]:
        """(license, start, end) of every rule that the sentences fulfil, by start."""
        found = self.sentences(text)
        used = [False] * len(found)
        named = []
        for license, rule in self.rules if found else ():
            for first in range(len(found)):
                chain = self._chain(found, used, first, rule)
                if chain:
                    for i in chain:
                        used[i] = True
                    named.append((license, found[chain[0]][1], found[chain[-1]][2]))
        return sorted(named, key=lambda n: (n[1], n[2], n[0]))

    @staticmethod
    def _chain(found: list[Found], used: list[bool], first: int, rule: tuple[str, ...]) -> list[int]:
        """The sentences that fulfil ``rule`` from sentence ``first`` on; none if they do not.

        They may lie any distance apart, but the rule's first sentence does not come again among them.
        """
        if used[first] or found[first][0] != rule[0]:
            return []
        chain = [first]
        for wanted in rule[1:]:
            for at in range(chain[-1] + 1, len(found)):
                if not used[at] and found[at][0] == wanted:
                    chain.append(at)
                    break
                if found[at][0] == rule[0]:
                    return []
            else:
                return []
        return chain


def scan(df: DataFrame, sentences=SENTENCES, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, licenses): one row per row of ``df``, its licenses as (license, start, end).

    Starts and ends are in code points. A null or empty text has none; a text that repeats a license
    has it as often. Repeated rows repeat their result; other columns are not looked at.
    """
    ship(df.sparkSession)
    struct = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        scanner = Scanner(sentences, rules)
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                batch = whole.slice(begin, ROWS)
                rows = [
                    [dict(zip(("license", "start", "end"), n)) for n in scanner.licenses(t.as_py() or "")]
                    for t in batch.column("text")
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(rows, struct)], ["doc_id", "licenses"]
                )

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, licenses array<struct<license:string,start:int,end:int>>")
