"""License notices by conditional compression against templates.

Every place where a text has a legal term or an anchor (a word pair of a template, after normalising)
begins candidate blocks, one for each template, a little longer than it; a template has one anchor more than
it may have differences. Anchors give rows only for confirmed notices. A block is compressed twice with zstandard, alone and with the template as raw
dictionary; templates are ranked by the share that the dictionary saves. They are then
confirmed by wording: block and template are aligned word by word, and the winner is the one with
the fewest missing or changed words, if these are at most ``tolerance`` of the template's. Only templates
with more words missing than that are not aligned. The differences are kept.

Defined cases: a null or empty text and one without a legal term give no rows; equal rows give equal
rows each; blocks that no template is confirmed for give a row with the best template and
``confirmed`` false, and such blocks that overlap are one row, with the template of the first; a place inside a
confirmed notice begins no block of its own; words are parted by any white space, a no-break space too; further
columns are ignored; texts are read whole.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edispark.shipping import ship

# Wording of public licenses and their customary notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MIT": "Released under the MIT License.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "GPL-2.0-header": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    "LGPL-2.1-header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense-text": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
}
#: Legal terms that begin a candidate; used by Spark and in tasks alike.
TERMS = r"(?i)\b(?:licen[sc]ed?\b|released\s+under|distributed\s+under|permission\s+(?:is\s+hereby|to\s+use)|redistribution\s+and\s+use|free\s+software|subject\s+to\s+the\s+terms|unencumbered\s+software|waived\s+all\s+copyright)"
_TERM = re.compile(TERMS)
#: Words before a term that a block also takes, so that a notice may begin before its term.
LEAD = 12
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")


def normal(word: str) -> str:
    return _EDGE.sub("", word).lower()


def anchors(words: list[str], tolerance: float) -> list[int]:
    """Places of word pairs of a template, one more than it may have differences; no two share a word, so one is always left."""
    chosen: list[int] = []
    for k in sorted(range(len(words) - 1), key=lambda k: (-len(words[k]) - len(words[k + 1]), k)):
        if all(abs(k - x) > 1 for x in chosen) and len(chosen) <= int(tolerance * len(words)):
            chosen.append(k)
    return chosen


def places(templates: dict[str, str] = TEMPLATES, tolerance: float = 0.1) -> str:
    """Pattern of all texts with a candidate: legal terms and anchors, with any signs between an anchor's words."""
    pairs = set()
    for text in templates.values():
        words = [w for w in map(normal, text.split()) if w]
        pairs |= {tuple(words[k : k + 2]) for k in anchors(words, tolerance)}
    return TERMS + "|(?iu)(?:" + "|".join(r"\W+".join(re.sub(r"(\W)", r"\\\1", w) for w in p) for p in sorted(pairs)) + ")"


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, tolerance: float = 0.1, level: int = 3):
        import zstandard

        self.tolerance = tolerance
        self.plain = zstandard.ZstdCompressor(level=level)
        self.templates = []
        for name, text in templates.items():
            words = [w for w in map(normal, text.split()) if w]
            own = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, words, zstandard.ZstdCompressor(level=level, dict_data=own)))
        self.longest = max(len(w) for _, w, _ in self.templates)
        self.wanted = [(len(w), frozenset(w), int(tolerance * len(w))) for _, w, _ in self.templates]
        self.anchors = {}
        for _, words, _ in self.templates:
            for k in anchors(words, tolerance):
                self.anchors.setdefault((words[k], words[k + 1]), []).append(k + int(tolerance * len(words)))

    def _wording(self, block: list[str], words: list[str]) -> tuple[list[str], int, int]:
        """Differences of the template's words from the block, and the block's words that the match spans."""
        ops = SequenceMatcher(None, words, block, autojunk=False).get_opcodes()
        same = [o for o in ops if o[0] == "equal"]
        if not same:
            return ["-" + w for w in words], 0, 0
        first, last = same[0][3], same[-1][4]
        wrong = []
        for kind, i, j, a, b in ops:
            if kind in ("replace", "delete"):
                wrong += ["-" + w for w in words[i:j]]
            if kind in ("replace", "insert"):
                wrong += ["+" + w for k, w in enumerate(block[a:b], a) if first <= k < last]
        return wrong, first, last

    def _best(self, spans: list, begin: int, at: int) -> tuple[bool, int, int, dict]:
        """The best template for a block: whether it is not confirmed, the words of its match, its row."""
        ranked = []
        for name, words, with_template in self.templates:
            block = [s[2] for s in spans[begin : at + len(words) + len(words) // 4 + 2]]
            raw = " ".join(block).encode()
            alone, given = len(self.plain.compress(raw)), len(with_template.compress(raw))
            ranked.append((-(alone - given) / alone, name, words, block, alone, given))
        ranked.sort(key=lambda x: x[:2])
        tried = []
        for rank, (saved, name, words, block, alone, given) in enumerate(ranked):
            # a template with more words missing than the tolerance cannot be confirmed
            if rank and (Counter(words) - Counter(block)).total() > self.tolerance * len(words):
                continue
            wrong, first, last = self._wording(block, words)
            row = {"license": name, "bytes_alone": alone, "bytes_given": given, "saved": -saved, "differences": wrong, "n_different": len(wrong), "confirmed": len(wrong) <= self.tolerance * len(words)}
            if not row["confirmed"]:
                first, last = 0, len(block)
            row |= {"start": spans[begin + first][0], "stop": spans[begin + last - 1][1]}
            tried.append((not row["confirmed"], len(wrong) if row["confirmed"] else 0, rank, begin + first, begin + last, row))
        missed, _, _, first, last, row = min(tried, key=lambda x: x[:3])
        return missed, first, last, row

    def _hopeless(self, spans: list, begin: int, at: int) -> bool:
        """Whether every template has more distinct words missing from its block than it may have differences."""
        have, upto = set(), begin
        for n, words, spare in sorted(self.wanted, key=lambda x: x[0]):
            stop = min(at + n + n // 4 + 2, len(spans))
            have.update(s[2] for s in spans[upto:stop])
            upto = max(upto, stop)
            if len(words - have) <= spare:
                return False
        return True

    def scan(self, text: str) -> Iterator[dict]:
        spans = [(m.start(), m.end(), normal(m[0])) for m in re.finditer(r"\S+", text)]
        spans = [s for s in spans if s[2]]
        # places: word, whether a legal term is there, words before it that the block takes
        places, at = [], 0
        for term in (m.start() for m in _TERM.finditer(text)):
            while at < len(spans) and spans[at][1] <= term:
                at += 1
            if at < len(spans):
                places.append((at, 0, LEAD))
        for k, pair in enumerate(zip(spans, spans[1:])):
            places += [(k, 1, lead) for lead in self.anchors.get((pair[0][2], pair[1][2]), ())]
        done, open_places, found = -1, [], []
        for at, anchor, lead in sorted(set(places)):
            if at < done:
                continue
            begin = max(0, done, at - lead)
            hopeless = self._hopeless(spans, begin, at)
            if hopeless and (anchor or (open_places and at < open_places[-1][1] and begin >= done)):
                # nothing to confirm: an anchor's block has no row, and one that overlaps an open block is part of it
                if not anchor:
                    open_places[-1][1] = max(open_places[-1][1], min(at + LEAD, len(spans)))
                continue
            missed, first, last, row = self._best(spans, begin, at)
            if not missed:
                done = last
                found.append((first, last, row))
            elif not anchor:
                if open_places and at < open_places[-1][1]:
                    open_places[-1][1] = max(open_places[-1][1], last)
                else:
                    open_places.append([at, last, row])
        inside = sorted((a, b) for a, b, _ in found)
        rest = []
        for at, last, row in open_places:
            k = bisect(inside, (at, len(spans) + 1)) - 1
            if k < 0 or at >= inside[k][1]:
                # an open block ends where a notice begins
                last = min([last, *(a for a, _ in inside[k + 1 : k + 2])])
                rest.append((at, at, row | {"stop": max(row["start"] + 1, spans[last - 1][1])}))
        yield from (row for *_, row in sorted(found + rest, key=lambda x: x[:2]))


COLUMNS = "doc_id long, license string, start long, stop long, bytes_alone int, bytes_given int, saved double, differences array<string>, n_different int, confirmed boolean"


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each candidate block; ``start`` and ``stop`` are code points of the text."""
    ship(docs.sparkSession)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for pdf in batches:
            rows = [{"doc_id": k["id"]} | row for k, text in zip(pdf["key"], pdf["text"], strict=True) for row in scanner.scan(text)]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    # most texts have no legal term and never leave the JVM
    some = docs.where(F.col(text_col).rlike(places())).select(F.struct(F.col(id_col).cast("long").alias("id")).alias("key"), F.col(text_col).alias("text"))
    return some.mapInPandas(over, COLUMNS)
