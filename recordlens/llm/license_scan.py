"""License texts in documents, by patience alignment with templates."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import reach_package

_WORD = re.compile(r"[^\W_]+")

# License lines and notices as authors paste them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "BSD-3-Clause condition": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "CC0 notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "ISC notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Reserved": "All rights reserved.",
    "Unlicense notice": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."
    ),
}


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (sorted by the first) whose second values increase, by piles."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back[k] = ends[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(j)
            ends.append(k)
        else:
            tops[pile], ends[pile] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of equal words ``(i in a, j in b)``, both increasing.

    Equal words at both ends are taken off. Words that stand once in what is left of
    each side are anchors; the longest increasing sequence of them is kept and the gaps
    between are aligned in the same way. A gap without such a word is aligned only at
    its ends.
    """
    found: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, n, j, m = work.pop()
        while i < n and j < m and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            found.append((n, m))
        if i >= n or j >= m:
            continue
        in_a, in_b = Counter(a[i:n]), Counter(b[j:m])
        place = {b[k]: k for k in range(j, m) if in_b[b[k]] == 1}
        pairs = [(k, place[a[k]]) for k in range(i, n) if in_a[a[k]] == 1 and a[k] in place]
        low_i, low_j = i, j
        for p, q in _increasing(pairs):
            found.append((p, q))
            work.append((low_i, p, low_j, q))
            low_i, low_j = p + 1, q + 1
        if pairs:
            work.append((low_i, n, low_j, m))
    return sorted(found)


class Template:
    """A template's words and those of them that any good match must hold."""

    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.words, self.coverage = name, split_words(text), coverage
        m = len(self.words)
        self.slack = 2 + math.ceil(0.25 * m)
        # a match leaves out at most m - ceil(coverage * m) words: one more than that cannot all be left out
        spare = m - math.ceil(coverage * m) + 1
        longest = sorted(range(m), key=lambda k: (-len(self.words[k]), k))[:spare]
        self.needed: dict[str, list[int]] = {}
        for k in longest:
            self.needed.setdefault(self.words[k], []).append(k)

    def scan(self, text: list[str], at: dict[str, list[int]]) -> list[tuple[float, int, int, int]]:
        """``coverage, matched, first, last`` of the matches, best of each overlapping set of places.

        A place is aligned as it stands first, then, unless that is whole, with slack around it: among
        copies in a row no word of the wider window is unique.
        """
        m = len(self.words)
        wanted = sorted({(p - k) for w, ks in self.needed.items() for p in at.get(w, ()) for k in ks})
        out: list[tuple[float, int, int, int]] = []
        for start in wanted:
            low = max(0, start)
            pairs = align(text[low : max(0, start + m)], self.words)
            if len(pairs) < m:
                wide = max(0, start - self.slack)
                more = align(text[wide : max(0, start + m + self.slack)], self.words)
                if len(more) > len(pairs):
                    low, pairs = wide, more
            if len(pairs) >= self.coverage * m:
                row = (len(pairs) / m, len(pairs), low + pairs[0][0], low + pairs[-1][0])
                if out and row[2] <= out[-1][3]:
                    out[-1] = max(out[-1], row, key=lambda r: (r[1], r[2] - r[3]))
                else:
                    out.append(row)
        return out


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, license, coverage, n_matched, n_places, first_word, last_word`` of texts that hold a template.

    ``coverage`` is the share of the template's words that the alignment finds in
    order, near each other; the best place of a document is given and the number of
    places. Words are runs of letters and digits, in lower case. A text that holds the words
    of two templates gives a row for each (a share-alike notice holds all words of the plain
    one); the row with more matched words is the nearer. Among places of equal coverage the
    first counts. A very long text costs memory for its words, and time for its places only.

    Null and empty texts hold nothing; null ids stay null; repeated rows are scanned one
    by one; an empty table gives no rows; other columns are ignored. Texts are scanned
    whole, where they lie: no shuffle.
    """
    reach_package(docs.sparkSession)
    given = templates or TEMPLATES

    def run(batches):
        made = [Template(n, t, coverage) for n, t in sorted(given.items())]
        every = {w for t in made for w in t.needed}
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                small = (text or "").lower()
                here = {w for w in every if w in small}
                if not here:
                    continue
                words = _WORD.findall(small)
                at: dict[str, list[int]] = {}
                for p, w in enumerate(words):
                    if w in here:
                        at.setdefault(w, []).append(p)
                for t in made:
                    if at.keys() & t.needed.keys() and (places := t.scan(words, at)):
                        best = max(places, key=lambda r: (r[0], -r[2]))
                        rows.append((i, t.name, best[0], best[1], len(places), best[2], best[3]))
            kinds = [pa.int64(), pa.string(), pa.float64()] + [pa.int64()] * 4
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            names = ["doc_id", "license", "coverage", "n_matched", "n_places", "first_word", "last_word"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = (
        "doc_id long, license string, coverage double, n_matched long, n_places long, first_word long, last_word long"
    )
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)
