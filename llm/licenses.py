"""Licence texts and notices in documents: MinHash bands over overlapping windows, then exact shingle containment.

A template is found where most of its shingles stand in a stretch of a document. Windows come in sizes of powers of two, two blocks of
shingles each, overlapping by a block; a template belongs to the size whose blocks just hold it, so it always lies inside one
window. The similarity of that window and the template is then at least `floor_similarity(contained)`, and the number of bands is chosen so that
a window of that similarity shares a band with the template with the wanted probability.
A block's MinHash values are the minima of its two halves, so all sizes cost one pass.

Retrieved windows are verified exactly: the share of the template's shingles in the stretch around them. A template of fewer words than a
shingle has is one whole run of words, looked for word by word at every place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T

U64 = np.uint64
#: Bytes of all templates together, at most: they are sent to every task.
TEMPLATE_BOUND = 16 << 20

#: Fixed texts: wording of published licences and of their usual notices.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "bsd-no-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express '
        "or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "rights-notice": "All rights reserved.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def floor_similarity(contained: float) -> float:
    """Least similarity of a template and the window around it.

    A template of n shingles belongs to blocks of less than 2 n, windows of less than 4 n; of the template, `contained` is there.
    """
    return contained / (4 + 1 - contained)


def bands_for(similarity: float, probability: float) -> int:
    """Bands of one MinHash value, so that a pair of that similarity shares one with that probability."""
    return math.ceil(math.log(1 - probability) / math.log1p(-similarity))


def plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words in order, without case and punctuation, and where each text's begin."""
    raw, bounds = T.buffers(column)
    raw = T.plained(raw)
    starts, ends, first = T.words(raw, bounds)
    return T.span_hashes(raw, starts, ends), first


class Templates:
    def __init__(self, texts: dict[str, str], contained: float, probability: float):
        if sum(len(x.encode()) for x in texts.values()) > TEMPLATE_BOUND:
            raise ValueError(f"templates of more than {TEMPLATE_BOUND} bytes; scan with parts of them")
        words, first = plain_words(pa.array(list(texts.values()), pa.string()))
        count = np.diff(first)
        if not count.all():
            raise ValueError("a template without words")
        names = np.array(list(texts), dtype=object)
        self.short = [(names[t], words[first[t] : first[t + 1]]) for t in np.flatnonzero(count < T.WORDS)]
        whole = count >= T.WORDS
        words, first = words[np.repeat(whole, count)], np.concatenate([[0], np.cumsum(count[whole])])
        shingles, begin = T.shingles(words, first)
        self.names, self.contained = names[whole].tolist(), contained
        self.sets = [np.unique(shingles[a:b]) for a, b in zip(begin[:-1], begin[1:])]
        self.lengths = np.diff(begin)
        self.level = np.ceil(np.log2(np.maximum(1, self.lengths))).astype(int)
        count = bands_for(floor_similarity(contained), probability)
        self.multipliers = T.mix(np.arange(1, count + 1, dtype=U64)) | U64(1)
        self.keys: dict[tuple[int, int], dict[int, list[int]]] = {}
        for t, members in enumerate(self.sets):
            for k, m in enumerate(self.multipliers):
                value = int((members * m + (m >> U64(7))).min())
                self.keys.setdefault((int(self.level[t]), k), {}).setdefault(value, []).append(t)
        self.tables = {}
        for key, known in self.keys.items():
            values = np.array(sorted(known), dtype=U64)
            table = np.zeros(1 << 12, dtype=bool)
            table[values & U64(0xFFF)] = True
            self.tables[key] = (table, values)

    def retrieved(self, shingles: np.ndarray, begin: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, first shingle of the window in it, template)."""
        if not self.names:
            return set()
        top = int(self.level.max())
        plan, at = [], begin  # for each level: where its blocks begin among the level below, where each text's begin
        for _ in range(top):
            n = -(-np.diff(at) // 2)
            up = np.concatenate([[0], np.cumsum(n)])
            owner = np.repeat(np.arange(len(n)), n)
            plan.append((at[owner] + 2 * (np.arange(up[-1]) - up[owner]), up))
            at = up
        found = set()
        for k, m in enumerate(self.multipliers):
            low, at = shingles * m + (m >> U64(7)), begin
            for level in range(top + 1):
                if level:
                    cuts, at = plan[level - 1]
                    low = np.minimum.reduceat(low, cuts) if len(cuts) else low[:0]
                if (level, k) not in self.tables or not len(low):
                    continue
                window = low.copy()
                inner = np.ones(len(low), dtype=bool)
                inner[at[1:][np.diff(at) > 0] - 1] = False
                inner[-1] = False
                place = np.flatnonzero(inner)
                window[place] = np.minimum(low[place], low[place + 1])
                table, values = self.tables[level, k]
                maybe = np.flatnonzero(table[(window & U64(0xFFF)).astype(np.int64)])
                maybe = maybe[np.isin(window[maybe], values)]
                text = np.searchsorted(at, maybe, side="right") - 1
                for x, w, value in zip(text.tolist(), maybe.tolist(), window[maybe].tolist()):
                    for t in self.keys[level, k][value]:
                        found.add((x, (w - int(at[x])) << level, t))
        return found

    def runs(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[str, int, int, int]]:
        """(name, text, first word, places) of each short template in each text that holds it whole."""
        for name, run in self.short:
            at = np.flatnonzero(words[: max(0, len(words) - len(run) + 1)] == run[0])
            for k in range(1, len(run)):
                at = at[words[at + k] == run[k]]
            text = np.searchsorted(first, at, side="right") - 1
            inside = at + len(run) <= first[text + 1]
            holders, begin, places = np.unique(text[inside], return_index=True, return_counts=True)
            for x, place, n in zip(holders.tolist(), at[inside][begin].tolist(), places.tolist()):
                yield name, x, place - int(first[x]), n

    def share(self, shingles: np.ndarray, template: int) -> float:
        return len(np.intersect1d(np.unique(shingles), self.sets[template], assume_unique=True)) / len(self.sets[template])


def _scan(templates):
    schema = pa.schema([("doc_id", pa.int64()), ("template", pa.string()), ("contained", pa.float64()), ("first_word", pa.int64()), ("windows", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = templates.value
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                words, first = plain_words(piece.column("text"))
                shingles, begin = T.shingles(words, first)
                ids, best = piece.column("doc_id").to_pylist(), {}
                for text, at, template in sorted(known.retrieved(shingles, begin)):
                    size = 1 << int(known.level[template])
                    low, high = int(begin[text]) + max(0, at - size), min(int(begin[text + 1]), int(begin[text]) + at + 3 * size)
                    share = known.share(shingles[low:high], template)
                    if share >= known.contained:
                        old = best.get((text, template), (0.0, 0, 0))
                        here = int(np.flatnonzero(np.isin(shingles[low:high], known.sets[template]))[0]) + low - int(begin[text])
                        best[text, template] = (share, here, old[2] + 1) if share > old[0] else (old[0], old[1], old[2] + 1)
                rows = [(ids[text], known.names[t], *rest) for (text, t), rest in best.items()]
                rows += [(ids[text], name, 1.0, place, places) for name, text, place, places in known.runs(words, first)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES, contained: float = 0.8, probability: float = 0.999) -> DataFrame:
    """(doc_id, template, contained, first_word, windows): each template found in a document, its best place and the number of windows that hold it.

    A template is found where at least `contained` of its five-word shingles stand together, with the given probability or more. One of fewer than five
    words is found wherever it stands whole, and `windows` counts its places; one without a word is refused. Null
    and empty texts hold none. Every row is read by itself: repeated rows give repeated results, a null id stays null. Without templates, or
    on an empty table, the result is empty. Only the two named columns are read.
    """
    spark = docs.sparkSession
    schema = "doc_id long, template string, contained double, first_word long, windows long"
    if not templates:
        return spark.createDataFrame([], schema)
    known = spark.sparkContext.broadcast(Templates(templates, contained, probability))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan(known), schema)
