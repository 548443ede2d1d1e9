"""Licence notices in texts: word bigrams compared to templates by Dice coefficient."""

from __future__ import annotations

import pathlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrays import flat_text, shingle_hashes, text_batches

THRESHOLD = 0.8

#: Wordings of public licences and of the notices that name them.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_WORD = re.compile("[a-z0-9]+")
_BETWEEN_PARAGRAPHS = re.compile("\n[ \t\r]*\n")
#: Bytes of lower-cased text as they count for words: all but a-z and 0-9 are spaces.
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[[*range(48, 58), *range(97, 123)]] = [*range(48, 58), *range(97, 123)]
#: Bits of a bigram's hash by which most bigrams of a text are known to be in no template.
_SIEVE_BITS = 20


def full_texts() -> list[tuple[str, str]]:
    """Name and whole text of the licences kept beside this file, and of the notices (name_notice) that some of them ask for."""
    return [(path.stem.split("_")[0], path.read_text("utf-8")) for path in sorted((pathlib.Path(__file__).parent / "licence_texts").glob("*.txt"))]


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of all word bigrams of lower-cased texts."""
    data, offsets = flat_text(texts)
    return shingle_hashes(_PLAIN[data], offsets, 2)


class _Scanner:
    """Templates, indexed by the hashes of their bigrams."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold, self.names = threshold, [name for name, _ in templates]
        words = [_WORD.findall(text.lower()) for _, text in templates]
        self.pairs = [frozenset(zip(w, w[1:])) for w in words]
        self.sizes = np.array([len(p) for p in self.pairs])
        # c of n and m in common reach threshold t only if c >= m * t / (2 - t) and n <= m * (2 - t) / t.
        self.least = self.sizes * threshold / (2 - threshold) - 1e-9
        found, owner = _hashes(pa.array([" ".join(w) for w in words]))
        both = np.unique(np.stack([found, owner.astype(np.uint64)]), axis=1)
        self.hashes, self.owners = both[0], both[1].astype(np.int64)
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.hashes >> np.uint64(64 - _SIEVE_BITS)] = True

    def likely(self, texts: pa.Array) -> list[np.ndarray]:
        """For each text, the templates of which it holds enough bigrams somewhere."""
        found, owner = _hashes(texts)
        maybe = self.sieve[found >> np.uint64(64 - _SIEVE_BITS)]
        both = np.unique(np.stack([found[maybe], owner[maybe].astype(np.uint64)]), axis=1)
        first, last = np.searchsorted(self.hashes, both[0]), np.searchsorted(self.hashes, both[0], "right")
        times = last - first
        at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        n = len(self.names)
        counts = np.bincount(np.repeat(both[1].astype(np.int64), times) * n + self.owners[at], minlength=len(texts) * n).reshape(len(texts), n)
        return [np.flatnonzero(row) for row in (counts >= self.least) & (counts > 0)]

    def notices(self, text: str, templates: np.ndarray) -> list[tuple[int, str, float]]:
        """Segment, licence and Dice coefficient of the notices in one lower-cased text that only ``templates`` may match."""
        spans = [m.span() for m in _WORD.finditer(text)]
        words = [text[a:b] for a, b in spans]
        numbers: dict[tuple[str, str], int] = {}
        ids = np.array([numbers.setdefault(p, len(numbers)) for p in zip(words, words[1:])], np.int64)
        hits = np.array([[p in self.pairs[t] for p in numbers] for t in templates.tolist()])
        order = sorted(range(len(templates)), key=lambda i: (self.names[templates[i]], templates[i]))
        templates, hits = templates[order], hits[order]  # of equal scores the first counts
        sizes, starts = self.sizes[templates], np.array([a for a, _ in spans])
        upto = np.concatenate([[0], np.cumsum(hits.any(axis=0)[ids])])
        out, left = [], np.ones(len(ids), bool)
        segments = list(_segments(text))
        for number, (a, b) in enumerate(segments):
            a, b = np.searchsorted(starts, [a, b]).tolist()
            if b - a < 2 or upto[b - 1] - upto[a] < self.least[templates].min():
                continue
            held = np.unique(ids[a: b - 1])
            dice = 2 * hits[:, held].sum(axis=1) / (len(held) + sizes)
            if dice.max() >= self.threshold:
                out.append((number, self.names[templates[dice.argmax()]], float(dice.max())))
                left[max(0, a - 1): b] = False
        place, passages = np.flatnonzero(left), []
        while found := self._round(ids[place], hits, sizes):
            gone = np.zeros(len(place), bool)
            for score, which, a, b in sorted(found, key=lambda x: (-x[0], x[1:])):
                if not gone[a: b + 1].any():
                    passages.append((int(place[a]), self.names[templates[which]], score))
                    gone |= (place >= place[a] - 1) & (place <= place[a]) | (place >= place[b]) & (place <= place[b] + 1)
                    gone[a: b + 1] = True
            place = place[~gone]
        return out + [(len(segments) + i, name, score) for i, (_, name, score) in enumerate(sorted(passages))]

    def _round(self, ids: np.ndarray, hits: np.ndarray, sizes: np.ndarray) -> list[tuple[float, int, int, int]]:
        """Score, template, first and last bigram of the best passage from every start that can be that of a best one.

        A passage becomes no worse when it takes in a bigram of the template
        before it, so it starts where none precedes.
        """
        n = len(ids)
        order = np.argsort(ids, kind="stable")
        again = np.flatnonzero(ids[order][1:] == ids[order][:-1])
        before = np.full(n, -1)
        before[order[again + 1]] = order[again]
        found = []
        for which, m in enumerate(sizes.tolist()):
            hit = hits[which][ids]
            most = m * (2 - self.threshold) / self.threshold
            for a in np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]])).tolist() if n else []:
                size = 2 * int(most) + 16
                while True:
                    new = before[a: a + size] < a
                    distinct = np.cumsum(new)
                    if a + size >= n or distinct[-1] > most:
                        break
                    size *= 2
                dice = 2 * np.cumsum(new & hit[a: a + size]) / (distinct + m)
                end = int(dice.argmax())
                if dice[end] >= self.threshold:
                    found.append((float(dice[end]), which, a, a + end))
        return found


def _segments(text: str):
    """Start and end of all lines, then of all paragraphs of several lines."""
    at = 0
    for line in text.split("\n"):
        yield at, at + len(line)
        at += len(line) + 1
    at = 0
    for start, end in [m.span() for m in _BETWEEN_PARAGRAPHS.finditer(text)] + [(len(text), len(text))]:
        if "\n" in text[at:start]:
            yield at, start
        at = end


_NOTICES = "notices array<struct<segment: int, licence: string, dice: double>>"


def _scanned(docs: DataFrame, templates: list[tuple[str, str]] | None, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_Scanner(TEMPLATES + full_texts() if templates is None else templates, threshold))
    kind = pa.list_(pa.struct([("segment", pa.int32()), ("licence", pa.string()), ("dice", pa.float64())]))

    def run(batches):
        for batch in text_batches(batches, "lowered"):
            texts = batch.column("lowered")
            found = [shared.value.notices(texts[i].as_py(), which) if len(which) else [] for i, which in enumerate(shared.value.likely(texts))]
            notices = pa.array([[dict(zip(("segment", "licence", "dice"), x)) for x in held] for held in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), notices], names=["doc_id", "text_hash", "notices"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                       F.lower(F.col("text")).alias("lowered")).mapInArrow(run, f"doc_id long, text_hash long, {_NOTICES}")


def licence_notices(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, segment, licence and dice of every notice; ``templates`` are TEMPLATES and the full texts if not given.

    First, every line and every paragraph of several lines that a template
    matches best with ``threshold`` or more is a notice. Of the words outside
    these, the passages of any length that a template matches with ``threshold``
    or more are notices, the best first, none with words of another; they run on
    over line ends and over what was found before. Segments number the lines,
    the paragraphs, then the passages, from 0. Of equal scores the first licence
    by name counts. Null text has no segments.

    Only texts that hold enough bigrams of some template are looked into; the
    others are told from them by hashes of their bigrams, batch by batch.
    """
    return _scanned(docs, templates, threshold).select("doc_id", "text_hash", F.inline("notices"))


def scan_licences(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_notices, licences (array of distinct names, sorted) and best (highest Dice coefficient) of every row.

    Rows without a notice, null texts among them, have 0, an empty array and
    null. Repeated rows are scanned alike.
    """
    found = _scanned(docs, templates, threshold)
    return found.select("doc_id", F.size("notices").cast("long").alias("n_notices"),
                        F.array_sort(F.array_distinct("notices.licence")).alias("licences"), F.array_max("notices.dice").alias("best"))
