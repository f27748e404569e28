"""Operator 6: license texts in documents, by min-hash bands over overlapping windows.

Templates are known license passages. A passage of m words is looked for in every window of m
neighbouring words of a document, and in the shorter ones at its end. Both are sets of 2-word shingles. A band is one min-hash: with 12 bands a
window of similarity s retrieves the template with probability 1 - (1 - s)^12, which is 0.99995 at
s = 0.56, where a passage of eight words has one word changed, and more above. What is retrieved is verified: the share
of the template's distinct shingles that the window holds, counted exactly, must be 0.75 or more.

Licenses of one family differ in a word or a number. So a window must have the deciding words of the
template, such as NonCommercial, Lesser or a version, and no others. Where windows of several templates
cover each other, the best is reported.

Minima over all windows are taken by doubling and shared by templates of different lengths. Retrieved
windows are verified many at a time, so common phrases that retrieve a template in vain cost little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rallybook.llm.text import GOLDEN, LOWER, U, Texts, flat_texts, hash_spans, mix, slices, split_words

# Passages of license notices as they are found in texts, by license. `GPL`, `LGPL`, `AGPL` and `BSD`
# stand for passages that all versions have.
TEMPLATES = (
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this program"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("none", "All rights reserved."),
)
# The Creative Commons licenses by their parts, in each version a long and a short notice.
PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
KINDS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
VERSIONS = {"4.0": "International", "3.0": "Unported"}
for kind in KINDS:
    for version, reach in VERSIONS.items():
        parts = "-".join(PARTS[part] for part in kind.split("-"))
        TEMPLATES += (
            (f"CC-{kind}-{version}", f"This work is licensed under a Creative Commons {parts} {version} {reach} License"),
            (f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}."),
        )
# Words in which licenses of one family differ, besides numbers.
DECIDING = ("lesser", "affero", "organization", "noncommercial", "noderivatives", "sharealike", "nc", "nd", "sa")
# Numbers of which a notice may lack the last one, as `Version 2` for `Version 2.0`.
OPTIONAL = ("0",)
BANDS = 12
PERCENT = 75
SLOTS = 1 << 16
BATCH_BYTES = 4 << 20

BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
FACTORS = np.random.default_rng(6).integers(0, 1 << 32, (2, BANDS), dtype=np.uint64).astype(np.uint32)
FACTORS[0] |= np.uint32(1)


def worded(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of every word, which of them decide, and where each text's words begin."""
    buf = LOWER[texts.buf]
    words = split_words(Texts(buf, texts.start), BREAKS)
    h = hash_spans(buf, words.start, words.end)
    # All of a word's bytes are digits if as many digits lie before its end as before its start and its length.
    digits = np.concatenate([[0], np.cumsum((buf >= 48) & (buf <= 57))])
    numbers = digits[words.end] - digits[words.start] == words.end - words.start
    return h, numbers | np.isin(h, hashes_of(DECIDING)), words.of


def hashes_of(words: tuple[str, ...]) -> np.ndarray:
    texts = flat_texts(pa.array(list(words)))
    return hash_spans(texts.buf, texts.start[:-1], texts.start[1:])


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of every two neighbouring words, across texts too."""
    return mix(words[:-1] * GOLDEN + words[1:])


def window_minima(hashed: np.ndarray, widths: list[int]) -> dict[int, np.ndarray]:
    """The minimum of every window, for each of the widths."""
    out, reach, least = {}, 1, hashed
    for width in sorted(widths):
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:]) if len(least) > reach else least[:0]
            reach *= 2
        rest = width - reach
        out[width] = np.minimum(least[: len(least) - rest], least[rest:]) if len(least) > rest else least[:0]
    return out


class Matcher:
    """Templates by the width of their windows. For each width and band a small table says where the
    low bits of the templates' min-hashes are."""

    def __init__(self, templates):
        self.names = [name for name, _ in templates]
        words, decides, of = worded(flat_texts(pa.array([t for _, t in templates])))
        self.widths = (np.diff(of) - 1).tolist()
        if min(self.widths, default=1) < 1:
            raise ValueError("a template needs two words at least")
        spans = [slice(a, a + w + 1) for a, w in zip(of[:-1].tolist(), self.widths)]
        own = [shingles(words[x]) for x in spans]
        self.sets = [np.unique(g) for g in own]
        self.allowed = [np.unique(words[x][decides[x]]) for x in spans]
        self.needed = [np.setdiff1d(a, hashes_of(OPTIONAL)) for a in self.allowed]
        self.shingles, self.words = np.unique(np.concatenate(self.sets)), np.unique(np.concatenate(self.allowed))
        self.slots = {w: [np.zeros(SLOTS, bool) for _ in range(BANDS)] for w in self.widths}
        for g, width in zip(own, self.widths):
            for band in range(BANDS):
                least = self.hashed(g, band).min()
                self.slots[width][band][int(least) % SLOTS] = True

    @staticmethod
    def hashed(grams: np.ndarray, band: int) -> np.ndarray:
        return (grams >> U(32)).astype(np.uint32) * FACTORS[0, band] + FACTORS[1, band]

    @staticmethod
    def places(values: np.ndarray, wanted: np.ndarray) -> dict[int, np.ndarray]:
        """Where each wanted value occurs, in order."""
        slots = np.zeros(SLOTS, bool)
        slots[(wanted % U(SLOTS)).astype(np.int64)] = True
        at = np.flatnonzero(slots[values.astype(np.uint16)])
        which = np.minimum(np.searchsorted(wanted, values[at]), max(len(wanted) - 1, 0))
        known = wanted[which] == values[at] if len(wanted) else np.zeros(len(at), bool)
        at, which = at[known], which[known]
        order = np.argsort(which, kind="stable")
        found, start = np.unique(which[order], return_index=True)
        return {int(wanted[w]): x for w, x in zip(found, np.split(at[order], start[1:]))}

    def retrieved(self, grams: np.ndarray, real: np.ndarray) -> dict[int, np.ndarray]:
        """Per width the windows that share a band with a template of that width, or seem to."""
        found: dict[int, list[np.ndarray]] = {w: [] for w in self.slots}
        for band in range(BANDS):
            # Between texts there is nothing that could be the least.
            hashed = np.where(real, self.hashed(grams, band), np.uint32(0xFFFFFFFF))
            for width, least in window_minima(hashed, list(self.slots)).items():
                found[width].append(np.flatnonzero(self.slots[width][band][least.astype(np.uint16)]))
        return {w: np.unique(np.concatenate(x)) for w, x in found.items()}

    def matches(self, texts: Texts) -> list[tuple[int, int, int, float]]:
        """(text, first word, template, containment) of every window that holds a template; of
        windows that cover each other's middle the best and first."""
        words, decides, of = worded(texts)
        # Room after each text, so that the windows at its end are there too and end with it.
        room = max(self.widths) + 1
        counts = np.diff(of)
        begin = of[:-1] + room * np.arange(len(counts))
        place = np.arange(len(words)) + room * np.repeat(np.arange(len(counts)), counts)
        size = len(words) + room * len(counts)
        spaced, is_word, deciding = np.zeros(size, U), np.zeros(size, bool), np.zeros(size, bool)
        spaced[place], is_word[place], deciding[place] = words, True, decides
        grams, real = shingles(spaced), is_word[:-1] & is_word[1:]
        grams = np.where(real, grams, U(0))
        deciders = np.concatenate([[0], np.cumsum(deciding)])
        shingle_at, word_at, nowhere = self.places(grams, self.shingles), self.places(spaced, self.words), np.zeros(0, np.int64)
        hits: dict[int, list[tuple[float, int, int, int]]] = {}
        for width, at in self.retrieved(grams, real).items():
            at = at[real[at]]
            for t in [i for i, w in enumerate(self.widths) if w == width]:
                # Distinct shingles of the template in each window, from where each of them occurs.
                held = np.zeros(len(at), np.int32)
                for shingle in self.sets[t]:
                    places = shingle_at.get(int(shingle), nowhere)
                    held += np.searchsorted(places, at + width) > np.searchsorted(places, at)
                hit = np.flatnonzero(100 * held >= PERCENT * len(self.sets[t]))
                start, end = at[hit], np.minimum(at[hit] + width + 1, size)
                # As many deciding words as there are allowed ones, and every needed one.
                fits, allowed = np.ones(len(hit), bool), np.zeros(len(hit), np.int64)
                for word in self.allowed[t]:
                    places = word_at.get(int(word), nowhere)
                    n = np.searchsorted(places, end) - np.searchsorted(places, start)
                    allowed += n
                    fits &= (n > 0) | (word not in self.needed[t])
                fits &= allowed == deciders[end] - deciders[start]
                for i, first in zip(hit[fits].tolist(), start[fits].tolist()):
                    doc = int(np.searchsorted(begin, first, side="right") - 1)
                    hits.setdefault(doc, []).append((float(held[i] / len(self.sets[t])), width, int(first - begin[doc]), t))
        out = []
        for doc, found in hits.items():
            taken: list[tuple[int, int]] = []
            for share, width, word, t in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[3])):
                if all(abs(2 * word + width - 2 * x - w) > max(width, w) for x, w in taken):
                    taken.append((word, width))
                    out.append((doc, word, t, share))
        return sorted(out)


def license_matches(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """`doc_id` and `matches`, an array of (license, word, containment), for every row of `docs`.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; `word` is
    the place of the first. Null or empty texts have no matches, repeated rows and null ids get an answer each,
    an empty table gives an empty result. Other columns are not looked at. A passage that the text breaks off, or that
    is all of it, counts if enough of it is there. The templates travel with the code, so there should be
    thousands of them at most; the given ones are notices, not whole license texts.
    """
    templates = tuple(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates)
        for batch in slices(batches, "text", BATCH_BYTES):
            rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for doc, at, t, held in matcher.matches(flat_texts(batch.column("text"))):
                rows[doc].append({"license": matcher.names[t], "word": at, "containment": held})
            kind = pa.list_(pa.struct([("license", pa.string()), ("word", pa.int64()), ("containment", pa.float64())]))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "matches": pa.array(rows, kind)})

    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, matches array<struct<license: string, word: long, containment: double>>"
    return narrow.mapInArrow(scan, schema)
