"""License scans: the Dice coefficient of word bigrams against licence notices and whole licence texts.

Notices and texts are looked for in lines, in sentences and in windows of words that may go on
over line breaks, so a licence is found where it is wrapped or stands inside a longer text.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, text_slices
from .toxicity import tokens

THRESHOLD = 0.8
MAX_TEMPLATES = 5000
LONG = 60  # bigrams; windows for shorter templates are no shorter than the template, as one word may decide there
MAX_CELLS = 1 << 18

# The notices as licensors publish them, and below the whole texts and file headers.
_NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
}
_FILES = {
    "Apache-2.0": ("Apache-2.0", "Apache-2.0-header"),
    "GPL-3.0": ("GPL-3.0", "GPL-3.0-header"),
    "GPL-2.0": ("GPL-2.0", "GPL-2.0-header"),
    "MPL-2.0": ("MPL-2.0", "MPL-2.0-header"),
    "CC-BY-4.0": ("CC-BY-4.0",),
    "CC-BY-SA-4.0": ("CC-BY-SA-4.0",),
    "CC-BY-NC-4.0": ("CC-BY-NC-4.0",),
    "CC0-1.0": ("CC0-1.0",),
    "MIT": ("MIT",),
    "BSD-3-Clause": ("BSD-3-Clause",),
    "BSD-2-Clause": ("BSD-2-Clause",),
}


def _text(file: str) -> str:
    return pkgutil.get_data(__package__, f"license_texts/{file}.txt").decode()


TEMPLATES: dict[str, tuple[str, ...]] = {n: t + tuple(map(_text, _FILES.get(n, ()))) for n, t in _NOTICES.items()}


class Notices:
    """Templates as bigram sets, by size, with the templates that hold each bigram."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], threshold: float):
        self.names = sorted(templates)
        texts = [(self.names.index(n), t) for n in self.names for t in templates[n]]
        if len(texts) > MAX_TEMPLATES:
            raise ValueError(f"{len(texts)} templates; a broadcast takes at most {MAX_TEMPLATES}")
        self.threshold = threshold
        self.name_of = np.array([n for n, _ in texts], np.int64)
        words = [tokens(Texts(pa.array([t])))[0] for _, t in texts]
        self.sets = [_bigrams(w, np.zeros(0)) for w in words]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        flat = np.concatenate([*self.sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(self.sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]
        self.seen = np.zeros(1 << 20, bool)  # by a bigram's first 20 bits
        self.seen[self.flat >> np.uint64(44)] = True
        # sizes a segment can have at the threshold: Dice <= 2 min / (a + b)
        self.least = np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9)
        self.most = np.floor(self.sizes * (2 - threshold) / threshold + 1e-9)
        # window lengths, in bigrams with repeats
        length = np.array([len(w) - 1 for w in words], np.int64)
        self.shortest = np.where(self.sizes < LONG, length, self.least).astype(np.int64)
        self.longest = np.floor(length * (2 - threshold) / threshold + 1e-9).astype(np.int64)

    def shared(self, segment: np.ndarray) -> np.ndarray:
        """How many of the segment's distinct bigrams each template holds."""
        lo, hi = np.searchsorted(self.flat, segment), np.searchsorted(self.flat, segment, "right")
        each = np.arange(int((hi - lo).sum())) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
        return np.bincount(self.owner[each], minlength=len(self.sizes))

    def best(self, segment: np.ndarray) -> tuple[float, int] | None:
        """(Dice, template) of the closest template within the size bounds; of equals the first licence by name."""
        fits = (self.least <= len(segment)) & (len(segment) <= self.most)
        if not fits.any():
            return None
        dice = np.where(fits, 2 * self.shared(segment) / (self.sizes + len(segment)), 0.0)
        at = int(dice.argmax())
        return (float(dice[at]), at) if dice[at] >= self.threshold else None

    def windows(self, grams: np.ndarray, before: np.ndarray, taken: np.ndarray, t: int) -> Iterator[tuple[float, int, int, int]]:
        """(Dice, template, first word, end) of template ``t``'s closest window from each start.

        ``grams`` are a text's bigrams in order, ``before`` the place where each stood last, and
        ``taken`` marks words that no window may hold. Windows start where enough bigrams are shared ahead.
        """
        n, shortest = len(grams), max(1, int(self.shortest[t]))
        longest = min(int(self.longest[t]), n)
        if longest < shortest:
            return
        free = ~(taken[:-1] | taken[1:])
        own = self.sets[t]
        hit = free & (own[np.searchsorted(own, grams).clip(max=len(own) - 1)] == grams)
        stop = np.where(free, n, np.arange(n))
        stop = np.minimum.accumulate(stop[::-1])[::-1]  # the next bigram that is not free
        starts = np.flatnonzero(free if self.sizes[t] < LONG else hit)  # long windows may shrink to a shared bigram
        ahead = np.minimum(starts + longest, stop[starts])
        hits = np.concatenate([[0], np.cumsum(hit)])
        starts = starts[(hits[ahead] - hits[starts] >= self.least[t]) & (ahead - starts >= shortest)]
        step = max(1, MAX_CELLS // longest)
        for lo in range(0, len(starts), step):
            first = starts[lo : lo + step, None]
            place = first + np.arange(longest)
            inside = place < stop[first]
            place = np.minimum(place, n - 1)
            new = inside & (before[place] < first)
            size, shared = np.cumsum(new, axis=1, dtype=np.int32), np.cumsum(new & hit[place], axis=1, dtype=np.int32)
            dice = 2 * shared / (self.sizes[t] + size)
            dice[~inside] = 0
            dice[:, : shortest - 1] = 0
            at = dice.argmax(axis=1)
            value = dice[np.arange(len(at)), at]
            for k in np.flatnonzero(value >= self.threshold).tolist():
                start = int(first[k, 0])
                yield float(value[k]), t, start, start + int(at[k]) + 2

    def places(self, hashes: np.ndarray, grams: np.ndarray, segments: list[tuple[int, int]], possible: list[int]) -> list[tuple[float, int]]:
        """(Dice, licence) of the places of a text that match, none with a word of another.

        Of places that overlap, the one with the largest template size x Dice^2 / (2 - Dice) stays;
        that is Dice x shared bigrams if the place holds no others.
        """
        found = []
        for lo, hi in segments:
            match = self.best(_bigrams(hashes[lo:hi], hashes))
            if match:
                found.append((*match, lo, hi))
        order = np.argsort(grams, kind="stable")
        before = np.full(len(grams), -1, np.int64)
        same = grams[order[1:]] == grams[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        taken, out = np.zeros(len(hashes), bool), []
        while True:
            if len(grams):
                found += [w for t in possible for w in self.windows(grams, before, taken, t)]
            kept = len(out)
            for dice, t, lo, hi in sorted(found, key=lambda w: (-self.sizes[w[1]] * w[0] ** 2 / (2 - w[0]), w[2], w[3], w[1])):
                if not taken[lo:hi].any():
                    taken[lo:hi] = True
                    out.append((dice, int(self.name_of[t])))
            if len(out) == kept:
                return out
            found = []


def _bigrams(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Distinct word bigrams of one text; a single word is a bigram with itself."""
    if len(hashes) == 1:
        return hashes.copy()
    with np.errstate(over="ignore"):
        return np.unique(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


def scan_licenses(
    df: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, license, dice, n_notices, licenses) of every row.

    A text's segments are its lines, its sentences, the whole text, and for every template the
    windows of words, across line breaks, that stand where bigrams are shared and are at most
    (2 - threshold) / threshold times as long as the template. All are normalised to lower-case
    words. A segment matches a template when the Dice coefficient of their sets of word bigrams is
    at least ``threshold``; size bounds first drop templates that cannot reach it. For templates
    below ``LONG`` bigrams a window is no shorter than the template. Of matches that overlap the
    one that explains most counts, so a file header inside its licence's text is no second place.

    ``license`` is the best match (ties: first by name), ``n_notices`` the number of places that
    match, ``licenses`` all licences found, sorted. Without a match, and for null and empty texts,
    ``license`` and ``dice`` are null and the rest is 0 and empty. A licence without a template
    of its own that hardly differs from one counts as that one. Rows are scanned one by one.
    """
    held = df.sparkSession.sparkContext.broadcast(Notices(templates, threshold))  # at most MAX_TEMPLATES notices
    names = ["id", "license", "dice", "n_notices", "licenses"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices = held.value
        for batch, texts in text_slices(batches):
            found = [_scan(notices, places) for places in _places(texts, notices)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.list_(pa.string())),
                ],
                names=names,
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, license string, dice double, n_notices long, licenses array<string>")
    return out.withColumnRenamed("id", id_col)


_ENDS = np.zeros(256, bool)
_ENDS[[ord(x) for x in ".!?;:"]] = True


def _places(texts: Texts, notices: Notices) -> Iterator[list[tuple[float, int]]]:
    """Per text its matching places.

    Bigrams are hashed for all texts at once. A template is looked for only in texts with as many
    of its distinct bigrams as a match needs, and lines and sentences only where one of those stands.
    """
    data, bounds = texts.data, texts.bounds
    hashes, at = tokens(texts)
    with np.errstate(over="ignore"):
        pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] if len(hashes) > 1 else np.zeros(0, np.uint64)
    possible = _possible(hashes, pairs, at, notices)
    if possible:
        starts = _starts(data, bounds)
        line = np.cumsum(data == 10, dtype=np.int64)
        blank = np.zeros(len(data), bool)
        blank[:-1] = _ENDS[data[:-1]] & np.isin(data[1:], [0x20, 9, 10, 13])
        sentence = np.cumsum(blank | (data == 10), dtype=np.int64)
    for i in range(len(texts)):
        if i not in possible:
            yield []
            continue
        a, b = int(at[i]), int(at[i + 1])
        grams = pairs[a : b - 1]
        known = np.sort(np.concatenate([notices.sets[t] for t in possible[i]]))
        spots = np.flatnonzero(known[np.searchsorted(known, grams).clip(max=len(known) - 1)] == grams) + a
        segments = {(0, b - a)}
        for ids in (line, sentence):
            own = ids[starts[a:b]]
            for s in np.unique(ids[starts[spots]]):
                segments.add((int(np.searchsorted(own, s)), int(np.searchsorted(own, s, "right"))))
        yield notices.places(hashes[a:b], grams, sorted(segments), possible[i])


def _possible(hashes: np.ndarray, pairs: np.ndarray, at: np.ndarray, notices: Notices) -> dict[int, list[int]]:
    """Per text the templates of which it holds enough distinct bigrams; other texts are left out."""
    if not len(notices.flat):
        return {}
    near = np.flatnonzero(notices.seen[pairs >> np.uint64(44)])
    lo = np.searchsorted(notices.flat, pairs[near])
    known = notices.flat[lo.clip(max=len(notices.flat) - 1)] == pairs[near]
    near, lo = near[known], lo[known]
    text = np.searchsorted(at, near, "right") - 1
    whole = near + 1 < at[text + 1]
    text, lo = text[whole], lo[whole]
    alone = np.flatnonzero(np.diff(at) == 1)  # a single word is a bigram with itself
    word = np.searchsorted(notices.flat, hashes[at[alone]])
    same = notices.flat[word.clip(max=len(notices.flat) - 1)] == hashes[at[alone]]
    text, lo = np.concatenate([text, alone[same]]), np.concatenate([lo, word[same]])
    cells = np.unique(text * len(notices.flat) + lo)
    text, lo = cells // len(notices.flat), cells % len(notices.flat)
    n = np.searchsorted(notices.flat, notices.flat[lo], "right") - lo
    each = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
    keys, counts = np.unique(np.repeat(text, n) * len(notices.sizes) + notices.owner[each], return_counts=True)
    out: dict[int, list[int]] = {}
    for key in keys[counts >= notices.least[keys % len(notices.sizes)]].tolist():
        out.setdefault(key // len(notices.sizes), []).append(key % len(notices.sizes))
    return out


def _starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    from .toxicity import _WORD

    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = bounds[:-1][bounds[:-1] < len(data)]
    first[begin] = inside[begin]
    return np.flatnonzero(first)


def _scan(notices: Notices, matches: list[tuple[float, int]]) -> tuple:
    if not matches:
        return None, None, 0, []
    dice, name = min(matches, key=lambda m: (-m[0], m[1]))
    return notices.names[name], dice, len(matches), sorted({notices.names[n] for _, n in matches})
