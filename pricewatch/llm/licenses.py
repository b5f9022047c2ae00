"""License scans: MinHash bands find candidate templates in overlapping windows, exact containment decides.

Words are lower-cased and stripped of punctuation at their ends; shingles are five words.
Templates of similar length share a window length of twice theirs; windows overlap by half,
so a template lies wholly in one of them. One-row bands make a window a candidate when any
of its minima equals the template's. A window that holds the share ``LEAST`` of a template
has a Jaccard similarity of at least ``LEAST * t / (w + (1 - LEAST) * t)`` for t template
and w window shingles; the number of bands is chosen so that such a window is missed with a
probability below ``MISS``. Candidates are then compared shingle by shingle.

Shingles are hashed once and minima are taken over windows with numpy, for many texts laid
end to end; nothing is shuffled. The templates are an argument and are sent to the tasks.

Nulls and odd input: a null or empty text, or one under five words, matches nothing. A text
may match several templates and one template more than once; the span of the best window
is given. Repeated rows are scanned each. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SHINGLE = 5
LEAST = 0.8
MISS = 1e-4
AT_ONCE = 200_000
EDGES = ".,;:!?\"'()[]<>*#/-"

# Opening words and notices of public licenses, as published.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at"
    ),
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def normal(text: str | None) -> list[str]:
    """The words, lower case, without punctuation at their ends."""
    listed = (w.strip(EDGES) for w in (text or "").lower().split())
    return [w for w in listed if w]


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    return [tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def bands_needed(template: int, window: int) -> int:
    """One-row bands with which a window of that many shingles is missed with probability MISS at most."""
    needed = math.ceil(LEAST * template)
    jaccard = needed / (window + template - needed)
    return max(1, math.ceil(math.log(MISS) / math.log(1 - jaccard))) if jaccard < 1 else 1


def _mixed(x: np.ndarray, band: int) -> np.ndarray:
    """A different order of the shingle hashes for each band."""
    z = (x ^ np.uint64((0x9E3779B97F4A7C15 * (2 * band + 1)) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(32))


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.hashes: dict[str, int] = {}
        self.templates = {name: set(shingles(normal(text))) for name, text in templates.items()}
        by_size: dict[int, list[str]] = defaultdict(list)
        for name, grams in self.templates.items():
            if grams:
                by_size[1 << (len(grams) - 1).bit_length()].append(name)
        #: Per class: window shingles, step, and per band the templates of each minimum.
        self.classes: list[tuple[int, int, list[dict[int, list[str]]]]] = []
        for size, names in by_size.items():
            window, step = 2 * size, size
            n = max(bands_needed(len(self.templates[x]), window) for x in names)
            bands: list[dict[int, list[str]]] = [defaultdict(list) for _ in range(n)]
            for name in names:
                h = np.array([self._gram_hash(g) for g in self.templates[name]], np.uint64)
                for band in range(n):
                    bands[band][int(_mixed(h, band).min())].append(name)
            self.classes.append((window, step, bands))

    def _word_hash(self, word: str) -> int:
        h = self.hashes.get(word)
        if h is None:
            from xxhash import xxh64_intdigest

            if len(self.hashes) > 500_000:
                self.hashes.clear()
            h = self.hashes[word] = xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    @staticmethod
    def _combined(h: np.ndarray) -> np.ndarray:
        """Hashes of the shingles from the hashes of the words."""
        n = len(h) - SHINGLE + 1
        out = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            out = (out ^ h[k : k + n]) * np.uint64(0x100000001B3)
            out ^= out >> np.uint64(29)
        return out

    def _gram_hash(self, gram: tuple[str, ...]) -> np.uint64:
        return self._combined(np.array([self._word_hash(w) for w in gram], np.uint64))[0]

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[int, str, int, int, float]]:
        """(text, template, first word, last word + 1, share) of the templates found, text by text."""
        part, size, first = [], 0, 0
        for i, text in enumerate(texts):
            part.append(normal(text))
            size += len(part[-1])
            if size >= AT_ONCE:
                yield from self._scanned(part, first)
                part, size, first = [], 0, i + 1
        yield from self._scanned(part, first)

    def _scanned(self, texts: list[list[str]], first: int) -> Iterator[tuple[int, str, int, int, float]]:
        lengths = np.array([len(w) for w in texts], np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        if total < SHINGLE:
            return
        hashes = np.fromiter(map(self._word_hash, chain.from_iterable(texts)), np.uint64, total)
        grams = self._combined(hashes)
        # Texts lie end to end. Windows may reach into the next text: it is looked at as well.
        candidates: set[tuple[int, str, int, int]] = set()
        for band in range(max(len(bands) for _, _, bands in self.classes)):
            mixed = _mixed(grams, band)
            for window, step, bands in self.classes:
                if band >= len(bands):
                    continue
                low = np.minimum.reduceat(mixed, np.arange(0, len(grams), step))
                low = np.minimum(low, np.concatenate([low[1:], low[-1:]]))
                for minimum, names in bands[band].items():
                    for k in np.flatnonzero(low == np.uint64(minimum)):
                        start = int(k) * step
                        for text in range(
                            int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, start + window, "left")) + 1
                        ):
                            if text < len(texts):
                                inside = max(start - int(ends[text] - lengths[text]), 0)
                                stop = start + window - int(ends[text] - lengths[text])
                                candidates.update((text, name, inside, stop) for name in names)
        by_text: dict[tuple[int, str], tuple[float, int, int]] = {}
        for text, name, start, stop in sorted(candidates):
            words, wanted = texts[text], self.templates[name]
            here = [i for i in range(start, min(stop, len(words) - SHINGLE + 1)) if tuple(words[i : i + SHINGLE]) in wanted]
            share = len({tuple(words[i : i + SHINGLE]) for i in here}) / len(wanted)
            if share >= LEAST and share > by_text.get((text, name), (0.0,))[0]:
                by_text[text, name] = (share, here[0], here[-1] + SHINGLE)
        for (text, name), (share, start, stop) in by_text.items():
            yield first + text, name, start, stop, share


def scan(documents: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, template, first_word, end_word, containment) for every template a document holds."""
    known = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known)
        for batch in batches:
            out = list(scanner(batch.column("text").to_pylist()))
            of = pa.array([m[0] for m in out], pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(of),
                    "template": pa.array([m[1] for m in out], pa.string()),
                    "first_word": pa.array([m[2] for m in out], pa.int32()),
                    "end_word": pa.array([m[3] for m in out], pa.int32()),
                    "containment": pa.array([m[4] for m in out], pa.float64()),
                }
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, template string, first_word int, end_word int, containment double"
    )
