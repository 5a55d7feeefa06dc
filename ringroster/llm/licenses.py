"""License scans: MinHash bands over text windows, verified by shingle containment.

Texts and templates are cut into overlapping windows of words. A window's MinHash bands
retrieve the templates that have a window with an equal band; the template's shingles are
then looked for around the window, and it matches when enough of them are there. A template
of m words is looked for at the scale whose windows hold it whole wherever it begins, so
a verbatim occurrence has a known least similarity with a window, from which the chance of
a shared band follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringroster.llm.common import ALNUM_GAP, texts_of, windows_hash, word_hashes

# Public license notices, in natural order.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
SHINGLE = 2
BANDS = 24
ROWS = 2
CONTAINED = 0.8
SEED = 8
CHUNK_WORDS = 1 << 17
BLOCK = 1 << 15  # shingles hashed at a time


def normalised(text: str) -> np.ndarray:
    """Hashes of the words of a text: runs of letters and digits, A-Z lower-cased."""
    return word_hashes(text, gaps=ALNUM_GAP)


def stride_of(words: int) -> int:
    """Stride whose windows of four strides hold a run of `words` wherever it begins."""
    stride = 1
    while 3 * stride + 1 < words:
        stride += 1 if stride < 4 else stride // 2
    return stride


def collision_chance(words: int, bands: int = BANDS, rows: int = ROWS) -> float:
    """Least chance that a verbatim run of `words` shares a band with its template."""
    inside = max(1, words - SHINGLE + 1)
    similarity = inside / max(inside, 4 * stride_of(words))
    return 1 - (1 - similarity**rows) ** bands


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(1, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 62, count, dtype=np.uint64)


def laid_out(texts: list[np.ndarray], stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of many texts in one array, each text from a multiple of the stride and
    followed by a window of gaps, so no window holds two texts. Also where the gaps are and
    where each text begins."""
    sizes = np.array([len(x) for x in texts])
    rooms = (-(-sizes // stride) + 4) * stride
    starts = np.cumsum(rooms) - rooms
    out, gap = np.zeros(int(rooms.sum()), np.uint64), np.ones(int(rooms.sum()), bool)
    for x, at in zip(texts, starts, strict=True):
        out[at : at + len(x)] = x
        gap[at : at + len(x)] = False
    return out, gap, starts


def band_keys(shingles: np.ndarray, gap: np.ndarray, stride: int, bands: int, rows: int) -> np.ndarray:
    """Band hashes (bands, windows) of the windows that begin at each stride.

    Strides stand in columns, a block of them at a time, so that a hash and its least value are
    taken within the processor's cache."""
    a, b = permutations(bands * rows)
    strides = len(shingles) // stride
    columns = np.ascontiguousarray(shingles.reshape(strides, stride).T)
    none = np.uint64(1 << 63)
    gaps = np.ascontiguousarray(gap.reshape(strides, stride).T) * none
    keys = np.zeros((bands, strides - 3), np.uint64)
    width = max(8, BLOCK // stride)
    for start in range(0, strides - 3, width):
        x, no = columns[:, start : start + width + 3], gaps[:, start : start + width + 3]
        x, no = np.ascontiguousarray(x), np.ascontiguousarray(no)
        h, own = np.empty_like(x), keys[:, start : start + width]
        for i in range(bands * rows):
            np.multiply(x, a[i], out=h)
            h += b[i]
            h >>= np.uint64(1)
            h |= no  # hashes have 63 bits, so a gap is never least beside a shingle
            least = np.minimum(h.min(0), none)
            two = np.minimum(least[:-1], least[1:])
            key = own[i // rows]
            key *= np.uint64(0x9E3779B97F4A7C15)
            key += np.minimum(two[:-2], two[2:])
    return keys


class Index:
    """Templates of one stride by their bands, with a bitmap that most windows miss."""

    def __init__(self, stride: int, templates: list[tuple[str, np.ndarray]], bands: int, rows: int):
        self.stride, self.bands, self.rows = stride, bands, rows
        self.items = [(name, len(own), np.unique(own)) for name, own in templates]
        self.table: list[dict[int, set[int]]] = [{} for _ in range(bands)]
        self.bits = np.zeros((bands, 1 << 16), bool)
        for place, (_, own) in enumerate(templates):
            for shift in range(min(stride, len(own))):  # however the window lies over it
                x, gap, _ = laid_out([own[shift:]], stride)
                keys = band_keys(x, gap, stride, bands, rows)
                for band in range(bands):
                    for key in keys[band].tolist():
                        self.table[band].setdefault(key, set()).add(place)
                        self.bits[band, key & 0xFFFF] = True

    def found(self, texts: list[np.ndarray], contained: float) -> Iterator[tuple[int, str, int, float]]:
        """(text, template, first word, containment) of every window that matches."""
        x, gap, starts = laid_out(texts, self.stride)
        keys = band_keys(x, gap, self.stride, self.bands, self.rows)
        hit = np.zeros(keys.shape[1], bool)
        for band in range(self.bands):
            hit |= self.bits[band][(keys[band] & np.uint64(0xFFFF)).astype(np.int64)]
        places = np.flatnonzero(hit)
        keys = keys[:, places]
        low = (keys & np.uint64(0xFFFF)).astype(np.int64)
        window, band = np.nonzero(np.stack([self.bits[i][low[i]] for i in range(self.bands)], 1))
        met: dict[int, set[int]] = {}
        for w, i, key in zip(places[window].tolist(), band.tolist(), keys[band, window].tolist(), strict=True):
            own = self.table[i].get(key)
            if own:
                met[w] = met[w] | own if w in met else own
        text_of = np.searchsorted(starts, np.fromiter(met, np.int64, len(met)) * self.stride, "right") - 1
        for (w, own), text in zip(met.items(), text_of.tolist(), strict=True):
            at = w * self.stride - int(starts[text])
            for place in sorted(own):
                name, length, items = self.items[place]
                near = texts[text][max(0, at - length) : at + 4 * self.stride + length]
                share = _share(items, near)
                if share >= contained:
                    yield text, name, at, share


def _share(items: np.ndarray, near: np.ndarray) -> float:
    """Share of the items, which rise, that occur in the other array."""
    at = np.searchsorted(items, near)
    at[at == len(items)] = 0
    seen = np.zeros(len(items), bool)
    seen[at[items[at] == near]] = True
    return int(np.count_nonzero(seen)) / len(items)


def scanned(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    bands: int = BANDS,
    rows: int = ROWS,
    contained: float = CONTAINED,
) -> DataFrame:
    """One row per document and template found: doc_id, license, first_word (place of the
    first window that matches), windows (how many match) and containment (the largest).

    Null and empty texts, and texts without a match, give no row; repeated rows are scanned
    separately; whole texts are scanned; other columns are ignored. Templates are a bounded
    parameter that travels with the tasks; one of fewer than two words is never found.
    """
    plan: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in sorted((TEMPLATES if templates is None else templates).items()):
        words = normalised(text)
        if len(words) >= SHINGLE:
            own = windows_hash(words, SHINGLE)
            plan.setdefault(stride_of(len(words)), []).append((name, own))
    indexes = [Index(stride, own, bands, rows) for stride, own in sorted(plan.items())]
    names = ["doc_id", "license", "first_word", "windows", "containment"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]

    def matches(ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        found: dict[tuple[int, str], list] = {}
        for index in indexes if texts else []:
            for text, name, at, share in index.found(texts, contained):
                first = found.setdefault((text, name), [at, 0, 0.0])
                first[1] += 1
                first[2] = max(first[2], share)
        out = [(ids[text], name, *values) for (text, name), values in sorted(found.items())]
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                shingles = windows_hash(normalised(text or ""), SHINGLE)
                if len(shingles):
                    ids.append(doc_id)
                    held.append(shingles)
                    size += len(shingles)
                if size >= CHUNK_WORDS:
                    yield matches(ids, held)
                    ids, held, size = [], [], 0
            yield matches(ids, held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scan, "doc_id long, license string, first_word long, windows long, containment double"
    )
