"""Licence scan: which documents hold the text of a known licence or licence notice, and where."""

from __future__ import annotations

import math
import pathlib
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.session import ship

#: share of a template's shingles that a passage must hold
CONTAINMENT = 0.75
#: chance that a passage which qualifies is not retrieved
MISS = 1e-6
#: templates are sent to every task
MAX_TEMPLATES, MAX_TEMPLATE_BYTES = 20_000, 16 << 20

# Wordings of common licence notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the terms of the MIT license.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files, to deal in the Software without restriction",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "LGPL-notice": "licensed under the GNU Lesser General Public License",
    "AGPL-notice": "licensed under the GNU Affero General Public License",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                 "that the following conditions are met",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-notice": "This work is licensed under a Creative Commons Attribution",
    "CC0-1.0-notice": "dedicated to the public domain under the CC0 1.0 Universal",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: whole licences, one file each, named as their license_id
TEXTS = pathlib.Path(__file__).parent / "license_texts"

_MATCH = "doc_id bigint, license_id string, start bigint, end bigint, containment double"


def known_templates() -> dict[str, str]:
    """The notices and the whole texts; read by the driver."""
    return TEMPLATES | {path.stem: path.read_text(encoding="utf-8") for path in sorted(TEXTS.glob("*.txt"))}


def _family(name: str) -> str:
    """The name without its version: versions of one text share it."""
    return re.sub(r"-[0-9]+(?:\.[0-9]+)*", "", name)


def _best_versions(matches: list[tuple]) -> list[tuple]:
    """Of overlapping passages (row, doc_id, name, start, end, share) of a family, those of the best version."""
    groups: dict[tuple, list[tuple]] = {}
    for m in matches:
        groups.setdefault((m[0], _family(m[2])), []).append(m)
    return [m for rivals in groups.values() for m in rivals
            if not any(r[2] != m[2] and r[3] < m[4] and m[3] < r[4] and r[5] > m[5] for r in rivals)]


def bands_for(similarity: float, miss: float = MISS) -> int:
    """Bands of one min-hash each with which sets of this similarity collide, but for a chance of ``miss``."""
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log(1 - similarity))


def _plain(data: np.ndarray) -> np.ndarray:
    """Lower case; ASCII punctuation counts as white space."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for first, end in ((33, 48), (58, 65), (91, 97), (123, 127)):
        table[first:end] = 32
    return table[data]


class _Class:
    """Templates of similar length, and the windows that hold them.

    A window consists of whole blocks; windows begin at every block, so a
    passage as long as the longest template lies whole in one of them.
    """

    def __init__(self, width: int, members: list[tuple[str, np.ndarray]], containment: float, versions: Mapping[str, np.ndarray]):
        self.members = members
        self.versions = versions
        self.block = max(1, width // 2)
        self.blocks = -(-(width + self.block - 1) // self.block)
        span = self.block * self.blocks
        least = 1.0
        for _, items in members:
            common = math.ceil(containment * len(items) - 1e-9)
            least = min(least, common / (max(span, len(items)) + len(items) - common))
        self.bands = bands_for(least)
        self.values = [np.array([_minhash(items, band).min() for _, items in members]) for band in range(self.bands)]


def _minhash(items: np.ndarray, band: int) -> np.ndarray:
    seed = (2 * band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return (items ^ np.uint64(seed)) * np.uint64((seed ^ 0x5851F42D4C957F2D) | 1)


def compile_templates(templates: Mapping[str, str], containment: float = CONTAINMENT) -> list[_Class]:
    if len(templates) > MAX_TEMPLATES or sum(map(len, templates.values())) > MAX_TEMPLATE_BYTES:
        raise ValueError("too many templates to send to every task; scan in several passes")
    classes: dict[int, list[tuple[str, np.ndarray]]] = {}
    versions: dict[str, np.ndarray] = {}
    for name, text in sorted(templates.items()):
        data = _plain(np.frombuffer((text or "").encode(), dtype=np.uint8))
        every = K.shingles(data, np.array([0, len(data)]))[0]
        items = np.unique(every)
        words = data.tobytes().split()
        # shingles of a named version's number, of which a passage must hold one
        if _family(name) != name and len(every) == len(words) - K.SHINGLE_WORDS + 1:
            bearing = [any(w.isdigit() for w in words[i:i + K.SHINGLE_WORDS]) for i in range(len(every))]
            if any(bearing):
                versions[name] = np.unique(every[bearing])
        if len(items):
            classes.setdefault(1 << (len(items) - 1).bit_length(), []).append((name, items))
    return [_Class(width, members, containment, versions) for width, members in sorted(classes.items())]


def _retrieved(kind: _Class, items: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Document, first shingle and template of every window that shares a band with a template."""
    counts = -(-np.diff(edges) // kind.block)
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = edges[:-1][owner] + (np.arange(first[-1]) - first[:-1][owner]) * kind.block
    if not len(starts):
        return
    hits = []
    for band, values in enumerate(kind.values):
        least = np.minimum.reduceat(_minhash(items, band), starts)
        window = least.copy()
        for step in range(1, kind.blocks):
            same = owner[step:] == owner[:-step]
            window[:-step] = np.where(same, np.minimum(window[:-step], least[step:]), window[:-step])
        order = np.argsort(values, kind="stable")
        at = np.minimum(np.searchsorted(values[order], window), len(values) - 1)
        for place in np.flatnonzero(values[order][at] == window):
            hits += [(int(place), int(t)) for t in np.flatnonzero(values == window[place])]
    for place, template in sorted(set(hits)):
        yield int(owner[place]), int(starts[place]), template


def _scan(classes: list[_Class], containment: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column("doc_id"), []
        data, offsets = K.utf8(batch.column("text"))
        for first, end, part, bounds in K.chunks(data, offsets):
            plain = _plain(part)
            starts, ends, words = K.words(plain, bounds)
            items, edges = K.windows(K.span_hashes(plain, starts, ends), words)
            points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
            for kind in classes:
                found: dict[tuple[int, int], list[list]] = {}
                for doc, at, template in _retrieved(kind, items, edges):
                    name, wanted = kind.members[template]
                    window = items[at:min(at + kind.block * kind.blocks, edges[doc + 1])]
                    inside = np.flatnonzero(np.isin(window, wanted))
                    share = len(np.unique(window[inside])) / len(wanted)
                    if share < containment or (name in kind.versions and not np.isin(window, kind.versions[name]).any()):
                        continue
                    # shingle k of a document begins at its word k
                    word = words[doc] + at - edges[doc]
                    a, b = int(word + inside[0]), int(min(word + inside[-1] + K.SHINGLE_WORDS, words[doc + 1]))
                    spans = found.setdefault((doc, template), [])
                    if spans and a <= spans[-1][1]:
                        spans[-1] = [spans[-1][0], max(b, spans[-1][1]), max(share, spans[-1][2])]
                    else:
                        spans.append([a, b, share])
                for (doc, template), spans in found.items():
                    zero = points[bounds[doc]]
                    out += [(first + doc, ids[first + doc].as_py(), kind.members[template][0], int(points[starts[a]] - zero),
                             int(points[ends[b - 1]] - zero), share) for a, b, share in spans]
        out = [m[1:] for m in _best_versions(out)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()))],
                ["doc_id", "license_id", "start", "end", "containment"])


def license_scan(docs: DataFrame, templates: Mapping[str, str] | None = None,
                 containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, license_id, start, end, containment)``: passages of ``docs(doc_id, text)`` that hold a template.

    Words ignore case and ASCII punctuation; shingles take five of them (a
    shorter template is one shingle of all its words, which only matches a text
    of just these words).  A passage counts when a window of the text holds
    ``containment`` of the template's distinct shingles; passages of the same
    template that touch are one, with the largest share.  A template named after
    a version needs one of the shingles with a number, and of overlapping
    passages of several versions the one with the largest share stays.  ``start`` and ``end``
    are code points.

    Null and empty texts match nothing.  Repeated rows are reported each.  A
    null doc_id is reported as null.  Versions with equal shares tie to the
    passage found first, in the order of the templates.  No templates, or an
    empty table: no rows.  Very long texts are scanned whole; other columns are
    ignored.  There is no shuffle: templates, at most 20,000, go to every task.
    """
    ship(docs.sparkSession)
    classes = compile_templates(known_templates() if templates is None else templates, containment)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda batches: _scan(classes, containment, batches), _MATCH)
