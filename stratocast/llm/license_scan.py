"""License scans by conditional compression.

Cues (fragments of which every template holds one) find the places to look at;
a block is what stands up to the longest template's length around them. A block
is compressed with zstandard alone and with each template as a raw dictionary.
The reduction, as a share of what the template itself compresses to, ranks the
templates; those that save enough are confirmed, best first, by their exact
wording: the words of the template that the block lacks and those that it puts
between must be few.

Documents are scanned where they are read, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import columns, ship, slices

#: License notices by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at",
    ),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
#: Fragments of which each template holds one (lower case); others are found by
#: a word of their own.
CUES = (b"licens", b"permission", b"redistribut")
LEVEL = 9
MIN_REDUCTION = 0.3  # of a template's own compressed size
DIFFERENCE = 8  # one word in so many may differ

_WORD = re.compile(rb"\S+")
_OUTER = re.compile(rb"^[^\w]+|[^\w]+$")


def _words(text: bytes) -> list[bytes]:
    return [w for w in (_OUTER.sub(b"", x.lower()) for x in _WORD.findall(text)) if w]


def cues(words: list[list[bytes]]) -> list[bytes]:
    """CUES and, for each template (its words) without one, its rarest word over
    the templates, of these the longest."""
    out = list(CUES)
    for own in words:
        if any(c in w for w in own for c in out):
            continue
        if not own:
            raise ValueError("a template without words has no cue")
        out.append(min(own, key=lambda w: (sum(w in other for other in words), -len(w))))
    return out


class Scanner:
    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        texts = [t.encode() for _, t in templates]
        self.words = [_words(t) for t in texts]
        self.cues = cues(self.words)
        self.reach = max(map(len, texts))
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = [
            zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(t, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            )
            for t in texts
        ]
        empty = len(self.alone.compress(b""))
        self.own = [len(self.alone.compress(t)) - empty for t in texts]

    def blocks(self, text: bytes) -> list[bytes]:
        low = text.lower()
        places = sorted({m.start() for cue in self.cues for m in re.finditer(re.escape(cue), low)})
        out, begin, end = [], None, None
        for p in places:
            if end is not None and p - self.reach <= end and p - begin < 8 * self.reach:
                end = p + self.reach
                continue
            if end is not None:
                out.append(text[begin:end])
            begin, end = max(0, p - self.reach), p + self.reach
        if end is not None:
            out.append(text[begin:end])
        return out

    def reductions(self, block: bytes) -> list[tuple[float, int]]:
        """(share of the template's size that it saves, template), best first."""
        plain = len(self.alone.compress(block))
        found = [(round((plain - len(c.compress(block))) / o, 6), i) for i, (c, o) in enumerate(zip(self.given, self.own, strict=True))]
        return sorted(found, key=lambda x: (-x[0], x[1]))

    def differences(self, block: list[bytes], template: int) -> int:
        """Words of the template that the block lacks, and words between the
        found ones that the template lacks, where the two fit best."""
        want, best = self.words[template], len(self.words[template])
        for at in [i for i, w in enumerate(block) if w in want[: 1 + len(want) // DIFFERENCE]]:
            part = block[at : at + len(want) + len(want) // DIFFERENCE]
            same = [m for m in SequenceMatcher(None, want, part, autojunk=False).get_matching_blocks() if m.size]
            if same:
                found = sum(m.size for m in same)
                span = same[-1].b + same[-1].size - same[0].b
                best = min(best, len(want) - found + span - found)
        return best

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, float, int]]]:
        """The number of blocks and, for each license found, its largest
        reduction and the differences there."""
        blocks, found = self.blocks(text), {}
        for block in blocks:
            words = _words(block)
            for saved, i in self.reductions(block):
                if saved < MIN_REDUCTION:
                    break
                off = self.differences(words, i)
                if off <= len(self.words[i]) // DIFFERENCE and (self.names[i] not in found or saved > found[self.names[i]][0]):
                    found[self.names[i]] = (saved, off)
        return len(blocks), sorted((n, *v) for n, v in found.items())


_FOUND = T.StructType(
    [
        T.StructField("n_blocks", T.LongType()),
        T.StructField(
            "licenses",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("license", T.StringType()),
                        T.StructField("reduction", T.DoubleType()),
                        T.StructField("differences", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("reduction", pa.float64()), ("differences", pa.int64())]))


def _scan(templates: list[tuple[str, str]], kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch, texts in slices(batches):
            counts, found = [], []
            for t in texts:
                n, licenses = scanner.scan(t)
                counts.append(n)
                found.append([{"license": a, "reduction": b, "differences": c} for a, b, c in licenses])
            yield pa.RecordBatch.from_arrays(
                [*columns(batch, *kept), pa.array(counts, pa.int64()), pa.array(found, _ARROW)], names=[*kept, *_FOUND.names]
            )

    return run


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """The rows of ``docs`` (text and any others) with n_blocks (places looked
    at) and licenses, an array of (license, reduction, differences) by name;
    columns of these names are replaced. ``templates`` are (name, notice) pairs.

    A license is found if some block is reduced by 0.3 of what the notice
    itself compresses to or more and differs from the notice by one word in
    eight at most (by none if it has fewer than eight). Null and empty texts
    have no blocks. Repeated rows stay.
    """
    ship(docs.sparkSession)
    docs = docs.drop(*_FOUND.names)
    schema = T.StructType([*docs.schema.fields, *_FOUND.fields])
    return docs.mapInArrow(_scan(templates or TEMPLATES, docs.columns), schema)
