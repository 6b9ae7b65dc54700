"""Fill-in-the-middle: the middle of a text is moved behind its end, in place.

A text is cut after two of its units (lines) into prefix, middle and suffix. In
one bytearray the sentinels are put in at the cuts,

    <P> prefix <M> middle <S> suffix

and two neighbouring blocks change places by a rotation, made of three
reversals in place: of either block, then of both together. With the last two
blocks that is <P> prefix <S> suffix <M> middle (psm); with the last block and
the two before it, <S> suffix <P> prefix <M> middle (spm). The inverse rotation
brings the blocks back, and the sentinels are cut out again.

A text that holds a sentinel stays plain, so an output's form and sentinels say
exactly what its text was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, opened, sealed, ship, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLOCK = 1 << 16  # bytes exchanged at a time
_SENTINEL = re.compile(b"<[PSM]>")
_ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def reverse(data: np.ndarray, begin: int, end: int) -> None:
    """Reverse data[begin:end] in place, a block from either end at a time."""
    while end - begin > 1:
        size = min(BLOCK, (end - begin) // 2)
        low, high = data[begin : begin + size], data[end - size : end]
        held = low[::-1].copy()
        low[:] = high[::-1]
        high[:] = held
        begin, end = begin + size, end - size


def rotate(buffer: bytearray, begin: int, between: int, end: int) -> None:
    """Let the blocks [begin, between) and [between, end) change places."""
    data = np.frombuffer(buffer, np.uint8)
    reverse(data, begin, between)
    reverse(data, between, end)
    reverse(data, begin, end)


def cuts(text: bytes, first: int, second: int) -> tuple[int, int, int]:
    """(units, bytes of the prefix, bytes of prefix and middle) for two numbers,
    each taken modulo the units and one. A unit is a line with its newline."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 10) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    place = lambda units: int(ends[units - 1]) if units else 0
    return n, place(low), place(high)


def transform(text: bytes, low: int, high: int, form: str) -> bytes:
    """The text, cut at bytes ``low`` and ``high``, in the form psm or spm."""
    out = bytearray(text)
    for at, sentinel in ((high, SUFFIX), (low, MIDDLE), (0, PREFIX)):
        out[at:at] = sentinel
    middle, suffix = low + 3, high + 6
    rotate(out, middle if form == "psm" else 0, suffix, len(out))
    return bytes(out)


def invert(output: bytes, form: str) -> bytes:
    """The text that has this output in this form."""
    if form == "plain":
        return output
    out = bytearray(output)
    if form == "psm":
        rotate(out, out.index(SUFFIX), out.index(MIDDLE), len(out))
    else:
        rotate(out, 0, out.index(PREFIX), len(out))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = out.index(sentinel)
        del out[at : at + 3]
    return bytes(out)


def _chars(text: bytes) -> int:
    """Code points: bytes that go on no character."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def _draws(seed: int, key: str | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{key or ''}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _transform(kept: list[str], seed: int, rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in slices([whole]):
                found = []
                for text, key in zip(texts, columns(batch, "key_")[0].to_pylist(), strict=True):
                    h = _draws(seed, key)
                    n, low, high = cuts(text, h[0], h[1])
                    if not text or _SENTINEL.search(text) or h[2] % 100 >= rate:
                        found.append((n, "plain", None, None, text))
                    else:
                        form = "spm" if h[3] % 100 < spm else "psm"
                        found.append((n, form, _chars(text[:low]), _chars(text[low:high]), transform(text, low, high, form)))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                made = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns(batch, *kept), *made], names=[*kept, *_ADDED])

    return run


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) with n long (units),
    form (plain, psm or spm), prefix_chars and middle_chars long (null if plain)
    and output string; columns of these names are replaced.

    Cuts and forms follow from the first four 8-digit groups of the sha256 of
    ``seed``, a colon and the doc_id, so equal ids cut alike and reruns agree; a
    null doc_id counts as an empty one. ``rate`` percent of the documents are
    transformed and ``spm`` percent of these in that form. A null or empty text,
    and one that holds a sentinel, is plain (null: an empty output). Repeated
    rows stay. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    whole = opened(docs.columns, "doc_id", "text", but=_ADDED)
    docs = sealed(docs, "doc_id", "text")
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(_ADDED, kinds, strict=True))])
    moved = docs.withColumn("key_", F.col("doc_id").cast("string")).mapInArrow(_transform(docs.columns, seed, rate, spm), schema)
    return moved.select(*whole, *_ADDED)


def _restore(kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, outputs in slices([whole], text="output"):
                found = [invert(o, f) for o, f in zip(outputs, columns(batch, "form")[0].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*columns(batch, *kept), pa.array(found, pa.string())], names=[*kept, "restored"])

    return run


def restore(transformed: DataFrame) -> DataFrame:
    """The rows with a column restored: the text, from output and form alone."""
    transformed = transformed.drop("restored")
    schema = T.StructType([*transformed.schema.fields, T.StructField("restored", T.StringType())])
    return transformed.mapInArrow(_restore(transformed.columns), schema)
