"""Benchmark decontamination: Wu-Manber search for many word windows at once.

Symbols are words. Benchmark words get numbers, every other word is 0, which no
window holds. Windows of one length m are searched together: the last two words
of the current m positions form a block; the shift table says how far the
search may move on without missing a window that holds this block (m - 1 words
if none does); at shift 0 the block's hash selects the bucket of windows that
end in it, and these are compared word by word.

The search runs in numpy over many pieces of texts in step: pieces of
``PIECE`` words that overlap by m - 1, so a long text is no slower than many
short ones. Documents are searched where they are read, without a shuffle.

The benchmark is read to the driver in blocks of ``BLOCK_BYTES`` of text at
most; each block is one pass over the documents (a block's tables are of
bounded size and travel with the tasks; between passes the documents and what
was found in them are written to the shared folder). Usually there is one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, columns, opened, sealed, ship, slices

BLOCK_BYTES = 16 << 20
PIECE = 1024
_TABLE = 1 << 18  # entries of a shift table
#: Words: A-Z as a-z, digits, and all bytes of characters beyond ASCII; the rest separates.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B1) + b.astype(np.uint64) * np.uint64(0x85EBCA77)) >> np.uint64(7)) & np.uint64(_TABLE - 1)


class WuManber:
    """Windows of m words: rows of a matrix of word numbers."""

    def __init__(self, windows: np.ndarray):
        self.windows = windows
        self.m = m = windows.shape[1]
        before = windows[:, : m - 1] if m > 1 else np.zeros((len(windows), 1), windows.dtype)
        blocks = _hash(before, windows[:, 1:] if m > 1 else windows).astype(np.intp)
        self.shift = np.full(_TABLE, max(1, m - 1), np.int32)
        for j in range(blocks.shape[1]):  # a block that ends j words before the end allows a shift of j
            np.minimum.at(self.shift, blocks[:, j], blocks.shape[1] - 1 - j)
        last = blocks[:, -1]
        self.order = np.argsort(last, kind="stable")
        self.start = np.searchsorted(last[self.order], np.arange(_TABLE + 1))

    def find(self, symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (first position, window) in the texts symbols[begins[i]:ends[i]]."""
        m = self.m
        counts = np.maximum(0, -(-(ends - begins - m + 1) // PIECE))
        piece = np.repeat(begins, counts) + PIECE * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        at = piece + m - 1  # the word that the block ends at
        stop = np.minimum(piece + PIECE + m - 1, np.repeat(ends, counts))
        firsts, rows = [], []
        while len(at):
            before = symbols[at - 1] if m > 1 else np.zeros(len(at), symbols.dtype)
            block = _hash(before, symbols[at]).astype(np.intp)
            step = self.shift[block]
            hit = np.flatnonzero(step == 0)
            if len(hit):
                lo, hi = self.start[block[hit]], self.start[block[hit] + 1]
                n = hi - lo
                first = np.repeat(at[hit] - m + 1, n)
                row = self.order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
                for j in (0, *range(m - 1, 0, -1)):
                    same = self.windows[row, j] == symbols[first + j]
                    first, row = first[same], row[same]
                firsts.append(first)
                rows.append(row)
            at = at + np.maximum(step, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        none = np.empty(0, np.intp)
        return np.concatenate(firsts or [none]), np.concatenate(rows or [none])


class Block:
    """The windows of some items; ``items`` is a list of (item_id, text bytes)."""

    def __init__(self, items: list[tuple[int | str, bytes]], width: int):
        self.number: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[int | str]]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            m = min(width, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                by_length.setdefault(m, {}).setdefault(tuple(ids[i : i + m]), set()).add(item)
        self.searches = [(WuManber(np.array(list(w), np.int32)), [sorted(o) for o in w.values()]) for w in by_length.values()]

    def search(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[set[int | str]]]:
        """Hit flags of all words, where each text begins in them, and each
        text's items."""
        get, unknown = self.number.get, 0
        symbols = np.array([get(w, unknown) for t in texts for w in t], np.int32)
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.intp)
        edge = np.zeros(len(symbols) + 1, np.int64)
        items: list[set[int | str]] = [set() for _ in texts]
        for search, owners in self.searches:
            firsts, rows = search.find(symbols, begins[:-1], begins[1:])
            np.add.at(edge, firsts, 1)
            np.add.at(edge, firsts + search.m, -1)
            text = np.searchsorted(begins, firsts, side="right") - 1
            for t, r in set(zip(text.tolist(), rows.tolist(), strict=True)):
                items[t].update(owners[r])
        return np.cumsum(edge[:-1]) > 0, begins, items


_FOUND = ("words_", "n_hit_", "hits_", "items_")


def _pass(items: list[tuple[int | str, bytes]], width: int, kept: list[str], first: bool, kind: pa.DataType):
    """One block over the documents: the hit words as a bitmap and the items,
    with those of earlier passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(items, width)
        for batch, texts in slices(batches):
            split = [words(t) for t in texts]
            hit, begins, found = block.search(split)
            maps = []
            for i in range(len(texts)):
                flags = hit[begins[i] : begins[i + 1]]
                maps.append(np.packbits(flags).tobytes() if flags.any() else b"")
            if not first:
                old, before = columns(batch, "hits_", "items_")
                for i, (o, b) in enumerate(zip(old.to_pylist(), before.to_pylist(), strict=True)):
                    found[i].update(b)
                    if o and maps[i]:
                        maps[i] = (np.frombuffer(o, np.uint8) | np.frombuffer(maps[i], np.uint8)).tobytes()
                    maps[i] = maps[i] or o
            yield pa.RecordBatch.from_arrays(
                [
                    *columns(batch, *kept),
                    pa.array([len(s) for s in split], pa.int64()),
                    pa.array([int(np.bitwise_count(np.frombuffer(b, np.uint8)).sum()) for b in maps], pa.int64()),
                    pa.array(maps, pa.binary()),
                    pa.array([sorted(f) for f in found], pa.list_(kind)),
                ],
                names=[*kept, *_FOUND],
            )

    return run


def _blocks(benchmark: DataFrame, limit: int, kind: T.DataType) -> Iterator[list[tuple[int | str, bytes]]]:
    """The items in blocks of about ``limit`` bytes, one block at a time on the driver."""
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast(kind), F.encode("text", "UTF-8")).where("item_id is not null and text is not null")
    for item, text in rows.toLocalIterator():
        block.append((item, bytes(text)))
        held += len(text)
        if held >= limit:
            yield block
            block, held = [], 0
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (text and any others) with n_words, n_hit (words
    inside an occurrence of an item's window of ``width`` words; an item of
    fewer words is one window), items (sorted ids of the items with such
    windows: longs if item_id is a whole number, else strings) and contaminated
    (n_hit > 0); columns of these names are replaced.

    Null texts have no words; items without words, text or id have no windows,
    and items of the same id count as one. Repeated rows stay. No items: no
    hits.
    """
    ship(docs.sparkSession)
    whole = opened(docs.columns, "text", but=("n_words", "n_hit", "items", "contaminated"))
    docs = sealed(docs, "text")
    kind = T.LongType() if isinstance(benchmark.schema["item_id"].dataType, T.IntegralType) else T.StringType()
    arrow = pa.int64() if kind == T.LongType() else pa.string()
    kinds = (T.LongType(), T.LongType(), T.BinaryType(), T.ArrayType(kind))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(_FOUND, kinds, strict=True))])
    found = docs
    for number, block in enumerate(_blocks(benchmark, block_bytes, kind)):
        if number:
            found = checkpointed(found)
        found = found.mapInArrow(_pass(block, width, docs.columns, number == 0, arrow), schema)
    return found.select(
        *whole,
        F.col("words_").alias("n_words"),
        F.col("n_hit_").alias("n_hit"),
        F.col("items_").alias("items"),
        (F.col("n_hit_") > 0).alias("contaminated"),
    )
