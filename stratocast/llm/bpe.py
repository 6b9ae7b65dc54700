"""Byte-level BPE encoding and decoding by published ranks.

Encoding: a text is pre-tokenised by the vocabulary's pattern, and each match
is merged pair by pair, lowest rank first. Texts of up to ``LONG`` characters
are encoded where they are read. Longer ones are cut into chunks of ``CHUNK``
characters that overlap by ``OVERLAP``; the chunks are spread over the tasks
and pre-tokenised in parallel, each from its own first character. A chunk's
boundaries are wrong at first and right from the first one that it shares with
the chunk before, since the pattern never looks back. There the two are
stitched; if an overlap holds no common boundary, the scan goes on from the
last sure one until it meets one. Then the pieces between the boundaries are
encoded.

Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, ship, slices

LONG, CHUNK, OVERLAP = 1 << 16, 1 << 15, 1 << 10
#: A match that ends so near to the end of what a chunk sees may go on or, as
#: with 're and 'll, be another one in the whole text.
UNSURE = 3
_MEMORY = 200_000  # pieces whose ids a worker remembers


def load_ranks(path: str) -> bytes:
    """The file of a vocabulary: lines of a base64 token and its rank."""
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    def __init__(self, file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.splitlines() if line.strip())}
        self.pattern = regex.compile(pattern)
        # merges one pre-token at a time, lowest rank first
        self.merge = tiktoken.Encoding("ranks", pat_str=".", mergeable_ranks=self.ranks, special_tokens={})._encode_single_piece if self.ranks else None
        self.known: dict[str, list[int]] = {}

    def pieces(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = self.merge(p)
                if len(p) <= 64:
                    if len(known) >= _MEMORY:
                        known.clear()
                    known[p] = ids
            out += ids
        return out

    def encode(self, text: str) -> list[int]:
        return self.pieces(self.pattern.findall(text))

    def starts(self, text: str) -> np.ndarray:
        return np.array([m.start() for m in self.pattern.finditer(text)], np.int64)

    def stitch(self, text: str, chunks: list[np.ndarray], chunk: int, overlap: int) -> list[str]:
        """The pieces of ``text`` from the starts found in its chunks, chunk i
        being text[i * chunk : (i + 1) * chunk + overlap]."""
        sure = lambda i: len(text) if i == len(chunks) - 1 else (i + 1) * chunk + overlap - UNSURE
        right = chunks[0][chunks[0] <= sure(0)]
        out = []
        for i in range(1, len(chunks)):
            own = chunks[i] + i * chunk
            own = own[own <= sure(i)]
            common = np.intersect1d(right, own, assume_unique=True)
            if len(common):
                out.append(right[right < common[0]])
                right = own[own >= common[0]]
                continue
            # no common boundary: scan on from the last right one
            out.append(right[:-1])
            found, meets = [], set(own.tolist())
            for m in self.pattern.finditer(text, int(right[-1])):
                found.append(m.start())
                if m.start() in meets or m.start() > sure(i):
                    break
            if found[-1] in meets:
                out.append(np.array(found[:-1], np.int64))
                right = own[own >= found[-1]]
            else:
                right = np.array(found, np.int64)
        bounds = [*np.concatenate([*out, right]).tolist(), len(text)]
        return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def _short(vocabulary, pattern: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value, pattern)
        for batch, texts in slices(batches):
            ids = [encoder.encode(t.decode()) for t in texts]
            yield pa.RecordBatch.from_arrays([*columns(batch, *kept), pa.array(ids, pa.list_(pa.int32()))], names=[*kept, "ids"])

    return run


def _chunks(chunk: int, overlap: int, kept: list[str]):
    """Rows of chunks: all columns of the row, its text cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                text = columns(row, "text")[0][0].as_py()
                for number, at in enumerate(range(0, len(text), chunk)):
                    cut = pa.array([text[at : at + chunk + overlap]], columns(row, "text")[0].type)
                    yield pa.RecordBatch.from_arrays(
                        [*[cut if n == "text" else columns(row, n)[0] for n in kept], *columns(row, "row_"), pa.array([number], pa.int32())],
                        names=[*kept, "row_", "chunk_"],
                    )

    return run


def _pretokenise(vocabulary, pattern: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(b"", pattern)
        for batch, texts in slices(batches):
            starts = [encoder.starts(t.decode()).tobytes() for t in texts]
            names = [*kept, "row_", "chunk_"]
            yield pa.RecordBatch.from_arrays([*columns(batch, *names), pa.array(starts, pa.binary())], names=[*names, "starts_"])

    return run


def _stitch(vocabulary, pattern: str, chunk: int, overlap: int, kept: list[str]):
    """The chunks of one text to its row with ids."""
    encoders: list[Encoder] = []

    def run(rows: pa.Table) -> pa.Table:
        if not encoders:
            encoders.append(Encoder(vocabulary.value, pattern))
        rows = rows.sort_by("chunk_")
        cuts = rows["text"].to_pylist()
        text = "".join([c[:chunk] for c in cuts[:-1]] + cuts[-1:])
        starts = [np.frombuffer(s, np.int64) for s in rows["starts_"].to_pylist()]
        ids = encoders[0].pieces(encoders[0].stitch(text, starts, chunk, overlap))
        first = rows.slice(0, 1)
        values = [pa.array([text], first["text"].type) if n == "text" else first[n] for n in kept]
        return pa.table([*values, pa.array([ids], pa.list_(pa.int32()))], names=[*kept, "ids"])

    return run


def encode(docs: DataFrame, ranks: str, pattern: str, long: int = LONG, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The rows of ``docs`` (text and any others) with ids array<int> by the
    ranks file at ``ranks`` and the pre-tokenising ``pattern``, without special
    tokens: their strings are ordinary text. A column ids is replaced.

    Null and empty texts have no ids. Repeated rows stay. The vocabulary (a
    fixed file of about a megabyte) is read on the driver and broadcast.
    """
    ship(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks))
    docs = docs.drop("ids", "row_", "chunk_", "starts_")
    kept = docs.columns
    with_ids = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    size = F.coalesce(F.length("text"), F.lit(0))
    short = docs.where(size <= long).mapInArrow(_short(vocabulary, pattern, kept), with_ids)
    numbered = docs.where(size > long).withColumn("row_", F.monotonically_increasing_id())
    cut = T.StructType([*docs.schema.fields, T.StructField("row_", T.LongType()), T.StructField("chunk_", T.IntegerType())])
    marked = T.StructType([*cut.fields, T.StructField("starts_", T.BinaryType())])
    chunks = numbered.mapInArrow(_chunks(chunk, overlap, kept), cut).repartition("row_", "chunk_")
    pieces = chunks.mapInArrow(_pretokenise(vocabulary, pattern, kept), marked)
    whole = pieces.groupBy("row_").applyInArrow(_stitch(vocabulary, pattern, chunk, overlap, kept), with_ids)
    return short.unionByName(whole)


def _decode(vocabulary, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {i: t for t, i in Encoder(vocabulary.value, "").ranks.items()}
        for batch in batches:
            ids = columns(batch, "ids")[0]
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = [None if x is None else b"".join(map(tokens.__getitem__, x)) for x in ids.slice(start, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([*columns(part, *kept), pa.array(out, pa.binary())], names=[*kept, "decoded"])

    return run


def decode(df: DataFrame, ranks: str) -> DataFrame:
    """The rows of ``df`` (ids array<int> and any others) with decoded binary:
    the raw bytes of the ids in order, null for null, empty for none. An id that
    the ranks lack is an error. A column decoded is replaced."""
    ship(df.sparkSession)
    vocabulary = df.sparkSession.sparkContext.broadcast(load_ranks(ranks))
    df = df.drop("decoded")
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())])
    return df.mapInArrow(_decode(vocabulary, df.columns), schema)


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN
