"""Exact substring dedup: bytes covered by a ``width``-byte string that starts
more than once in the corpus.

Only strings that can repeat reach a suffix array:

1. Every ``width``-byte window has an anchor, the leftmost of its ``GRAM``-byte
   grams with the smallest hash, so equal windows have equal anchors at equal
   places. A stretch is a run of windows with one anchor; each window is in one
   stretch.
2. Stretches whose anchor's hash occurs once hold no repeat and go. Of those
   that are equal as a whole one is kept, and all windows of them repeat. This
   takes out copies and the insides of common passages before any text moves.
3. Anchors with several different stretches are dealt into shards. A shard's
   suffix array is built by Larsson and Sadakane's refinement (groups that are
   not yet sorted are sorted by the rank of the suffix h further on, h
   doubling), and Kasai's common prefixes of neighbours tell which windows
   repeat in it.
4. A hot anchor's stretches are split over several shards. These shards' window
   digests, sorted, are cut into ranges; each range is merged from all shards,
   and shards find the repeated digests in their own by binary search.
5. The repeated windows go back to all occurrences of their stretches, and each
   text's spans are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, columns, opened, release, released, sealed, ship, slices

GRAM = 32
PIECE = 1 << 19  # bytes that are hashed at a time; fewer than 2**22 with overlap
SHARD_BYTES, MIN_SHARDS = 1 << 19, 32
HOT_BYTES = SHARD_BYTES // 4  # an anchor's stretches beyond this are split
_PLACE = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C13
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = [_mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(k)) for k in (0xD1342543DE82EF95, 0xDA942042E4DD58B5)]


class Rolling:
    """Hashes of any substring: polynomials over random byte values mod 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, inverse = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        power[0] = inverse[0] = 1
        power, self.inverse = np.cumprod(power), np.cumprod(inverse)
        self.sums = []
        for values in _BYTES:
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values[data] * power[:n], out=sums[1:])
            self.sums.append(sums)

    def of(self, kind: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        s = self.sums[kind]
        return _mix((s[end] - s[begin]) * self.inverse[begin])


def _sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i : i + w]) for all i, from minima within blocks of w."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def stretches(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(text, begin in the text, windows, anchor hash, stretch hash) of the
    stretches of texts with fewer than 2**22 bytes in all."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    gram = min(GRAM, width)
    none = np.empty(0, np.int64)
    if len(data) < width:
        return none, none, none, none, none
    rolling = Rolling(data)
    at = np.arange(len(data) - gram + 1)
    grams = rolling.of(0, at, at + gram)
    least = _sliding_minimum((grams & ~_PLACE) | at.astype(np.uint64), width - gram + 1)
    anchor = (least & _PLACE).astype(np.int64)
    text = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    ok = np.arange(len(anchor)) + width <= ends[text]
    start = ok.copy()
    start[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(start)
    count = np.diff(np.append(np.cumsum(ok)[begin] - 1, ok.sum()))
    a = anchor[begin]
    whole = rolling.of(1, begin, begin + count + width - 1)
    whole = _mix(whole + _mix(((a - begin) * (1 << 32) + count).astype(np.uint64)))
    base = np.concatenate([[0], ends[:-1]])
    return text[begin], begin - base[text[begin]], count, grams[a].astype(np.int64), whole.astype(np.int64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    packed = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel().astype(np.uint64)
    order = np.argsort(packed, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = packed[order][1:] != packed[order][:-1]
    rank = np.zeros(n + 1, np.int64)  # behind the end: 0, below all others
    heads = np.flatnonzero(fresh)
    rank[order] = heads[np.cumsum(fresh) - 1] + 1
    h = 8
    while True:
        last = np.append(fresh[1:], True)
        open_ = np.flatnonzero(~(fresh & last))  # slots of groups of two and more
        if not len(open_):
            break
        suffix = order[open_]
        group, then = rank[suffix], rank[np.minimum(suffix + h, n)]
        sort = np.argsort(group * (n + 1) + then, kind="stable")
        suffix, group, then = suffix[sort], group[sort], then[sort]
        order[open_] = suffix
        new = np.ones(len(open_), bool)
        new[1:] = (group[1:] != group[:-1]) | (then[1:] != then[:-1])
        fresh[open_] = new
        slot = np.maximum.accumulate(np.where(new, open_, -1))
        rank[suffix] = slot + 1
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, begins: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """lcp[i]: common bytes, at most ``most``, of the suffixes order[i - 1] and
    order[i]. ``order`` are sorted suffixes: all places of the runs from
    ``begins`` to ``ends``.

    Kasai's rule is followed along the runs, all in step: a place's value is at
    least that of the place before, less one, if the place behind the latter's
    neighbour is in ``order``, too.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    packed = np.lib.stride_tricks.sliding_window_view(padded, 8)[: n + 1].copy().view(">u8").ravel().astype(np.uint64)
    before = np.full(n + 1, -1)
    before[order[1:]] = order[:-1]
    there = np.zeros(n + 1, bool)
    there[order] = True
    lcp = np.zeros(n, np.int64)
    at, stop = begins.copy(), ends
    held = np.zeros(len(at), np.int64)
    while len(at):
        q = before[at]
        room = np.where(q >= 0, np.minimum(n - np.maximum(at, q), most), 0)
        held = np.minimum(held, room)
        on = np.flatnonzero(held < room)
        while len(on):
            x = packed[at[on] + held[on]] ^ packed[q[on] + held[on]]
            same = np.full(len(on), 8)
            some = x != 0
            # equal leading bytes, by the number of bits up to the highest that differs
            high = x[some]
            for shift in (1, 2, 4, 8, 16, 32):
                high |= high >> np.uint64(shift)
            same[some] = 8 - (np.bitwise_count(high).astype(np.int64) + 7) // 8
            held[on] = np.minimum(held[on] + same, room[on])
            on = on[(same == 8) & (held[on] < room[on])]
        lcp[at] = held
        held = np.where(there[q + 1] & (q >= 0), np.maximum(held - 1, 0), 0)
        at = at + 1
        go = at < stop
        at, stop, held = at[go], stop[go], held[go]
    return lcp[order]


def repeated_windows(parts: list[bytes], counts: np.ndarray, width: int, digests: bool):
    """For stretches: a flag for each window, in order, that repeats among them,
    and, if asked for, each window's two digests."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
    window = np.zeros(len(data), bool)
    places = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    window[places] = True
    order = suffix_array(data)
    order = order[window[order]]
    same = common_prefixes(data, order, begins, begins + counts, width)[1:] >= width
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    flags = np.zeros(len(data), bool)
    flags[order] = again
    both = None
    if digests:
        rolling = Rolling(data)
        both = np.stack([rolling.of(k, places, places + width) for k in (0, 1)], 1)
    return flags[places], both


# -- tasks ----------------------------------------------------------------


def _find_stretches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=PIECE):
            rows = columns(batch, "rid")[0].to_numpy()
            pieces = [(i, a) for i, t in enumerate(texts) for a in range(0, max(1, len(t) - width + 1), PIECE)]
            while pieces:
                taken, held = [], 0
                while pieces and (not taken or held + min(len(texts[pieces[0][0]]) - pieces[0][1], PIECE) <= PIECE):
                    taken.append(pieces.pop(0))
                    held += min(len(texts[taken[-1][0]]) - taken[-1][1], PIECE + width - 1)
                cut = [texts[i][a : a + PIECE + width - 1] for i, a in taken]
                text, begin, count, anchor, whole = stretches(cut, width)
                origin = np.array([(rows[i], a) for i, a in taken], np.int64).reshape(-1, 2)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor, whole, origin[:, 0], (origin[:, 1] + begin), count.astype(np.int32))],
                    names=["anchor", "stretch", "rid", "begin", "windows"],
                )

    return released(run)


def _cut_stretches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit=PIECE):
            out = [
                {**w, "bytes": t[w["begin"] : w["begin"] + w["windows"] + width - 1]}
                for t, wanted in zip(texts, columns(batch, "wanted")[0].to_pylist(), strict=True)
                for w in wanted
            ]
            if out:
                names = ["shard", "split", "anchor", "stretch", "windows", "bytes"]
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([w[n] for w in out], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return released(run)


def _sort_shard(width: int):
    def run(rows: pa.Table) -> pa.Table:
        counts = rows["windows"].to_numpy().astype(np.int64)
        split = rows["split"].to_numpy(zero_copy_only=False)
        flags, both = repeated_windows(rows["bytes"].to_pylist(), counts, width, bool(split.any()))
        ends = np.cumsum(counts)
        release()
        return pa.table(
            {
                "shard": rows["shard"],
                "split": rows["split"],
                "anchor": rows["anchor"],
                "stretch": rows["stretch"],
                "flags": pa.array([flags[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)], pa.binary()),
                "digests": pa.array([both[e - c : e].tobytes() if s else None for e, c, s in zip(ends, counts, split, strict=True)], pa.binary()),
            }
        )

    return run


def _digests(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.uint64).reshape(-1, 2)


def _ranges(ranges: int):
    """A shard's digests in order, once each, cut into ranges of the first."""

    def run(rows: pa.Table) -> pa.Table:
        own = np.unique(_digests(rows["digests"].to_pylist()), axis=0)
        bounds = (np.arange(1, ranges, dtype=np.float64) * (2.0**64 / ranges)).astype(np.uint64)
        cuts = [0, *np.searchsorted(own[:, 0], bounds).tolist(), len(own)]
        found = [(r, own[a:b].tobytes()) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        return pa.table(
            {
                "shard": pa.array([rows["shard"][0].as_py()] * len(found), pa.int64()),
                "part": pa.array([r for r, _ in found], pa.int32()),
                "digests": pa.array([d for _, d in found], pa.binary()),
            }
        )

    return run


def _merge(rows: pa.Table) -> pa.Table:
    """The digests of one range that several shards have, for each of them."""
    runs = [_digests([c]) for c in rows["digests"].to_pylist()]
    every = np.concatenate(runs)
    every = every[np.lexsort((every[:, 1], every[:, 0]))]
    again = np.unique(every[1:][(every[1:] == every[:-1]).all(1)], axis=0)
    found = [own[_among(own, again)].tobytes() for own in runs]
    return pa.table({"shard": rows["shard"], "digests": pa.array(found, pa.binary())})


def _among(own: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of ``own`` are in the sorted ``found``, by binary search."""
    if not len(found):
        return np.zeros(len(own), bool)
    at = np.minimum(np.searchsorted(found[:, 0], own[:, 0]), len(found) - 1)
    return (found[at] == own).all(1)


def _mark(rows: pa.Table, found: pa.Table) -> pa.Table:
    """A shard's stretches with the windows flagged that other shards have, too."""
    again = _digests(found["digests"].to_pylist())
    again = again[np.lexsort((again[:, 1], again[:, 0]))]
    flags = []
    for f, d in zip(rows["flags"].to_pylist(), rows["digests"].to_pylist(), strict=True):
        flags.append((np.frombuffer(f, bool) | _among(_digests([d]), again)).tobytes())
    return pa.table({"anchor": rows["anchor"], "stretch": rows["stretch"], "flags": pa.array(flags, pa.binary())})


_COVER = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))


def _cover(width: int):
    """Flags of windows to the byte ranges that they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cell in columns(batch, "flags")[0].to_pylist():
                edge = np.diff(np.concatenate([[0], np.frombuffer(cell, np.int8), [0]]))
                begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + width - 1
                out.append([{"b": int(b), "e": int(e)} for b, e in zip(begins, ends, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [*columns(batch, "anchor", "stretch"), pa.array(out, _COVER)], names=["anchor", "stretch", "cover"]
            )

    return run


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _cut(kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            sizes, spans, rest = [], [], []
            for text, covers in zip(texts, columns(batch, "covers_")[0].to_pylist(), strict=True):
                found = sorted((c["begin"] + x["b"], c["begin"] + x["e"]) for c in covers or () for x in c["cover"])
                own, left, at = [], [], 0
                for b, e in found:
                    if own and b <= own[-1]["end"]:
                        own[-1]["end"] = max(own[-1]["end"], e)
                    else:
                        own.append({"begin": b, "end": e})
                for s in own:
                    left.append(text[at : s["begin"]])
                    at = s["end"]
                left.append(text[at:])
                sizes.append(len(text))
                spans.append(own)
                rest.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [*columns(batch, *kept), pa.array(sizes, pa.int64()), pa.array(spans, _SPANS), pa.array(rest, pa.binary())],
                names=[*kept, "n_bytes", "spans", "kept"],
            )

    return released(run)


def repeated_spans(docs: DataFrame, width: int = 400) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) with n_bytes, spans
    (array of [begin, end) byte ranges to remove, apart from each other) and
    kept (binary: the other bytes); columns of these names are replaced.

    A byte goes if some ``width``-byte string that covers it also starts
    elsewhere, in another row or in the same one; matches never cross rows and
    are judged on the input. A null text is empty. Repeated rows are copies of
    each other. Texts of fewer bytes than ``width`` stay whole. An empty table
    gives no rows.
    """
    ship(docs.sparkSession)
    given = opened(docs.columns, "doc_id", "text", but=("n_bytes", "spans", "kept"))
    docs = sealed(docs, "doc_id", "text")
    named = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    long_enough = named.where(F.octet_length("text") >= width).select("rid", "text")
    every = checkpointed(
        long_enough.mapInArrow(_find_stretches(width), "anchor long, stretch long, rid long, begin long, windows int")
    )
    # written first, so that adaptive execution can split the join at a hot anchor
    twice = checkpointed(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    every = checkpointed(every.join(twice, "anchor"))
    kinds = checkpointed(
        every.groupBy("anchor", "stretch")
        .agg(F.count("*").alias("n"), F.min(F.struct("rid", "begin", "windows")).alias("one"))
        .select("anchor", "stretch", "n", "one.rid", "one.begin", "one.windows")
    )
    whole = F.array(F.struct(F.lit(0).alias("b"), (F.col("windows") + width - 1).alias("e")))
    covers = kinds.where("n > 1").select("anchor", "stretch", whole.alias("cover"))

    mixed = checkpointed(
        kinds.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.col("windows") + width - 1).alias("size")).where("n > 1")
    )
    total = mixed.agg(F.sum("size")).first()[0]
    if total:
        shards = max(MIN_SHARDS, -(-total // SHARD_BYTES))
        parts = F.ceil(F.col("size") / HOT_BYTES)
        wanted = kinds.drop("n").join(mixed.select("anchor", parts.alias("parts")), "anchor")
        part = F.pmod(F.xxhash64("stretch", F.lit(3)), F.col("parts"))
        wanted = wanted.withColumn("shard", F.pmod(F.xxhash64("anchor", part), F.lit(shards))).withColumn("split", F.col("parts") > 1)
        wanted = wanted.groupBy("rid").agg(F.collect_list(F.struct("shard", "split", "anchor", "stretch", "begin", "windows")).alias("wanted"))
        cut = long_enough.join(wanted, "rid").mapInArrow(
            _cut_stretches(width), "shard long, split boolean, anchor long, stretch long, windows int, bytes binary"
        )
        sorted_ = checkpointed(
            cut.groupBy("shard").applyInArrow(
                _sort_shard(width), "shard long, split boolean, anchor long, stretch long, flags binary, digests binary"
            )
        )
        split = sorted_.where("split")
        flagged = sorted_.where("not split").select("anchor", "stretch", "flags")
        if not split.isEmpty():
            runs = split.select("shard", "digests").groupBy("shard").applyInArrow(_ranges(shards), "shard long, part int, digests binary")
            found = runs.groupBy("part").applyInArrow(_merge, "shard long, digests binary")
            marked = split.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(_mark, "anchor long, stretch long, flags binary")
            flagged = flagged.union(marked)
        some = flagged.mapInArrow(_cover(width), "anchor long, stretch long, cover array<struct<b:int,e:int>>")
        covers = covers.union(some.where(F.size("cover") > 0))
    spans = (
        every.join(covers, ["anchor", "stretch"])
        .groupBy("rid")
        .agg(F.collect_list(F.struct("begin", "cover")).alias("covers_"))
    )
    out = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    found = named.join(spans, "rid", "left").mapInArrow(_cut(docs.columns), out)
    return found.select(*given, "n_bytes", "spans", "kept")
