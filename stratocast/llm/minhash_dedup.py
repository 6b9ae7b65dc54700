"""Near-duplicate texts: one-permutation MinHash, optimal densification, banded
buckets and star-shaped candidate edges.

1. A text's set holds the hashes of its distinct w-word shingles. Texts with
   equal sets form a class, which is one vertex from here on.
2. One permutation: the hash space is cut into ``BINS`` bins; a bin's value is
   the smallest hash in it. An empty bin takes the value of the first filled
   bin on its own random walk (optimal densification), so bins agree with
   probability close to the Jaccard similarity however short the text.
3. ``BANDS`` bands of ``ROWS`` bins: classes with an equal band share a bucket.
   At similarity 0.8 a pair shares none with probability (1 - 0.8**4)**32,
   about 5e-8.
4. In each bucket star edges from one hub are candidates, so a bucket of n
   classes gives n - 1 pairs. Each pair is confirmed on the full sets. Then
   components are formed, and buckets that still hold several components get
   another hub, drawn by hashes, as long as a turn links many classes.
5. Buckets that still hold several components after that are finished exactly:
   salted blocks of their members compare all pairs of different components on
   the full sets and give a link for each two components that meet, not a row
   for each pair. So classes that share a bucket and are similar always end in
   one component.

Hot keys: classes take out copies before any bucket is formed; bucket hubs come
from a partially aggregated minimum and are joined back (one row per bucket on
that side), so that a bucket or hub with a third of all rows can be split;
buckets are finished in pairs of slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, columns, released, ship, slices
from .components import components, smallest_ids

BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
PAYS = 0.05  # links found a class in open buckets, for which another turn of hubs is taken
SLICE, SLICE_SHINGLES = 512, 1_000_000  # classes and shingles of a slice of a bucket
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles;
    of fewer words, the whole sequence counts as one shingle; none of no words."""
    words = [t.lower().split() for t in texts]  # bytes: A-Z only, split at \\x20 \\x09-\\x0D
    flat = [w for ws in words for w in ws]
    if not flat:
        return [np.empty(0, np.uint64)] * len(texts)
    cells = np.empty(len(flat), object)
    cells[:] = flat
    hashes = pd.util.hash_array(cells, categorize=False).astype(np.uint64)
    rolled = hashes.copy()
    for i in range(1, min(width, len(flat))):
        rolled[: len(flat) - i] = rolled[: len(flat) - i] * _P + hashes[i:]
    out, at = [], 0
    for ws in words:
        n = len(ws)
        if n >= width:
            out.append(np.unique(mix(rolled[at : at + n - width + 1])))
        elif n:
            h = np.uint64(n)
            with np.errstate(over="ignore"):
                for x in hashes[at : at + n]:
                    h = h * _P + x
            out.append(mix(np.array([h], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


_EDGES = (np.arange(BINS, dtype=np.uint64) * np.uint64(2**64 // BINS)).astype(np.uint64)


def _walk(step: int) -> np.ndarray:
    """The bin that each bin looks at in a step of its random walk."""
    with np.errstate(over="ignore"):
        return (mix(np.arange(BINS, dtype=np.uint64) * _P + np.uint64(step)) % np.uint64(BINS)).astype(np.intp)


_WALKS = [_walk(s) for s in range(1, 65)]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The densified one-permutation sketch of a non-empty sorted set."""
    first = np.searchsorted(hashes, _EDGES)
    end = np.append(first[1:], len(hashes))
    filled = end > first
    bins = hashes[np.minimum(first, len(hashes) - 1)]
    empty, step = np.flatnonzero(~filled), 0
    source = np.arange(BINS)
    while len(empty):
        walk = _WALKS[step] if step < len(_WALKS) else _walk(step + 1)
        to = walk[empty]
        hit = filled[to]
        source[empty[hit]] = to[hit]
        empty, step = empty[~hit], step + 1
    return bins[source]


_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def bands_of(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, different bands never meeting by design."""
    rows = sketch(hashes).reshape(BANDS, ROWS)
    key = _SALT.copy()
    for i in range(ROWS):
        key = mix(key * _P + rows[:, i])
    return key


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            ids, tids = columns(batch, "doc_id", "tid")
            sizes, keys, bands = [], [], []
            for s in shingle_sets(texts, width):
                sizes.append(len(s))
                if len(s):
                    keys.append(mix(s.sum(keepdims=True) + np.array([len(s)], np.uint64) * _P)[0].astype(np.int64))
                    bands.append(bands_of(s).astype(np.int64))
                else:
                    keys.append(None)
                    bands.append([])
            yield pa.RecordBatch.from_arrays(
                [ids, tids, pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "tid", "n_shingles", "vertex", "bands"],
            )

    return released(run)


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            sets = [s.astype(np.int64) for s in shingle_sets(texts, width)]
            yield pa.RecordBatch.from_arrays(
                [*columns(batch, "vertex"), pa.array(sets, pa.list_(pa.int64()))], names=["vertex", "shingles"]
            )

    return released(run)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least ``percent`` % in common."""
    one = sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("sa"))
    other = sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(one, "a").join(other, "b").where(100 * both >= percent * union).select("a", "b")


def linked(sets: list[np.ndarray], parts: np.ndarray, sides: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Places of similar sets that join all parts that have any similar sets in
    common; with ``sides`` (0 or 1 for each set) only pairs of both sides count."""
    flat, codes = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    often = np.bincount(codes) > 1
    # tokens of one set only are in no intersection
    tokens = [c[often[c]] for c in np.split(codes, ends[:-1])]
    shared = np.array([len(t) for t in tokens])
    order = np.argsort(sizes, kind="stable")
    # and a set with too many of them is like no other
    order = order[100 * shared[order] >= percent * sizes[order]]
    root, out = parts.copy(), []
    held = np.zeros(len(flat), bool)
    for t, x in enumerate(order):
        first = np.searchsorted(100 * sizes[order[:t]], percent * sizes[x])
        near = order[first:t]
        near = near[root[near] != root[x]]
        if sides is not None:
            near = near[sides[near] != sides[x]]
        if not len(near):
            continue
        held[tokens[x]] = True
        starts = np.concatenate([[0], np.cumsum(shared[near])[:-1]])
        both = np.add.reduceat(held[np.concatenate([tokens[y] for y in near])].astype(np.int64), starts)
        held[tokens[x]] = False
        for y in near[100 * both >= percent * (sizes[near] + sizes[x] - both)]:
            if root[y] != root[x]:
                out.append((int(x), int(y)))
                root[root == root[y]] = root[x]
    return out


def _tile(percent: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        vertex = table["vertex"].to_numpy()
        sets = [np.asarray(s.values) for s in table["shingles"].combine_chunks()]
        sides = None if key[1].as_py() == key[2].as_py() else (table["slice"].to_numpy() == key[2].as_py()).astype(int)
        found = linked(sets, table["part"].to_numpy(), sides, percent)
        ends = [pa.array([int(vertex[p[i]]) for p in found], pa.int64()) for i in (0, 1)]
        return pa.Table.from_arrays(ends, names=["a", "b"])

    return run


def _finished(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all components with similar classes in a bucket of
    ``members`` (bucket, vertex, n_shingles, part)."""
    # buckets of the same members are compared once
    mark = lambda i: F.bit_xor(F.xxhash64("vertex", F.lit(i)))
    counts = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("held"), mark(1).alias("x"), mark(2).alias("y"))
    slices_ = F.ceil(F.greatest(F.col("n") / SLICE, F.col("held") / SLICE_SHINGLES)).cast("int")
    once = checkpointed(counts.groupBy("n", "x", "y").agg(F.min(F.struct("bucket", slices_.alias("k"))).alias("r")).select("r.bucket", "r.k"))
    own = F.pmod(F.xxhash64("vertex", F.lit("slice")), F.col("k")).cast("int")
    tiles = (
        members.join(once, "bucket")
        .select("bucket", "vertex", "part", own.alias("slice"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("to"))
        .select("bucket", F.least("slice", "to").alias("low"), F.greatest("slice", "to").alias("high"), "slice", "vertex", "part")
    )
    tiles = checkpointed(tiles)
    return tiles.join(sets, "vertex").groupBy("bucket", "low", "high").applyInArrow(_tile(percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text string; other columns are
    ignored): doc_id, n_shingles, component_id, kept. doc_id keeps its type, and
    ids are compared as that type is.

    Words are the maximal runs free of ASCII white space, A-Z lower-cased.
    Rows are linked if 100 * common >= ``percent`` * union over their sets of
    distinct ``width``-word shingles. component_id is the smallest doc_id
    reachable by links (itself included); kept is doc_id = component_id.

    Null, empty and blank texts have no shingles and link with nothing. Fewer
    words than ``width`` form one shingle. Rows that share a doc_id stay rows
    of their own. A null doc_id takes part but is never a component_id unless
    the component has no other, and is then kept. An empty table gives none.
    """
    return grouped(docs, width, percent).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``near_duplicates`` with tid, the hash of the row's text, and
    root, which the rows of a component share also where component_id is null."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tid"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketched = checkpointed(
        rows.mapInArrow(_sketches(width), f"doc_id {kind}, tid long, n_shingles long, vertex long, bands array<long>")
    )
    classes = checkpointed(
        sketched.where("vertex is not null")
        .groupBy("vertex")
        .agg(F.min(F.struct("doc_id", "tid", "n_shingles", "bands")).alias("r"))
        .select("vertex", F.col("r.doc_id").alias("doc_id"), "r.tid", "r.n_shingles", "r.bands")
    )
    size = F.col("n_shingles")
    members = classes.select("vertex", size, F.explode("bands").alias("bucket"))
    # written first, so that adaptive execution can split the join at a hot bucket
    shared = checkpointed(members.groupBy("bucket").agg(F.count("*").alias("in_bucket")).where("in_bucket > 1"))
    members = checkpointed(members.join(shared, "bucket"))
    # a class that shares many buckets with many others is near the middle of its group
    weights = members.groupBy("vertex").agg(F.sum("in_bucket").alias("weight"))
    members = checkpointed(
        members.drop("in_bucket").join(weights, "vertex").select("bucket", "vertex", size, "weight", F.col("vertex").alias("part"))
    )

    links, sets, turn = None, None, 0
    while True:
        # the first hub of a bucket is its most central class, so that buckets share
        # hubs; later ones are drawn, the central ones oftener
        drawn = (F.shiftrightunsigned(F.xxhash64("vertex", F.lit(turn)), 11) + 1) / F.lit(2.0**53)
        rank = -F.log(drawn) / F.col("weight") if turn else -F.col("weight").cast("double")
        hubs = (
            members.groupBy("bucket")
            .agg(
                F.min("part").alias("low"),
                F.max("part").alias("high"),
                F.min(F.struct(rank.alias("rank"), "vertex", "part", size)).alias("h"),
            )
            .where("low < high")
            .select("bucket", "h")
        )
        hub_n = F.col("h.n_shingles")
        near_size = 100 * F.least(size, hub_n) >= percent * F.greatest(size, hub_n)
        near = members.join(hubs, "bucket").where(F.col("part") != F.col("h.part")).where(near_size)
        pairs = near.select(F.least("vertex", "h.vertex").alias("a"), F.greatest("vertex", "h.vertex").alias("b")).distinct()
        if sets is None:
            # sets of the classes in buckets only, from one text of each class
            wanted = members.select("vertex").distinct().join(classes.select("vertex", "doc_id", "tid"), "vertex")
            texts = rows.alias("t").join(
                wanted.alias("w"),
                F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.tid") == F.col("w.tid")),
            )
            sets = checkpointed(
                texts.select("w.vertex", "t.text")
                .mapInArrow(_full_sets(width), "vertex long, shingles array<long>")
                .dropDuplicates(["vertex"])
            )
        found = checkpointed(_confirmed(pairs, sets, percent))
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            roots = components(links)
            # only buckets that still hold several components go on
            placed = (
                members.drop("part")
                .join(roots, "vertex", "left")
                .select("bucket", "vertex", size, "weight", F.coalesce("root", "vertex").alias("part"))
            )
            parts = placed.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high"))
            open_ = checkpointed(parts.where("low < high").select("bucket"))
            members = checkpointed(placed.join(open_, "bucket"))
        if found.count() <= PAYS * members.select("vertex").distinct().count():
            break
        turn += 1
    found = checkpointed(_finished(members, sets, percent))
    if not found.isEmpty():
        links = found if links is None else links.union(found)
        roots = components(links)

    if links is None:
        roots = spark.createDataFrame([], "vertex long, root long")
    # a row without shingles is a component of its own
    own = F.coalesce("vertex", F.xxhash64("doc_id", F.lit("no shingles")))
    return smallest_ids(sketched.select("doc_id", "tid", "n_shingles", own.alias("vertex")), roots, "doc_id")
