"""Embedding near-duplicates: int8 tile products with a rigorous error bound.

A vector x of unit length is stored as s * q with whole numbers q of -127 to
127 and e = x - s * q. For two vectors

    x . y = s_x s_y (q_x . q_y) + (s_x q_x) . e_y + e_x . y,

so it differs from the quantised product by |s_x q_x| |e_y| + |e_x| at most,
which is known for each vector. Products of q are exact in float32 up to 1040
dimensions (float64 beyond). Only pairs whose quantised product plus this bound
reaches the threshold are computed again from the given components in double
precision, and that decides.

Equal vectors form a class, one vertex. The classes are dealt by hash into
blocks, and every pair of blocks is a tile, one small task: exact search over
all pairs, quadratic in the number of classes and bounded in memory. A tile
returns a row for each of its vertices with links, never the pairs: the number
of links (copies counted) and the smallest vertex of its part of the tile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, ship
from .components import components, smallest_ids

MIN_BLOCKS, MAX_BLOCK_ROWS = 24, 4096
_ROWS = 512  # of a product at a time
_PAIRS = 1 << 16  # recomputed at a time
_SLACK = 1e-5  # for float32 rounding of the scaled product


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows x -> (q, s, |s q|, |e|)."""
    s = np.abs(x).max(axis=1, initial=0, keepdims=True) / 127
    q = np.rint(x / s)
    return q, s[:, 0], np.linalg.norm(q * s, axis=1), np.linalg.norm(x - q * s, axis=1)


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float):
    """Blocks of (rows of a, rows of b) with cosine >= threshold."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    exact = np.float32 if a.shape[1] <= 1040 else np.float64
    (qa, sa, la, ea), (qb, sb, _, eb) = quantise(a / na[:, None]), quantise(b / nb[:, None])
    qb, right = np.ascontiguousarray(qb.astype(exact).T), (sb.astype(np.float32), eb.astype(np.float32))
    for i in range(0, len(a), _ROWS):
        rows = slice(i, i + _ROWS)
        most = qa[rows].astype(exact) @ qb
        most *= sa[rows, None].astype(exact)
        most *= right[0]
        most += la[rows, None].astype(np.float32) * right[1]
        p, q = np.nonzero(most >= (threshold - _SLACK - ea[rows])[:, None].astype(np.float32))
        p += i
        for j in range(0, len(p), _PAIRS):
            u, v = p[j : j + _PAIRS], q[j : j + _PAIRS]
            near = np.einsum("ij,ij->i", a[u], b[v]) / (na[u] * nb[v]) >= threshold
            yield u[near], v[near]


def _join(parent: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Union of p[i] and q[i] for all i, towards the smaller place."""
    while len(p):
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        p, q = parent[p], parent[q]
        apart = p != q
        p, q = p[apart], q[apart]
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))


def _tile(threshold: float, kind: str):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        rows = rows.sort_by([("block", "ascending"), ("vertex", "ascending")])
        vertex, copies, block = (rows[c].to_numpy() for c in ("vertex", "copies", "block"))
        x = np.stack([np.frombuffer(v, kind) for v in rows["vector"].to_pylist()]).astype(np.float64)
        # scaling by a power of two is exact and keeps squares finite
        x = x / np.exp2(np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
        cut = int((block == i).sum())
        off = 0 if i == j else cut
        links, parent = np.zeros(len(x), np.int64), np.arange(len(x))
        for p, q in close_pairs(x[:cut], x[off:], threshold):
            q = q + off
            if i == j:
                p, q = p[p < q], q[p < q]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            _join(parent, p, q)
        _join(parent, np.arange(len(x)), parent.copy())
        some = links > 0
        order = vertex[parent][some]
        return pa.table({"vertex": vertex[some], "links": links[some], "root": order})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``vectors`` (vec_id long, embedding array of numbers; others are
    ignored) -> vec_id, n_links, component_id, kept, one row per row.

    Rows are linked if their cosine, in double precision, is at least
    ``threshold``. n_links counts the other rows linked directly; component_id
    is the smallest vec_id reachable by links, itself included; kept is vec_id
    = component_id.

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing, and so do vectors of different lengths. Rows that share
    a vec_id stay rows of their own. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = "<f4" if "array<float>" in dict(vectors.dtypes)["embedding"] else "<f8"
    element = "float" if kind == "<f4" else "double"
    x = F.col("embedding").cast(f"array<{element}>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    good = x.isNotNull() & F.forall(x, finite) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(good, F.xxhash64(x, F.size(x))).alias("vertex"), F.when(good, x).alias("x")
    )
    classes = checkpointed(
        rows.where("vertex is not null").groupBy("vertex").agg(F.count("*").alias("copies"), F.first("x").alias("x"))
    )
    packed = classes.mapInArrow(_pack(kind), "vertex long, copies long, size long, vector binary")
    blocks = max(MIN_BLOCKS, -(-classes.count() // MAX_BLOCK_ROWS))
    own = F.pmod(F.xxhash64("vertex", F.lit(7)), F.lit(blocks)).cast("int")
    dealt = packed.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select(
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "size", "vertex", "copies", "vector", "block"
    )
    found = checkpointed(
        dealt.groupBy("i", "j", "size").applyInArrow(_tile(threshold, kind), "vertex long, links long, root long")
    )
    links = found.groupBy("vertex").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("vertex").alias("a"), F.col("root").alias("b")))
    counted = classes.select("vertex", "copies").join(links, "vertex", "left").select(
        "vertex", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    named = rows.select("vec_id", F.coalesce("vertex", F.xxhash64("vec_id", F.lit("alone"))).alias("vertex"))
    placed = smallest_ids(named.join(counted, "vertex", "left"), roots, "vec_id")
    return placed.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _pack(kind: str):
    def run(batches):
        for batch in batches:
            x = batch.column(batch.schema.get_field_index("x"))
            cells = [np.asarray(v, kind).tobytes() for v in x.to_pylist()]
            sizes = pa.array([len(c) // np.dtype(kind).itemsize for c in cells], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, pa.array(cells, pa.binary())], names=["vertex", "copies", "size", "vector"]
            )

    return run
