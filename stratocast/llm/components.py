"""Connected components by repeated contraction, without collecting anything.

Each round every vertex moves to the smallest vertex of its neighbourhood, by
number in even rounds and by a hash that changes with the round in odd ones
(so that a long path with sorted numbers still shrinks by a constant factor).
Edges are renamed accordingly, loops and doubles go, and the round's moves are
applied to the labels. The last few edges are finished in one step. All others are partially aggregated groupings and
equi-joins with one row per key on one side, which adaptive execution splits
when a key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, ship


def _pairs(df: DataFrame, a, b) -> DataFrame:
    pair = df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return pair.where("a < b").distinct()


#: As few edges as this are finished in one task (80 kB); more go another round.
LAST_EDGES = 5_000


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    roots = [top(x) for x in list(parent)]
    yield pa.RecordBatch.from_arrays([pa.array(list(parent), pa.int64()), pa.array(roots, pa.int64())], names=["u", "r"])


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (vertex, root): one row per vertex that has
    an edge to another; vertices share a root exactly if they are connected.

    Loops and repeated or reversed edges change nothing; edges with a null end
    are ignored; no edges give no rows.
    """
    ship(edges.sparkSession)
    edges = checkpointed(_pairs(edges, F.col("a"), F.col("b")))
    labels, turn, left = None, 0, edges.count()
    while left or labels is None:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        if left <= LAST_EDGES:
            moves = edges.coalesce(1).mapInArrow(_finish, "u long, r long")
        elif turn % 2 == 0:
            moves = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("r"))
        else:
            order = lambda c: F.xxhash64(F.col(c), F.lit(turn))
            moves = (
                both.groupBy("u")
                .agg(F.min(F.struct(order("v").alias("o"), F.col("v").alias("v"))).alias("m"))
                .select("u", F.when(order("u") < F.col("m.o"), F.col("u")).otherwise(F.col("m.v")).alias("r"))
            )
        moves = checkpointed(moves)
        if labels is None:
            labels = moves.select(F.col("u").alias("vertex"), F.col("r").alias("root"))
        else:
            labels = checkpointed(
                labels.join(moves, labels.root == moves.u, "left").select("vertex", F.coalesce("r", "root").alias("root"))
            )
        if left <= LAST_EDGES:
            break
        one = moves.select(F.col("u").alias("a"), F.col("r").alias("ra"))
        other = moves.select(F.col("u").alias("b"), F.col("r").alias("rb"))
        edges = checkpointed(_pairs(edges.join(one, "a").join(other, "b"), F.col("ra"), F.col("rb")))
        turn, left = turn + 1, edges.count()
    return labels


def smallest_ids(rows: DataFrame, roots: DataFrame, id_column: str) -> DataFrame:
    """``rows`` (a long ``vertex`` and others) with component_id, the smallest
    ``id_column`` of their component, and the component's root instead of
    ``vertex``; ``roots`` is what ``components`` returns."""
    placed = rows.join(roots, "vertex", "left").withColumn("part_", F.coalesce("root", "vertex")).drop("root")
    lowest = placed.groupBy("part_").agg(F.min(id_column).alias("component_id"))
    return placed.join(lowest, "part_").drop("vertex").withColumnRenamed("part_", "root")
