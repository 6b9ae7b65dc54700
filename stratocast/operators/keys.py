"""Surrogate keys (K1): dense 1..N ids in key order, without a
single-partition window.

Plan: range-partition on the key and sort inside each partition (one
shuffle); tag each row with its partition and position; count rows per
partition (one row per partition reaches the next step, so its size is
bounded by the partition count, not the data); turn the counts into running
offsets; add offset + position. The tagged rows are checkpointed to the
shared checkpoint folder first, so the count and the final pass see the same
partitions even if an executor is lost or AQE re-plans between them.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratocast.session import checkpoint_root
from stratocast.sources.publish import partitions, read_current, recover, replace_partitions

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def with_dense_id(df: DataFrame, order_cols: Sequence[str], id_col: str = "id", partitions: int | None = None) -> DataFrame:
    """Prepend ``id_col``: 1 for the smallest key, N for the largest."""
    spark = df.sparkSession
    # Tests and local runs without a configured shared folder get a scratch one.
    if spark.sparkContext.getCheckpointDir() is None:
        checkpoint_root(spark, fallback=tempfile.mkdtemp(prefix="stratocast-ckpt-"))
    # A deterministic row hash as the last key spreads rows that tie on the
    # order key over several range partitions (a key holding a third of all
    # rows is not one task) and makes the order among ties repeatable.
    salted = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    cols = [*order_cols, "_tie"]
    ranged = salted.repartitionByRange(partitions, *cols) if partitions else salted.repartitionByRange(*cols)
    tagged = (
        ranged.sortWithinPartitions(*cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(F.col("_mid"), _POSITION_BITS))
        .withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_part"), _POSITION_BITS))
        .drop("_mid")
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset"))
    # one row per partition: a bounded broadcast
    out = tagged.join(F.broadcast(offsets), "_part")
    return out.select((F.col("_offset") + F.col("_pos") + F.lit(1)).alias(id_col), *df.columns)


def store_ranked(df: DataFrame, path: str, order_cols: Sequence[str], part: str = "date", replaced: Sequence = ()) -> None:
    """Write the rows of some values of ``part`` (a date) with their places in
    ``order_cols`` within it, in place of what the table at ``path`` had for
    these values and for ``replaced``. The number of rows of a value stands in
    its partition's name, ``<part>=.../rows=...``, and is the offset index of
    ``read_dense``: a rerun of one day writes that day alone and renumbers all
    days after it."""
    spark = df.sparkSession
    placed = with_dense_id(df, [part, *order_cols], "_id")
    spans = placed.groupBy(part).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("rows"))
    # written with few rows a value: the sizes stay as they were counted
    ranked = placed.join(spans, part).withColumn("place", F.col("_id") - F.col("_first") + 1).drop("_id", "_first")
    recover(spark, path)
    values = {str(r[part]) for r in spans.select(part).collect()} | {str(v) for v in replaced}
    gone = [p for p in partitions(spark, path, 2) if p.split("/")[0].removeprefix(f"{part}=") in values]
    write = lambda to: ranked.hint("rebalance", part).write.partitionBy(part, "rows").parquet(to)
    replace_partitions(spark, path, [part, "rows"], write, gone)


def read_dense(spark, path: str, id_col: str = "id", part: str = "date") -> DataFrame:
    """The stored rows with their dense ids, 1..N in the order of ``part`` and of
    the places within: the place plus the rows of all values before, which the
    partitions' names tell."""
    recover(spark, path)
    offsets, total = [], 0
    for p in sorted(partitions(spark, path, 2)):
        value, rows = (x.split("=", 1)[1] for x in p.split("/"))
        offsets.append((value, total))
        total += int(rows)
    stored = read_current(spark, path, [part, "rows"])
    # one row for each value of the partition column, days at most
    index = spark.createDataFrame(offsets, "_value string, _offset long")
    out = stored.join(F.broadcast(index), F.col(part).cast("string") == F.col("_value"))
    columns = [c for c in stored.columns if c not in ("place", "rows")]
    return out.select((F.col("_offset") + F.col("place")).alias(id_col), *[F.col(f"`{c}`") for c in columns])
