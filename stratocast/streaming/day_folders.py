"""Day folders as a stream (ST1, ST2).

ST1: a text stream over ``<raw_root>/input_*/<attribute>/`` picks up the lines of
files not processed yet; the stream's checkpoint (in the shared folder named by
``spark.checkpoint.dir``) replaces the text ledger, and
``trigger(availableNow=True)`` processes everything that has arrived, then stops,
which is the daily batch cadence.

ST2: a micro-batch holds whole files, so each line finds its file's header in
the same batch. ``foreachBatch`` pairs the cells with the headers' names, stages
the readings by file, and recomputes the daily tables of every day the new rows
touch from **all** staged rows of those days. A late reading therefore corrects
its day, a batch replayed after a failure replaces its files' partitions, and
every file is read once. No file name comes to the driver.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast.plans import incremental as INC
from stratocast.schemas import ATTRIBUTES
from stratocast.session import checkpoint_root

#: New files taken per micro-batch.
MAX_FILES_PER_TRIGGER = 1000


def arrivals(
    spark: SparkSession,
    raw_root: str,
    attributes: Sequence[str] = ATTRIBUTES,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """ST1: streaming DataFrame of the lines of new CSV files: ``(value, file,
    block)``, block being where the line's split begins in the file."""
    stream = (
        spark.readStream.format("text")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(os.path.join(raw_root, "input_*", "{" + ",".join(sorted(attributes)) + "}"))
    )
    return stream.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def process_batch(spark: SparkSession, layout: INC.Layout, batch: DataFrame) -> list[_dt.date]:
    """ST2 for one micro-batch: stage its files' readings and recompute every
    touched day. Returns the recomputed days."""
    # kept for the batch's several uses, so that the files are read once
    lines = batch.where(F.trim("value") != "").withColumn("at", F.monotonically_increasing_id()).persist()
    try:
        attribute = F.element_at(F.split("file", "/"), -2)
        load_day = F.to_date(F.regexp_extract("file", r"input_(\d{4}-\d{2}-\d{2})/", 1))
        # a row for each attribute, and for each day's city file
        found = lines.groupBy(attribute.alias("a"), F.when(attribute == "city_attributes", load_day).alias("d")).agg(F.count("*").alias("n")).collect()
        for r in sorted((r for r in found if r.d is not None), key=lambda r: r.d):
            INC.load_cities(spark, layout, r.d)
        attributes = sorted({r.a for r in found} - {"city_attributes"})
        if not attributes:
            return []
        days = sorted(INC.stage_lines(spark, layout, lines.where(attribute != "city_attributes"), attributes))
        INC.aggregate_days(spark, layout, days, attributes)
        INC.refresh_facts(spark, layout, days)
        return days
    finally:
        lines.unpersist()


def run_available(
    spark: SparkSession,
    layout: INC.Layout,
    name: str = "day_folders",
    attributes: Sequence[str] = ATTRIBUTES,
    checkpoint: str | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> list[list[_dt.date]]:
    """Process every folder that has arrived since the last run, then stop.
    Returns the days recomputed by each micro-batch."""
    ckpt = checkpoint or os.path.join(checkpoint_root(spark), "streams", name)
    done: list[list[_dt.date]] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        done.append(process_batch(spark, layout, batch))

    q = (
        arrivals(spark, layout.raw_root, attributes, max_files_per_trigger)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return done
