"""Reading tables, reliable checkpoints and byte-bounded batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task holds as Python objects at a time.
SLICE_BYTES = 4 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this folder's modules to the executors, once per application, so
    that their Python workers can import what tasks run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(os.path.dirname(here))
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "llm_tasks.zip")
    with zipfile.ZipFile(path, "w") as out:
        top = os.path.dirname(here)
        for folder in (top, here):
            for name in sorted(os.listdir(folder)):
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; one
    of its own only where that is unset and the master is this process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, so that a lost
    executor costs no recomputation of what came before."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def sealed(df: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` of ``df`` and ``others_``, a struct of all others, so
    that no other column's name can meet one that an operator makes."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(c for c in df.columns if c not in names)]
    return df.select(*names, (F.struct(*others) if others else F.lit(None).cast("boolean")).alias("others_"))


def opened(columns_: Sequence[str], *names: str, but: Sequence[str] = ()) -> list[Column]:
    """The columns ``columns_`` of a frame that was ``sealed`` with ``names``, but
    for those in ``but``."""
    others = {c: i for i, c in enumerate(c for c in columns_ if c not in names)}
    return [F.col(c) if c in names else F.col("others_")[f"c{others[c]}"].alias(c) for c in columns_ if c not in but]


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch cut into runs of rows of about ``limit`` text bytes (one row
    at least), with the texts as UTF-8 bytes; a null text is empty."""
    for batch in batches:
        raw = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        at, start, held, texts = 0, 0, 0, []
        for at in range(batch.num_rows):
            value = raw[at].as_py() or b""
            texts.append(value)
            held += len(value)
            if held >= limit:
                yield batch.slice(start, at + 1 - start), texts
                start, held, texts = at + 1, 0, []
        if texts:
            yield batch.slice(start, batch.num_rows - start), texts


def released(run):
    """``run`` (batches to batches), after which what it held goes back to the
    system: Python workers serve many tasks, and else keep the memory of the
    largest one."""

    def batches_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return batches_


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def columns(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]
