"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe, decontaminate, minhash_dedup, suffix_dedup, toxicity
from .common import checkpointed, columns, opened, sealed, table
from .queries import bpe_digests


def _whole(docs: DataFrame) -> list[F.Column]:
    return opened(docs.columns, "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    scored = toxicity.score(sealed(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*_whole(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) one row stays, of the
    smallest id; rows of the same id, or without one, are rows of their own. Of
    rows of one id and text the one whose other columns come first stays.
    Documents without words are no duplicates, but of such rows of one id and
    text one stays."""
    near = minhash_dedup.grouped(docs, width=5, percent=80)
    keys = checkpointed(near.groupBy("root", "doc_id", "tid").agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tid", "copies")).alias("r")
    one = keys.where("n_shingles > 0").groupBy("root").agg(first).select("r.doc_id", "r.tid", "r.copies")
    blank = keys.where("n_shingles = 0").select("doc_id", "tid", F.lit(1).cast("long").alias("copies"))
    kept = one.union(blank).toDF("kept_id", "kept_tid", "copies")
    rows = sealed(docs, "doc_id", "text")
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_tid")))
    # texts are grouped only where an id has several copies of one
    once = rows.where("copies = 1").select("doc_id", "text", "others_")
    again = rows.where("copies > 1").groupBy("doc_id", "text").agg(F.min_by("others_", F.to_json(F.struct("others_"))).alias("others_"))
    return once.unionByName(again).select(*_whole(docs))


def _as_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([b.decode(errors="ignore") for b in columns(batch, "kept")[0].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*columns(batch, "doc_id", "others_"), texts], names=["doc_id", "others_", "text"])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes or more that occur again are cut out, the parts of
    characters at the cuts too; a text that is empty then has nothing of its own
    and goes, while a text that was null or empty before stays."""
    found = suffix_dedup.repeated_spans(sealed(docs, "doc_id", "text"), width=400)
    rest = found.where((F.octet_length("kept") > 0) | (F.col("n_bytes") == 0))
    whole = F.size("spans") == 0
    same = rest.where(whole).select(*_whole(docs))
    cut = rest.where(~whole).select("doc_id", "others_", "kept")
    schema = T.StructType([*cut.schema.fields[:2], T.StructField("text", T.StringType())])
    cut = cut.mapInArrow(_as_text, schema).select(*_whole(docs))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.unionByName(cut)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    found = decontaminate.contamination(sealed(docs, "doc_id", "text"), table(spark, sf_dir, "benchmark"), width=10)
    return found.where("not contaminated").select(*_whole(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to."""
    ranks, pattern = bpe.public_vocabulary()
    coded = bpe.encode(docs.select("doc_id", "text"), ranks, pattern).drop("text")
    return bpe_digests(bpe.decode(coded, ranks))
