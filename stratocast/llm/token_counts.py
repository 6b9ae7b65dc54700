"""Token counts: an exact histogram of encoded lengths and what its suffix sums say.

Documents are encoded where they are read and summed by encoded length, partly
before the shuffle, so a common length is no hot key. Everything else comes
from the histogram: with the sums over all lengths of at least L, the total
kept under a context limit c with L the first length above c is
``total - (tokens of lengths >= L) + c * (documents of lengths >= L)``.

The running sums are made in two levels, within blocks of ``BLOCK`` lengths and
over the blocks' sums, so no single task orders all lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encode
from .common import checkpointed

BLOCK = 1024


def length_histogram(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(n_tokens, n_docs): one row per encoded length of the texts of ``docs``.
    Null and empty texts have length 0; repeated rows count each time; an empty
    table gives no rows."""
    counted = encode(docs.select("text"), ranks, pattern).select(F.size("ids").cast("long").alias("n_tokens"))
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length: n_docs and tokens of that length, docs_from and
    tokens_from (of this and all greater lengths), truncated_total (tokens that
    a context limit of this length leaves), docs_total, tokens_total, and
    rank_from and rank_to, the places of its documents by length from 1 on.
    The histogram, a row for each length, is written once for its two uses.
    """
    rows = checkpointed(histogram).select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / BLOCK).alias("block")
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(everything).alias("docs_total"),
        F.sum("t").over(everything).alias("tokens_total"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    docs_from = F.col("docs_above") + F.sum("n_docs").over(inside)
    tokens_from = F.col("tokens_above") + F.sum("tokens").over(inside)
    summed = rows.join(blocks, "block").select(
        "n_tokens", "n_docs", "tokens", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "docs_total", "tokens_total"
    )
    shorter = F.col("tokens_total") - F.col("tokens_from")
    return summed.select(
        "n_tokens",
        "n_docs",
        "tokens",
        "docs_from",
        "tokens_from",
        (shorter + F.col("n_tokens") * F.col("docs_from")).alias("truncated_total"),
        "docs_total",
        "tokens_total",
        (F.col("docs_total") - F.col("docs_from") + 1).alias("rank_from"),
        (F.col("docs_total") - F.col("docs_from") + F.col("n_docs")).alias("rank_to"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least this share of the
    documents doesn't exceed."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    place = F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("docs_total")))
    rows = sums.select("n_tokens", "rank_from", "rank_to", "docs_total", wanted)
    return rows.where((place >= F.col("rank_from")) & (place <= F.col("rank_to"))).select("share", "n_tokens")


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, total): tokens left if every document is cut at the limit."""
    rows = sums.select("*", F.explode(F.array(*[F.lit(int(c)).cast("long") for c in limits])).alias("context_limit"))
    part = F.least("n_tokens", "context_limit") * F.col("n_docs")
    return rows.groupBy("context_limit").agg(F.sum(part).alias("total"))
