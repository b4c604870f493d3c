"""Exact length histogram of documents in tokens and what follows from its suffix sums.

A row of the histogram per distinct encoded length is all that totals, quantiles and
truncated totals for any context limit need; texts are read once.

Null and empty texts have length 0.  Repeated rows count as often as they occur, an empty
table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import column, map_rows, prefix_sums, stored
from geoloom.llm.tokens import BYTE_BPE, encoder


def lengths(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """(length) of every document."""

    def make():
        encode = encoder(tokenizer)
        return lambda texts: [(len(encode(t)) // 4,) for t in texts]

    return map_rows(docs.select(column(docs, "text").alias("text")), make, "length bigint")


def histogram(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """(length, documents), stored: a row per distinct length stands for all texts from here on."""
    return stored(lengths(docs, tokenizer).groupBy("length").agg(F.count("*").alias("documents")), "lengths")


def curve(hist: DataFrame) -> DataFrame:
    """Per distinct length, taken as a context limit: the documents and tokens up to it and beyond it.

    ``truncated_tokens`` is the total when every document is cut to ``length`` tokens,
    ``lost_tokens`` what that cuts off, ``quantile`` the share of documents no longer.
    """
    rows = hist.withColumn("tokens", F.col("length") * F.col("documents"))
    total = rows.agg(F.sum("documents").alias("_docs"), F.sum("tokens").alias("_tokens"))
    sums = prefix_sums(rows, "length", {"_d": "documents", "_t": "tokens"}).crossJoin(F.broadcast(total))
    at_most = F.col("_d") + F.col("documents")
    longer = F.col("_docs") - at_most
    kept = F.col("_t") + F.col("tokens") + F.col("length") * longer
    return sums.select(
        "length", "documents", "tokens", at_most.alias("documents_at_most"), longer.alias("documents_longer"),
        (F.col("_tokens") - F.col("_t") - F.col("tokens")).alias("tokens_longer"),
        kept.alias("truncated_tokens"), (F.col("_tokens") - kept).alias("lost_tokens"),
        (at_most / F.col("_docs")).alias("quantile"),
    )


def truncated_total(curve_df: DataFrame, limit: int) -> DataFrame:
    """One row (total_tokens) for any context limit, also one that no document has."""
    below = curve_df.filter(F.col("length") <= limit).agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("documents"), F.lit(0)).alias("d")
    )
    total = curve_df.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("n"))
    return below.crossJoin(total).select((F.col("t") + (F.col("n") - F.col("d")) * limit).alias("total_tokens"))


def length_quantiles(curve_df: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least ``share`` of the documents do not exceed."""
    picks = [F.min(F.when(F.col("quantile") >= p, F.col("length"))).alias(f"_{i}") for i, p in enumerate(shares)]
    row = F.array(*[F.struct(F.lit(float(p)).alias("share"), F.col(f"_{i}").alias("length")) for i, p in enumerate(shares)])
    return curve_df.agg(*picks).select(F.explode(row).alias("q")).select("q.*")
