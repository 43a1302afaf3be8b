"""Exact length histogram: documents by encoded length, and suffix sums that answer every context limit.

The encoder's lengths are counted map-side; only (length, documents) pairs are shuffled. Suffix sums are taken in two
levels (blocks of lengths, then the sum of the blocks above), so that no task holds all lengths. For a limit L that is
itself a length in the table, `truncated_tokens` is the corpus's size when every document is cut to L tokens; for other
limits `total_at` reads the next longer length's suffix. Null and empty texts have length 0 and are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .op3_bpe import VOCABULARY, token_counts
from .shared import kept, table

BLOCK = 4096


def histogram(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """n_tokens, n_docs: how many documents have each encoded length."""
    return token_counts(docs, text=text, vocabulary=vocabulary).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """A row for each length: documents and tokens at this length or above, documents below, and the total cut to it."""
    held = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    sums = held.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    up = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = sums.select(
        "block",
        F.coalesce(F.sum("d").over(up), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(up), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    own = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = held.join(above, "block").select(
        "n_tokens",
        "n_docs",
        (F.col("docs_above") + F.sum("n_docs").over(own)).alias("docs_at_least"),
        (F.col("tokens_above") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(own)).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        "all_docs",
        "all_tokens",
    )


def total_at(sums: DataFrame, limit: int) -> DataFrame:
    """One row: tokens in all when every document is cut to `limit`; none for a table without documents."""
    next_ = sums.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").limit(1)
    whole = sums.agg(F.max("all_tokens").alias("all_tokens"))
    cut = next_.select((F.col("all_tokens") - F.col("tokens_at_least") + F.lit(limit) * F.col("docs_at_least")).alias("cut"))
    return whole.select("all_tokens").unionByName(cut.select(F.col("cut").alias("all_tokens"))).agg(F.min("all_tokens").alias("total_tokens"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the least length that a share q of the documents does not exceed; null for a table without documents."""
    return sums.filter(F.col("docs_at_most") >= F.ceil(F.lit(q) * F.col("all_docs"))).agg(F.min("n_tokens").alias("quantile"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(kept(histogram(table(spark, sf_dir, "documents")), "lengths"))
