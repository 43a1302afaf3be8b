"""Ground truth and splits: links from lists, exact-size splits and folds that don't depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 2026


def entities(truth: DataFrame, source1: DataFrame) -> DataFrame:
    """source1_entity_id, country, n_matches of every entity with a truth row."""
    ids = F.trim(F.coalesce("matched_entity_ids", F.lit("")))
    counted = truth.select("source1_entity_id", F.when(ids == "", 0).otherwise(F.size(F.split(ids, ","))).cast("int").alias("n_matches"))
    country = source1.select(F.col("entity_id").alias("source1_entity_id"), "country")
    return counted.join(country, "source1_entity_id", "left").select("source1_entity_id", "country", "n_matches")


def links(truth: DataFrame) -> DataFrame:
    """source1_entity_id, matched_entity_id: lists taken apart, blanks dropped."""
    each = truth.select("source1_entity_id", F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), ",")).alias("m"))
    return each.select("source1_entity_id", F.trim("m").alias("matched_entity_id")).filter("matched_entity_id <> ''")


def id_lists(pairs: DataFrame) -> DataFrame:
    """The lists again, in the order of ids: the reverse of `links` up to order."""
    return pairs.groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_list("matched_entity_id")), ",").alias("matched_entity_ids"))


def order_key(column: str, seed: int = SEED) -> Column:
    """A hash that any engine can follow."""
    return F.md5(F.concat(F.col(column).cast("string"), F.lit(f":{seed}")))


def with_split(df: DataFrame, n_val: int, *, key: str = "source1_entity_id", seed: int = SEED) -> DataFrame:
    """df and `split`: "val" for exactly n_val rows (all, if there are fewer), "train" for the others.

    The n_val least keys are found by a distributed top-n; ids are unique."""
    hashed = df.withColumn("__k", order_key(key, seed))
    chosen = hashed.select("__k", key).orderBy("__k", key).limit(n_val).select(F.col(key).alias("__id"))
    return hashed.join(chosen, F.col(key) == F.col("__id"), "left").withColumn("split", F.when(F.col("__id").isNotNull(), "val").otherwise("train")).drop("__k", "__id")


def sample_ids(df: DataFrame, n: int, *, key: str, seed: int = SEED) -> DataFrame:
    return df.select(key).distinct().orderBy(order_key(key, seed), key).limit(n)


def fold(column: str, folds: int = 2, salt: int = 0) -> Column:
    """The same fold for all rows of an id; another salt gives an independent one."""
    return F.pmod(F.conv(F.substring(order_key(column, salt), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def summary(df: DataFrame) -> DataFrame:
    """By split and country: entities, share without matches, mean matches."""
    return df.groupBy("split", "country").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("n_matches") == 0).cast("int")).alias("singleton_rate"), F.avg("n_matches").alias("mean_matches"))


def top_k(df: DataFrame, k: int, *, by: str = "s1_entity_id", score: str = "score", tie: str = "candidate_entity_id", least: float | None = None) -> DataFrame:
    """The k best rows of each group, at `least` or more."""
    held = df.filter(F.col(score) >= least) if least is not None else df
    return held.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(score), tie))).filter(F.col("__r") <= k).drop("__r")
