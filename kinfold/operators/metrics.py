"""Macro F0.5 by entity, recall of candidates, and the ceiling that recall allows. Entities without candidates or truth always count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    p, r = tp / n_pred, tp / n_true
    return F.when(tp > 0, 1.25 * p * r / (0.25 * p + r)).when((n_pred == 0) & (n_true == 0), 1.0).otherwise(0.0)


def by_entity(predicted: DataFrame, links: DataFrame, entities: DataFrame, *, within: tuple[str, ...] = ()) -> DataFrame:
    """entity columns with tp, n_pred, n_true, fp, fn, f05 of every entity (of each grid point, if `within` names its columns).

    entities: s1_entity_id and what else it has (such as country); with `within`, these columns too."""
    true = links.select(F.col("source1_entity_id").alias("s1_entity_id"), F.col("matched_entity_id").alias("candidate_entity_id")).distinct()
    marked = predicted.join(true.withColumn("__t", F.lit(1)), ["s1_entity_id", "candidate_entity_id"], "left")
    pred = marked.groupBy(*within, "s1_entity_id").agg(F.count(F.lit(1)).alias("n_pred"), F.count("__t").alias("tp"))
    known = true.groupBy("s1_entity_id").agg(F.count(F.lit(1)).alias("n_true"))
    out = entities.join(known, "s1_entity_id", "left").join(pred, [*within, "s1_entity_id"], "left").fillna(0, ["n_true", "n_pred", "tp"])
    return out.withColumns({"fp": F.col("n_pred") - F.col("tp"), "fn": F.col("n_true") - F.col("tp"), "f05": f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))})


def macro(entities: DataFrame, *by: str) -> DataFrame:
    """Mean F0.5 over all, precision over entities with predictions, recall over entities with truth."""
    return entities.groupBy(*by).agg(
        F.avg("f05").alias("f05"),
        F.avg(F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred"))).alias("precision"),
        F.avg(F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true"))).alias("recall"),
        F.count(F.lit(1)).alias("n_entities"),
    )


def ceiling(found: Column, n_true: Column) -> Column:
    """The best F0.5 of an entity when only `found` of its matches are candidates."""
    r = found / n_true
    return F.when(n_true == 0, 1.0).when(found == 0, 0.0).otherwise(1.25 * r / (0.25 + r))
