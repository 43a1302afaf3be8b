"""Match selection: thresholds by country and source, the one-owner rule, the rescue of an entity's best pair."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """Thresholds: of `country|S2` or `country|S3`, else of the country, else the global one."""

    threshold: float = 0.5
    one_owner: bool = True
    top1_threshold: float | None = None
    by_country: dict[str, float] = field(default_factory=dict)

    def changed(self, country: str, threshold: float) -> Rules:
        """These rules with another threshold for one country."""
        return Rules(self.threshold, self.one_owner, self.top1_threshold, self.by_country | {country: threshold})


def threshold_of(rules: Rules) -> Column:
    """A row's threshold. The settings are a few literals; scores need a country only where thresholds name one."""
    if not rules.by_country:
        return F.lit(rules.threshold)
    table = F.create_map(*(F.lit(x) for pair in rules.by_country.items() for x in pair))
    source = F.concat(F.col("country"), F.lit("|"), F.substring("candidate_entity_id", 1, 2))
    return F.coalesce(F.try_element_at(table, source), F.try_element_at(table, F.col("country")), F.lit(rules.threshold))


def selected(scores: DataFrame, rules: Rules = Rules(), *, within: tuple[str, ...] = (), threshold: Column | None = None, top1: Column | None = None) -> DataFrame:
    """The kept rows of scores (s1_entity_id, candidate_entity_id, score, country).

    In order: scores below both thresholds go; a candidate stays with its best entity (ties: the lesser id); of these,
    pairs at their threshold are kept, and with a top-1 threshold an entity's best one. `within` holds columns (such as a
    grid's number) that keep everything apart; `threshold` and `top1` may be columns of it."""
    thr = threshold if threshold is not None else threshold_of(rules)
    rescue = top1 if top1 is not None else F.lit(rules.top1_threshold).cast("double")
    held = scores.withColumns({"__thr": thr, "__top1": rescue}).filter(F.col("score") >= F.least("__thr", F.coalesce("__top1", "__thr")))
    if rules.one_owner:
        best = Window.partitionBy(*within, "candidate_entity_id").orderBy(F.desc("score"), "s1_entity_id")
        held = held.withColumn("__own", F.row_number().over(best)).filter("__own = 1").drop("__own")
    first = Window.partitionBy(*within, "s1_entity_id").orderBy(F.desc("score"), "candidate_entity_id")
    held = held.withColumn("__first", F.row_number().over(first)).filter((F.col("score") >= F.col("__thr")) | (F.col("__top1").isNotNull() & (F.col("__first") == 1)))
    return held.drop("__thr", "__top1", "__first")


def blended(scores: DataFrame, rescored: DataFrame, weight: float, *, own: str = "score", other: str = "ce") -> DataFrame:
    """scores with weight * own + (1 - weight) * other where a pair was scored again."""
    again = rescored.select("s1_entity_id", "candidate_entity_id", F.col(other).alias("__ce"))
    mixed = F.coalesce(weight * F.col(own) + (1 - weight) * F.col("__ce"), F.col(own))
    return scores.join(again, ["s1_entity_id", "candidate_entity_id"], "left").withColumn(own, mixed).drop("__ce")
