"""Threshold search. A grid is one job: scores meet the grid's few rows, and every window also partitions by the grid point.

Scores that no point could keep are dropped first. Ties go to the lower threshold. What is adopted must be better on all entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .metrics import by_entity
from .selection import Rules, blended, selected, threshold_of

THRESHOLDS = [round(0.3 + 0.025 * i, 3) for i in range(26)]
TOP1 = [None, 0.1, 0.2, 0.3]
SOURCES = ("S2", "S3")
WEIGHTS = [1.0, 0.8, 0.6, 0.5, 0.4, 0.2, 0.0]
LEAST_GAIN = 1e-9


def grid(spark: SparkSession, thresholds: list[float] = THRESHOLDS, top1: list[float | None] = TOP1, one_owner: bool = True) -> DataFrame:
    """point, threshold, top1: pairs in which the rescue is below the threshold. As many rows as the lists allow, never by the data."""
    rows = [(i, t, p) for i, (t, p) in enumerate((t, p) for t in thresholds for p in top1 if p is None or p < t)]
    return spark.createDataFrame(rows, "point int, threshold double, top1 double")


def _over_grid(scores: DataFrame, links: DataFrame, entities: DataFrame, points: DataFrame, one_owner: bool) -> DataFrame:
    """Every entity's figures at every grid point."""
    floor = points.agg(F.min(F.least("threshold", F.coalesce("top1", "threshold")))).first()[0]
    met = scores.filter(F.col("score") >= floor).crossJoin(F.broadcast(points))
    kept = selected(met, Rules(one_owner=one_owner), within=("point",), threshold=F.col("threshold"), top1=F.col("top1"))
    return by_entity(kept.select("point", "s1_entity_id", "candidate_entity_id"), links, entities.crossJoin(F.broadcast(points)), within=("point",))


def search(scores: DataFrame, links: DataFrame, entities: DataFrame, points: DataFrame, *, one_owner: bool = True) -> DataFrame:
    """Macro F0.5 of each grid point."""
    return _over_grid(scores, links, entities, points, one_owner).groupBy("point", "threshold", "top1").agg(F.avg("f05").alias("f05"))


def search_by_country(scores: DataFrame, links: DataFrame, entities: DataFrame, points: DataFrame, *, one_owner: bool = True) -> DataFrame:
    """country, threshold, f05: the best threshold of each country (matches never cross countries); of equal ones the lowest."""
    each = _over_grid(scores, links, entities, points, one_owner).groupBy("country", "threshold").agg(F.avg("f05").alias("f05"))
    best = each.groupBy("country").agg(F.max(F.struct("f05", (-F.col("threshold")).alias("low"))).alias("b"))
    return best.select("country", (-F.col("b.low")).alias("threshold"), F.col("b.f05").alias("f05"))


def score_of(scores: DataFrame, links: DataFrame, entities: DataFrame, rules: Rules) -> float:
    return by_entity(selected(scores, rules), links, entities).agg(F.avg("f05")).first()[0] or 0.0


def tune(scores: DataFrame, links: DataFrame, entities: DataFrame, *, thresholds: list[float] = THRESHOLDS, top1: list[float | None] = TOP1) -> tuple[Rules, float]:
    """The best rules of the whole grid, with and without the one-owner rule."""
    spark, best = scores.sparkSession, (Rules(), -1.0)
    for one_owner in (True, False):
        row = search(scores, links, entities, grid(spark, thresholds, top1), one_owner=one_owner).orderBy(F.desc("f05"), "threshold", F.col("top1").asc_nulls_first()).first()
        if row and row["f05"] > best[1]:
            best = Rules(row["threshold"], one_owner, row["top1"]), row["f05"]
    return best


def tune_by_country(scores: DataFrame, links: DataFrame, entities: DataFrame, rules: Rules, *, thresholds: list[float] = THRESHOLDS) -> tuple[Rules, float]:
    """rules with thresholds by country, if these are better on the whole."""
    points = scores.sparkSession.createDataFrame([(i, t, rules.top1_threshold) for i, t in enumerate(thresholds)], "point int, threshold double, top1 double")
    found = {r["country"]: r["threshold"] for r in search_by_country(scores, links, entities, points, one_owner=rules.one_owner).collect() if r["country"] is not None}
    new = Rules(rules.threshold, rules.one_owner, rules.top1_threshold, rules.by_country | found)
    before, after = score_of(scores, links, entities, rules), score_of(scores, links, entities, new)
    return (new, after) if after > before else (rules, before)


def tune_by_source(scores: DataFrame, links: DataFrame, entities: DataFrame, rules: Rules, *, thresholds: list[float] = THRESHOLDS, rounds: int = 2) -> tuple[Rules, float]:
    """Coordinate descent on each country's thresholds of source 2, then 3. Steps depend on each other, so this is a loop on the
    driver, but a step is one grid job over the rows of its country: matches never cross countries, and the mean over all
    entities moves by what the country's sum gains."""
    best = score_of(scores, links, entities, rules)
    sizes = {r["country"]: r["n"] for r in entities.groupBy("country").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, countries = sum(sizes.values()), sorted(c for c in sizes if c is not None)
    points = scores.sparkSession.createDataFrame([(i, t) for i, t in enumerate(thresholds)], "point int, threshold double")
    for _ in range(rounds):
        before = best
        for country, source in ((c, s) for c in countries for s in SOURCES):
            if not thresholds:
                continue
            own, held = entities.filter(F.col("country") == country), scores.filter(F.col("country") == country)
            now = score_of(held, links, own, rules) * sizes[country]
            met = held.crossJoin(F.broadcast(points))
            thr = F.when(F.substring("candidate_entity_id", 1, 2) == source, F.col("threshold")).otherwise(threshold_of(rules))
            kept = selected(met, rules, within=("point",), threshold=thr).select("point", "s1_entity_id", "candidate_entity_id")
            each = by_entity(kept, links, own.crossJoin(F.broadcast(points)), within=("point",)).groupBy("threshold").agg(F.sum("f05").alias("f05"))
            top = each.orderBy(F.desc("f05"), "threshold").first()
            gain = (top["f05"] - now) / total
            if gain > LEAST_GAIN:
                best, rules = best + gain, rules.changed(f"{country}|{source}", top["threshold"])
        if best <= before + LEAST_GAIN:
            break
    return rules, best


def tune_weight(scores: DataFrame, rescored: DataFrame, links: DataFrame, entities: DataFrame, *, weights: list[float] = WEIGHTS, thresholds: list[float] = THRESHOLDS) -> tuple[float, Rules, float]:
    """The best weight of the first score in a blend, with its rules."""
    found = [(w, *tune(blended(scores, rescored, w), links, entities, thresholds=thresholds, top1=[None, 0.2])) for w in weights]
    return max(found, key=lambda x: x[2])
