"""Reports: blocking recall, missed links, error types, and profiles of the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import similarities
from ..functions.text import light
from . import split, tune
from .blocking import PASSES
from .metrics import ceiling
from .selection import Rules


def found_links(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """True links with the passes that found them, null for missed ones."""
    true = links.select(F.col("source1_entity_id").alias("s1_entity_id"), F.col("matched_entity_id").alias("candidate_entity_id")).distinct()
    return true.join(pairs.select("s1_entity_id", "candidate_entity_id", "passes"), ["s1_entity_id", "candidate_entity_id"], "left")


def pass_report(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """For each pass: pairs and links that it finds, and those that it alone finds."""
    held = pairs.join(found_links(pairs, links).select("s1_entity_id", "candidate_entity_id", F.lit(1).alias("t")), ["s1_entity_id", "candidate_entity_id"], "left")
    each = held.select("passes", "t", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(b).alias("bit")) for n, b in PASSES.items()))).alias("p"))
    hit, alone = F.col("passes").cast("int").bitwiseAND(F.col("p.bit")) > 0, F.col("passes").cast("int") == F.col("p.bit")
    total = lambda c: F.count(F.when(c, 1))
    return each.groupBy(F.col("p.name").alias("pass_name")).agg(total(hit).alias("pairs"), total(hit & F.col("t").isNotNull()).alias("links"), total(alone).alias("pairs_alone"), total(alone & F.col("t").isNotNull()).alias("links_alone"))


def recall_by_country(pairs: DataFrame, links: DataFrame, entities: DataFrame) -> DataFrame:
    """Candidates of an entity (mean, median, 90 and 99 per cent, most), recall, and the F0.5 ceiling, by country."""
    found = found_links(pairs, links).groupBy("s1_entity_id").agg(F.count(F.lit(1)).alias("n_true"), F.count("passes").alias("found"))
    counts = pairs.groupBy("s1_entity_id").agg(F.count(F.lit(1)).alias("n"))
    every = entities.join(counts, "s1_entity_id", "left").join(found, "s1_entity_id", "left").fillna(0, ["n", "n_true", "found"])
    return every.groupBy("country").agg(
        F.count(F.lit(1)).alias("entities"), F.avg("n").alias("mean"), F.median("n").alias("median"), F.percentile("n", 0.9).alias("p90"), F.percentile("n", 0.99).alias("p99"), F.max("n").alias("most"),
        F.sum((F.col("n") == 0).cast("int")).alias("without"), (F.sum("found") / F.greatest(F.sum("n_true"), F.lit(1))).alias("recall"), F.avg(ceiling(F.col("found"), F.col("n_true"))).alias("ceiling"),
    )


def missed(pairs: DataFrame, links: DataFrame, norm: DataFrame) -> DataFrame:
    """Links that are no candidates: what the two sides share."""
    lost = links.select(F.col("source1_entity_id").alias("s1_entity_id"), F.col("matched_entity_id").alias("candidate_entity_id")).join(pairs, ["s1_entity_id", "candidate_entity_id"], "left_anti")
    side = lambda p, key: norm.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{p}_{c}") for c in ("country", "name_core", "addr_norm", "addr_nums")))
    both = lost.join(side("a", "s1_entity_id"), "s1_entity_id").join(side("b", "candidate_entity_id"), "candidate_entity_id")
    words = lambda c: F.filter(F.split(c, " "), lambda t: t != "")
    return both.select("s1_entity_id", "candidate_entity_id", F.col("a_country").alias("country"), F.arrays_overlap(words("a_name_core"), words("b_name_core")).alias("shares_word"), F.arrays_overlap(words("a_addr_nums"), words("b_addr_nums")).alias("shares_number"), ((F.col("a_addr_norm") == "") | (F.col("b_addr_norm") == "")).alias("empty_address"))


def missed_report(rows: DataFrame) -> DataFrame:
    share = lambda c: F.avg(F.col(c).cast("int")).alias(c)
    return rows.groupBy("country").agg(F.count(F.lit(1)).alias("n_missed"), share("shares_word"), share("shares_number"), share("empty_address"))


def missed_likeness(rows: DataFrame, norm: DataFrame) -> DataFrame:
    """rows of `missed` with the token-set similarity of the sides' names and addresses, and whether each side has a number."""
    side = lambda p, key: norm.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{p}_{c}") for c in ("name_core", "addr_norm", "addr_nums")))
    both = rows.join(side("a", "s1_entity_id"), "s1_entity_id").join(side("b", "candidate_entity_id"), "candidate_entity_id")
    alike = similarities({n: ("token_set", F.col(f"a_{c}"), F.col(f"b_{c}")) for n, c in (("name_tset", "name_core"), ("addr_tset", "addr_norm"))})
    held = both.withColumn("__s", alike)
    return held.select(*rows.columns, "__s.name_tset", "__s.addr_tset", *((F.col(f"{p}_addr_nums") != "").alias(f"{p}_has_number") for p in "ab"))


def missed_likeness_report(rows: DataFrame, *by: str) -> DataFrame:
    """Of rows of `missed_likeness`: shares that are alike by name or address (80 or more) or by neither (both below 50), of either
    side with a number, and the median similarities."""
    share = lambda c, name: F.avg(c.cast("int")).alias(name)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_missed"), share(F.col("name_tset") >= 80, "name_alike"), share(F.col("addr_tset") >= 80, "addr_alike"), share((F.col("name_tset") < 50) & (F.col("addr_tset") < 50), "neither_alike"),
        share(F.col("a_has_number"), "a_has_number"), share(F.col("b_has_number"), "b_has_number"), F.median("name_tset").alias("median_name"), F.median("addr_tset").alias("median_addr"),
    )


def examples(rows: DataFrame, records: DataFrame, n: int, *, seed: int = split.SEED) -> DataFrame:
    """n pairs of rows by the hash of their ids, with both sides' names and addresses as they were given."""
    key = F.concat("s1_entity_id", F.lit(" "), "candidate_entity_id")
    few = rows.withColumn("__id", key).orderBy(split.order_key("__id", seed), "__id").limit(n).drop("__id")
    side = lambda p, key: records.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{p}_name"), F.col("business_address").alias(f"{p}_address"))
    return few.join(side("a", "s1_entity_id"), "s1_entity_id", "left").join(side("b", "candidate_entity_id"), "candidate_entity_id", "left")


def error_type() -> Column:
    """The class of an entity's result, from tp, n_pred, n_true, fp, fn."""
    t, p, fp, fn = (F.col(c) for c in ("n_true", "n_pred", "fp", "fn"))
    return (
        F.when((t == 0) & (p > 0), "singleton, wrong prediction")
        .when((t > 0) & (p == 0), "matches exist, none predicted")
        .when((t > 0) & (fn > 0) & (fp == 0), "missed some matches only")
        .when((t > 0) & (fp > 0) & (fn == 0), "wrong matches only")
        .when((t > 0) & (fp > 0) & (fn > 0), "both missed and wrong")
        .otherwise("correct")
    )


def error_report(entities: DataFrame) -> DataFrame:
    """By class: entities and the F0.5 that they cost. entities: of `metrics.by_entity`."""
    return entities.withColumn("error", error_type()).groupBy("error").agg(F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("f05")).alias("lost"))


def miss_reasons(scores: DataFrame, predicted: DataFrame, links: DataFrame, entities: DataFrame) -> DataFrame:
    """By country, source and reason: true links that were not predicted (no candidate, given to another entity, below the threshold)."""
    true = links.select(F.col("source1_entity_id").alias("s1_entity_id"), F.col("matched_entity_id").alias("candidate_entity_id"))
    lost = true.join(predicted, ["s1_entity_id", "candidate_entity_id"], "left_anti")
    owned = predicted.select("candidate_entity_id", F.lit(1).alias("owned")).distinct()
    held = lost.join(scores.select("s1_entity_id", "candidate_entity_id", F.lit(1).alias("scored")), ["s1_entity_id", "candidate_entity_id"], "left").join(owned, "candidate_entity_id", "left").join(entities.select("s1_entity_id", "country"), "s1_entity_id", "left")
    reason = F.when(F.col("scored").isNull(), "not a candidate").when(F.col("owned").isNotNull(), "given to another").otherwise("below threshold")
    return held.groupBy("country", F.substring("candidate_entity_id", 1, 2).alias("source"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def wrong_matches(predicted: DataFrame, links: DataFrame) -> DataFrame:
    """By source: predicted pairs that are no links, whose candidate belongs to another entity, or to none."""
    true = links.select(F.col("source1_entity_id").alias("s1_entity_id"), F.col("matched_entity_id").alias("candidate_entity_id"))
    wrong = predicted.join(true, ["s1_entity_id", "candidate_entity_id"], "left_anti")
    owners = true.select("candidate_entity_id", F.lit(1).alias("o")).distinct()
    kind = F.when(F.col("o").isNotNull(), "belongs to another").otherwise("belongs to none")
    return wrong.join(owners, "candidate_entity_id", "left").groupBy(F.substring("candidate_entity_id", 1, 2).alias("source"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def trials(scores: DataFrame, links: DataFrame, entities: DataFrame, rules: Rules, *, thresholds: list[float] = tune.THRESHOLDS, top1: list[float | None] = tune.TOP1) -> list[tuple[str, float, float]]:
    """(trial, F0.5, gain over the rules as they are): other rescues, thresholds tuned again by country, and by source on top of these."""
    now = tune.score_of(scores, links, entities, rules)
    tried = [("as it is", now)]
    for t in top1:
        tried.append((f"rescue {t}", tune.score_of(scores, links, entities, Rules(rules.threshold, rules.one_owner, t, rules.by_country))))
    by_country, score = tune.tune_by_country(scores, links, entities, rules, thresholds=thresholds)
    tried.append(("thresholds by country", score))
    tried.append(("thresholds by source", tune.tune_by_source(scores, links, entities, by_country, thresholds=thresholds)[1]))
    return [(name, f, f - now) for name, f in tried]


def histogram(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """Counts by right-closed bins, numbered from 0; what lies outside of the edges is left out."""
    bin_ = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        bin_ = F.when((F.col(column) > lo) & (F.col(column) <= hi), i).otherwise(bin_)
    return df.select(bin_.alias("bin")).filter("bin is not null").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def profile(records: DataFrame, *by: str) -> DataFrame:
    """By source: rows, distinct ids, empty fields, lengths, and rows that repeat a name and address."""
    name, addr = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("entity_id").alias("n_ids"), F.sum((F.trim(name) == "").cast("int")).alias("empty_names"), F.sum((F.trim(addr) == "").cast("int")).alias("empty_addresses"),
        F.avg(F.length(name)).alias("mean_name"), F.max(F.length(name)).alias("longest_name"), F.avg(F.length(addr)).alias("mean_address"), F.max(F.length(addr)).alias("longest_address"), (F.count(F.lit(1)) - F.countDistinct(name, addr)).alias("repeats"),
    )


def unknown_ids(links: DataFrame, records: DataFrame) -> DataFrame:
    """entity_id, side: ids of links, of source 1 or of the others, that no record has."""
    ids = links.select(F.explode(F.array(*(F.struct(F.col(c).alias("entity_id"), F.lit(s).alias("side")) for c, s in (("source1_entity_id", "query"), ("matched_entity_id", "match"))))).alias("x")).select("x.*").distinct()
    return ids.join(records.select("entity_id"), "entity_id", "left_anti")


def country_crosstab(links: DataFrame, records: DataFrame) -> DataFrame:
    """country, matched_country, n: links by the countries of both sides, null for unknown ids."""
    side = lambda key, name: records.select(F.col("entity_id").alias(key), F.col("country").alias(name))
    held = links.join(side("source1_entity_id", "country"), "source1_entity_id", "left").join(side("matched_entity_id", "matched_country"), "matched_entity_id", "left")
    return held.groupBy("country", "matched_country").agg(F.count(F.lit(1)).alias("n"))


def exact_rates(links: DataFrame, records: DataFrame, *, sample: int | None = 200_000, seed: int = 42) -> DataFrame:
    """n_links, name_equal, address_equal, both_equal: how often the sides of true links agree after light normalization, over the
    `sample` links of least hash (None: all). Links to unknown ids agree in nothing."""
    held = links.select("source1_entity_id", "matched_entity_id").distinct()
    if sample is not None:
        held = held.withColumn("__id", F.concat("source1_entity_id", F.lit(" "), "matched_entity_id"))
        held = held.orderBy(split.order_key("__id", seed), "__id").limit(sample).drop("__id")
    side = lambda p, key: records.select(F.col("entity_id").alias(key), *(light(F.coalesce(c, F.lit(""))).alias(f"{p}_{n}") for n, c in (("name", "business_name"), ("address", "business_address"))))
    both = held.join(side("a", "source1_entity_id"), "source1_entity_id", "left").join(side("b", "matched_entity_id"), "matched_entity_id", "left")
    same = {n: F.coalesce(F.col(f"a_{n}") == F.col(f"b_{n}"), F.lit(False)) for n in ("name", "address")}
    rate = lambda c, name: F.avg(c.cast("int")).alias(name)
    return both.agg(F.count(F.lit(1)).alias("n_links"), rate(same["name"], "name_equal"), rate(same["address"], "address_equal"), rate(same["name"] & same["address"], "both_equal"))


def outside(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Matches that are no candidates: none, if all is well."""
    return pairs.join(candidates, ["s1_entity_id", "candidate_entity_id"], "left_anti")


def stage_report(stages: dict[str, DataFrame], links: DataFrame, entities: DataFrame) -> DataFrame:
    """By stage: pairs, pairs an entity, recall and ceiling of its candidate set."""
    out = None
    for name, pairs in stages.items():
        held = pairs.select("s1_entity_id", "candidate_entity_id").distinct().withColumn("passes", F.lit(1))
        found = found_links(held, links).groupBy("s1_entity_id").agg(F.count(F.lit(1)).alias("n_true"), F.count("passes").alias("found"))
        counts = held.groupBy("s1_entity_id").agg(F.count(F.lit(1)).alias("n"))
        every = entities.join(counts, "s1_entity_id", "left").join(found, "s1_entity_id", "left").fillna(0, ["n", "n_true", "found"])
        row = every.agg(F.lit(name).alias("stage"), F.sum("n").alias("pairs"), F.avg("n").alias("pairs_an_entity"), (F.sum("found") / F.greatest(F.sum("n_true"), F.lit(1))).alias("recall"), F.avg(ceiling(F.col("found"), F.col("n_true"))).alias("ceiling"))
        out = row if out is None else out.unionByName(row)
    return out
