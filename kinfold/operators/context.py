"""Second-stage features: a pair's score among its entity's candidates, and its likeness to the reference candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import similarities

FLOOR = 1e-6
SCORE_FEATURES = ["s1_score", "s1_rank", "s1_gap", "s1_rel", "s1_max", "s1_second", "s1_n_ge50", "s1_n_ge20", "s1_sum", "s1_share"]
TRANSITIVE_FEATURES = ["t_name_tset", "t_name_ratio", "t_addr_tset", "t_addr_ratio", "t_ref_score", "t_has_ref", "t_combo_x_ref"]


def with_scores(pairs: DataFrame, score: str = "score") -> DataFrame:
    """pairs (complete by entity) with the score's rank, gaps and shares. Of equal scores the lesser id stands first."""
    own = Window.partitionBy("s1_entity_id")
    order = own.orderBy(F.desc(score), "candidate_entity_id")
    s, whole = F.col(score).cast("double"), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return pairs.withColumns({
        "s1_score": s,
        "s1_rank": F.rank().over(own.orderBy(F.desc(score))),
        "s1_gap": F.max(s).over(own) - s,
        "s1_rel": s / F.greatest(F.max(s).over(own), F.lit(FLOOR)),
        "s1_max": F.max(s).over(own),
        "s1_second": F.coalesce(F.nth_value(s, 2).over(whole), F.lit(0.0)),
        "s1_n_ge50": F.sum((s >= 0.5).cast("int")).over(own),
        "s1_n_ge20": F.sum((s >= 0.2).cast("int")).over(own),
        "s1_sum": F.sum(s).over(own),
        "s1_share": s / F.greatest(F.sum(s).over(own), F.lit(FLOOR)),
    })


def with_reference(pairs: DataFrame, score: str = "score") -> DataFrame:
    """pairs and `ref`: the entity's best candidate, for the best itself the second, null if it is alone."""
    order = Window.partitionBy("s1_entity_id").orderBy(F.desc(score), "candidate_entity_id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row = F.struct("candidate_entity_id", F.col(score).cast("double").alias("score"), F.col("b_name_core").alias("name"), F.col("b_addr_norm").alias("addr"))
    return pairs.withColumn("ref", F.when(F.row_number().over(order) == 1, F.nth_value(row, 2).over(whole)).otherwise(F.first(row).over(whole)))


def with_transitive(pairs: DataFrame, score: str = "score") -> DataFrame:
    """Similarities to the reference candidate and its score; -1 without one."""
    held = with_reference(pairs, score)
    name, addr = (F.col("b_name_core"), F.col("ref.name")), (F.col("b_addr_norm"), F.col("ref.addr"))
    held = held.withColumn("__t", similarities({"t_name_tset": ("token_set", *name), "t_name_ratio": ("ratio", *name), "t_addr_tset": ("token_set", *addr), "t_addr_ratio": ("ratio", *addr)}))
    has = F.col("ref").isNotNull()
    out = held.withColumns({c: F.when(has, F.col(f"__t.{c}")).otherwise(-1.0).cast("float") for c in TRANSITIVE_FEATURES[:4]})
    close = (F.greatest("t_name_tset", F.lit(0.0)) + F.greatest("t_addr_tset", F.lit(0.0))) / 200.0
    return out.withColumns({"t_ref_score": F.when(has, F.col("ref.score")).otherwise(-1.0), "t_has_ref": has.cast("int"), "t_combo_x_ref": F.when(has, close * F.col("ref.score")).otherwise(-1.0)}).drop("__t", "ref")
