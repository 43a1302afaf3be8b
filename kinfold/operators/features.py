"""Pair features: string similarities, sets and numbers of both sides, blocking passes, and the place among an entity's candidates.

Texts are joined by id; everything but the string similarities is built-in expressions. The group features' windows all
partition by s1_entity_id, so they share one exchange.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import similarities
from .blocking import PASSES

TEXTS = ("name_norm", "name_core", "addr_norm", "addr_nums", "postcode", "state")
STRONG = 90.0

#: Similarities of a pair: kind and the columns compared.
SIMILAR = {
    "name_ratio": ("ratio", "name_core"),
    "name_tsort": ("token_sort", "name_core"),
    "name_tset": ("token_set", "name_core"),
    "name_partial": ("partial", "name_core"),
    "name_jw": ("jaro_winkler", "name_core"),
    "name_full_tset": ("token_set", "name_norm"),
    "name_nospace_ratio": ("ratio", "glued"),
    "name_nospace_partial": ("partial", "glued"),
    "addr_ratio": ("ratio", "addr_norm"),
    "addr_tsort": ("token_sort", "addr_norm"),
    "addr_tset": ("token_set", "addr_norm"),
    "addr_partial": ("partial", "addr_norm"),
}


def attached(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """pairs with both sides' texts as a_* and b_*. `missing` tells which ids have none."""

    def side(prefix: str, key: str) -> DataFrame:
        return norm.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{prefix}_{c}") for c in TEXTS))

    return pairs.join(side("a", "s1_entity_id"), "s1_entity_id").join(side("b", "candidate_entity_id"), "candidate_entity_id")


def missing(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """entity_id of pairs' ids without a record; an empty result is the precondition of `attached`."""
    ids = pairs.select(F.explode(F.array("s1_entity_id", "candidate_entity_id")).alias("entity_id")).distinct()
    return ids.join(norm.select("entity_id"), "entity_id", "left_anti")


def _tokens(c: str) -> Column:
    return F.array_remove(F.split(c, " "), "")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_sets(pairs: DataFrame) -> DataFrame:
    """Features of equality, length, token sets, numbers, postcode, state, passes and source."""
    held = pairs.withColumns({f"{s}_{n}": _tokens(f"{s}_{c}") for s in "ab" for n, c in (("nt", "name_core"), ("at", "addr_norm"), ("nn", "addr_nums"))})
    sets = ("nt", "at", "nn")
    held = held.withColumns({f"n_{n}": F.size(F.array_intersect(f"a_{n}", f"b_{n}")) for n in sets} | {f"{s}_n_{n}": F.size(F.array_distinct(f"{s}_{n}")) for s in "ab" for n in sets})  # once each, though several features use them
    both = {n: F.col(f"n_{n}") for n in sets}
    count = {(s, n): F.col(f"{s}_n_{n}") for s in "ab" for n in sets}
    union = {n: count["a", n] + count["b", n] - both[n] for n in sets}
    full = lambda n: (F.size(f"a_{n}") > 0) & (F.size(f"b_{n}") > 0)
    flag = lambda c: c.cast("int")
    longest = lambda c: F.aggregate(c, F.lit(""), lambda m, x: F.when(F.length(x) > F.length(m), x).otherwise(m))
    given = {c: (F.col(f"a_{c}") != "") & (F.col(f"b_{c}") != "") for c in ("postcode", "state")}
    same = {c: F.col(f"a_{c}") == F.col(f"b_{c}") for c in ("postcode", "state")}
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1
    out = held.withColumns(
        {
            "name_exact": flag(F.col("a_name_core") == F.col("b_name_core")),
            "name_tok_jacc": F.when(full("nt"), both["nt"] / union["nt"]).otherwise(0.0),
            "name_first_eq": flag(F.when(full("nt"), F.get("a_nt", F.lit(0)) == F.get("b_nt", F.lit(0))).otherwise(False)),
            "name_len_diff": F.abs(F.length("a_name_core") - F.length("b_name_core")),
            "name_ntok_a": spaces(F.col("a_name_core")),
            "name_ntok_b": spaces(F.col("b_name_core")),
            "addr_empty_a": flag(F.col("a_addr_norm") == ""),
            "addr_empty_b": flag(F.col("b_addr_norm") == ""),
            "addr_contain_a": F.when(full("at"), _share(both["at"], count["a", "at"])).otherwise(0.0),
            "addr_contain_b": F.when(full("at"), _share(both["at"], count["b", "at"])).otherwise(0.0),
            "num_subset_b": flag((F.size("b_nn") > 0) & (both["nn"] == count["b", "nn"])),
            "num_both": flag(full("nn")),
            "num_common": F.when(full("nn"), both["nn"]).otherwise(0),
            "num_jacc": F.when(full("nn"), both["nn"] / union["nn"]).otherwise(0.0),
            "num_long_eq": flag(F.when(full("nn"), longest(F.col("a_nn")) == longest(F.col("b_nn"))).otherwise(False)),
            "num_conflict": flag(full("nn") & (both["nn"] == 0)),
            "pc_eq": flag(given["postcode"] & same["postcode"]),
            "pc_conflict": flag(given["postcode"] & ~same["postcode"]),
            "state_eq": flag(given["state"] & same["state"]),
            "state_conflict": flag(given["state"] & ~same["state"]),
            "cand_is_s3": flag(F.col("candidate_entity_id").startswith("S3-")),
        }
        | {f"pass_{n}": flag(F.col("passes").cast("int").bitwiseAND(F.lit(b)) > 0) for n, b in PASSES.items()}
    )
    return out.drop(*(f"n_{n}" for n in sets), *(f"{s}_{k}{n}" for s in "ab" for n in sets for k in ("", "n_")))


def with_similarities(pairs: DataFrame, only: set[str] = frozenset(SIMILAR)) -> DataFrame:
    """The string similarities, all from one UDF call a pair, in single precision so that ties stay ties. Those not in `only` are 0."""
    glue = lambda s: F.replace(f"{s}_name_core", F.lit(" "), F.lit(""))
    sides = {c: [glue(s) if c == "glued" else F.col(f"{s}_{c}") for s in "ab"] for _, c in SIMILAR.values()}  # one object each, so that it is sent once
    made = {n: (k, *sides[c]) for n, (k, c) in SIMILAR.items() if n in only}
    scored = pairs.withColumn("__s", similarities(made)) if made else pairs
    return scored.withColumns({n: (F.col(f"__s.{n}") if n in made else F.lit(0)).cast("float") for n in SIMILAR}).drop("__s")


def with_group(pairs: DataFrame, *, name: str = "name_tset", addr: str = "addr_tset", strong: float = STRONG) -> DataFrame:
    """The candidate count, and rank, gap to the best, and number of strong candidates by name, address and both."""
    own = Window.partitionBy("s1_entity_id")
    scores = {"name_tset": F.col(name), "addr_tset": F.col(addr), "combo": F.col(name) + F.col(addr)}
    out = pairs.withColumns({f"{n}_rank": F.rank().over(own.orderBy(score.desc())) for n, score in scores.items()})
    whole = {"n_cands": F.count(F.lit(1)).over(own)} | {f"{n}_gap": F.max(score).over(own) - score for n, score in scores.items()}
    return out.withColumns(whole | {f"n_{n}_strong": F.sum((F.col(c) >= strong).cast("int")).over(own) for n, c in (("addr", addr), ("name", name))})


#: The model's features, in order.
FEATURES = [
    *(n for n in SIMILAR if not n.startswith("addr")), "name_exact", "name_tok_jacc", "name_first_eq", "name_len_diff", "name_ntok_a", "name_ntok_b",
    *(n for n in SIMILAR if n.startswith("addr")), "addr_empty_a", "addr_empty_b", "addr_contain_a", "addr_contain_b", "num_subset_b",
    "num_jacc", "num_common", "num_long_eq", "num_both", "num_conflict", "pc_eq", "pc_conflict", "state_eq", "state_conflict",
    *(f"pass_{n}" for n in PASSES), "n_passes", "cand_is_s3",
    "n_cands", "name_tset_rank", "name_tset_gap", "addr_tset_rank", "addr_tset_gap", "combo_rank", "combo_gap", "n_addr_strong", "n_name_strong",
]


def features(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """Keys, label if there is one, and all features as floats."""
    made = with_group(with_similarities(with_sets(attached(pairs, norm))))
    return made.select(*_keys(pairs), "b_name_core", "b_addr_norm", *(F.col(c).cast("float").alias(c) for c in FEATURES))


def _keys(pairs: DataFrame) -> list[str]:
    return [c for c in ("s1_entity_id", "candidate_entity_id", "label", "country") if c in pairs.columns]


def vectors(pairs: DataFrame, norm: DataFrame, only: set[str] = frozenset(FEATURES)) -> DataFrame:
    """Keys, label if there is one, and `features`, a vector of all features in order (NaN for null): narrow rows for the group's windows
    and for a fit. For a model that reads no others than `only`, the rest are 0 and not computed."""
    at = FEATURES.index("n_cands")
    own, group = FEATURES[:at], FEATURES[at:]
    needed = only | ({"name_tset", "addr_tset"} if only.intersection(group) - {"n_cands"} else set())
    part = lambda names: F.array(*(F.coalesce(F.col(c).cast("float"), F.lit(float("nan")).cast("float")) if c in only else F.lit(0.0).cast("float") for c in names))
    made = with_similarities(with_sets(attached(pairs, norm)), needed)
    made = with_group(made.select(*_keys(pairs), "name_tset", "addr_tset", part(own).alias("__own")))
    return made.select(*_keys(pairs), array_to_vector(F.concat("__own", part(group)).cast("array<double>")).alias("features"))
