"""Blocking: candidate pairs by equal keys, nine passes over names and addresses.

Records become token arrays with document frequencies; each pass makes keys from the rarest; keys that too many index
records share are dropped before the join, so that no key multiplies; pairs' passes are OR-ed into a bit mask. All keys
carry the country. A record's frequencies are joined once to its exploded tokens and gathered again by record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dictionaries as D

PASSES = {"name_pair": 1, "name_rare": 2, "name_prefix": 4, "addr": 8, "postcode": 16, "addr_pair": 32, "addr_num_all": 64, "name_nospace": 128, "addr_prefix": 256}


@dataclass(frozen=True)
class Settings:
    rare_df: int = 500
    max_block: int = 200
    max_nums: int = 3
    max_cands: int = 200
    new_passes: bool = True
    typo_passes: bool = True
    pair_words_index: int = 4
    pair_words_query: int = 6
    num_words_index: int = 8
    num_words_query: int = 12
    prefix_words: int = 3


def _split(text: str) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda t: t != "")


def _token_arrays(norm: DataFrame) -> DataFrame:
    """Distinct tokens of each kind: name words, name prefixes, address words and prefixes that aren't generic, and the numbers."""
    step = norm.select("entity_id", "country", "name_core", "postcode", F.array_distinct(_split("name_core")).alias("names"), F.array_distinct(_split("addr_norm")).alias("addr"), _split("addr_nums").alias("nums"))
    telling = F.filter("addr", lambda t: (F.length(t) >= 3) & ~t.rlike("^[0-9]+$") & ~t.isin(D.GENERIC))
    step = step.withColumn("telling", telling)
    return step.withColumns({
        "prefixes": F.array_distinct(F.transform(F.filter("names", lambda t: F.length(t) >= 3), lambda t: F.substring(t, 1, 4))),
        "nums": F.transform(F.array_sort(F.transform(F.array_distinct("nums"), lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t")))), lambda x: x["t"]),
    })


def frequencies(index: DataFrame) -> DataFrame:
    """kind, country, token, df over index records: name words, four-letter name prefixes, address words."""
    t = _token_arrays(index)
    kinds = [("n", F.col("names")), ("p", F.col("prefixes")), ("a", F.col("addr"))]
    flat = F.flatten(F.array(*(_tagged(k, a) for k, a in kinds)))
    return t.select("country", F.explode(flat).alias("x")).groupBy(F.col("x.kind").alias("kind"), "country", F.col("x.token").alias("token")).agg(F.count(F.lit(1)).alias("df"))


def _tagged(kind: str, array: Column) -> Column:
    return F.transform(array, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("token")))


def ranked(norm: DataFrame, df: DataFrame) -> DataFrame:
    """Records with their tokens rarest first: known name words (of two letters or more), name prefixes, telling address words, and
    address prefixes' words, of which unseen ones have frequency 0."""
    t = _token_arrays(norm)
    each = t.select("entity_id", "country", F.explode_outer(F.concat(_tagged("n", F.filter("names", lambda x: F.length(x) >= 2)), _tagged("p", F.col("prefixes")), _tagged("a", F.col("telling")))).alias("x"))
    counted = each.select("entity_id", "country", F.col("x.kind").alias("kind"), F.col("x.token").alias("token")).join(df, ["kind", "country", "token"], "left")
    item = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token")
    gathered = counted.groupBy("entity_id").agg(*(F.array_sort(F.collect_list(F.when(F.col("kind") == k, item))).alias(f"all_{k}") for k in "npa"))
    known = lambda c: F.filter(c, lambda x: x["df"] > 0)
    held = gathered.select("entity_id", known("all_n").alias("known_n"), known("all_p").alias("known_p"), known("all_a").alias("known_a"), "all_a")
    return t.select("entity_id", "country", "name_core", "postcode", "nums").join(held, "entity_id")


def _words(array: Column, n: int) -> Column:
    return F.transform(F.slice(array, 1, n), lambda x: x["token"])


def _sorted_pair(a: Column, b: Column) -> Column:
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def _pairs(array: Column) -> Column:
    """All pairs of an array of a few words, each in order."""
    return F.flatten(F.transform(array, lambda x, i: F.transform(F.slice(array, i + 2, F.greatest(F.size(array) - i - 1, F.lit(0))), lambda y: _sorted_pair(x, y))))


def keys(ranks: DataFrame, settings: Settings = Settings(), *, query: bool = False) -> DataFrame:
    """entity_id, bit, key: the keys of each record, for the query or the index side."""
    s, empty = settings, F.array().cast("array<string>")
    pair_words, num_words = (s.pair_words_query, s.num_words_query) if query else (s.pair_words_index, s.num_words_index)
    step = ranks.select(
        "entity_id", "country", "postcode", "nums",
        F.replace("name_core", F.lit(" "), F.lit("")).alias("glued"),
        _words(F.col("known_n"), 2).alias("n2"),
        F.transform(F.filter(F.slice("known_n", 1, 3), lambda x: x["df"] <= s.rare_df), lambda x: x["token"]).alias("n3"),
        _words(F.col("known_p"), 2).alias("p2"),
        _words(F.col("known_a"), 2).alias("a2"),
        _words(F.col("known_a"), pair_words).alias("ak"),
        F.transform(F.slice("known_a", 3, max(num_words - 2, 0)), lambda x: x["token"]).alias("rest"),
        F.array_distinct(F.transform(F.slice(F.filter("all_a", lambda x: F.length(x["token"]) >= 5), 1, s.prefix_words), lambda x: F.substring(x["token"], 1, 5))).alias("a5"),
    )
    nums = lambda n: F.slice("nums", 1, min(n, s.max_nums))
    cross = lambda kind, left, right: F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.concat_ws("|", F.lit(kind), x, y))))
    first = F.get("n2", F.lit(0))
    tag = lambda kind, array: F.transform(array, lambda x: F.concat_ws("|", F.lit(kind), x))
    made = {
        "name_pair": F.when(F.size("n2") > 0, F.array(F.concat_ws("|", F.lit("np"), F.when(F.size("n2") > 1, _sorted_pair(first, F.get("n2", F.lit(1)))).otherwise(first)))).otherwise(empty),
        "name_rare": tag("nr", F.col("n3")),
        "name_prefix": F.when(F.size("p2") == 2, F.array(F.concat_ws("|", F.lit("pp"), _sorted_pair(F.get("p2", F.lit(0)), F.get("p2", F.lit(1)))))).otherwise(empty),
        "addr": cross("ad", nums(s.max_nums), F.col("a2")),
        "postcode": F.when(F.col("postcode") != "", F.concat(F.when(first.isNotNull(), F.array(F.concat_ws("|", F.lit("pc"), "postcode", first))).otherwise(empty), F.transform(nums(2), lambda n: F.concat_ws("|", F.lit("pn"), "postcode", n)))).otherwise(empty),
    }
    if s.new_passes:
        made["addr_pair"] = tag("aw", _pairs(F.col("ak")))
        made["addr_num_all"] = cross("ad", nums(2), F.col("rest"))
    if s.typo_passes:
        whole = F.when(F.length("glued") >= 6, F.array(F.concat_ws("|", F.lit("ns"), "glued"))).otherwise(empty)
        start = F.when(F.length("glued") >= 10, F.array(F.concat_ws("|", F.lit("n8"), F.substring("glued", 1, 8)))).otherwise(empty)
        made["name_nospace"] = F.concat(whole, start)
        made["addr_prefix"] = F.concat(cross("ax", nums(2), F.col("a5")), tag("aq", _pairs(F.col("a5"))))
    each = F.explode(F.array_distinct(F.flatten(F.array(*(_with_bit(PASSES[name], array) for name, array in made.items())))))
    return step.select("entity_id", "country", each.alias("k")).select("entity_id", F.col("k.bit").alias("bit"), F.concat_ws("|", "country", "k.key").alias("key"))


def _with_bit(bit: int, array: Column) -> Column:
    return F.transform(array, lambda x: F.struct(F.lit(bit).alias("bit"), x.alias("key")))


def pruned(index_keys: DataFrame, max_block: int) -> DataFrame:
    """Index keys that at most max_block records share. Counting is combined map-side; the join keeps each key's rows at max_block."""
    one = index_keys.select("entity_id", "key").distinct()
    few = one.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= max_block).select("key")
    return one.join(few, "key")


def combined(query_keys: DataFrame, index_keys: DataFrame) -> DataFrame:
    """s1_entity_id, candidate_entity_id, passes, n_passes: the query side's bits of all keys that the two share."""
    q = query_keys.select(F.col("entity_id").alias("s1_entity_id"), "key", "bit")
    i = index_keys.select(F.col("entity_id").alias("candidate_entity_id"), "key")
    met = q.join(i, "key").groupBy("s1_entity_id", "candidate_entity_id").agg(F.bit_or("bit").cast("short").alias("passes"))
    return met.withColumn("n_passes", F.bit_count("passes").cast("byte"))


def capped(pairs: DataFrame, max_cands: int) -> DataFrame:
    """At most max_cands candidates an entity, those of most passes first, then by id; 0 is no cap."""
    if not max_cands:
        return pairs
    best = Window.partitionBy("s1_entity_id").orderBy(F.desc("n_passes"), "candidate_entity_id")
    return pairs.withColumn("__r", F.row_number().over(best)).filter(F.col("__r") <= max_cands).drop("__r")


def block(queries: DataFrame, index: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Candidate pairs of normalized records: queries against index."""
    df = frequencies(index)
    on_index = pruned(keys(ranked(index, df), settings), settings.max_block)
    return capped(combined(keys(ranked(queries, df), settings, query=True), on_index), settings.max_cands)


def labelled(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """pairs and `label`: 1 for true links."""
    true = links.select(F.col("source1_entity_id").alias("s1_entity_id"), F.col("matched_entity_id").alias("candidate_entity_id"), F.lit(1).alias("__t")).distinct()
    return pairs.join(true, ["s1_entity_id", "candidate_entity_id"], "left").withColumn("label", F.coalesce("__t", F.lit(0)).cast("byte")).drop("__t")
