"""Rule bitmask ledger: every rule is evaluated once, failures are kept as bits beside the measurements.

`ledger` measures each text once and stores one bit a rule that it fails. Policies are versioned masks of rules:
`apply_policy` keeps what fails none of a policy's rules, and `ablation` tells for each rule, from the bits alone, how
many documents it fails, how many it alone rejects, and how many are kept without it. Only DataFrame functions: there is
no shuffle in the ledger, and none but counts in the ablation.

Null text is empty text: no words, no lines, and it fails `few_words`. Repeated rows are measured alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

_BLANK = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_WORDS = r"[^\x20\x09-\x0D]"

#: Each rule's bit and its condition over the measurements; a rule keeps its bit for good.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 50"),
    "repeated_words": (1, "100 * n_repeat_words > 50 * n_words"),
    "symbols": (2, "10 * n_symbols > 3 * n_words"),
    "repeated_lines": (3, "10 * n_dup_lines > 3 * n_lines"),
    "short_words": (4, "2 * word_chars < 3 * n_words"),
    "long_words": (5, "word_chars > 30 * n_words"),
    "shouting": (6, "10 * n_upper > 7 * n_letters"),
}
#: Versions of what is asked; a version never changes.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "standard-1": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words", "shouting"),
}


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES[r][0] for r in rules)


def _repeated(grams: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more.

    Windows are sorted with their places; a window is repeated where a neighbour in that order is equal. The union of
    the windows at the repeated places p1 < p2 < ... has min(3, next - own) words for each, and 3 for the last."""
    by_gram = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def places(order: Column) -> Column:
        hit = F.filter(
            F.transform(order, lambda x, k: F.when((F.get(order, k + 1)["g"] == x["g"]) | (F.get(order, k - 1)["g"] == x["g"]), x["i"])),
            lambda p: p.isNotNull(),
        )
        return F.array_sort(hit)

    # a lambda's argument holds the sorted array, so that it is sorted once
    found = F.get(F.transform(F.array(by_gram), places), F.lit(0))
    covered = F.transform(F.array(found), lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(3)), F.lit(3))), F.lit(0), lambda a, b: a + b))
    return F.when(F.size(grams) > F.size(F.array_distinct(grams)), F.get(covered, F.lit(0))).otherwise(F.lit(0)).cast("long")


def measured(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with the measurements of its texts."""
    t, words, grams, lines = F.coalesce(F.col(text), F.lit("")), F.col("__words"), F.col("__grams"), F.col("__lines")
    trigram = F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    )
    out = docs.withColumns({
        "__words": F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        "__lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(_WORDS)),
    }).withColumn("__grams", trigram)
    return out.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(t, _BLANK, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, _SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeated(grams),
        "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long"),
        "n_letters": F.length(F.regexp_replace(t, r"[^\p{L}]+", "")).cast("long"),
    }).drop("__words", "__grams", "__lines")


def ledger(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with measurements and `failed`, a bit for each rule that its text fails."""
    held = measured(docs, text=text)
    bits = sum((F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, rule in RULES.values()), F.lit(0))
    return held.withColumn("failed", bits.cast("long"))


def apply_policy(entries: DataFrame, policy: str = "standard-1", *, kept: str = "kept") -> DataFrame:
    """A ledger's rows with whether they fail none of the policy's rules."""
    return entries.withColumn(kept, F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablation(entries: DataFrame, policy: str = "standard-1") -> DataFrame:
    """A row for each rule of the policy: documents that fail it, that only it rejects, and kept with and without it."""
    rules = POLICIES[policy]
    whole = mask(rules)
    hit = F.col("failed").bitwiseAND(F.lit(whole))
    by_bits = entries.groupBy(hit.alias("bits")).agg(F.count(F.lit(1)).alias("n"))  # as many rows as combinations occur
    own = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).alias("bit")) for r in rules))).alias("r")
    each = by_bits.select("bits", "n", own).select("bits", "n", "r.rule", "r.bit")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        count(F.col("bits") == F.col("bit")).alias("only_by_it"),
        count(F.col("bits") == 0).alias("kept_with_all"),
        count((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("kept_without_it"),
    )


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = F.col("failed").bitwiseAND(F.lit(mask(POLICIES["base-1"]))) != 0
    return apply_policy(ledger(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed", "n_lines", "n_upper", "n_letters")


_RULES_SQL = " + ".join(f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END" for bit, rule in RULES.values())
ORACLE_SQL = {
    "op8_rule_ledger": rf"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM base),
pos AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w WHERE len(words) >= 3),
gram AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM pos),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM gram) WHERE n >= 2),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_upper,
        CAST(length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS BIGINT) AS n_letters
      FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, CAST({_RULES_SQL} AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {mask(POLICIES["base-1"])}) <> 0 AS base_failed,
       (failed & {mask(POLICIES["standard-1"])}) = 0 AS kept, failed, n_lines, n_upper, n_letters FROM f
""",
}
