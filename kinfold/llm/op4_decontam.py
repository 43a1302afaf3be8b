"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity.

Texts are lower-cased and cut into words of letters and digits; shingles have `SHINGLE` words, and a shingle weighs as
much as it has distinct words. A window of a document is as long as a benchmark item. It can only be similar to the item
if it shares a shingle with it, and then an item laid over the text by such a shared shingle gives the window: so
windows are placed there, one for each maximal run of shared shingles in the same alignment, and nowhere is a window
lost. Equal windows are fingerprinted once. Items are indexed by the blocks of their fingerprints: 64 bits in `RADIUS` + 1
blocks, of which any two fingerprints within `RADIUS` share one at least. Since a radius that is sure at a similarity of
0.8 leaves blocks of three bits, which most pairs share by chance, a window looks its blocks up only among the items of
its size that it shares a shingle with: the join grows with the windows, not with windows times items. What survives is
verified by weighted Jaccard similarity, at `SIMILARITY` or more. The radius leaves 3.6 standard deviations above the
distance expected at 0.8.

Only DataFrame functions. The items' shingles, a stated query set, are broadcast in blocks of about `BROADCAST_SHINGLES`;
each block is one pass over the documents, whose texts are never shuffled. An item or document without a whole shingle
matches nothing; so do nulls and empty tables. Repeated rows of a doc_id give its matches once; repeated items are alike.
Only the named columns are read, so that others may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import dropped, free_name, kept, table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BROADCAST_SHINGLES = 400_000
BROADCAST_MATCHES = 20_000
_WEIGHT = 7  # the low bits of a shingle's number hold its weight


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(ws: Column) -> Column:
    """The numbers of a text's shingles, in order; none if it has too few words. `ws` must be a column: lambdas would compute an expression anew for each element."""
    n = F.size(ws) - (SHINGLE - 1)

    def number(w: Column, i: Column) -> Column:
        own = [w, *(F.get(ws, i + j) for j in range(1, SHINGLE))]
        weight = F.size(F.array_distinct(F.array(*own))).cast("long")
        return F.xxhash64(*own).bitwiseAND(F.lit(~_WEIGHT)).bitwiseOR(weight)

    return F.when(n > 0, F.transform(F.slice(ws, 1, F.greatest(n, F.lit(0))), number)).otherwise(F.array().cast("array<bigint>"))


def _weight(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x.bitwiseAND(F.lit(_WEIGHT)))


def fingerprints(df: DataFrame, key: str, numbers: str) -> DataFrame:
    """key, simhash: of the distinct shingles in the array column `numbers`, by weight. Sixteen sums hold four bits' counts each."""
    one = df.select(key, F.explode(F.array_distinct(numbers)).alias("x")).select(key, F.col("x").bitwiseAND(F.lit(_WEIGHT)).alias("w"), F.xxhash64("x").alias("x"))
    bit = lambda b: F.shiftrightunsigned("x", b).bitwiseAND(F.lit(1))
    lanes = [F.sum(F.col("w") * sum((F.shiftleft(bit(j + 16 * q), 16 * q) for q in range(1, 4)), bit(j))).alias(f"l{j}") for j in range(16)]
    sums = one.groupBy(key).agg(F.sum("w").alias("all"), *lanes)
    count = lambda j, q: F.shiftrightunsigned(f"l{j}", 16 * q).bitwiseAND(F.lit(0xFFFF))
    words_ = []
    for q in range(4):
        part = F.lit(0).cast("long")
        for j in range(16):
            part = part.bitwiseOR(F.when(count(j, q) * 2 > F.col("all"), F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long")))
        words_.append(F.shiftleft(part, 16 * q))
    return sums.select(key, words_[0].bitwiseOR(words_[1]).bitwiseOR(words_[2]).bitwiseOR(words_[3]).alias("simhash"))


def _blocks(radius: int, name: str) -> Column:
    """(block, its bits) of the column of fingerprints, for radius + 1 blocks of 64 bits."""
    edges = [64 * b // (radius + 1) for b in range(radius + 2)]
    return F.explode(F.array(*(F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(name, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits")) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)))))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, similarity (the best window's), n_windows, first_word (of the earliest such window, from 0)."""
    items = kept(
        benchmark.filter(F.col("item_id").isNotNull())
        .select("item_id", words(F.col("text")).alias("ws"))
        .select("item_id", F.size("ws").alias("size"), shingles(F.col("ws")).alias("numbers"))
        .filter(F.size("numbers") > 0)
        .withColumn("item", F.xxhash64("item_id", "numbers"))  # an item_id may have several texts
        .dropDuplicates(["item"]),
        "items",
    )
    placed = items.select("size", "numbers", F.posexplode("numbers").alias("at", "number")).select("size", "at", "number", F.get("numbers", F.col("at") - 1).alias("before")).distinct()
    placed = kept(placed, "placed")
    blocks = max(1, -(-placed.count() // BROADCAST_SHINGLES))
    cut = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col(text)).alias("ws"))
    spread = cut.select("doc_id", shingles(F.col("ws")).alias("own")).select("doc_id", "own", F.posexplode_outer("own").alias("pos", "number"))  # outer: else Spark infers a filter, in which it spells out `own` for each row again
    start = F.col("pos") - F.col("at")
    first = F.greatest(start, F.lit(0))
    window = F.slice("own", first + 1, F.greatest(start + F.col("size") - (SHINGLE - 1) - first, F.lit(0)))
    found = None
    for b in range(blocks):
        part = placed.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b)
        met = spread.join(F.broadcast(part), "number").filter(~F.coalesce(F.get("own", F.col("pos") - 1) == F.col("before"), F.lit(False)))
        one = met.select("doc_id", start.alias("start"), "size", window.alias("window"))
        found = one if found is None else found.unionByName(one)
    windows = kept(found.withColumn("name", F.xxhash64("size", "window")).dropDuplicates(["doc_id", "start", "name"]), "windows")
    distinct = windows.groupBy("name").agg(F.first("size").alias("size"), F.first("window").alias("window"))
    held = kept(distinct.join(fingerprints(distinct, "name", "window"), "name"), "fingerprints")
    known = fingerprints(items, "item", "numbers").withColumnRenamed("simhash", "item_hash")
    blocks_of = lambda c: _blocks(radius, c).alias("b")
    shares = distinct.select("name", "size", F.explode(F.array_distinct("window")).alias("number")).join(items.select("item", "size", F.explode(F.array_distinct("numbers")).alias("number")), ["size", "number"]).select("name", "item").distinct()
    a = held.join(shares, "name").select("name", "item", "simhash", blocks_of("simhash")).select("name", "item", "simhash", "b.block", "b.bits")
    b = known.select("item", "item_hash", blocks_of("item_hash")).select("item", "item_hash", "b.block", "b.bits")
    near = a.join(b, ["item", "block", "bits"]).filter(F.bit_count(F.col("simhash").bitwiseXOR(F.col("item_hash"))) <= radius).select("name", "item").distinct()
    pairs = near.join(held.select("name", "window"), "name").join(items.select("item", "item_id", "numbers"), "item")
    own, other = F.array_distinct("window"), F.array_distinct("numbers")
    shared = _weight(F.array_intersect(own, other))
    verified = pairs.withColumn("similarity", shared / (_weight(own) + _weight(other) - shared)).filter(F.col("similarity") >= similarity).select("name", "item_id", "similarity")
    verified = kept(verified, "verified")
    small = verified.limit(BROADCAST_MATCHES + 1).count() <= BROADCAST_MATCHES
    hits = windows.select("doc_id", "start", "name").join(F.broadcast(verified) if small else verified, "name")
    out = kept(hits.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.countDistinct("start").alias("n_windows"), F.min("start").cast("long").alias("first_word")), "matches")
    dropped(items, placed, windows, held, verified)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows of docs whose text has no match. A row is named by a hash of doc_id and text, so that rows without a doc_id, or with the same, go by their texts; items without an item_id are named by their texts, too."""
    name, hit_here = F.xxhash64(F.col("doc_id").cast("long"), F.col(text)), free_name(docs, "__hit")
    items = benchmark.select(F.xxhash64(F.col("item_id"), F.col("text")).alias("item_id"), "text")
    hit = kept(contaminated(docs.select(name.alias("doc_id"), F.col(text).alias("text")), items).select(F.col("doc_id").alias(hit_here)).distinct(), "hits")
    few = hit.limit(BROADCAST_MATCHES + 1).count() <= BROADCAST_MATCHES
    return docs.join(F.broadcast(hit) if few else hit, name == F.col(hit_here), "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = {
    "op4_decontamination": rf"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws FROM documents WHERE doc_id IS NOT NULL),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws FROM benchmark WHERE item_id IS NOT NULL),
dp AS (SELECT doc_id, ws, unnest(generate_series(0, len(ws) - {SHINGLE})) AS pos FROM dw WHERE len(ws) >= {SHINGLE}),
ip AS (SELECT item_id, ws, len(ws) AS size, unnest(generate_series(0, len(ws) - {SHINGLE})) AS place FROM iw WHERE len(ws) >= {SHINGLE}),
ds AS (SELECT doc_id, pos, array_to_string(ws[pos + 1 : pos + {SHINGLE}], ' ') AS s, len(list_distinct(ws[pos + 1 : pos + {SHINGLE}])) AS w FROM dp),
its AS (SELECT item_id, size, place, array_to_string(ws[place + 1 : place + {SHINGLE}], ' ') AS s, len(list_distinct(ws[place + 1 : place + {SHINGLE}])) AS w FROM ip),
win AS (SELECT DISTINCT doc_id, pos - place AS start, size FROM ds JOIN its USING (s)),
ws AS (SELECT DISTINCT win.doc_id, start, size, s, w FROM win JOIN ds ON win.doc_id = ds.doc_id AND pos BETWEEN start AND start + size - {SHINGLE}),
iset AS (SELECT DISTINCT item_id, size, s, w FROM its),
wt AS (SELECT doc_id, start, size, sum(w) AS w FROM ws GROUP BY ALL), it AS (SELECT item_id, sum(w) AS w FROM iset GROUP BY ALL),
common AS (SELECT doc_id, start, item_id, ws.size, sum(ws.w) AS c FROM ws JOIN iset ON ws.s = iset.s AND ws.size = iset.size GROUP BY ALL),
sim AS (SELECT common.doc_id, item_id, common.start, c / (wt.w + it.w - c) AS similarity FROM common JOIN it USING (item_id)
        JOIN wt ON wt.doc_id = common.doc_id AND wt.start = common.start AND wt.size = common.size)
SELECT doc_id, item_id, CAST(max(similarity) AS DOUBLE) AS similarity, count(DISTINCT start) AS n_windows, CAST(min(start) AS BIGINT) AS first_word
FROM sim WHERE similarity >= {SIMILARITY} GROUP BY doc_id, item_id
""",
}
