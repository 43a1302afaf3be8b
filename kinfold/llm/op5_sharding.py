"""Hierarchical weighted hash tree: rows descend region, rack and shard by weighted hash draws.

A leaf's draw for a row is -ln(u) / weight, u a hash of (doc_id, leaf) in (0, 1]; an inner node's draw is the least
among its leaves, which is an exponential draw with the node's whole weight. A row goes down to the child of least
draw. Since a node's draw changes only with its own leaves, a change of weights moves rows only into or out of the
subtrees whose weights change; a new leaf takes rows only into itself.

Law `key`: doc_id and the tree (the shard count) decide, nothing else. Null doc_id draws like a key of its own. Equal
texts are not moved together; repeated doc_ids are. Slots count each shard's rows without gaps from 0 in two levels:
rows are numbered within (shard, bin), and bins get the sum of the bins before them; the table of bins has
shards x `BINS` rows at most, whatever the input, and so may be broadcast. Null text has size 1 and the CRC of nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import kept, table

SHARDS = 8
BINS = 1024
_UNIT = float(1 << 53)


@dataclass(frozen=True)
class Leaf:
    shard: int
    region: int
    rack: int
    weight: float = 1.0


def tree(shards: int, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """Leaves of equal weight: `per_rack` shards a rack, `racks` racks a region, regions as many as it takes."""
    return [Leaf(i, i // (per_rack * racks), i // per_rack % racks) for i in range(shards)]


def _draw(key: Column, leaf: Leaf) -> Column:
    """An exponential draw of rate `weight`."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(leaf.shard)), 11).cast("double") + F.lit(0.5)) / F.lit(_UNIT)
    return -F.ln(u) / F.lit(float(leaf.weight))


def _least(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.least(*columns)


def descend(leaves: list[Leaf], draws: dict[int, Column]) -> Column:
    """The shard that a row reaches: at each level the child of least draw, the first among equals."""
    if not leaves:
        raise ValueError("a tree has a leaf at least")

    def children(of: list[Leaf], level: str) -> list[list[Leaf]]:
        return [[x for x in of if getattr(x, level) == v] for v in sorted({getattr(x, level) for x in of})]

    def go(of: list[Leaf], levels: list[str]) -> Column:
        if len(of) == 1 or not levels:
            return F.lit(of[0].shard)
        below = children(of, levels[0])
        if len(below) == 1:
            return go(of, levels[1:])
        own = [_least([draws[x.shard] for x in b]) for b in below]
        best, out = _least(own), go(below[-1], levels[1:])
        for draw, b in reversed(list(zip(own[:-1], below[:-1], strict=True))):
            out = F.when(draw == best, go(b, levels[1:])).otherwise(out)
        return out

    return go(leaves, ["region", "rack", "shard"])


def assign(df: DataFrame, leaves: list[Leaf], *, key: str = "doc_id", grown: list[Leaf] | None = None) -> DataFrame:
    """df with `shard`, and `grown_shard` where a grown tree is given, by the key alone."""
    every = {x.shard: x for x in [*leaves, *(grown or [])]}
    names = {s: f"__draw_{s}" for s in every}
    out = df.withColumns({names[s]: _draw(F.col(key), x) for s, x in every.items()})
    draws = {s: F.col(n) for s, n in names.items()}
    out = out.withColumns({"shard": descend(leaves, draws).cast("int")} | ({"grown_shard": descend(grown, draws).cast("int")} if grown else {}))
    return out.drop(*names.values())


def with_slots(df: DataFrame, *, key: str = "doc_id", tie: str = "text_crc32") -> DataFrame:
    """df (with `shard`) and `slot`: the row's number in its shard, gapless from 0."""
    binned = df.withColumn("__bin", F.pmod(F.xxhash64(F.lit("bin"), F.col(key), F.col(tie)), F.lit(BINS)).cast("int"))
    sums = binned.groupBy("shard", "__bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = sums.select("shard", "__bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy("shard", "__bin").orderBy(F.col(key), F.col(tie))
    numbered = binned.withColumn("__own", F.row_number().over(own) - 1)
    return numbered.join(F.broadcast(bins), ["shard", "__bin"]).withColumn("slot", (F.col("__before") + F.col("__own")).cast("long")).drop("__bin", "__own", "__before")


def op5_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = kept(assign(docs, tree(SHARDS), grown=tree(SHARDS + 1)), "shards")
    return with_slots(rows).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
