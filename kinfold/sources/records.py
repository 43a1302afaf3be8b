"""The records view: business registries made from the documents table, alike in Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalized
from .store import stored


#: Letters of a text among which its first twelve words are looked for; where they aren't found, the whole text is read.
START = 600


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, sn, entity_id, business_name, business_address, country, text_key of every document: three sources by the number in `source`."""
    words = lambda text: F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}\s]", " "), r"\s+"), lambda t: t != "")
    start = words(F.regexp_extract(F.substring("text", 1, START), r"^([\s\S]*)\s", 1))  # up to a space, so that its words are those of the text
    cut = F.when(F.size(start) >= 12, start).otherwise(words("text"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", (1 + F.expr("cast(substr(source, 4) as int)") % 3).alias("sn"), cut.alias("t"), F.md5("text").alias("text_key"))
    part = lambda a, n: F.array_join(F.slice("t", a, n), " ")
    return docs.select(
        "doc_id",
        "sn",
        F.concat(F.lit("S"), F.col("sn").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        part(1, 4).alias("business_name"),
        F.concat(F.col("n_chars").cast("string"), F.lit(" "), part(5, 4), F.lit(", "), part(9, 4), F.lit(", "), (10000 + F.col("n_chars") % 997).cast("string")).alias("business_address"),
        F.col("lang").alias("country"),
        "text_key",
    )


def norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalized records of the three sources."""
    return normalized(records(spark, sf_dir))


def stored_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(norm(spark, sf_dir), "norm")


def true_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source1_entity_id, matched_entity_id: records of one country with the same text."""
    r = records(spark, sf_dir)
    a = r.filter("sn = 1").select(F.col("entity_id").alias("source1_entity_id"), "country", "text_key")
    b = r.filter("sn > 1").select(F.col("entity_id").alias("matched_entity_id"), "country", "text_key")
    return a.join(b, ["country", "text_key"]).select("source1_entity_id", "matched_entity_id")
