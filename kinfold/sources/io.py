"""Sources and sinks: tab-separated registries, id lists, Parquet, JSON settings, match lists."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def read_tsv(spark: SparkSession, path: str | list[str], columns: tuple[str, ...] = RECORD_COLUMNS, *, limit: int | None = None, multi_line: bool = False) -> DataFrame:
    """Some columns of files with a header, as text; nothing is taken for a null, and what is missing is the empty string.

    Only these columns are parsed, in whatever order the header has them; a name that it lacks is an error. Files are
    split among tasks, unless quoted fields may hold line breaks (`multi_line`), when each file is one task's."""
    df = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', inferSchema=False, enforceSchema=False, multiLine=multi_line)
    df = df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns))
    return df.limit(limit) if limit is not None else df


def read_columns(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """Some columns of Parquet files; a folder's part files are read together, and a missing path is an error."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path)).select(*columns)


def find_parquet(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Files of this name pattern anywhere below a folder."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(root)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: one a line, no header; blank lines are passed by."""
    return spark.read.text(path).select(F.trim("value").alias("entity_id")).filter("entity_id <> ''")


def only_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of df whose id is listed."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column, "left_semi")


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """n_rows: lines of a text file without its header."""
    return spark.read.text(path).agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("n_rows"))


def write_ids(ids: DataFrame, path: str) -> None:
    ids.select(F.col(ids.columns[0]).cast("string")).write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replaces what is there."""
    df.write.mode("overwrite").parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", quote='"', escape='"')


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def id_lists(pairs: DataFrame, entities: DataFrame, *, out: str = "matched_entity_ids") -> DataFrame:
    """source1_entity_id and its candidates, best score first, joined by commas: a row for every entity, "" for none.

    pairs: s1_entity_id, candidate_entity_id and, if it has one, score."""
    score = F.col("score") if "score" in pairs.columns else F.lit(0.0)
    held = pairs.groupBy("s1_entity_id").agg(F.array_sort(F.collect_list(F.struct((-score).alias("s"), F.col("candidate_entity_id").alias("c")))).alias("l"))
    joined = held.select("s1_entity_id", F.array_join(F.transform("l", lambda x: x["c"]), ",").alias(out))
    every = entities.select(F.col(entities.columns[0]).alias("source1_entity_id")).distinct()
    return every.join(joined, every["source1_entity_id"] == joined["s1_entity_id"], "left").select("source1_entity_id", F.coalesce(out, F.lit("")).alias(out))


def read_settings(path: str) -> dict:
    return json.loads(Path(path).read_text())


def write_settings(settings: dict, path: str) -> None:
    Path(path).write_text(json.dumps(settings, indent=2, sort_keys=True))
