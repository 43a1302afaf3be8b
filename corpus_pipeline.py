"""The corpus pipeline: quality, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir), docs being all that the stage before kept, and returns what `run` writes and
reads again for the next. All but the last return the columns of docs; the last gives token ids for each text.

quality         goes by the ordinal model's tail probability, fitted on `labels`: toxic and low-quality documents go
near_duplicates one document of each group of near copies stays (five words, 0.8), that of least doc_id; rows of one
                doc_id, or of none, are told apart by their texts
decontaminate   documents with a window similar to a benchmark item go
secrets         secrets in the texts are replaced by a mark, n_chars follows; every document stays
tokens          texts are encoded; the ids are decoded and compared, which `round_trip` tells

Null and empty texts are kept or dropped as the operators' own docstrings say; extra columns are carried through.
ORACLE_SQL is None: the trained stages and the encoder cannot be written in SQL. Tests hold the operators of the stages
against brute force (near copies, spans of the base patterns), SQL (benchmark leaks), the tokenizer's library and held-out
grades; the stages in a row are tested by counts and planted rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import op2_ngram_join, op3_bpe, op4_decontam, op6_quality, op10_secrets
from kinfold.llm.shared import kept, table

NEAR_SHINGLE, NEAR_PER_CENT = 5, 80
MARK = "[secret]"
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op6_quality.fit(docs, table(spark, sf_dir, "labels"))
    return op6_quality.select(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_ngram_join.first_of_each(docs, shingle=NEAR_SHINGLE, per_cent=NEAR_PER_CENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = op10_secrets.redact(docs, mark=MARK)
    return out.withColumn("n_chars", F.when(F.col("text").contains(MARK), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_bpe.round_trip(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
