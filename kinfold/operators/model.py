"""Scorers: gradient-boosted trees in two stages with out-of-fold scores, and a second scorer for an entity's best pairs.

Spark ML's trees take the place of a library that isn't at hand: they grow by depth, so scores differ from those of
leaf-wise trees. The second scorer is pluggable; the default is a logistic regression on hashed words of the pair.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import HashingTF, SQLTransformer, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import stored
from . import split
from .context import SCORE_FEATURES, TRANSITIVE_FEATURES, with_scores, with_transitive

KEEP_FROM = 0.02


def fit_trees(df: DataFrame, features: list[str], *, rounds: int = 20, depth: int = 4, validation: str | None = None, seed: int = split.SEED) -> PipelineModel:
    """Boosted trees on float features (or on a vector `features` of them, which the model then takes too); with a validation flag, rounds stop when it no longer improves (all are made where no row, or
    every row, has it)."""
    kind = GBTClassifier(labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=0.1, subsamplingRate=0.9, minInstancesPerNode=5, seed=seed)
    if validation and df.select(validation).distinct().count() == 2:
        kind = kind.setValidationIndicatorCol(validation)
    elif validation:
        df = df.drop(validation)
    rows = df.withColumn("label", F.col("label").cast("double"))
    first = [] if "features" in df.columns else [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")]
    return Pipeline(stages=[*first, kind]).fit(rows)


def scored(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    done = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return done.select(*df.columns, out)


def importances(model: PipelineModel, features: list[str], n: int = 15) -> list[tuple[str, float]]:
    return sorted(zip(features, model.stages[-1].featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))[:n]


def used(model: PipelineModel, features: list[str]) -> set[str]:
    """The features that a split of the model's trees reads; its scores depend on no others."""
    return {features[int(i)] for i in re.findall(r"\(feature (\d+) ", model.stages[-1].toDebugString)}


def out_of_fold(train: DataFrame, others: DataFrame, features: list[str], **options) -> tuple[DataFrame, DataFrame, list[PipelineModel]]:
    """train scored by the model of the other half of the entities, others by the mean of both models."""
    folded = train.withColumn("__f", split.fold("s1_entity_id"))
    models = [fit_trees(folded.filter(F.col("__f") != k), features, **options) for k in (0, 1)]
    own = scored(models[0], folded.filter("__f = 0")).unionByName(scored(models[1], folded.filter("__f = 1"))).drop("__f")
    return own, mean_scored(models, others), models


def mean_scored(models: list[PipelineModel], df: DataFrame) -> DataFrame:
    for i, m in enumerate(models):
        df = scored(m, df, f"__s{i}")
    mean = sum((F.col(f"__s{i}") for i in range(len(models))), F.lit(0.0)) / len(models)
    return df.withColumn("score", mean).drop(*(f"__s{i}" for i in range(len(models))))


def second_stage(df: DataFrame, *, transitive: bool = True) -> tuple[DataFrame, list[str]]:
    """df (complete by entity, with `score`) with the features of the second stage, and their names."""
    out = with_scores(df)
    return (with_transitive(out), SCORE_FEATURES + TRANSITIVE_FEATURES) if transitive else (out, list(SCORE_FEATURES))


def two_stages(train: DataFrame, others: DataFrame, features: list[str], *, transitive: bool = True, **options) -> tuple[DataFrame, PipelineModel]:
    """others scored by the second stage, which learns from out-of-fold scores of the first."""
    first, held, _ = out_of_fold(train, others, features, **options)
    a, more = second_stage(first, transitive=transitive)
    b, _ = second_stage(held, transitive=transitive)
    used = dict.fromkeys(("label", options.get("validation") or "label", *features, *more))
    model = fit_trees(stored(a.select(*used), "second-stage"), [*features, *more], **options)  # a fit reads its rows several times
    return scored(model, b.withColumnRenamed("score", "first_score")), model


def pair_text(left: DataFrame, side: str, length: int = 300) -> DataFrame:
    """entity_id and the text that a second scorer reads: name and address, cut to `length`."""
    return left.select(F.col("entity_id").alias(side), F.substring(F.concat_ws(" | ", "name_norm", "addr_norm"), 1, length).alias(f"{side}_text"))


Rescorer = Callable[[DataFrame, DataFrame], DataFrame]


def word_rescorer(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs and `ce`: a regression on words that one side alone or both have (left_text, right_text, label)."""
    marked = "SELECT *, concat_ws(' ', transform(array_intersect(split(left_text, ' '), split(right_text, ' ')), x -> concat('=', x)), transform(array_except(split(left_text, ' '), split(right_text, ' ')), x -> concat('<', x)), transform(array_except(split(right_text, ' '), split(left_text, ' ')), x -> concat('>', x))) AS words FROM __THIS__"
    words = PipelineModel([SQLTransformer(statement=marked), Tokenizer(inputCol="words", outputCol="tokens"), HashingTF(inputCol="tokens", outputCol="features", numFeatures=1 << 14)])
    rows = words.transform(train).select(F.col("label").cast("double").alias("label"), "features")
    model = LogisticRegression(labelCol="label", regParam=0.01, maxIter=30).fit(stored(rows, "words"))  # a fit reads its rows several times
    return model.transform(words.transform(pairs)).withColumn("ce", vector_to_array("probability")[1].cast("float")).select(*pairs.columns, "ce")


def rescored(train: DataFrame, scores: DataFrame, norm: DataFrame, *, train_norm: DataFrame | None = None, k: int = 10, least: float = KEEP_FROM, scorer: Rescorer = word_rescorer) -> DataFrame:
    """s1_entity_id, candidate_entity_id, ce of each entity's k best pairs, by a scorer that learns from those of train.

    The records of train are in norm too, unless `train_norm` has them: registries of different splits may share ids. The best
    pairs are stored, since what reads them may do so several times."""

    def best(df: DataFrame, norm: DataFrame) -> DataFrame:
        top = stored(split.top_k(df, k, least=least), "best")
        texts = norm.select("entity_id", "name_norm", "addr_norm")
        left, right = pair_text(texts, "left"), pair_text(texts, "right")
        return top.join(left, top["s1_entity_id"] == left["left"]).join(right, top["candidate_entity_id"] == right["right"])

    return scorer(best(train, norm if train_norm is None else train_norm), best(scores, norm)).select("s1_entity_id", "candidate_entity_id", "ce")
