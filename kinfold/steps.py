"""The ten steps from registries to matches, as functions with their defaults and as commands.

    python -m kinfold.steps blocking --work-dir /shared/work --split train

Steps talk through a work folder, which may lie on any file system that Spark reads: norm/, splits/, blocking/{split}_{tag}/ and
the folder of a run, with its models, scores, settings and lists. Tables are Parquet, lists are folders of tab-separated files,
reports folders of CSV. Options that a session's own settings stand for (workers, chunk and batch sizes) don't exist here, nor
do those of a transformer (model name, epochs, learning rate, lengths): a second scorer is a function.
"""

from __future__ import annotations

import argparse
import inspect
import json
import types
import typing
from dataclasses import asdict, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .functions.text import normalized
from .operators import blocking as B
from .operators import diagnostics as G
from .operators import features as X
from .operators import metrics as M
from .operators import model as L
from .operators import selection as P
from .operators import split as T
from .operators import tune as U
from .sources import io
from .sources.store import stored

SOURCES = (1, 2, 3)
PAIR = ("s1_entity_id", "candidate_entity_id")


def _save(spark: SparkSession, settings: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(settings, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _load(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _rules(spark: SparkSession, run_dir: str) -> P.Rules:
    return P.Rules(**_load(spark, f"{run_dir}/settings"))


def _records(spark: SparkSession, data_dir: str, split: str, sources: tuple[int, ...] = SOURCES) -> DataFrame:
    return io.read_tsv(spark, [f"{data_dir}/{split}_source{i}.tsv" for i in sources])


def _links(spark: SparkSession, work_dir: str) -> DataFrame:
    return spark.read.parquet(f"{work_dir}/splits/gt_links.parquet")


def _entities(spark: SparkSession, work_dir: str, split: str | None = None) -> DataFrame:
    every = spark.read.parquet(f"{work_dir}/splits/gt_entities.parquet")
    held = every.filter(F.col("split") == split) if split else every
    return held.select(F.col("source1_entity_id").alias("s1_entity_id"), F.lower(F.trim(F.coalesce("country", F.lit("")))).alias("country"))


def _norm(spark: SparkSession, work_dir: str, split: str, sources: tuple[int, ...] = SOURCES) -> DataFrame:
    return spark.read.parquet(*(f"{work_dir}/norm/{split}_source{i}.parquet" for i in sources))


def normalize_record(spark: SparkSession, name: str | None, address: str | None, country: str | None) -> Row:
    """The normalized columns of one record."""
    return normalized(spark.createDataFrame([("", name, address, country)], "entity_id string, business_name string, business_address string, country string")).drop("entity_id", "country").first()


def normalize(spark: SparkSession, data_dir: str, work_dir: str, splits: list[str] = ["train", "test"], limit: int | None = None) -> None:
    """norm/{split}_source{i}.parquet of the registries {split}_source{i}.tsv."""
    for split in splits:
        for i in SOURCES:
            records = io.read_tsv(spark, f"{data_dir}/{split}_source{i}.tsv", limit=limit)
            io.write_parquet(normalized(records), f"{work_dir}/norm/{split}_source{i}.parquet")


def make_split(spark: SparkSession, data_dir: str, work_dir: str, val_size: int = 50_000, seed: int = T.SEED) -> DataFrame:
    """splits/: entities and links with their split, and the ids of both splits. Returns the summary."""
    truth = io.read_tsv(spark, f"{data_dir}/train_ground_truth.tsv", io.TRUTH_COLUMNS)
    every = T.with_split(T.entities(truth, _records(spark, data_dir, "train", (1,))), val_size, seed=seed)
    io.write_parquet(every, f"{work_dir}/splits/gt_entities.parquet")
    every = spark.read.parquet(f"{work_dir}/splits/gt_entities.parquet")
    io.write_parquet(T.links(truth).join(every.select("source1_entity_id", "split"), "source1_entity_id"), f"{work_dir}/splits/gt_links.parquet")
    for split in ("val", "train"):
        io.write_ids(every.filter(F.col("split") == split).select("source1_entity_id"), f"{work_dir}/splits/{split}_s1_ids.txt")
    return T.summary(every)


def blocking(
    spark: SparkSession, work_dir: str, split: str, ids_file: str | None = None, sample: int | None = None, tag: str | None = None, rare_df: int = 500, max_block: int = 200, max_nums: int = 3, max_cands: int = 200,
    no_new_passes: bool = False, pair_words_index: int = 4, pair_words_query: int = 6, num_words_index: int = 8, num_words_query: int = 12, typo_passes: bool = False, prefix_words: int = 3, seed: int = T.SEED,
) -> DataFrame | None:
    """blocking/{split}_{tag}/: candidates of the split's source 1 (of the listed ids; on train without a list, of the validation ids).
    Sources 2 and 3 are the index, always whole. On train, pairs have labels, and recall by country is returned."""
    if split not in ("train", "test"):
        raise ValueError("split is train or test")
    s = B.Settings(rare_df, max_block, max_nums, max_cands, not no_new_passes, typo_passes, pair_words_index, pair_words_query, num_words_index, num_words_query, prefix_words)
    name = tag or ("val" if split == "train" and not ids_file else "all")
    ids = ids_file or (f"{work_dir}/splits/val_s1_ids.txt" if split == "train" else None)
    queries, index = _norm(spark, work_dir, split, (1,)), _norm(spark, work_dir, split, (2, 3))
    if ids:
        queries = io.only_ids(queries, io.read_ids(spark, ids), "entity_id")
    if sample is not None:
        queries, name = io.only_ids(queries, T.sample_ids(queries, sample, key="entity_id", seed=seed), "entity_id"), f"{name}_s{sample}"
    pairs, out = B.block(queries, index, s), f"{work_dir}/blocking/{split}_{name}"
    if split == "test":
        io.write_parquet(pairs, out)
        return None
    io.write_parquet(B.labelled(pairs, _links(spark, work_dir)), out)
    every = _entities(spark, work_dir).join(queries.select(F.col("entity_id").alias("s1_entity_id")), "s1_entity_id", "left_semi")
    links = _links(spark, work_dir).join(every.select(F.col("s1_entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    return G.recall_by_country(spark.read.parquet(out), links, every)


def _countries(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    return pairs.join(norm.select(F.col("entity_id").alias("s1_entity_id"), "country"), "s1_entity_id")


def _write_matches(scores: DataFrame, rules: P.Rules, ids: DataFrame, path: str) -> None:
    io.write_tsv(io.id_lists(P.selected(scores, rules), ids), path)


def train_predict(
    spark: SparkSession, work_dir: str, out_dir: str, train_cands: str = "train_train", val_cands: str = "train_val", test_cands: str = "test_all", resource_dir: str | None = None, rounds: int = 1000, depth: int = 4,
    skip_train: bool = False, skip_test: bool = False, apply_only: bool = False, stage2: bool = False, transitive: bool = False, source_thresholds: bool = False,
) -> float | None:
    """Trains, tunes on the validation scores, scores the test candidates (those of 0.02 or more stay) and writes lists.

    `skip_train` takes models and settings from `resource_dir` (else out_dir); `apply_only` selects again from saved scores, by
    those settings, without any scoring. Training stops before `rounds` when a tenth of its entities no longer gains. Returns
    F0.5 on validation where it was tuned."""
    if transitive and not stage2:
        raise ValueError("transitive features belong to the second stage")
    found, had = None, resource_dir or out_dir
    if not (skip_train or apply_only):
        norm, links, every = _norm(spark, work_dir, "train"), _links(spark, work_dir), _entities(spark, work_dir, "val")
        read = lambda c: stored(X.features(_countries(spark.read.parquet(f"{work_dir}/blocking/{c}"), norm), norm), "features")
        train, val = read(train_cands).withColumn("__stop", T.fold("s1_entity_id", 10, 7) == 0), read(val_cands)
        options, names = {"rounds": rounds, "depth": depth, "validation": "__stop"}, list(X.FEATURES)
        if stage2:
            own, scored, first = L.out_of_fold(train, val, names, **options)
            a, more = L.second_stage(stored(own, "first"), transitive=transitive)
            b, _ = L.second_stage(stored(scored, "first"), transitive=transitive)
            last = L.fit_trees(stored(a, "second"), [*names, *more], **options)
            scores = L.scored(last, b.drop("score"))
            models = {"first0": first[0], "first1": first[1], "last": last}
        else:
            models = {"last": L.fit_trees(train, names, **options)}
            scores = L.scored(models["last"], val)
        for name, m in models.items():
            m.write().overwrite().save(f"{out_dir}/model/{name}")
        io.write_parquet(scores.select(*PAIR, "score", "label", "country"), f"{out_dir}/val_scores.parquet")
        scores = spark.read.parquet(f"{out_dir}/val_scores.parquet")
        rules, found = U.tune(scores, links, every)
        rules, found = U.tune_by_country(scores, links, every, rules)
        if source_thresholds:
            rules, found = U.tune_by_source(scores, links, every, rules)
        _save(spark, asdict(rules), f"{out_dir}/settings")
        _save(spark, {"stage2": stage2, "transitive": transitive}, f"{out_dir}/stages")
        had = out_dir
    if skip_test:
        return found
    ids = _norm(spark, work_dir, "test", (1,)).select("entity_id")
    if not apply_only:
        stages, norm = _load(spark, f"{had}/stages"), _norm(spark, work_dir, "test")
        test = X.features(_countries(spark.read.parquet(f"{work_dir}/blocking/{test_cands}"), norm), norm)
        if stages["stage2"]:
            first = [PipelineModel.load(f"{had}/model/first{k}") for k in (0, 1)]
            test = L.second_stage(stored(L.mean_scored(first, test), "first"), transitive=stages["transitive"])[0].drop("score")
        scores = L.scored(PipelineModel.load(f"{had}/model/last"), test).select(*PAIR, "score", "country").filter(F.col("score") >= L.KEEP_FROM)
        io.write_parquet(scores, f"{out_dir}/test_scores.parquet")
        io.write_tsv(io.id_lists(spark.read.parquet(f"{out_dir}/test_scores.parquet"), ids, out="candidate_entity_ids"), f"{out_dir}/candidate_pairs.tsv")
    at = had if apply_only else out_dir
    _write_matches(spark.read.parquet(f"{at}/test_scores.parquet"), _rules(spark, had), ids, f"{out_dir}/matching_results.tsv")
    return found


def cross_encoder(
    spark: SparkSession, run_dir: str, work_dir: str, out_dir: str, topk: int = 10, min_score: float = L.KEEP_FROM, val_only: bool = False, force_weight: float | None = None, scorer: L.Rescorer = L.word_rescorer
) -> tuple[float, float]:
    """Scores each entity's best pairs again: the scorer learns from half of the validation entities, weight and thresholds are
    searched on the other half, then the test's best pairs are scored, blended and selected. Returns the first score's weight and F0.5."""
    norm, links = _norm(spark, work_dir, "train"), _links(spark, work_dir)
    scores = spark.read.parquet(f"{run_dir}/val_scores.parquet")
    half = lambda df, k: df.filter(T.fold("s1_entity_id", salt=5) == k)
    again = stored(L.rescored(half(scores, 0), half(scores, 1), norm, k=topk, least=min_score, scorer=scorer), "again")
    io.write_parquet(half(scores, 1).join(again, list(PAIR), "left"), f"{out_dir}/ce_val_scores.parquet")
    tuned = half(_entities(spark, work_dir, "val"), 1)
    weights = U.WEIGHTS if force_weight is None else [force_weight]
    weight, rules, found = U.tune_weight(half(scores, 1), again, links, tuned, weights=weights)
    rules, found = U.tune_by_country(P.blended(half(scores, 1), again, weight), links, tuned, rules)
    _save(spark, asdict(rules), f"{out_dir}/settings")
    _save(spark, {"weight": weight}, f"{out_dir}/weight")
    if not val_only:
        test = spark.read.parquet(f"{run_dir}/test_scores.parquet")
        again = stored(L.rescored(half(scores, 0), test, _norm(spark, work_dir, "test"), train_norm=norm, k=topk, least=min_score, scorer=scorer), "again")
        io.write_parquet(test.join(again, list(PAIR), "left"), f"{out_dir}/ce_test_scores.parquet")
        _write_matches(P.blended(test, again, weight), rules, _norm(spark, work_dir, "test", (1,)).select("entity_id"), f"{out_dir}/matching_results.tsv")
    return weight, found


def _final_scores(spark: SparkSession, run_dir: str, ce_dir: str | None, split: str) -> tuple[DataFrame, P.Rules]:
    """The scores of a run, blended with the second scorer's where its folder is given, and the settings that belong to them."""
    if not ce_dir:
        return spark.read.parquet(f"{run_dir}/{split}_scores.parquet"), _rules(spark, run_dir)
    again = spark.read.parquet(f"{ce_dir}/ce_{split}_scores.parquet")
    return P.blended(again.drop("ce"), again.filter("ce is not null"), _load(spark, f"{ce_dir}/weight")["weight"]), _rules(spark, ce_dir)


def france_threshold(spark: SparkSession, run_dir: str, data_dir: str, out_dir: str, ce_dir: str | None = None, france: list[float] = [0.7, 0.8, 0.9], country: str = "france") -> list[str]:
    """Lists with another threshold of one country, one folder a value; all else stays. Returns the folders."""
    scores, rules = _final_scores(spark, run_dir, ce_dir, "test")
    ids, out = _records(spark, data_dir, "test", (1,)).select("entity_id"), []
    for value in france:
        kept = {k: v for k, v in rules.by_country.items() if not k.startswith(f"{country}|")}
        out.append(f"{out_dir}/matching_results_{country}_{value}.tsv")
        _write_matches(scores, replace(rules, by_country=kept).changed(country, value), ids, out[-1])
    return out


def make_candidates(spark: SparkSession, run_dir: str, data_dir: str, out_dir: str, min_score: float = 0.02, matching: str | None = None) -> str:
    """candidate_pairs.tsv of a run's test scores; where a list of matches is named, each of them must be a candidate."""
    pairs = spark.read.parquet(f"{run_dir}/test_scores.parquet").filter(F.col("score") >= min_score)
    if matching:
        held = T.links(io.read_tsv(spark, matching, io.TRUTH_COLUMNS)).select(F.col("source1_entity_id").alias(PAIR[0]), F.col("matched_entity_id").alias(PAIR[1]))
        lost = G.outside(held, pairs).count()
        if lost:
            raise ValueError(f"{lost} matches are no candidates")
    io.write_tsv(io.id_lists(pairs, _records(spark, data_dir, "test", (1,)).select("entity_id"), out="candidate_entity_ids"), f"{out_dir}/candidate_pairs.tsv")
    return f"{out_dir}/candidate_pairs.tsv"


def analyze_misses(spark: SparkSession, work_dir: str, cands: str, examples: int = 12) -> dict[str, DataFrame]:
    """Reports on validation links that a candidate set lacks: what they share, how alike they are, and examples."""
    norm, pairs = _norm(spark, work_dir, "train"), spark.read.parquet(f"{work_dir}/blocking/{cands}")
    lost = stored(G.missed_likeness(G.missed(pairs, _links(spark, work_dir).filter("split = 'val'"), norm), norm), "missed")
    named = norm.select("entity_id", F.col("name_norm").alias("business_name"), F.col("addr_norm").alias("business_address"))
    return {"shared": G.missed_report(lost), "alike": G.missed_likeness_report(lost), "alike_by_country": G.missed_likeness_report(lost, "country"), "examples": G.examples(lost, named, examples)}


def analyze_errors(spark: SparkSession, run_dir: str, work_dir: str, data_dir: str, out_dir: str | None = None, ce_dir: str | None = None, examples: int = 15) -> dict[str, DataFrame]:
    """Reports on a run's validation matches: figures, error classes, reasons, wrong matches with examples, and what-if trials.

    With a second scorer, of the half of the entities that its weight was searched on. Written as CSV where a folder is named."""
    scores, rules = _final_scores(spark, run_dir, ce_dir, "val")
    every = _entities(spark, work_dir, "val")
    if ce_dir:
        every = every.filter(T.fold("s1_entity_id", salt=5) == 1)
    links = _links(spark, work_dir).join(every.select(F.col("s1_entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    kept = stored(P.selected(scores, rules), "kept")
    figures = stored(M.by_entity(kept.select(*PAIR), links, every), "figures")
    true = links.select(F.col("source1_entity_id").alias(PAIR[0]), F.col("matched_entity_id").alias(PAIR[1]))
    wrong = kept.select(*PAIR, "score").join(true, list(PAIR), "left_anti")
    out = {
        "figures": M.macro(figures), "figures_by_country": M.macro(figures, "country"), "errors": G.error_report(figures), "reasons": G.miss_reasons(scores, kept, links, every), "wrong": G.wrong_matches(kept, links),
        "wrong_examples": G.examples(wrong, _records(spark, data_dir, "train"), examples), "trials": spark.createDataFrame(G.trials(scores, links, every, rules), "trial string, f05 double, gain double"),
    }
    for name, df in out.items() if out_dir else ():
        io.write_report(df, f"{out_dir}/{name}.csv")
    return out


def explore_data(spark: SparkSession, data_dir: str = "dataset", examples: int = 6, seed: int = 42) -> dict[str, DataFrame]:
    """Reports on registries and truth: profiles by source, entities without matches, links by source, ids that are linked twice or
    unknown, countries of both sides, how often sides agree exactly, and examples."""
    records = _records(spark, data_dir, "train")
    source = F.substring("entity_id", 1, 2)
    truth = io.read_tsv(spark, f"{data_dir}/train_ground_truth.tsv", io.TRUTH_COLUMNS)
    links = T.links(truth)
    every = T.entities(truth, _records(spark, data_dir, "train", (1,))).withColumn("split", F.lit("train"))
    by = F.substring("matched_entity_id", 1, 2).alias("source")
    pairs = links.select(F.col("source1_entity_id").alias(PAIR[0]), F.col("matched_entity_id").alias(PAIR[1]))
    return {
        "profile": G.profile(records.withColumn("source", source), "source"), "by_country": G.profile(records.withColumn("source", source), "source", "country"), "entities": T.summary(every),
        "links_by_source": links.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("matched_entity_id").alias("n_ids")), "linked_twice": links.groupBy("matched_entity_id").agg(F.countDistinct("source1_entity_id").alias("n")).filter("n > 1"),
        "unknown": G.unknown_ids(links, records), "countries": G.country_crosstab(links, records), "exact": G.exact_rates(links, records, seed=seed), "examples": G.examples(pairs, records, examples, seed=seed),
    }


STEPS = {f.__name__: f for f in (normalize, make_split, blocking, train_predict, cross_encoder, france_threshold, make_candidates, analyze_misses, analyze_errors, explore_data)}


def parser() -> argparse.ArgumentParser:
    """A command a step, an option a parameter: lists by commas, flags without a value."""
    top = argparse.ArgumentParser(prog="kinfold.steps")
    commands = top.add_subparsers(dest="step", required=True)
    for name, f in STEPS.items():
        command, hints = commands.add_parser(name, description=f.__doc__), typing.get_type_hints(f)
        for p in list(inspect.signature(f).parameters.values())[1:]:
            if p.name == "scorer":
                continue
            kind, option = hints[p.name], f"--{p.name.replace('_', '-')}"
            if kind is bool:
                command.add_argument(option, action="store_true")
                continue
            if isinstance(kind, types.UnionType):
                kind = next(k for k in typing.get_args(kind) if k is not type(None))
            if typing.get_origin(kind) is list:
                kind = lambda text, each=typing.get_args(kind)[0]: [each(x.strip()) for x in text.split(",") if x.strip()]
            if p.default is inspect.Parameter.empty:
                command.add_argument(option, type=kind, required=True)
            else:
                command.add_argument(option, type=kind, default=p.default)
    return top


def main(argv: list[str] | None = None) -> None:
    options = vars(parser().parse_args(argv))
    step = STEPS[options.pop("step")]
    out = step(SparkSession.builder.getOrCreate(), **options)
    for name, df in out.items() if isinstance(out, dict) else [("", out)]:
        if name:
            print(f"== {name}")
        if isinstance(df, DataFrame):
            df.show(50, truncate=False)
        elif df is not None:
            print(df)


if __name__ == "__main__":
    main()
