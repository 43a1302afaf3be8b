"""The ten steps over a made registry, and the reports that they give."""

import pytest

from kinfold import steps
from kinfold.functions.similarity import token_set_ratio
from kinfold.operators import diagnostics as G
from kinfold.operators import tune as U
from kinfold.operators.selection import Rules

WORDS = "amber birch cedar delta ember fjord grove haven islet jade kelp lunar maple north ocean pearl quartz river slate tidal".split()


def written(path, header, rows):
    path.write_text("\n".join("\t".join(r) for r in [header, *rows]) + "\n", encoding="utf-8")


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    """60 entities a split; each has a copy in source 2 with another ending, every second one in source 3 with a lost word."""
    folder, columns = tmp_path_factory.mktemp("data"), ("entity_id", "business_name", "business_address", "country")
    for split, shift in (("train", 0), ("test", 7)):
        sides, truth = ([], [], []), []
        for i in range(60):
            a, b, c = WORDS[(i + shift) % 20], WORDS[(i // 3 + 5) % 20], WORDS[(7 * i + shift) % 20]
            country = "France" if i % 3 == 0 else "US"
            name, address = f"{a}ton {b}field {c}", f"{100 + i} {c}wood street, {a}ville"
            sides[0].append((f"S1-{i}", name, address, country))
            sides[1].append((f"S2-{i}", f"{name} Inc", address, country))
            ids = [f"S2-{i}"]
            if i % 2:
                sides[2].append((f"S3-{i}", f"{a}ton {b}field", address, country))
                ids.append(f"S3-{i}")
            truth.append((f"S1-{i}", "" if i % 10 == 0 else ",".join(ids)))
        for k, rows in enumerate(sides, 1):
            written(folder / f"{split}_source{k}.tsv", columns, rows)
        if split == "train":
            written(folder / "train_ground_truth.tsv", ("source1_entity_id", "matched_entity_ids"), truth)
    return str(folder)


def test_steps_end_to_end(spark, data, tmp_path):
    work, run = str(tmp_path / "work"), str(tmp_path / "run")
    steps.normalize(spark, data, work)
    assert sum(r.n for r in steps.make_split(spark, data, work, val_size=25).collect()) == 60
    recall = steps.blocking(spark, work, "train").collect()
    assert sum(r.entities for r in recall) == 25 and all(r.recall == 1 for r in recall)
    steps.blocking(spark, work, "train", ids_file=f"{work}/splits/train_s1_ids.txt", tag="train")
    assert steps.blocking(spark, work, "test") is None
    found = steps.train_predict(spark, work, run, rounds=2, depth=2)
    lists = {r.source1_entity_id: r.matched_entity_ids for r in spark.read.csv(f"{run}/matching_results.tsv", sep="\t", header=True).collect()}
    assert found > 0.5 and len(lists) == 60 and "S2-7" in lists["S1-7"]
    assert steps.make_candidates(spark, run, data, str(tmp_path / "c"), matching=f"{run}/matching_results.tsv")
    again = str(tmp_path / "again")
    steps.train_predict(spark, work, again, resource_dir=run, apply_only=True)
    assert lists == {r.source1_entity_id: r.matched_entity_ids for r in spark.read.csv(f"{again}/matching_results.tsv", sep="\t", header=True).collect()}
    ce = str(tmp_path / "ce")
    assert steps.cross_encoder(spark, run, work, ce, force_weight=0.5)[0] == 0.5
    blended, _ = steps._final_scores(spark, run, ce, "test")
    assert blended.columns == spark.read.parquet(f"{run}/test_scores.parquet").columns and blended.count() == spark.read.parquet(f"{run}/test_scores.parquet").count()
    errors = {k: v.collect() for k, v in steps.analyze_errors(spark, run, work, data, out_dir=str(tmp_path / "e")).items()}
    trials = {r.trial: r.f05 for r in errors["trials"]}
    assert sum(r.n for r in errors["errors"]) == 25 and errors["figures"][0].f05 == pytest.approx(found) == pytest.approx(trials["as it is"])
    assert trials["thresholds by source"] >= trials["thresholds by country"] >= trials["as it is"]
    misses = {k: v.collect() for k, v in steps.analyze_misses(spark, work, "train_val").items()}
    assert misses["examples"] == [] and misses["alike"][0].n_missed == 0
    folders = steps.france_threshold(spark, run, data, str(tmp_path / "f"), france=[2.0])
    none = {r.source1_entity_id: r.matched_entity_ids for r in spark.read.csv(folders[0], sep="\t", header=True).collect()}
    assert all((none[f"S1-{i}"] or "") == ("" if i % 3 == 0 else lists[f"S1-{i}"] or "") for i in range(60) if steps._rules(spark, run).top1_threshold is None)


def test_explore(spark, data):
    out = {k: v.collect() for k, v in steps.explore_data(spark, data).items()}
    assert {(r.source, r.n_rows) for r in out["profile"]} == {("S1", 60), ("S2", 60), ("S3", 30)}
    exact = out["exact"][0]
    assert (exact.n_links, exact.name_equal, exact.address_equal, exact.both_equal) == (84, 0, 1, 0)
    assert out["unknown"] == [] and out["linked_twice"] == [] and len(out["examples"]) == 6
    assert {(r.country, r.matched_country) for r in out["countries"]} == {("France", "France"), ("US", "US")}


def test_missed_likeness(spark):
    norm = spark.createDataFrame([("S1-1", "us", "a b c", "x 1", "1"), ("S2-1", "us", "a b d", "", ""), ("S2-2", "us", "zz", "q", "")], "entity_id string, country string, name_core string, addr_norm string, addr_nums string")
    links = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2")], "source1_entity_id string, matched_entity_id string")
    none = spark.createDataFrame([], "s1_entity_id string, candidate_entity_id string")
    rows = G.missed_likeness(G.missed(none, links, norm), norm)
    held = {r.candidate_entity_id: r for r in rows.collect()}
    assert held["S2-1"].name_tset == pytest.approx(token_set_ratio("a b c", "a b d")) and held["S2-1"].a_has_number and not held["S2-1"].b_has_number
    report = G.missed_likeness_report(rows).first()
    assert (report.n_missed, report.name_alike, report.neither_alike, report.a_has_number) == (2, 0.5, 0.5, 1.0)


def test_tuning_by_source_against_each_score(spark):
    """The grid job of a step finds what scoring every threshold by itself finds."""
    rows = [(f"S1-{i % 12}", f"S{2 + i % 2}-{i}", ((i * 37) % 100) / 100, "us" if i % 12 < 7 else "france") for i in range(60)]
    scores = spark.createDataFrame(rows, "s1_entity_id string, candidate_entity_id string, score double, country string").cache()
    links = spark.createDataFrame([(a, b) for a, b, s, _ in rows if s > 0.6 or b.startswith("S3") and s > 0.3], "source1_entity_id string, matched_entity_id string").cache()
    every = scores.select("s1_entity_id", "country").distinct().cache()
    rules, best = U.tune_by_source(scores, links, every, Rules(0.9), thresholds=[0.3, 0.6], rounds=1)
    plain, top = Rules(0.9), U.score_of(scores, links, every, Rules(0.9))
    for key in ("france|S2", "france|S3", "us|S2", "us|S3"):
        tried = max((U.score_of(scores, links, every, plain.changed(key, t)), -t) for t in (0.3, 0.6))
        if tried[0] > top + U.LEAST_GAIN:
            top, plain = tried[0], plain.changed(key, -tried[1])
    assert rules == plain and best == pytest.approx(top) and best == pytest.approx(U.score_of(scores, links, every, rules))


def test_commands():
    p = steps.parser()
    got = vars(p.parse_args(["blocking", "--work-dir", "w", "--split", "train", "--typo-passes", "--sample", "5"]))
    assert (got["typo_passes"], got["sample"], got["max_cands"], got["rare_df"], got["ids_file"]) == (True, 5, 200, 500, None)
    assert p.parse_args(["france_threshold", "--run-dir", "r", "--data-dir", "d", "--out-dir", "o", "--france", "0.5,0.6"]).france == [0.5, 0.6]
    assert p.parse_args(["make_split", "--data-dir", "d", "--work-dir", "w"]).val_size == 50_000
    assert len(steps.STEPS) == 10
