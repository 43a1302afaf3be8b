import itertools

from pyspark.sql import functions as F

from kinfold.operators import blocking as B
from kinfold.operators import metrics as M
from kinfold.operators import selection as P
from kinfold.operators import split as T
from kinfold.plans import registry
from kinfold.sources import io
from kinfold.sources import records as R
from kinfold.streaming.incremental import Index, block_stream

SCORES = "s1_entity_id string, candidate_entity_id string, score double, country string"


def test_queries_have_sql():
    missing = set(registry.queries()) - set(registry.oracle_sql())
    assert missing == {"features_all", "context_transitive", "tune_rules", "model_two_stages", "model_rescored", "report_missed_likeness"}


def test_queries_over_all_passes(spark, small):
    queries, sql = registry.queries(), registry.oracle_sql()
    pairs = {tuple(r) for r in queries["blocking_all"](spark, small).select("s1_entity_id", "candidate_entity_id").collect()}
    one = {tuple(r) for r in queries["blocking_name_pair"](spark, small).select("s1_entity_id", "candidate_entity_id").collect()}
    assert one < pairs
    for name in ("features_sets_all_passes", "context_scores_all_passes", "features_all", "context_transitive"):
        got = [tuple(r) for r in queries[name](spark, small).select("s1_entity_id", "candidate_entity_id").collect()]
        assert len(got) == len(pairs) and set(got) == pairs
    assert {r.p for r in queries["features_all"](spark, small).selectExpr("n_passes > 1 as p").distinct().collect()} == {True, False}
    held = R.true_links(spark, small).collect()
    lost = {(r[0], r[1]) for r in queries["report_missed_links_all_passes"](spark, small).collect()}
    assert lost == {(a, b) for a, b in held if (a, b) not in pairs}
    assert {f"{n}_all_passes" for n, text in sql.items() if f"{n}_all_passes" in queries} <= set(sql) and not any("LIKE 'S2-%'" in x for n, x in sql.items() if n.endswith("_all_passes"))


def test_one_owner_and_rescue(spark):
    rows = [("S1-a", "S2-x", 0.9, "us"), ("S1-b", "S2-x", 0.9, "us"), ("S1-b", "S2-y", 0.3, "us"), ("S1-c", "S3-z", 0.1, "us")]
    scores = spark.createDataFrame(rows, SCORES)
    kept = lambda rules: sorted((r[0], r[1]) for r in P.selected(scores, rules).collect())
    assert kept(P.Rules(0.5)) == [("S1-a", "S2-x")]  # of equal owners the lesser id
    assert kept(P.Rules(0.5, top1_threshold=0.2)) == [("S1-a", "S2-x"), ("S1-b", "S2-y")]
    assert kept(P.Rules(0.5, one_owner=False)) == [("S1-a", "S2-x"), ("S1-b", "S2-x")]
    assert kept(P.Rules(0.95, by_country={"us|S3": 0.05})) == [("S1-c", "S3-z")]


def test_metrics_count_every_entity(spark):
    entities = spark.createDataFrame([("S1-a", "us"), ("S1-b", "us"), ("S1-c", "us")], "s1_entity_id string, country string")
    links = spark.createDataFrame([("S1-a", "S2-x")], "source1_entity_id string, matched_entity_id string")
    pred = spark.createDataFrame([("S1-b", "S2-x")], "s1_entity_id string, candidate_entity_id string")
    f = {r["s1_entity_id"]: r["f05"] for r in M.by_entity(pred, links, entities).collect()}
    assert f == {"S1-a": 0.0, "S1-b": 0.0, "S1-c": 1.0}
    assert {r["f05"] for r in M.by_entity(pred.limit(0), links.limit(0), entities).collect()} == {1.0}


def test_name_pair_against_brute_force(spark, small):
    norm = R.stored_norm(spark, small)
    rows = norm.collect()
    df = {(r["country"], r["token"]): r["df"] for r in B.frequencies(norm.filter(~F.col("entity_id").startswith("S1-"))).filter("kind = 'n'").collect()}
    keys = {}
    for r in rows:
        known = sorted((df[r["country"], t], t) for t in {*r["name_core"].split()} if len(t) >= 2 and (r["country"], t) in df)
        if known:
            keys[r["entity_id"]] = (r["country"], *sorted(t for _, t in known[:2]))
    expected = {(a, b) for a, b in itertools.product(keys, keys) if a.startswith("S1-") and not b.startswith("S1-") and keys[a] == keys[b]}
    got = registry.queries()["blocking_name_pair"](spark, small).collect()
    assert {(r[0], r[1]) for r in got} == expected


def test_more_passes_find_more(spark, small):
    norm = R.stored_norm(spark, small)
    q, i = norm.filter(F.col("entity_id").startswith("S1-")), norm.filter(~F.col("entity_id").startswith("S1-"))
    few, all_ = (B.block(q, i, s).select("s1_entity_id", "candidate_entity_id") for s in (B.Settings(new_passes=False, typo_passes=False, max_cands=0), B.Settings(max_cands=0)))
    assert few.exceptAll(all_).count() == 0 and few.count() <= all_.count()


def test_split_is_exact_and_free_of_order(spark):
    df = spark.createDataFrame([(f"S1-{i}",) for i in range(100)], "source1_entity_id string")
    a = {r[0]: r[1] for r in T.with_split(df, 30).collect()}
    b = {r[0]: r[1] for r in T.with_split(df.orderBy(F.desc("source1_entity_id")), 30).collect()}
    assert a == b and sum(v == "val" for v in a.values()) == 30


def test_tsv_round_trip(spark, tmp_path):
    rows = [("S1-1", 'a "quoted" name', "NA", ""), ("S1-2", "", "null", "us")]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    io.write_tsv(df, str(tmp_path / "t"))
    assert sorted(tuple(r) for r in io.read_tsv(spark, str(tmp_path / "t")).collect()) == rows
    pairs = spark.createDataFrame([("S1-1", "S2-b", 0.5), ("S1-1", "S2-a", 0.9)], "s1_entity_id string, candidate_entity_id string, score double")
    assert sorted(tuple(r) for r in io.id_lists(pairs, df.select("entity_id")).collect()) == [("S1-1", "S2-a,S2-b"), ("S1-2", "")]


def test_stream(spark, small, tmp_path):
    records = R.records(spark, small).select("entity_id", "business_name", "business_address", "country")
    norm = R.stored_norm(spark, small)
    index = Index(norm.filter(~F.col("entity_id").startswith("S1-")))
    new = records.filter(F.col("entity_id").startswith("S1-"))
    new.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(new.schema).parquet(str(tmp_path / "in"))
    block_stream(stream, index, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("s1_entity_id", "candidate_entity_id", "passes")
    expected = registry.queries()["blocking_all"](spark, small).select("s1_entity_id", "candidate_entity_id", "passes")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_jaro_winkler_query_of_other_letters(spark, tmp_path):
    import duckdb

    texts = ["große straße haus bau", "straße haus große bau", "bau große straßen haus", "name of plain letters", "plain name letters of"]
    rows = [(i, f"{t} acht worte mehr als der name hat {i}", "de", f"src{i % 3}", 60) for i, t in enumerate(texts * 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, registry.queries()["features_jaro_winkler"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(registry.oracle_sql()["features_jaro_winkler"]).fetchall()) and any("S2" in r[1] and 0 < r[2] < 1 for r in got)


def test_second_stage_is_made_once(spark, monkeypatch):
    """A fit reads its rows several times; those of the second stage come from windows and similarities."""
    from kinfold.operators import model as L

    rows = [(f"S1-{i}", f"S2-{j}", float(i % 3 + j), f"name {i}", f"street {j}", int(i % 2 == j % 2)) for i in range(12) for j in range(4)]
    pairs = spark.createDataFrame(rows, "s1_entity_id string, candidate_entity_id string, x float, b_name_core string, b_addr_norm string, label int")
    plans = []
    monkeypatch.setattr(L, "fit_trees", lambda df, features, fit=L.fit_trees, **o: plans.append(df._jdf.queryExecution().toString()) or fit(df, features, **o))
    made, _ = L.two_stages(pairs, pairs, ["x"], rounds=1, depth=1)
    assert len(plans) == 3 and "Window" not in plans[2] and "parquet" in plans[2] and made.count() == len(rows)


def _small_pairs(spark, small):
    from kinfold.plans import linkage as Q
    from kinfold.sources.store import stored

    norm = R.stored_norm(spark, small)
    return stored(Q._labelled_pairs(spark, small, norm), "pairs"), norm


def test_vectors_hold_the_features_that_a_model_reads(spark, small):
    from kinfold.operators import features as X
    from kinfold.operators import model as L

    pairs, norm = _small_pairs(spark, small)
    rows = lambda df: {(r[0], r[1]): r for r in df.collect()}
    every, made = rows(X.features(pairs, norm)), X.vectors(pairs, norm).localCheckpoint()
    held = rows(made)
    assert set(held) == set(every) and all(r.features.toArray().tolist() == [every[k][f] for f in X.FEATURES] for k, r in held.items())
    model = L.fit_trees(made, X.FEATURES, rounds=2, depth=2)
    read = L.used(model, X.FEATURES)
    assert 0 < len(read) <= 6 and {f for f, x in L.importances(model, X.FEATURES) if x > 0} <= read
    part = X.vectors(pairs, norm, read)
    assert rows(L.scored(model, part).drop("features")) == rows(L.scored(model, made).drop("features"))
    for only in ({"n_cands"}, {"combo_gap", "addr_ratio"}, {"n_name_strong"}, set()):
        got = rows(X.vectors(pairs, norm, only))
        assert set(got) == set(every) and all(r.features.toArray().tolist() == [every[k][f] if f in only else 0.0 for f in X.FEATURES] for k, r in got.items())


def test_rescored_query_reads_what_is_stored(spark, small, monkeypatch):
    """The normalized records are made once, and the second scorer's rows aren't scored, ranked and joined again with each reading."""
    from kinfold.operators import model as L
    from kinfold.plans import linkage as Q

    norms, given = [], []
    monkeypatch.setattr(R, "stored_norm", lambda *a, make=R.stored_norm: norms.append(a) or make(*a))

    def scorer(train, pairs):
        given.extend(df._jdf.queryExecution().toString() for df in (train, pairs))
        return L.word_rescorer(train, pairs)

    monkeypatch.setattr(L.rescored, "__kwdefaults__", L.rescored.__kwdefaults__ | {"scorer": scorer})
    made = Q.QUERIES["model_rescored"](spark, small).collect()
    assert len(norms) == 1 and len(given) == 2 and not any("Window" in x or "UDF" in x for x in given)
    pairs, _ = _small_pairs(spark, small)
    others = pairs.filter(T.fold("s1_entity_id", salt=9) == 1).groupBy("s1_entity_id").count().collect()
    assert len(made) == len({(r[0], r[1]) for r in made}) == sum(min(10, r["count"]) for r in others) and all(0 <= r.ce <= 1 for r in made)


def test_records_of_long_texts(spark, tmp_path, monkeypatch):
    """The first words come from a text's start only where it has them all, uncut."""
    word = "Wort ΑΣ' x́y 12,3\t"
    texts = [word * 40, " " * 700 + word * 5, "!" * 900 + " " + word * 9, "a" * 650 + " " + word * 9, word * 2, "eins", "", None, " ".join(["NBSP"] * 300), "\n".join(f"z{i}ΟΔΟΣ" for i in range(400))]
    texts += [" ".join("w" * k for _ in range(20)) for k in range(3, 60)]
    docs = [(i, t, "de", f"src{i}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = []
    for start in (0, 7, 50, R.START, 5000):  # 0: whole texts
        monkeypatch.setattr(R, "START", start)
        found.append(sorted(map(tuple, R.records(spark, str(tmp_path)).collect()), key=lambda r: r[0]))
    assert all(x == found[0] for x in found) and found[0][0][3] == "wort ας x́y 12"
