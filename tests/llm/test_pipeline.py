import importlib

from pyspark.sql import functions as F


def test_stages(spark, small):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    item = spark.read.parquet(f"{small}/benchmark.parquet").first().text
    extra = spark.createDataFrame([(10**9, f"Some words before it. {item} And after it some more.", "en", "src1", 9), (10**9 + 1, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    columns, seen = docs.columns, [docs.count()]
    for name, stage in pipeline.STAGES:
        docs = pipeline.kept(stage(spark, docs, small), name)
        seen.append(docs.count())
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "decontaminate":
            assert docs.filter(f"doc_id = {10**9}").count() == 0
        if name == "secrets":
            assert docs.filter(F.col("text").rlike(r"token = \"[0-9a-f]{20}")).count() == 0 and seen[-1] == seen[-2]
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    assert docs.filter("not round_trip").count() == 0
