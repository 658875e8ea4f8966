"""The pipeline: each stage on its own input against a plain version of its rule."""

import re

import corpus_pipeline
from sackcast.llm import secret_scan

from .test_jaccard import _brute


def test_stages_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [" ".join(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", r["text"].lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    before = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = corpus_pipeline.cut(stages["quality"](spark, docs, sf))
    ids = {r["doc_id"] for r in kept.collect()}
    good = {i for i, x in labels.items() if x == (1, 0)}
    assert len(good & ids) > 0.97 * len(good) and len((labels.keys() - good) & ids) < 0.03 * len(labels)
    assert kept.columns == docs.columns

    single = corpus_pipeline.cut(stages["near_duplicates"](spark, kept, sf))
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, _, root in _brute(rows, 5, 80) if i == root)

    clean = corpus_pipeline.cut(stages["decontamination"](spark, single, sf))
    left = {r["doc_id"] for r in clean.collect()}
    for r in single.collect():
        text = " ".join(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", r["text"].lower()))
        assert any(f" {i} " in f" {text} " for i in items) == (r["doc_id"] not in left)

    masked = corpus_pipeline.cut(stages["secrets"](spark, clean, sf))
    for r in masked.collect():
        text = before[r["doc_id"]]
        assert r["text"] == secret_scan.redacted(text, secret_scan.find_secrets(text)[1]) and r["n_chars"] == len(r["text"])
        assert not secret_scan.scan(r["text"])
    mixed = stages["mixing"](spark, masked, sf).collect()
    assert {r["doc_id"] for r in mixed} == left
    assert sum(r["taken"] for r in mixed) > 0


def test_odd_rows(spark, odd_docs, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "no such text at all")], "item_id long, text string")
    for name, table in (("documents", odd_docs), ("labels", labels), ("benchmark", benchmark)):
        table.write.parquet(f"{tmp_path}/full/{name}.parquet")
        table.limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "2", "3", "4", "5", "6", "None"]
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_quality_stage_leaves_columns_of_any_name(spark):
    from pyspark.sql import functions as F
    sf = "/root/testdata/sf0.001"
    plain = spark.read.parquet(f"{sf}/documents.parquet")
    docs = plain.withColumns({"keep": F.lit("mine"), "p_good": F.lit("mine"), "p_not_toxic": F.lit(None).cast("int"), "expected_grade": F.lit("mine")})
    stage = dict(corpus_pipeline.STAGES)["quality"]
    kept = stage(spark, docs, sf)
    assert kept.schema == docs.schema
    rows = kept.collect()
    assert {(r["keep"], r["p_good"], r["p_not_toxic"], r["expected_grade"]) for r in rows} == {("mine", "mine", None, "mine")}
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in stage(spark, plain, sf).collect())
