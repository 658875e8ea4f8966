"""Operator 7: held-out accuracy and odd rows."""

from pyspark.sql import functions as F

from sackcast.llm import quality


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = quality.graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    split = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    raw = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit_quality(docs, raw.where(~split))
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = quality.rate_quality(docs, model).join(labels.where(split), "doc_id").groupBy("grade").agg(
        F.avg(F.col("keep").cast("double")).alias("kept"), F.avg("expected_grade").alias("mean"), F.count(F.lit(1)).alias("n")).collect()
    kept = {r["grade"]: r["kept"] for r in rows}
    mean = {r["grade"]: r["mean"] for r in rows}
    assert kept[2] > 0.98 and kept[1] < 0.05 and kept[0] < 0.08
    assert mean[0] < mean[1] < mean[2]


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (5, 1, 0), (6, 0, 0), (None, 1, 0), (3, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(odd_docs, labels)
    rated = quality.rate_quality(odd_docs, model)
    assert rated.count() == odd_docs.count() and rated.columns[:len(odd_docs.columns)] == odd_docs.columns
    assert {r["p_good"] for r in rated.where("doc_id = 1").collect()}.__len__() == 1
    assert quality.fit_quality(odd_docs, labels.limit(0)) is None
    assert quality.rate_quality(odd_docs, None).where("keep").count() == odd_docs.count()
    assert quality.rate_quality(odd_docs.limit(0), model).count() == 0


def test_fit_holds_little_beside_its_sample(spark):
    """The driver's arrays while it fits stay near the size of the sample's entries (8 bytes each)."""
    import tracemalloc
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = docs.join(quality.graded(labels), "doc_id").select("text").toArrow()
    entries = sum(len(quality.features(x)[0]) for x in quality.pieces(rows.to_batches()))
    model = quality.fit_quality(docs, labels)
    tracemalloc.start()
    try:
        again = quality.fit_quality(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (again.weights == model.weights).all() and (again.thresholds == model.thresholds).all()
    assert peak < 2 * 8 * entries + 32 * (1 << quality.BITS)
