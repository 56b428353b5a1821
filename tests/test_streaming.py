"""Fitted stateless steps on a readStream source give the batch results."""

import tempfile

from pyspark.sql import functions as F

from quarry.operators import classify as C
from quarry.operators import clean, discretize as D, features as X
from quarry.operators.split import stratified_split
from quarry.plans.derived import dirty_orders
from quarry.streaming.score import CleanPlan, bin_stream, clean_stream, score_stream

SF = "/root/testdata/sf0.001"


def _drain(spark, stream, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_stream_equals_batch(spark):
    batch = dirty_orders(spark, SF).drop("o_orderkey")
    res = clean.clean_table(batch, dedupe=False)
    plan = CleanPlan.from_result(batch, res)
    src = tempfile.mkdtemp(prefix="quarry-stream-src-")
    dirty_orders(spark, SF).write.mode("overwrite").parquet(src)
    sdf = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    got = _drain(spark, clean_stream(sdf, plan), "cleaned")
    want = clean.convert_columns(clean.null_markers(dirty_orders(spark, SF), plan.text), plan.converted)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)

    o = spark.read.parquet(f"{SF}/orders.parquet")
    b = D.bin_quantile(o, "o_totalprice", 3, out="cat")
    osrc = tempfile.mkdtemp(prefix="quarry-stream-orders-")
    o.write.mode("overwrite").parquet(osrc)
    os_ = spark.readStream.schema(o.schema).parquet(osrc)
    got = _drain(spark, bin_stream(os_, "o_totalprice", b.edges, b.labels, "cat").select("o_orderkey", "cat"), "binned")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, b.table.select("o_orderkey", "cat").collect()))


def test_score_stream(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    s = stratified_split(c, "c_mktsegment", ["c_custkey"]).table
    fm = X.fit_features(s, ["c_acctbal", "c_nationkey"], [])
    classes = C.class_labels(s, "c_mktsegment")
    feats = C.with_label(fm.transform(s), "c_mktsegment", classes)
    tree = C.train_tree(feats.where(F.col("split") == "train"), classes, max_depth=3)
    src = tempfile.mkdtemp(prefix="quarry-stream-cust-")
    c.write.mode("overwrite").parquet(src)
    sdf = spark.readStream.schema(c.schema).parquet(src)
    got = _drain(spark, score_stream(sdf, fm, tree, "c_mktsegment", ["c_custkey"]).select("c_custkey", "pred"), "scored")
    want = C.predict(tree, fm.transform(c), "c_mktsegment", ["c_custkey"]).select("c_custkey", "pred")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
