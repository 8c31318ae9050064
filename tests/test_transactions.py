"""Batches as transactions: races, replays, digests; and objects in a model's answer."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from docfacts.operators import transactions as X
from docfacts.sources import records, sinks

STATE = "target_id string, cert_name string, cert_no string, cert_level string"
PLAN = "entry_id string, action string, target_id int, cert_name string, cert_no string, cert_level string, patch array<struct<field:string,value:string>>"
RECEIPTS = "batch_uid string, approval_hash string, entry_id string, action string, target_id string, patch string, before string, state_before string, state_after string"


@pytest.fixture
def root(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    sinks.publish_snapshot({"business": spark.createDataFrame([("7", "资质", "N7", ""), ("8", "别的", "N8", "甲级")], STATE), "receipts": spark.createDataFrame([], RECEIPTS)}, path, 1)
    return path


def plan_of(spark):
    rows = [("i1", "INSERT", None, "新证", "N9", "一级", None), ("p1", "PATCH_EMPTY", 7, "资质", "N7", "乙级", [("cert_level", "乙级")]), ("d1", "DUPLICATE", None, "x", "y", None, None)]
    return spark.createDataFrame(rows, PLAN)


def chosen(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "entry_id string")


def test_apply_replay_and_refuse(spark, root):
    plan = plan_of(spark)
    assert X.commit_batch(spark, root, 1, plan, chosen(spark, "i1", "p1"), "b1", "h1") == {"status": "APPLIED", "version": 2}
    got = {r["target_id"]: r["cert_level"] for r in sinks.read_snapshot(spark, root, "business").collect()}
    assert got == {"7": "乙级", "8": "甲级", "i1": "一级"}
    rows = {r["entry_id"]: r for r in sinks.read_snapshot(spark, root, "receipts").collect()}
    assert '"N7"' in rows["p1"]["before"] and rows["i1"]["before"] is None and rows["p1"]["state_before"] != rows["p1"]["state_after"]
    assert X.commit_batch(spark, root, 2, plan, chosen(spark, "i1", "p1"), "b1", "h1") == {"status": "REPLAYED", "version": 2}
    for error, args in ((X.ReplayRefused, (2, "i1", "b1", "h2")), (X.StateChanged, (1, "i1", "b2", "h1")), (X.BatchRefused, (2, "d1", "b3", "h1"))):
        with pytest.raises(error):
            X.commit_batch(spark, root, args[0], plan, chosen(spark, args[1]), *args[2:])
    with pytest.raises(X.BatchRefused, match="larger"):
        X.commit_batch(spark, root, 2, plan, chosen(spark, "p1"), "b4", "h", most_bytes=10)
    assert X.current_version(spark, root) == 2


def test_two_racing_batches(spark, root):
    def run(uid):
        try:
            return X.commit_batch(spark, root, 1, plan_of(spark), chosen(spark, "i1"), uid, "h")["status"]
        except X.StateChanged:
            return "CHANGED"

    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(run, ["b1", "b2"])) == ["APPLIED", "CHANGED"]
    assert sinks.read_snapshot(spark, root, "receipts").count() == 1 and X.current_version(spark, root) == 2


def test_digests_by_range(spark):
    a = spark.range(1000).withColumn("v", F.col("id") * 2)
    b = a.withColumn("v", F.when(F.col("id") == 77, F.lit(None)).otherwise(F.col("v")))
    of = lambda df: X.state_digest(df, F.col("id"), ["id", "v"], 16)
    assert X.state_root(of(a)) == X.state_root(of(a.repartition(7))) != X.state_root(of(b))
    assert [r["bucket"] for r in X.changed_ranges(of(a), of(b)).collect()] == [77 % 16]


def test_first_balanced_object(spark):
    texts = ['{"a":"}"} text {"b":1}', 'say ```json\n{"a": {"b": "\\"}{"}}\n``` {', '{"a": 1', "none", None, '"quoted { brace" {"k":2}', '}{"x":"é{"}']
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", records.first_object(F.col("t")).alias("o")).orderBy("i").collect()
    assert [r["o"] for r in got] == ['{"a":"}"}', '{"a": {"b": "\\"}{"}}', None, None, None, None, '{"x":"é{"}']
