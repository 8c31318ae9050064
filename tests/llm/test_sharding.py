"""Order along the curve, equal texts side by side, and files that a reader can leave out."""

import numpy as np
from pyspark.sql import functions as F

from docfacts.llm import sharding


def corpus(spark, n=3000):
    rng = np.random.default_rng(4)
    sources = [f"site{k:03}" for k in range(40)]
    rows = [(i, f"{i:04} " + "w " * int(rng.integers(10, 4000)), sources[int(rng.integers(0, 40))], "en de fr es".split()[int(rng.integers(0, 4))]) for i in range(n)]
    rows += [(n + i, "the same text", sources[i % 40], None) for i in range(300)] + [(n + 300 + i, None, None, "en") for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("rank", F.lit(1)).withColumn("shard", F.lit("x"))


def test_rows_follow_the_curve_and_equal_texts_lie_together(spark):
    docs = corpus(spark)
    rows = sorted(sharding.hilbert_shards(docs).collect(), key=lambda r: (r["shard"], r["slot"]))
    curve = [r["hilbert"] for r in rows]
    assert curve == sorted(curve) and len(rows) == docs.count()
    for size, want in ((14, 300), (1, 20)):
        at = [k for k, r in enumerate(rows) if r["size"] == size]
        assert len(at) >= want and at[-1] - at[0] == len(at) - 1
    cells = {r["source"]: r["d_source"] for r in sharding.sorted_cells(docs.select(F.coalesce("source", F.lit("")).alias("source")), "source", 8).collect()}
    assert [cells[s] for s in sorted(cells)] == sorted(cells.values()) and len(set(cells.values())) == 41


def test_files_can_be_left_out(spark, tmp_path):
    """Readers that look for one source, one language or a range of sizes open fewer files than of rows in their order of arrival."""
    docs = corpus(spark).drop("rank", "shard").withColumn("size", F.length(F.coalesce("text", F.lit(""))))
    sharding.write_shards(docs, str(tmp_path / "curve"), shards=64)
    docs.repartition(64).write.parquet(str(tmp_path / "plain"))
    opened = {}
    for name in ("curve", "plain"):
        boxes = spark.read.parquet(str(tmp_path / name)).groupBy(F.col("_metadata.file_path")).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("source", "lang", "size") for f in (F.min, F.max)]).collect()
        assert len(boxes) == 64
        asked = [("source", f"site{k:03}", f"site{k:03}") for k in range(40)] + [("lang", x, x) for x in ("de", "es")] + [("size", k, k + 300) for k in range(0, 8000, 500)]
        opened[name] = sum(b[f"min_{c}"] is not None and b[f"min_{c}"] <= high and b[f"max_{c}"] >= low for c, low, high in asked for b in boxes)
    assert opened["curve"] < 0.6 * opened["plain"]
    assert spark.read.parquet(str(tmp_path / "curve")).count() == docs.count()


def test_written_rows_are_the_given_ones(spark, tmp_path):
    """doc_ids that repeat, equal rows and null doc_ids: every row is stored once, in its own place."""
    rows = [(1, "a", "s", "en", 7), (1, "b", "s", "en", 8), (1, "b", "s", "en", 8), (None, "b", None, None, 9), (None, None, None, None, None)] + [(i, f"text {i}", "s", "de", i) for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, slot long")
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    got = spark.read.parquet(str(tmp_path / "out"))
    same = lambda rs: sorted((tuple(r[c] for c in ("doc_id", "text", "source", "lang")) for r in rs), key=repr)
    assert same(got.collect()) == same(docs.collect())
    for shard, slots in got.groupBy("shard").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert slots == list(range(len(slots))) and 8 <= len(slots) <= 9
