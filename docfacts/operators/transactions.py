"""Import batches as transactions on versioned snapshots.

A batch is planned against one version of the state and may only be published
as the next one. Whoever creates the claim file of that version first owns it
(creation without overwriting is atomic in the shared file system); all others
are told that the state has changed and plan again. A batch that is there
already writes nothing, and is refused under another approval. Receipts hold
what each row was before, and digests of the state before and after.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.operators.certificates import approve_subset
from docfacts.sources import sinks
from docfacts.storage import written

RANGES = 256


class BatchRefused(ValueError):
    """The batch may not be applied; nothing was written."""


class StateChanged(BatchRefused):
    """Another version was published since the batch was planned."""


class ReplayRefused(BatchRefused):
    """The batch was applied before under another approval."""


def _row_digest(columns: list[str]) -> Column:
    text = [F.col(c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def state_digest(state: DataFrame, key: Column, columns: list[str], ranges: int = RANGES) -> DataFrame:
    """(bucket, n, digest) of the rows by ranges of an integer key's remainder, whatever their order: count and sums of three pieces of the rows' hashes."""
    row = state.select(F.pmod(key, F.lit(ranges)).cast("int").alias("bucket"), _row_digest(columns).alias("h"))
    pieces = [F.sum(F.conv(F.substring("h", 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(3)]
    found = row.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[p.alias(f"s{k}") for k, p in enumerate(pieces)])
    return found.select("bucket", "n", F.sha2(F.concat_ws("|", "bucket", "n", "s0", "s1", "s2"), 256).alias("digest"))


def state_root(ranges: DataFrame) -> str:
    """One digest over the ranges' digests, of which there are few by construction."""
    each = F.transform(F.array_sort(F.collect_list(F.struct("bucket", "digest"))), lambda x: x["digest"])
    return ranges.agg(F.sha2(F.array_join(each, ""), 256).alias("root")).first()["root"]


def changed_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose rows differ between two states; only they have to be compared row by row."""
    b, a = before.select("bucket", F.col("digest").alias("was")), after.select("bucket", F.col("digest").alias("now"))
    return b.join(a, "bucket", "full").filter(~F.col("was").eqNullSafe(F.col("now"))).select("bucket")


def current_version(spark: SparkSession, root: str) -> int:
    return spark.read.parquet(f"{root}/published").agg(F.max("version").alias("v")).first()["v"]


def publish_next(tables: dict[str, DataFrame], root: str, base: int) -> int:
    """K7 as compare-and-swap: the tables become version base + 1, or StateChanged if another writer owns that version."""
    spark = next(iter(tables.values())).sparkSession
    if current_version(spark, root) != base:
        raise StateChanged(f"version {base} is not the current one")
    claim = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/claims/{base + 1}")
    fs = claim.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        fs.create(claim, False).close()
    except Exception as e:  # the gateway has one exception for all of the file system's
        if fs.exists(claim):
            raise StateChanged(f"version {base + 1} is being written") from e
        raise
    try:
        sinks.publish_snapshot(tables, root, base + 1)
    except PySparkException:
        fs.delete(claim, False)
        raise
    return base + 1


def patched(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State rows (target_id, ...) with the patches (target_id, patch array<struct<field, value>>) written over empty fields."""
    each = changes.select("target_id", F.explode("patch").alias("p")).groupBy("target_id").agg(F.map_from_entries(F.collect_set(F.struct("p.field", "p.value"))).alias("_patch"))
    joined = state.join(each, "target_id", "left")
    kinds = dict(state.dtypes)
    value = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.try_element_at("_patch", F.lit(c))).cast(kinds[c])
    return joined.select(*[F.col(c) if c == "target_id" else value(c).alias(c) for c in state.columns])


def commit_batch(
    spark: SparkSession, root: str, base: int, plan: DataFrame, approved: DataFrame, batch_uid: str, approval_hash: str, most: int = 200, most_bytes: int = 1 << 20,
) -> dict:
    """{status, version} of a batch against version `base` of the snapshot (tables business and receipts).

    plan: what `plan_candidates` gives; approved: (entry_id). An insert's
    target_id is its entry_id. Refused are: another current version, another
    approval of the same batch, entries that may not be written, more than
    `most` entries, changes of more than `most_bytes`.
    """
    if current_version(spark, root) != base:
        raise StateChanged(f"version {base} is not the current one")
    state, receipts = (spark.read.parquet(f"{root}/version={base}/{name}") for name in ("business", "receipts"))
    seen = receipts.filter(F.col("batch_uid") == batch_uid).select("approval_hash").limit(1).collect()
    if seen:
        if seen[0]["approval_hash"] != approval_hash:
            raise ReplayRefused(f"batch {batch_uid} was applied under another approval")
        return {"status": "REPLAYED", "version": base}
    wrong = approve_subset(plan, approved, most).limit(1).collect()
    if wrong:
        raise BatchRefused(f"{wrong[0]['entry_id']}: {wrong[0]['rule']}")
    chosen = written(plan.join(approved.select("entry_id").distinct(), "entry_id", "left_semi").withColumn("target_id", F.coalesce(F.col("target_id").cast("string"), "entry_id")), "chosen")
    kinds = dict(state.dtypes)
    fields = [F.col(c).cast(kinds[c]).alias(c) if c in chosen.columns else F.lit(None).cast(kinds[c]).alias(c) for c in state.columns]
    after = patched(state, chosen.filter("action = 'PATCH_EMPTY'")).unionByName(chosen.filter("action = 'INSERT'").select(*fields))
    after = written(after, "after")
    digests = [state_root(state_digest(df, F.xxhash64("target_id"), state.columns)) for df in (state, after)]
    old = state.select("target_id", F.to_json(F.struct(*state.columns)).alias("before"))
    receipt = chosen.join(old, "target_id", "left").select(
        F.lit(batch_uid).alias("batch_uid"), F.lit(approval_hash).alias("approval_hash"), "entry_id", "action", "target_id", F.to_json("patch").alias("patch"), "before",
        F.lit(digests[0]).alias("state_before"), F.lit(digests[1]).alias("state_after"),
    )
    receipt = written(receipt, "receipt")
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("patch", "before")])
    if (receipt.agg(F.sum(size).alias("n")).first()["n"] or 0) > most_bytes:
        raise BatchRefused(f"changes of batch {batch_uid} are larger than {most_bytes} bytes")
    version = publish_next({"business": after, "receipts": receipts.select(*receipt.columns).unionByName(receipt)}, root, base)
    return {"status": "APPLIED", "version": version}
