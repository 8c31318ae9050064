"""Helpers used by several operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.storage import discard, shared_dir
from docfacts.storage import written as materialize

__all__ = ["discard", "materialize", "shared_dir"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def fold(col: Column, folds: int) -> Column:
    """crc32 of the number's decimal text, modulo folds."""
    return F.crc32(col.cast("string").cast("binary")) % folds


def batch_rows(spark: SparkSession, rows: int) -> None:
    """Rows of the Arrow batches of the queries that start from now on in this session: few for texts, which can be long, many for short rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns that tasks need, in batches of at most 1,000 rows."""
    batch_rows(docs.sparkSession, 1000)
    return docs.select(*columns)


class Shipped:
    """An object sent to executors once, with its class: they need not have this package."""

    def __init__(self, spark: SparkSession, thing):
        self._sent, self._here = spark.sparkContext.broadcast(cloudpickle.dumps(thing)), None

    @property
    def value(self):
        if self._here is None:
            self._here = cloudpickle.loads(self._sent.value)
        return self._here

    def release(self) -> None:
        """Frees it on executors and driver; nothing that uses it may run later."""
        self._sent.destroy()


def trim() -> None:
    """Gives back memory that a partition took: Python workers live on and would hold it beside the next stage's."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if release:
        release(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20):
    """Cut an Arrow batch so that the text of each piece stays near max_bytes (one row at least)."""
    sizes = np.array([0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()], dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def global_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add `rank`: the gapless position from 0 in the total order of the given columns.

    Range partitions are written with their row numbers; only one count per
    partition reaches the driver. `order` has to end in a unique key, so that
    equal values never share one partition by force.
    """
    spark = df.sparkSession
    n = max(partitions(spark), 1)
    placed = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", 33).cast("int"))
        .withColumn("_pos", F.col("_mid").bitwiseAND((1 << 33) - 1)).drop("_mid"),
        name,
    )
    counts = {r["_pid"]: r["n"] for r in placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    at, starts = 0, []
    for pid in sorted(counts):
        starts.append((pid, at))
        at += counts[pid]
    offsets = spark.createDataFrame(starts or [(0, 0)], "_pid int, _start long")
    return placed.join(F.broadcast(offsets), "_pid").withColumn("rank", F.col("_start") + F.col("_pos")).drop("_pid", "_pos", "_start")


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def to_batch(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return to_batch(list(zip(*rows, strict=True)) if rows else [[] for _ in schema], schema)


def filter_rows(df: DataFrame, keep) -> DataFrame:
    """Rows of df for which keep(Arrow batch) -> boolean array holds; all columns stay as they are and nothing is shuffled."""

    batch_rows(df.sparkSession, 1000)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch), pa.bool_()))
        trim()

    return df.mapInArrow(run, df.schema)


def _rows(df: DataFrame, rows: DataFrame, how: str, most: int) -> DataFrame:
    rows = materialize(rows.select("doc_id", "key").distinct(), "rows")
    near = F.broadcast(rows) if rows.count() <= most else rows
    return df.join(near, df["doc_id"].eqNullSafe(near["doc_id"]) & (F.xxhash64(df["text"]) == near["key"]), how)


def without_rows(df: DataFrame, rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """df without the rows whose doc_id and hash of the text are in rows (doc_id, key); these are broadcast only if they are at most `most`."""
    return _rows(df, rows, "left_anti", most)


def only_rows(df: DataFrame, rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """The rows of df whose doc_id and hash of the text are in rows (doc_id, key)."""
    return _rows(df, rows, "left_semi", most)
