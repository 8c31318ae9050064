"""Hilbert-curve sharding (operator 4).

Documents are ordered along a Hilbert curve through several quantised metadata
dimensions and cut into runs of equal row counts, so that a file covers a small
box in every dimension and readers prune files by min/max statistics. Rows of
one text lie together: a group of equal texts takes its dimensions from the
whole group (least source and language), and the text's hash and doc_id break
ties. A group larger than a run continues in the next shards; nothing is moved
or dropped to keep it together, since the law `rows` keeps counts at most one
apart.

Edge cases: null text has size 1 and the checksum of no bytes; null metadata
take the lowest cell; fewer rows than shards leave shards empty, and an empty
table gives no row. Repeated rows get a place each; texts of any length are
hashed whole and never moved. Columns other than doc_id, text, source and lang
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import discard, global_rank, materialize, read


#: Distinct values of a dimension up to which their cells are broadcast; more are joined.
MOST_CELLS = 100_000


def hilbert_index(bits: int):
    """A pandas UDF: index on the Hilbert curve of three integer coordinates below 2**bits."""

    @F.pandas_udf("long")
    def index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert(np.stack([v.to_numpy(dtype=np.int64) for v in (a, b, c)]), bits))

    return index


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of the points in the columns of x (transpose form: undo the rotations, Gray-decode, interleave)."""
    x = x.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(dims):
            high = (x[i] >> level & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap if i else 0
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> level & 1)
    return out


def sorted_cells(values: DataFrame, column: str, bits: int) -> DataFrame:
    """(column, cell): the distinct values of a column in their order, cut into 2**bits ranges of equally many values; null is the empty text."""
    distinct = values.select(column).distinct()
    ranked = materialize(global_rank(distinct, [column], f"{column}_order"), f"{column}_cells")
    n = max(ranked.count(), 1)
    return ranked.select(column, F.floor(F.col("rank") * F.lit(1 << bits) / F.lit(n)).cast("long").alias(f"d_{column}"))


def size_cell(values: DataFrame, bits: int):
    """A pandas UDF: the cell of a size, cells holding about equally many of the values (their edges are approximate quantiles)."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    edges = np.array(values.agg(F.percentile_approx("size", shares, 10_000).alias("e")).first()["e"] or [], dtype=np.int64)

    @F.pandas_udf("long")
    def cell(size: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, size.to_numpy(dtype=np.int64), side="left"))

    return cell


def quantised(docs: DataFrame, bits: int, *keep: str) -> DataFrame:
    """(doc_id, size, text_crc32, group key, dimensions, and the columns to keep) of every document; no text is moved.

    A dimension keeps the order of its column, so that near cells hold near values and a file's least and largest value say what it lacks.
    """
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    base = docs.select(
        "doc_id",
        (F.length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw).alias("text_key"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        *keep,
    )
    base = materialize(base, "base")
    groups = materialize(
        base.groupBy("text_key", "text_crc32", "size").agg(F.min("source").alias("source"), F.min("lang").alias("lang")), "texts"
    )
    for column in ("source", "lang"):
        cells = sorted_cells(groups, column, bits)
        groups = groups.join(F.broadcast(cells) if cells.count() <= MOST_CELLS else cells, column)
    cells = groups.select("text_key", "text_crc32", "size", "d_source", "d_lang", size_cell(groups, bits)(F.col("size")).alias("d_size"))
    # both sides are written: the join can then split a large group's rows
    return base.select("doc_id", "size", "text_crc32", "text_key", *keep).join(materialize(cells, "groups"), ["text_key", "text_crc32", "size"])


def hilbert_shards(docs: DataFrame, shards: int = 16, bits: int = 8, *keep: str) -> DataFrame:
    """Every document's shard and its slot there, in Hilbert order, with the columns to keep."""
    cells = materialize(quantised(docs, bits, *keep), "cells")
    order = cells.withColumn("hilbert", hilbert_index(bits)("d_source", "d_lang", "d_size"))
    ranked = global_rank(order.select("doc_id", "size", "text_crc32", "text_key", "hilbert", *keep), ["hilbert", "text_key", "doc_id", *keep], "ranked")
    total = cells.count()
    discard(cells)
    base, more = divmod(total, shards)  # the first `more` shards have one row more
    cut = more * (base + 1)
    shard = F.when(F.col("rank") < cut, F.floor(F.col("rank") / (base + 1))).otherwise(more + F.floor((F.col("rank") - cut) / max(base, 1))).cast("int")
    start = F.when(F.col("shard") < more, F.col("shard") * (base + 1)).otherwise(cut + (F.col("shard") - more) * base)
    return ranked.withColumn("shard", shard).withColumn("slot", (F.col("rank") - start).cast("long"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, bits: int = 8) -> None:
    """Write documents as one folder per shard in curve order, for file pruning; shard and slot take the place of columns of that name."""
    # rows are numbered and written once: doc_ids may repeat, and equal rows each have a place
    rows = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.monotonically_increasing_id().alias("row_number")), "numbered")
    placed = hilbert_shards(rows.select("r.*", F.col("row_number").alias("_row")), shards, bits, "_row").select(F.col("_row").alias("row_number"), "shard", "slot")
    out = rows.join(placed, "row_number").select("shard", "slot", "r")
    taken = [c for c in docs.columns if c not in ("shard", "slot")]
    out = out.repartition(shards, "shard").sortWithinPartitions("shard", "slot").select("shard", "slot", *[F.col(f"r.`{c}`").alias(c) for c in taken])
    out.write.partitionBy("shard").parquet(path)
    discard(rows)


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )
