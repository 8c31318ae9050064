"""Sinks: keyed upserts, summaries, errors, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.functions.text import safe_error_message
from docfacts.storage import written


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new replace those of old with the same key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def touched_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """K1: document types that an upsert of new rows (source, document_type) changes: their own, and those their sources leave."""
    left = old.join(new.select("source"), "source", "left_semi").select("document_type")
    return left.union(new.select("document_type")).distinct()


def write_records_by_type(new: DataFrame, path: str) -> None:
    """K1: upsert by source into one folder per document type; only folders with a change are written, from a copy in the shared folder.

    A type whose last source left is an empty folder: its files are removed.
    """
    spark = new.sparkSession
    new = written(new, "new_records")
    if not exists(spark, path):
        new.write.partitionBy("document_type").parquet(path)
        return
    old = spark.read.parquet(path)
    types = written(touched_types(old, new), "touched_types")
    rows = written(upsert(old.join(types, "document_type", "left_semi"), new, ["source"]), "records")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("document_type").parquet(path)
    for r in types.join(rows.select("document_type").distinct(), "document_type", "left_anti").collect():  # types are a fixed list
        remove(spark, f"{path}/document_type={r['document_type']}")


def type_summaries(records: DataFrame) -> DataFrame:
    """K2."""
    return records.groupBy("document_type").agg(F.count(F.lit(1)).alias("record_count"), F.count_if("review_required").alias("review_required_count"), F.array_sort(F.collect_list("source")).alias("sources"))


def split_errors(df: DataFrame, roots: list[str], secrets: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """K3: (valid, errors); messages are free of these local folders and secrets, and redacted."""
    message = safe_error_message(F.col("error"), roots, list(secrets))
    errors = df.filter("error IS NOT NULL").select("source", "error_type", message.alias("message"), F.current_timestamp().alias("at"))
    return df.filter("error IS NULL").drop("error"), errors


def write_page_content(pages: DataFrame, path: str) -> None:
    """K4: pages of a document in order, in one file of its partition."""
    pages.repartition("doc_id").sortWithinPartitions("doc_id", "physical_page").write.mode("overwrite").parquet(path)


def upsert_profile_values(stored: DataFrame, new: DataFrame, cap: int = 5 << 20) -> tuple[DataFrame, DataFrame]:
    """K5: (values, errors): stored (field_code, source_ref, values array<struct<entry_id,value>>) with new (field_code, source_ref, entry_id, value) that are not there yet; other sources stay; rows over the size cap are errors."""
    have = stored.select("field_code", "source_ref", F.explode("values").alias("v")).select("field_code", "source_ref", "v.entry_id", "v.value")
    fresh = new.join(have.select("field_code", "source_ref", "entry_id"), ["field_code", "source_ref", "entry_id"], "left_anti")
    merged = have.unionByName(fresh.select(*have.columns)).groupBy("field_code", "source_ref").agg(F.array_sort(F.collect_list(F.struct("entry_id", "value"))).alias("values"))
    fits = F.octet_length(F.to_json("values")) <= cap
    return merged.filter(fits), merged.filter(~fits).select("field_code", "source_ref", F.lit("value is too large").alias("error"))


def append_batch_receipt(receipt: DataFrame, path: str) -> None:
    """K6: append-only; a batch that is there already is not written again."""
    spark = receipt.sparkSession
    if exists(spark, path):
        receipt = receipt.join(spark.read.parquet(path).select("batch_uid").distinct(), "batch_uid", "left_anti")
    receipt.write.mode("append").parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def publish_snapshot(tables: dict[str, DataFrame], root: str, version: int) -> None:
    """K7: all tables under a new version, the pointer row last: readers see a whole version or the one before."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/version={version}/{name}")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(version,)], "version long").write.mode("append").parquet(f"{root}/published")


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = spark.read.parquet(f"{root}/published").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/version={version}/{name}")


def assemble_page_text(pages: DataFrame) -> DataFrame:
    """One text per document with page markers; a placeholder where text is missing."""
    body = F.when(F.trim(F.coalesce("text", F.lit(""))) != "", F.col("text")).when(F.col("needs_ocr"), "_[OCR required]_").otherwise("_[no text]_")
    part = F.concat(F.lit("<!-- PDF page "), F.col("physical_page").cast("string"), F.lit(" -->\n"), body)
    return pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("physical_page", part.alias("p")))).alias("x")).select("doc_id", F.array_join(F.transform("x", lambda e: e["p"]), "\n\n").alias("text"))


def profile_output_index(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(index, errors): one published profile for each (project, company_key)."""
    n = profiles.groupBy("project", "company_key").agg(F.count(F.lit(1)).alias("n"), F.max_by(F.struct("path", "decision"), "updated_at").alias("p"))
    return n.filter("n = 1").select("project", "company_key", "p.*"), n.filter("n > 1").select("project", "company_key", F.lit("several published profiles").alias("error"))


def import_preview_rows(plan: DataFrame) -> DataFrame:
    """What a reader sees of a plan."""
    return plan.select("entry_id", "kind", "action", "cert_name", "cert_no", "target_id", "patch", "reasons")
