"""Ordered operators: neighbours, runs, ranges, chunks, best candidates, duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docfacts.functions.text import redact_sensitive, strip


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def best_page_candidate(df: DataFrame, keys: list[str], rank: list[Column], ordinal: str) -> DataFrame:
    """Best by several criteria (higher first); the first pass wins ties."""
    return first_row(df, keys, [*[c.desc_nulls_last() for c in rank], F.col(ordinal).asc()])


def latest_source(df: DataFrame, keys: list[str], updated: str, ties: list[str]) -> DataFrame:
    """The newest row of each key."""
    return first_row(df, keys, [F.col(updated).desc(), *[F.col(t).desc() for t in ties]])


def section_runs(df: DataFrame, key: list[str], at: str, labels: list[str]) -> DataFrame:
    """Runs of consecutive positions with the same labels: (key, labels, start, end, n)."""
    w = W.partitionBy(*key).orderBy(at)
    same = F.lag(at).over(w) == F.col(at) - 1
    for c in labels:
        same = same & F.lag(c).over(w).eqNullSafe(F.col(c))
    marked = df.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    return marked.groupBy(*key, *labels, "_run").agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count(F.lit(1)).alias("n")).drop("_run")


def contiguous_ranges(df: DataFrame, key: list[str], at: str, most: int | None = None) -> DataFrame:
    """Runs of consecutive numbers, cut at `most`."""
    w = W.partitionBy(*key).orderBy(at)
    runs = df.select(*key, at).distinct().withColumn("_island", F.col(at) - F.row_number().over(w))
    keys = [*key, "_island"]
    if most:
        first = F.min(at).over(W.partitionBy(*keys))
        runs, keys = runs.withColumn("_part", F.floor((F.col(at) - first) / most)), [*keys, "_part"]
    return runs.groupBy(*keys).agg(F.min(at).alias("start"), F.max(at).alias("end"), F.count(F.lit(1)).alias("n")).drop("_island", "_part")


def page_blocks(pages: DataFrame, key: list[str], page: str, text: str, limit: int) -> DataFrame:
    """(key, page, part, block): pages under their marker; a page that is longer than the limit is split, and its parts say which they are."""
    header = F.concat(F.lit("<!-- PDF page "), F.col(page).cast("string"), F.lit(" -->"))
    body = F.coalesce(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(""))
    rows = pages.select(*key, page, header.alias("_h"), body.alias("_t"))
    room = F.greatest(F.lit(1000), F.lit(limit - 80) - F.length("_h"))
    fits = F.length("_h") + F.length("_t") + 1 <= limit
    n = F.when(fits, 1).otherwise(F.greatest(F.ceil(F.length("_t") / room).cast("int"), F.lit(1)))
    each = rows.withColumn("_room", room).withColumn("_fits", fits).withColumn("_n", n).withColumn("part", F.explode(F.sequence(F.lit(1), "_n")))
    piece = F.substring(F.col("_t"), (F.col("part") - 1) * F.col("_room") + 1, F.col("_room"))
    marked = F.concat("_h", F.lit("\n[本页分段 "), F.col("part").cast("string"), F.lit("/"), F.col("_n").cast("string"), F.lit("]\n"), piece)
    return each.select(*key, page, "part", F.when(F.col("_fits"), F.concat("_h", F.lit("\n"), "_t")).otherwise(marked).alias("block"))


def chunk_rows(df: DataFrame, key: list[str], order: list[str], size: str, most_rows: int, most_size: int, separator: int = 0) -> DataFrame:
    """Greedy packing of each key's rows in order, by row count and total size, separators between rows included: adds `chunk` from 0.

    A fold over the key's ordered array; one document is the unit of order, so
    arrays are bounded by a document.
    """
    item = F.struct(*[F.col(c) for c in order], F.col(size).alias("_size"))
    lists = df.groupBy(*key).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    start = "named_struct('chunk', 0, 'rows', 0, 'size', 0L, 'out', cast(array() as array<int>))"
    full = f"(s.rows > 0 AND (s.rows >= {most_rows} OR s.size + {separator} + x._size > {most_size}))"
    fold = f"""aggregate(_items, {start}, (s, x) -> IF({full},
        named_struct('chunk', s.chunk + 1, 'rows', 1, 'size', cast(x._size as bigint), 'out', array_append(s.out, s.chunk + 1)),
        named_struct('chunk', s.chunk, 'rows', s.rows + 1, 'size', s.size + IF(s.rows > 0, {separator}, 0) + cast(x._size as bigint), 'out', array_append(s.out, s.chunk))), s -> s.out)"""
    zipped = lists.select(*key, F.explode(F.arrays_zip("_items", F.expr(fold).alias("_chunks"))).alias("z"))
    return zipped.select(*key, *[F.col(f"z._items.{c}").alias(c) for c in order], F.col("z._items._size").alias(size), F.col("z._chunks").alias("chunk"))


def neighbours(df: DataFrame, key: list[str], at: str, text: str, cut: int) -> DataFrame:
    """Previous and next text, only of positions that are adjacent."""
    w = W.partitionBy(*key).orderBy(at)
    near = lambda f, step: F.when(f(at).over(w) == F.col(at) + step, F.left(f(text).over(w), F.lit(cut)))
    return df.withColumn("previous_text", near(F.lag, -1)).withColumn("next_text", near(F.lead, 1))


def batch_duplicates(df: DataFrame, key: list[str], digest: str, ordinal: str) -> DataFrame:
    """Adds batch_action: the first row of a fact stays (KEEP), equal later ones are DUPLICATE, and if any differs from the first, it and the first are REVIEW.

    ordinal is unique. The first row comes from an aggregation and not a window, so a fact that is everywhere stays bounded."""
    facts = df.groupBy(*key).agg(F.min(ordinal).alias("_at"), F.min_by(digest, ordinal).alias("_first"), (F.min(digest) != F.max(digest)).alias("_any"))
    facts = facts.select(*[F.col(k).alias(f"_key_{k}") for k in key], "_at", "_first", "_any")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key])
    differs, first = F.col(digest) != F.col("_first"), F.col(ordinal) == F.col("_at")
    action = F.when(differs | (first & F.col("_any")), "REVIEW").when(~first, "DUPLICATE").otherwise("KEEP")
    return df.join(facts, same).withColumn("batch_action", action).select(*df.columns, "batch_action")


def collisions(df: DataFrame, keys: list[str], fact: str) -> DataFrame:
    """Adds collision: rows whose key stands for several facts. Two aggregations instead of sets in a window: a hot key stays bounded."""
    several = df.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg((F.count_distinct(fact) > 1).alias("collision"))
    return df.join(several, keys, "left").withColumn("collision", F.coalesce("collision", F.lit(False)))


def running_offset(df: DataFrame, key: list[str], order: str, length: Column) -> DataFrame:
    """Start and end offset of each node in the concatenation of its view."""
    w = W.partitionBy(*key).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn("end_off", F.sum(length).over(w)).withColumn("start_off", F.col("end_off") - length)


def fixed_batches(df: DataFrame, key: list[str], order: list[str], n: int) -> DataFrame:
    """Adds batch: consecutive groups of n rows."""
    return df.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(*key).orderBy(*order)) - 1) / n))


def page_quality_status(results: DataFrame, documents: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Status of every expected page with all passes side by side.

    results: (doc_id, physical_page, pass, text, confidence, error) and, where known, source, needs_ocr and hosted_recommended;
    documents: (doc_id, total_pages); asked: pages (doc_id, physical_page) for which text recognition was asked.

    A page whose native pass says that it needs recognition, or for which it
    was asked, and whose recognition gave no text, is OCR_FAILED if it was
    tried and OCR_REQUIRED if not; then an empty text is EMPTY, one that the
    chosen pass calls doubtful LOW_CONFIDENCE. The chosen pass is the last one
    with a text. Without these columns an empty native text needs recognition,
    and a confidence below 0.8 is doubtful.
    """
    passes = ["native", "initial", "retry"]
    blank = strip(F.coalesce("text", F.lit(""))) == ""
    defaults = {
        "source": F.when(F.col("pass") == "native", "native").otherwise("ocr"), "needs_ocr": blank & (F.col("pass") == "native"),
        "hosted_recommended": F.coalesce(F.col("confidence") < 0.8, F.lit(False)),
    }
    for name, value in defaults.items():
        results = results.withColumn(name, F.coalesce(name, value) if name in results.columns else value)
    columns = ["text", "confidence", "error", "source", "needs_ocr", "hosted_recommended"]
    wide = results.groupBy("doc_id", "physical_page").pivot("pass", passes).agg(*[F.first(c).alias(c) for c in columns])
    pages = documents.filter("total_pages > 0").select("doc_id", F.explode(F.sequence(F.lit(1), "total_pages")).alias("physical_page"))
    joined = pages.join(wide, ["doc_id", "physical_page"], "left")
    if asked is None:
        joined = joined.withColumn("asked", F.lit(False))
    else:
        joined = joined.join(asked.distinct().withColumn("asked", F.lit(True)), ["doc_id", "physical_page"], "left")
    has = lambda p: strip(F.coalesce(f"{p}_text", F.lit(""))) != ""
    chosen = F.when(has("retry"), "retry").when(has("initial"), "initial").when(F.col("native_source").isNotNull(), "native")
    chosen = F.coalesce(chosen, F.when(F.col("retry_source").isNotNull(), "retry").when(F.col("initial_source").isNotNull(), "initial"))
    completed = (has("initial") & F.col("initial_source").isin("ocr", "fused")) | (has("retry") & F.col("retry_source").isin("ocr", "fused"))
    attempted = F.col("initial_source").isNotNull() | F.col("retry_source").isNotNull()
    needs = F.coalesce("asked", F.lit(False)) | F.coalesce("native_needs_ocr", F.lit(False)) | attempted
    of = lambda c: F.coalesce(*[F.when(F.col("chosen") == p, F.col(f"{p}_{c}")) for p in passes])
    joined = joined.withColumn("chosen", chosen).withColumn("needs_ocr", needs).withColumn("ocr_attempted", attempted).withColumn("ocr_completed", F.coalesce(completed, F.lit(False)))
    status = (
        F.when(F.col("chosen").isNull(), "MISSING_RESULT")
        .when(F.col("needs_ocr") & ~F.col("ocr_completed"), F.when(F.col("ocr_attempted"), "OCR_FAILED").otherwise("OCR_REQUIRED"))
        .when(strip(F.coalesce(of("text"), F.lit(""))) == "", "EMPTY").when(of("hosted_recommended"), "LOW_CONFIDENCE").otherwise("AVAILABLE")
    )
    return joined.withColumn("status", status)


def select_ambiguous_pages(pages: DataFrame) -> DataFrame:
    """Pages to be refined, with a redacted preview (900 first, and of longer texts 200 last characters) and both neighbours' types and redacted beginnings."""
    head = F.left("text", F.lit(900))
    preview = F.when(F.length("text") <= 1100, head).otherwise(F.concat(head, F.lit("\n...[页面中部省略]...\n"), F.right("text", F.lit(200))))
    w = W.partitionBy("doc_id").orderBy("physical_page")
    near = neighbours(pages, ["doc_id"], "physical_page", "text", 240)
    for side in ("previous", "next"):
        at = (F.lag if side == "previous" else F.lead)("document_type").over(w)
        near = near.withColumn(f"{side}_type", F.when(strip(F.col(f"{side}_text")) != "", at))
        near = near.withColumn(f"{side}_text", F.when(strip(F.col(f"{side}_text")) != "", redact_sensitive(F.col(f"{side}_text"))[0]))
    asked = (F.col("classification_confidence") != "HIGH") & (F.col("document_type") != "INVOICE") & (strip(F.col("text")) != "")
    return near.filter(asked).withColumn("preview", redact_sensitive(preview)[0])


def most_common(df: DataFrame, keys: list[str], name: str, ordinal: str) -> DataFrame:
    """Count and ratio (four places) per name and key; rank by count, ties by first appearance."""
    counts = df.filter(F.col(name) != "").groupBy(*keys, name).agg(F.count(F.lit(1)).alias("value"), F.min(ordinal).alias("_first"))
    whole = W.partitionBy(*keys)
    ratio = F.bround(F.col("value").cast("decimal(18,0)") / F.sum("value").over(whole).cast("decimal(18,0)"), 4)
    return counts.withColumn("ratio", ratio.cast("decimal(6,4)")).withColumn("rank", F.row_number().over(whole.orderBy(F.col("value").desc(), "_first", name))).drop("_first")


def union_payloads(chunks: list[DataFrame]) -> DataFrame:
    """The rows of all chunks of a domain; columns that a chunk lacks are null."""
    out = chunks[0]
    for c in chunks[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def limit_input(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """L2: the first n rows, where the limit is the caller's wish."""
    return df.orderBy(*order).limit(n)


def cap_breaches(df: DataFrame, key: list[str], most: int, error: str) -> DataFrame:
    """L2: keys with more rows than allowed, as errors; nothing is cut silently."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).withColumn("error", F.lit(error))


def ordered_output(df: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """L4: rows of a partition together and in order, for writing."""
    return df.repartition(*partition).sortWithinPartitions(*partition, *order)


def distinct_awards(df: DataFrame) -> DataFrame:
    """One award per (project, lot, winner, amount, issue), the first one."""
    return first_row(df, ["project_name", "lot", "winner", "amount", "issue"], [F.col("ordinal")])


def distinct_evidence(df: DataFrame) -> DataFrame:
    """One row per evidence id, the last one."""
    return first_row(df, ["evidence_id"], [F.col("ordinal").desc()])


def equivalent_outcomes(df: DataFrame, key: list[str], outcome: list[str]) -> DataFrame:
    """Keys whose rows have one outcome only."""
    return df.groupBy(*key).agg(F.count_distinct(F.struct(*outcome)).alias("n")).filter("n = 1").drop("n")
