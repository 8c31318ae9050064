"""Constraint checks: every rule gives rows (key, rule, path, severity)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfacts.functions.text import SENSITIVE

REQUIRED_SECTIONS = ["概况", "资质", "业绩", "风险"]


def violations(df: DataFrame, key: list[str], rules: dict[str, Column], severity: str = "ERROR") -> DataFrame:
    """Row rules, all in one pass: a rule's column is true where it is broken."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]))
    return df.select(*key, F.explode(hits).alias("rule")).withColumn("severity", F.lit(severity))


def duplicates(df: DataFrame, key: list[str], unique: list[str], rule: str) -> DataFrame:
    """Values that have to be unique and are not."""
    return df.groupBy(*key, *unique).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key, F.lit(rule).alias("rule")).distinct().withColumn("severity", F.lit("ERROR"))


def references(df: DataFrame, key: list[str], refs: str, targets: DataFrame, target: str, rule: str) -> DataFrame:
    each = df.select(*key, F.explode(refs).alias("_r"))
    return each.join(targets.select(F.col(target).alias("_r")).distinct(), "_r", "left_anti").select(*key, F.lit(rule).alias("rule")).distinct().withColumn("severity", F.lit("ERROR"))


def sensitive(c: Column) -> Column:
    out = F.lit(False)
    for _, pattern in SENSITIVE:
        out = out | c.rlike(pattern)
    return out


def validate_package(evidence: DataFrame, pages: DataFrame, entities: DataFrame, conflicts: DataFrame, candidates: DataFrame, assessments: DataFrame, actions: list[str], dimensions: int = 8) -> DataFrame:
    """All violations of a package, by doc_id.

    evidence: (doc_id, evidence_id, physical_page, source_text); pages: (doc_id, physical_page); entities: (doc_id, entity_key, refs,
    conflict_refs, amount, day string, profile_action, verification_status); conflicts: (doc_id, conflict_id); candidates: (doc_id,
    field_code, value); assessments: (doc_id, dimension).
    """
    key = ["doc_id"]
    bad_page = evidence.join(pages, ["doc_id", "physical_page"], "left_anti").select("doc_id", F.lit("evidence on an unknown page").alias("rule")).distinct().withColumn("severity", F.lit("ERROR"))
    dims = assessments.groupBy("doc_id").agg(F.count_distinct("dimension").alias("n"), F.count(F.lit(1)).alias("m"))
    parts = [
        duplicates(pages, key, ["physical_page"], "page numbers are not unique"),
        violations(pages, key, {"page number is not positive": F.col("physical_page") <= 0}),
        duplicates(evidence, key, ["evidence_id"], "evidence ids are not unique"), bad_page,
        violations(evidence, key, {
            "evidence without id": F.coalesce("evidence_id", F.lit("")) == "", "evidence without text": F.trim(F.coalesce("source_text", F.lit(""))) == "",
            "sensitive text": sensitive(F.coalesce("source_text", F.lit(""))),
        }),
        violations(entities, key, {
            "negative amount": F.col("amount") < 0, "not an ISO date": F.col("day").isNotNull() & ~(F.col("day").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date("day").isNotNull()),
            "illegal profile action": ~F.col("profile_action").isin(actions), "machine facts have to be UNVERIFIED": F.col("verification_status") != "UNVERIFIED",
        }),
        references(entities, key, "refs", evidence, "evidence_id", "dangling evidence"), references(entities, key, "conflict_refs", conflicts, "conflict_id", "dangling conflict"),
        duplicates(conflicts, key, ["conflict_id"], "conflict ids are not unique"), duplicates(candidates, key, ["field_code"], "several candidates of one field"),
        violations(dims, key, {"not all capability dimensions": (F.col("n") != dimensions) | (F.col("m") != dimensions)}),
    ]
    return reduce(DataFrame.unionByName, parts)


def validate_schema(df: DataFrame, key: list[str], required: list[str], enums: dict[str, list[str]], patterns: dict[str, str], sizes: dict[str, int]) -> DataFrame:
    """Schema facts as rules: required, enumerated, matching, of a least size."""
    rules = {f"{c} is missing": F.col(c).isNull() for c in required}
    rules |= {f"{c} is not allowed": F.col(c).isNotNull() & ~F.col(c).isin(v) for c, v in enums.items()}
    rules |= {f"{c} has a wrong form": ~F.col(c).rlike(p) for c, p in patterns.items()}
    rules |= {f"{c} has too few items": F.size(c) < n for c, n in sizes.items()}
    return violations(df, key, rules)


def missing_and_unknown(present: Column, required: list[str], allowed: list[str]) -> tuple[Column, Column]:
    """U4."""
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    return F.array_except(lit(required), present), F.array_except(present, lit(allowed))


def validate_fact_chunks(facts: DataFrame, chunks: DataFrame, kinds: list[str], sections: list[str]) -> DataFrame:
    """Facts (chunk_id, section, kind, text, pages) against chunks (chunk_id, pages)."""
    joined = facts.join(chunks.select("chunk_id", F.col("pages").alias("_pages")), "chunk_id", "left")
    rows = violations(joined, ["chunk_id"], {
        "page outside the chunk": F.size(F.array_except("pages", F.coalesce("_pages", F.array().cast("array<int>")))) > 0, "unknown kind": ~F.col("kind").isin(kinds), "empty text": F.trim(F.coalesce("text", F.lit(""))) == "", "no page": F.size("pages") == 0,
    })
    have = facts.groupBy("chunk_id").agg(F.collect_set("section").alias("s"))
    lacking = chunks.join(have, "chunk_id", "left").filter(F.size(F.array_except(F.array(*[F.lit(s) for s in sections]), F.coalesce("s", F.array().cast("array<string>")))) > 0)
    return rows.unionByName(lacking.select("chunk_id", F.lit("section missing").alias("rule"), F.lit("ERROR").alias("severity")))


def profile_document_guard(docs: DataFrame, sections: list[str], least: int = 10) -> DataFrame:
    """Markdown reports: one H1, exactly the H2 headings in order, enough text in each section, a page cited."""
    t = F.col("text")
    h2 = F.regexp_extract_all(t, F.lit(r"(?m)^##\s+(.+?)\s*$"), F.lit(1))
    bodies = F.transform(F.slice(F.split(t, r"(?m)^##\s+.+$"), 2, 1000), lambda b: F.length(F.regexp_replace(b, r"\s+", "")))
    return violations(docs, ["doc_id"], {
        "not exactly one H1": F.regexp_count(t, F.lit(r"(?m)^#\s+\S")) != 1, "headings differ": h2 != F.array(*[F.lit(s) for s in sections]),
        "section too short": F.exists(bodies, lambda n: n < least), "no page cited": ~t.rlike(r"第\s*[0-9]+\s*页|\[p\.?\s*[0-9]+\]"),
    })


def intermediate_guard(results: DataFrame, sources: DataFrame, version: str) -> DataFrame:
    """Adds usable: same schema version, same source hash, status SUCCESS or PARTIAL."""
    joined = results.join(sources.select("source", F.col("source_hash").alias("_hash")), "source", "left")
    ok = (F.col("schema_version") == version) & (F.col("source_hash") == F.col("_hash")) & F.col("status").isin("SUCCESS", "PARTIAL")
    return joined.withColumn("usable", F.coalesce(ok, F.lit(False))).drop("_hash")


def expand_page_range(c: Column) -> Column:
    """`1-3,7` as an array of pages; parts that are no range give nothing."""
    def pages(p: Column) -> Column:
        a = F.regexp_extract(p, r"^\s*([0-9]+)", 1).try_cast("int")
        b = F.coalesce(F.regexp_extract(p, r"^\s*[0-9]+\s*-\s*([0-9]+)\s*$", 1).try_cast("int"), a)
        ok = p.rlike(r"^\s*[0-9]+\s*(-\s*[0-9]+\s*)?$") & (a >= 1) & (a <= b)
        return F.when(ok, F.sequence(a, F.greatest(a, b))).otherwise(F.array().cast("array<int>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(c, ","), pages))))


def page_range_error(c: Column, total_pages: Column) -> Column:
    """Why a page range is refused, null if it is none or right: a part that is no range, a start after its end, pages outside 1 to total_pages."""
    form, blank = r"^\s*[0-9]+\s*(-\s*[0-9]+\s*)?$", r"^\s*$"
    parts = F.filter(F.split(c, ","), lambda p: ~p.rlike(blank))
    end = lambda p: F.regexp_extract(p, r"([0-9]+)\s*$", 1).try_cast("long")
    start = lambda p: F.regexp_extract(p, r"^\s*([0-9]+)", 1).try_cast("long")
    wrong = F.filter(parts, lambda p: ~p.rlike(form))
    turned = F.filter(parts, lambda p: p.rlike(form) & (start(p) > end(p)))
    outside = F.exists(parts, lambda p: F.coalesce((start(p) < 1) | (end(p) > total_pages), F.lit(True)))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(None).cast("string")).otherwise(
        F.when(F.size(wrong) > 0, F.concat(F.lit("no page range: "), F.trim(F.element_at(wrong, 1))))
        .when(F.size(turned) > 0, F.concat(F.lit("start after end: "), F.trim(F.element_at(turned, 1))))
        .when((F.size(parts) == 0) | outside, F.concat(F.lit("pages have to lie in 1 to "), total_pages.cast("string")))
    )


def page_set_ops(a: Column, b: Column) -> tuple[Column, Column]:
    """Union and intersection."""
    return F.array_sort(F.array_union(a, b)), F.array_sort(F.array_intersect(a, b))
