"""Record normaliser and domain evidence (H10, H12); families of entities are in `families`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfacts.functions.nested import add_warnings, stable_hash
from docfacts.functions.text import clean_inline_text, clean_text, compact, redact_sensitive
from docfacts.functions.values import expiry_status, normalize_confidence, normalize_date, normalize_date_keep, normalize_document_type
from docfacts.operators.joins import company_match

MAX_ENTRIES, MAX_UNCLASSIFIED, MAX_EVIDENCE = 50, 100, 200


def normalize_records(df: DataFrame, as_of: Column, target_company: Column, days: int = 180, threshold: float = 0.8) -> DataFrame:
    """Certificate records (source, document_type, holder, entries array<struct<cert_name,cert_no,level,expiry_date>>, evidence, unclassified, warnings, confidence, review_required) cleaned, capped and marked for review."""
    kind, w1 = normalize_document_type(F.col("document_type"))
    conf, w2 = normalize_confidence(F.col("confidence").cast("string"))

    def entry(e: Column) -> Column:
        day, _ = normalize_date_keep(e["expiry_date"], "expiry_date")
        return F.struct(
            clean_inline_text(e["cert_name"]).alias("cert_name"), clean_inline_text(e["cert_no"]).alias("cert_no"), clean_inline_text(e["level"]).alias("level"), day.alias("expiry_date"),
            expiry_status(normalize_date(e["expiry_date"]), as_of, days).alias("expiry_status"),
        )

    filled = lambda e: F.coalesce(e["cert_name"], e["cert_no"], e["level"], e["expiry_date"]).isNotNull()
    entries = F.filter(F.transform(F.slice("entries", 1, MAX_ENTRIES), entry), filled)
    unread = F.exists(F.slice("entries", 1, MAX_ENTRIES), lambda e: clean_text(e["expiry_date"]).isNotNull() & normalize_date(e["expiry_date"]).isNull())
    out = df.select(
        "source", kind.alias("document_type"), clean_inline_text(F.col("holder")).alias("holder"), company_match(F.col("holder"), target_company).alias("company_match"), entries.alias("entries"),
        F.filter(F.slice("evidence", 1, MAX_EVIDENCE), lambda e: F.trim(F.coalesce(e["text"], F.lit(""))) != "").alias("evidence"), F.slice("unclassified", 1, MAX_UNCLASSIFIED).alias("unclassified"),
        add_warnings(F.col("warnings"), w1, w2, F.when(unread, "an expiry date could not be read")).alias("warnings"), conf.alias("confidence"), "review_required",
    )
    review = F.coalesce("review_required", F.lit(True)) | (F.col("document_type") == "unknown") | (F.col("confidence") < threshold) | (F.size("warnings") > 0) | (F.size("entries") == 0) | F.col("company_match").isin("OTHER_COMPANY", "PROBABLE")
    return out.withColumn("review_required", review)


def domain_evidence(evidence: DataFrame, pages: DataFrame, strengths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) evidence (doc_id, domain, local_id, physical_page, field_path, source_text): the text has to stand on the redacted page; ids become stable; strength follows the page's type."""
    right = pages.select("doc_id", "physical_page", compact(redact_sensitive(F.col("text"))[0]).alias("_page"), "document_type")
    text = redact_sensitive(clean_text(F.col("source_text")))[0]
    joined = evidence.withColumn("source_text", text).join(right, ["doc_id", "physical_page"], "left")
    reason = (
        F.when(F.col("_page").isNull(), "page outside the chunk").when(F.col("source_text").isNull(), "no text").when(F.coalesce("field_path", F.lit("")) == "", "no field path")
        .when(~F.contains(F.col("_page"), compact(F.col("source_text"))), "text is not on the page")
    )
    strength = F.coalesce(*[F.when(F.col("document_type") == t, F.lit(s)) for t, s in strengths.items()], F.lit("D"))
    marked = joined.withColumn("reason", reason).withColumn("source_strength", strength).withColumn("evidence_id", stable_hash(F.col("doc_id"), F.col("physical_page"), F.col("field_path"), F.col("source_text"), length=24)).drop("_page")
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL").select("doc_id", "domain", "local_id", "reason")
