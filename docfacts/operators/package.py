"""Creation packages, readiness, reports and roll-ups (A21-A26, B9-B11, B18, B20, K8-K12 rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.functions.text import normalize_company_name
from docfacts.operators.joins import contains_any

CONTRACT_DATE = "2026-09-09"
# Enabled profile fields (code, group, type, extraction mode).
PROFILE_FIELDS = [
    ("enterprise.name", "BUSINESS_REGISTRATION", "STRING", "DIRECT"), ("enterprise.credit_code", "BUSINESS_REGISTRATION", "STRING", "DIRECT"),
    ("enterprise.legal_person", "BUSINESS_REGISTRATION", "STRING", "DIRECT"), ("enterprise.registered_capital", "BUSINESS_REGISTRATION", "MONEY", "DIRECT"),
    ("enterprise.established_date", "BUSINESS_REGISTRATION", "DATE", "DIRECT"), ("enterprise.business_scope", "BUSINESS_REGISTRATION", "TEXT", "DIRECT"),
    ("enterprise.location", "BUSINESS_REGISTRATION", "OBJECT", "DIRECT"), ("enterprise.employee_count", "BUSINESS_REGISTRATION", "NUMBER", "DIRECT"),
    ("qualification.items", "QUALIFICATION", "ARRAY", "ENTITY_AND_FIELD"), ("personnel.core_members", "PERSONNEL", "ARRAY", "ENTITY_AND_FIELD"),
    ("personnel.professionals", "PERSONNEL", "ARRAY", "ENTITY_AND_FIELD"), ("capability.main_industries", "CAPABILITY", "ARRAY", "DERIVED"),
    ("capability.intellectual_properties", "CAPABILITY", "ARRAY", "ENTITY_AND_FIELD"), ("capability.project_performances", "CAPABILITY", "ARRAY", "ENTITY_AND_FIELD"),
    ("capability.main_regions", "CAPABILITY", "ARRAY", "DERIVED"), ("capability.average_win_amount", "CAPABILITY", "MONEY", "DERIVED"),
    ("capability.win_project_count_3y", "CAPABILITY", "NUMBER", "DERIVED"), ("capability.buyer_relationships", "CAPABILITY", "ARRAY", "DERIVED"),
    ("capability.tender_records", "CAPABILITY", "OBJECT", "POST_IMPORT_DERIVED"), ("preference.target_industries", "DECISION", "ARRAY", "USER_CONFIRMED_ONLY"),
    ("preference.target_regions", "DECISION", "ARRAY", "USER_CONFIRMED_ONLY"), ("preference.project_types", "DECISION", "ARRAY", "USER_CONFIRMED_ONLY"),
    ("preference.amount_range", "DECISION", "OBJECT", "USER_CONFIRMED_ONLY"), ("preference.products_solutions", "DECISION", "ARRAY", "USER_CONFIRMED_ONLY"),
    ("risk.records", "RISK", "ARRAY", "ENTITY_AND_FIELD"), ("tag.capabilities", "TAG", "ARRAY", "DERIVED"), ("tag.risks", "TAG", "ARRAY", "DERIVED"),
    ("evaluation.scores", "EVALUATION", "OBJECT", "POST_IMPORT_DERIVED"), ("quality.api_coverage", "DATA_QUALITY", "ARRAY", "EXTERNAL_ONLY"),
    ("quality.data_gaps", "DATA_QUALITY", "ARRAY", "DERIVED"),
]
# Capability dimensions with the fields that serve them.
DIMENSION_FIELDS = {
    "industry_capability": ["capability.main_industries", "capability.tender_records"],
    "technical_capability": ["qualification.items", "capability.intellectual_properties", "tag.capabilities"],
    "similar_performance_capability": ["capability.project_performances", "capability.tender_records"],
    "regional_delivery_capability": ["enterprise.location", "capability.main_regions", "capability.project_performances"],
    "amount_experience_capability": ["capability.average_win_amount", "capability.win_project_count_3y"],
    "personnel_resource_capability": ["enterprise.employee_count", "personnel.core_members", "personnel.professionals"],
    "buyer_relationship_capability": ["capability.buyer_relationships", "capability.project_performances"],
    "tender_performance_capability": ["capability.tender_records", "capability.project_performances"],
}
#: Direct fields: company column and the fragments of evidence paths that support it.
DIRECT = {
    "enterprise.name": ("company_name", ["companyname", "enterprise.name"]), "enterprise.credit_code": ("credit_code", ["creditcode", "credit_code"]),
    "enterprise.legal_person": ("legal_person", ["legalperson", "legal_person"]), "enterprise.registered_capital": ("registered_capital", ["capital"]),
    "enterprise.established_date": ("established_date", ["established"]), "enterprise.business_scope": ("business_scope", ["scope"]),
    "enterprise.location": ("location", ["address", "location"]), "enterprise.employee_count": ("employee_count", ["employee"]),
}


def contract_table(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Enabled fields and dimensions as rows, with the snapshot's date."""
    fields = spark.createDataFrame(PROFILE_FIELDS, "field_code string, field_group string, value_type string, mode string").withColumn("snapshot_date", F.lit(CONTRACT_DATE).cast("date"))
    return fields, spark.createDataFrame([(d, f) for d, fs in DIMENSION_FIELDS.items() for f in fs], "dimension string, field_code string")


def rollup_status(done: Column) -> Column:
    """SUCCESS if all parts are done, PARTIAL if some are, else FAILED."""
    return F.when(F.bool_and(done), "SUCCESS").when(F.bool_or(done), "PARTIAL").otherwise("FAILED")


def page_quality_rollup(pages: DataFrame) -> DataFrame:
    """Pages per status, the pages to look at, and the document's status."""
    bad = F.col("status") != "AVAILABLE"
    lost = F.col("status").isin("MISSING_RESULT", "OCR_FAILED", "OCR_REQUIRED")
    return pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(~bad).alias("available"), F.array_sort(F.collect_list(F.when(bad, F.col("physical_page")))).alias("open_pages"),
        F.when(F.bool_and(lost), "FAILED").when(F.bool_or(bad), "COMPLETE_WITH_WARNINGS").otherwise("COMPLETE").alias("status"),
    )


def usage_summary(calls: DataFrame) -> DataFrame:
    """Requests and tokens by stage; cached calls count no request; usage that is no integer counts nothing. calls: (stage, cached, request_count, usage map<string,string>)."""
    tokens = F.aggregate(F.map_values(F.coalesce("usage", F.create_map().cast("map<string,string>"))), F.lit(0).cast("long"), lambda a, v: a + F.coalesce(F.when(v.rlike("^[0-9]+$"), v.try_cast("long")), F.lit(0).cast("long")))
    return calls.groupBy("stage").agg(F.sum(F.when(F.coalesce("cached", F.lit(False)), 0).otherwise(F.coalesce("request_count", F.lit(0)))).alias("requests"), F.sum(tokens).alias("tokens"))


def quality_metrics(parts: dict[str, DataFrame], errors: DataFrame, docs: DataFrame) -> DataFrame:
    """A counter per document and part, and its status."""
    out = docs.select("doc_id")
    for name, df in parts.items():
        out = out.join(df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name)), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    out = out.join(errors.groupBy("doc_id").agg(F.count(F.lit(1)).alias("errors")), "doc_id", "left").withColumn("errors", F.coalesce("errors", F.lit(0)))
    facts = reduce(lambda a, b: a + b, [F.col(n) for n in parts])
    return out.withColumn("status", F.when(facts == 0, "FAILED").when(F.col("errors") > 0, "PARTIAL").otherwise("SUCCESS"))


def field_refs(evidence: DataFrame, fragments: list[str]) -> Column:
    """J9 as an aggregate: ids of the evidence whose path holds any fragment."""
    return F.array_sort(F.collect_set(F.when(contains_any(F.col("field_path"), fragments), F.col("evidence_id"))))


def _mentions(column: str):
    return lambda path: F.contains(path, F.lit(column.replace("_", "").lower()))


def profile_projection(company: DataFrame, evidence: DataFrame, entities: DataFrame, derived: DataFrame, conflicts: DataFrame) -> DataFrame:
    """(doc_id, field_code, value JSON, refs, blocked_reason) of direct, entity and derived candidates.

    company: (doc_id, source_hash, columns of DIRECT); entities: (doc_id, field_code, entity_key, value, refs, conflict_refs); derived:
    (doc_id, field_code, value); conflicts: (doc_id, field_path).
    """
    refs = evidence.groupBy("doc_id").agg(*[field_refs(evidence, paths).alias(code.replace(".", "_")) for code, (_, paths) in DIRECT.items()])
    clash = conflicts.groupBy("doc_id").agg(F.collect_set(F.lower("field_path")).alias("clashes"))
    base = company.join(refs, "doc_id", "left").join(clash, "doc_id", "left")
    cells = F.array(*[F.struct(F.lit(code).alias("field_code"), F.to_json(F.struct(F.col(c).alias("v"))).alias("value"), F.col(c).isNotNull().alias("there"), F.coalesce(F.col(code.replace(".", "_")), F.array().cast("array<string>")).alias("refs"),
                               F.exists(F.coalesce("clashes", F.array().cast("array<string>")), _mentions(c)).alias("clash")) for code, (c, _) in DIRECT.items()])
    direct = base.select("doc_id", F.explode(cells).alias("c")).filter("c.there").select("doc_id", "c.field_code", "c.value", "c.refs", F.when(F.size("c.refs") == 0, "MISSING_FIELD_EVIDENCE").when(F.col("c.clash"), "UNRESOLVED_CONFLICT").alias("blocked_reason"))
    ok = (F.size("refs") > 0) & (F.size("conflict_refs") == 0)
    grouped = entities.groupBy("doc_id", "field_code").agg(
        F.to_json(F.array_sort(F.collect_list(F.when(ok, F.col("value"))))).alias("value"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(ok, F.col("refs")))))).alias("refs"), F.count_if(ok).alias("n"), F.count_if(F.size("refs") > 0).alias("with_refs"),
    )
    entity = grouped.select("doc_id", "field_code", "value", "refs", F.when(F.col("with_refs") == 0, "ENTITY_WITHOUT_EVIDENCE").when(F.col("n") == 0, "UNRESOLVED_CONFLICT").alias("blocked_reason"))
    rest = derived.select("doc_id", "field_code", "value", F.array().cast("array<string>").alias("refs"), F.lit(None).cast("string").alias("blocked_reason"))
    return direct.unionByName(entity).unionByName(rest)


def entity_candidates(performances: DataFrame) -> dict[str, DataFrame]:
    """Row sets of historical projects. performances: (doc_id, performance_key, relation_type, bid_amount, is_winner, customer, owner, contract struct, project_personnel array, consortium_members array, refs)."""
    key = ["doc_id", F.col("performance_key").alias("performance_ref")]
    filled = F.coalesce(*[F.nullif(F.col(f"contract.{c}").cast("string"), F.lit("")) for c in ("contract_no", "contract_name", "amount_yuan", "sign_date")]).isNotNull()
    return {
        "project_relations": performances.select(*key, "relation_type", "bid_amount", "is_winner", "refs"),
        "project_persons": performances.select(*key, F.explode("project_personnel").alias("p")).select("doc_id", "performance_ref", "p.*"),
        "consortium_members": performances.select(*key, F.explode("consortium_members").alias("m")).select("doc_id", "performance_ref", "m.*"),
        "contracts": performances.filter(filled).select(*key, F.coalesce("customer", "owner").alias("buyer_name"), "contract.*", "refs"),
    }


def creation_readiness(company: DataFrame, evidence: DataFrame, conflicts: DataFrame, partial: DataFrame) -> DataFrame:
    """Blocking issues, warnings, status and next action per document; a partial page range always demotes."""
    strong = lambda paths: F.bool_or(contains_any(F.col("field_path"), paths) & (F.col("source_strength") == "A"))
    some = lambda paths: F.bool_or(contains_any(F.col("field_path"), paths))
    name, code = DIRECT["enterprise.name"][1], DIRECT["enterprise.credit_code"][1]
    ev = evidence.groupBy("doc_id").agg(some(name).alias("n_any"), strong(name).alias("n_strong"), some(code).alias("c_any"), strong(code).alias("c_strong"))
    cf = conflicts.filter("review_required").groupBy("doc_id").agg(F.bool_or((F.col("entity_type") == "COMPANY") & F.col("field_path").isin("companyName", "creditCode")).alias("identity"), F.count(F.lit(1)).alias("open"))
    d = company.join(ev, "doc_id", "left").join(cf, "doc_id", "left").join(partial.select("doc_id", F.lit(True).alias("partial")), "doc_id", "left")
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    has_name, has_code = F.coalesce("company_name", F.lit("")) != "", F.coalesce("credit_code", F.lit("")) != ""
    issues = F.array_compact(F.array(
        F.when(~has_name, "MISSING_COMPANY_NAME").when(no("n_any"), "COMPANY_NAME_WITHOUT_EVIDENCE"), F.when(~has_code, "MISSING_OR_INVALID_CREDIT_CODE").when(no("c_any"), "CREDIT_CODE_WITHOUT_EVIDENCE"),
        F.when(normalize_company_name(F.col("subject_company_name")) != normalize_company_name(F.col("company_name")), "SUBJECT_COMPANY_NAME_MISMATCH"), F.when(F.col("identity"), "UNRESOLVED_COMPANY_IDENTITY_CONFLICT"),
    ))
    warnings = F.array_compact(F.array(
        F.when(has_name & ~no("n_any") & no("n_strong"), "company name without strong evidence"), F.when(has_code & ~no("c_any") & no("c_strong"), "credit code without strong evidence"),
        F.when((F.col("open") > 0) & no("identity"), "open conflicts"), F.when(F.col("partial"), "partial page range"),
    ))
    out = d.withColumn("blocking_issues", issues).withColumn("warnings", warnings)
    status = F.when(F.size("blocking_issues") > 0, "IDENTITY_INCOMPLETE").when(F.size("warnings") > 0, "NEEDS_REVIEW").otherwise("READY_FOR_DUPLICATE_CHECK")
    action = F.when(status == "IDENTITY_INCOMPLETE", "MANUAL_IDENTITY_REVIEW").when(status == "NEEDS_REVIEW", "MANUAL_CONFLICT_REVIEW_THEN_DUPLICATE_CHECK").otherwise("CHECK_CREDIT_CODE_AND_NORMALIZED_NAME_IN_DATABASE")
    return out.select("doc_id", "blocking_issues", "warnings", status.alias("status"), action.alias("next_action"))


def build_package(docs: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """One row per document with every part nested as an array of structs."""
    out = docs
    for name, df in parts.items():
        rows = df.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c != "doc_id"]))).alias(name))
        out = out.join(rows, "doc_id", "left")
    return out.withColumn("schema_version", F.lit("company-tender-profile/v2")).withColumn("operation", F.lit("CREATE_COMPANY"))


def all_relationships(evidenced: DataFrame, declared: DataFrame) -> DataFrame:
    """U8."""
    return evidenced.unionByName(declared.join(evidenced, ["owner", "name_key", "relation_type"], "left_anti"), allowMissingColumns=True)


def metric_rows(df: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    """K9: (key, metric, value) rows of wide counters."""
    return df.select(*key, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics])).alias("r")).select(*key, "r.metric", "r.value")


def project_pipeline(tenders: DataFrame, bids: DataFrame, decisions: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per project over all of them: tender fields by status, bids by decision, errors, status; a failing document marks its project and stops none."""
    fields = tenders.groupBy("project").agg(F.count_if(F.col("status") == "EXTRACTED").alias("extracted"), F.count_if(F.col("status") == "MISSING").alias("missing"), F.count_if(F.col("status") == "CONFLICT").alias("conflicts"))
    rows = bids.join(decisions, ["project", "company"], "left").groupBy("project").agg(F.count(F.lit(1)).alias("bids"), F.count_if(F.col("decision") == "WINNER").alias("winners"), F.count_if(F.coalesce(F.col("decision"), F.lit("REVIEW_REQUIRED")) == "REVIEW_REQUIRED").alias("to_review"))
    failed = errors.groupBy("project").agg(F.count(F.lit(1)).alias("errors"))
    out = fields.join(rows, "project", "full").join(failed, "project", "full").na.fill(0)
    return out.withColumn("status", F.when((F.col("extracted") == 0) & (F.col("bids") == 0), "FAILED").when((F.col("errors") > 0) | (F.col("extracted") == 0), "PARTIAL").otherwise("SUCCESS"))


def run_status(projects: DataFrame) -> DataFrame:
    """The class of a whole run by its projects' status."""
    ok = F.col("status") == "SUCCESS"
    return projects.agg(rollup_status(ok).alias("status"), F.count(F.lit(1)).alias("projects"), F.count_if(~ok).alias("not_complete"))


def tender_warning_summary(fields: DataFrame) -> DataFrame:
    """How many fields of a document are missing or in conflict."""
    return fields.groupBy("doc_id").agg(F.count_if(F.col("status") == "MISSING").alias("missing"), F.count_if(F.col("status") == "CONFLICT").alias("conflicts"), F.array_sort(F.collect_list(F.when(F.col("status") != "EXTRACTED", F.col("field")))).alias("open_fields"))


def bid_warning_summary(pages: DataFrame) -> DataFrame:
    """Pages of a bid that OCR left open."""
    return pages.groupBy("doc_id").agg(F.count_if(F.col("status").isin("OCR_FAILED", "OCR_REQUIRED", "MISSING_RESULT")).alias("ocr_open"), F.count_if(F.col("status") == "EMPTY").alias("blank"))
