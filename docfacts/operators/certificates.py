"""Certificate import: candidates, plan, approval, application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfacts.functions.nested import entry_id, fact_key, stable_hash
from docfacts.functions.text import certificate_identity_name, compact, credential_kind, level_suffix, mask_document_numbers, strict_text, unrelated_warning
from docfacts.functions.values import date_consistency, strict_date, validity_status
from docfacts.operators.joins import affiliation_reasons, small

VERSION = "certificate-import-v1"
SOURCE_REF = "certificate-batch:v1"
FIELD_CODES = {"qualification": "qualification.items", "personnel": "personnel.professionals"}
WRITABLE = ["INSERT", "PATCH_EMPTY", "LINK_EVIDENCE", "HISTORY"]
#: Fields compared with existing rows, and those patched where empty, per kind.
CHECKED = ["cert_level", "issue_date", "expiry_date", "issuing_authority"]
PATCHED = {"qualification": CHECKED, "personnel": ["cert_level", "person_role"]}


# Names under which a field of a stored certificate may stand, first ones first.
ALIASES = {
    "cert_name": ["certName", "cert_name", "qualificationName", "qualification_name", "certificateName", "licenseName", "licencename", "资质名称", "证书名称", "许可证名称", "name", "type"],
    "cert_no": ["certNo", "cert_no", "certificateNum", "certificateNo", "certificate_number", "licenseNumber", "licencenumber", "证书编号", "资质证书编号", "许可证编号"],
    "cert_level": ["certLevel", "cert_level", "qualificationLevel", "qualification_level", "grade", "level", "资质等级", "等级"],
    "issue_date": ["issueDate", "issue_date", "issuingCertificateTime", "startDate", "fromdate", "发证日期"],
    "expiry_date": ["expiryDate", "expiry_date", "effectiveTime", "endDate", "validUntil", "todate", "有效期至", "到期日期"],
    "issuing_authority": ["issuingAuthority", "issuing_authority", "organ", "orgAn", "department", "发证机关"],
    "person_name": ["personName", "person_name", "姓名"],
    "person_role": ["personRole", "person_role"],
    "scope": ["scope", "范围"],
    "profession": ["profession", "specialty", "major", "专业"],
    "valid_from": ["validFrom", "valid_from"],
    "holder_company_name": ["holderCompanyName", "company_name", "companyName", "注册单位"],
    "registration_status": ["registrationStatus", "registration_status"],
    "qualification_type": ["qualificationType", "qualification_type"],
}


def canonical_certificate(df: DataFrame, aliases: dict[str, list[str]] = ALIASES) -> DataFrame:
    """the first non-empty of each field's alias columns that df has; dates cut to ten characters; level from the name's suffix."""
    have = set(df.columns)
    out = {}
    for field, names in aliases.items():
        found = [F.nullif(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names if n in have]
        value = F.coalesce(*found) if found else F.lit(None).cast("string")
        out[field] = F.left(value, F.lit(10)) if field.endswith("_date") or field == "valid_from" else value
    out["cert_level"] = F.coalesce(out["cert_level"], level_suffix(out["cert_name"]))
    return df.select("*", F.struct(*[v.alias(k) for k, v in out.items()]).alias("canonical"))


def normalize_candidates(records: DataFrame, company: DataFrame, reviews: DataFrame, as_of: Column) -> DataFrame:
    """B1: one candidate per certificate entry with value columns, reasons and an action (INVALID, REVIEW or null).

    records: (source_hash, kind, document_type, holder_name, credit_code, person_name, person_role, document_title, entries
    array<struct<cert_name,cert_no,cert_level,issue_date,expiry_date,valid_from,issuing_authority,scope>>, warnings, confidence,
    review_required, image_hash); company: one row (company_id, company_name, company_credit); reviews: (entry_id, note,
    content_confirmed, affiliation_confirmed).
    """
    expected = F.when(F.col("kind") == "qualification", "qualification_certificate").otherwise("employee_certificate")
    n = F.coalesce(F.size("entries"), F.lit(0))
    bad = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("document_type") == expected, F.lit(False)), "document type is not part of this import"),
        F.when((n <= 0) | (n > 50), "no entry or more than 50"),
    ))
    docs = records.crossJoin(F.broadcast(company)).withColumn("_bad", bad)
    invalid = docs.filter(F.size("_bad") > 0).select(
        stable_hash(F.col("company_id"), F.col("source_hash"), F.col("kind"), F.lit("invalid")).alias("entry_id"), "source_hash", "kind", F.lit(0).alias("index"),
        F.lit("INVALID").alias("action"), F.col("_bad").alias("reasons"),
    )
    each = docs.filter(F.size("_bad") == 0).select("*", F.posexplode("entries").alias("index", "e"))
    each = each.withColumn("entry_id", entry_id(VERSION, F.col("company_id"), F.col("source_hash"), F.col("kind"), F.col("index")))
    each = each.join(reviews.select("entry_id", "note", "content_confirmed", "affiliation_confirmed"), "entry_id", "left")
    errors, values = [], {}
    for name, limit in (("cert_name", 200), ("cert_no", 128), ("cert_level", 64), ("issuing_authority", 200), ("scope", 12000)):
        values[name], e = strict_text(F.col(f"e.{name}"), limit)
        errors.append(e)
    for name in ("issue_date", "expiry_date", "valid_from"):
        values[name], e = strict_date(F.col(f"e.{name}"))
        errors.append(e)
    for name, limit in (("holder_name", 255), ("credit_code", 32), ("person_name", 64), ("person_role", 64)):
        values[name], e = strict_text(F.col(name), limit)
        errors.append(e)
    each = each.select(*[c for c in each.columns if c not in values], *[v.alias(k) for k, v in values.items()], F.array_compact(F.array(*errors)).alias("errors"))
    each = each.withColumn("cert_level", F.coalesce("cert_level", level_suffix(F.col("cert_name"))))
    noted = F.coalesce(F.trim("note") != "", F.lit(False))
    content_ok = F.coalesce("content_confirmed", F.lit(False)) & noted
    warnings = F.filter(F.transform(F.coalesce("warnings", F.array().cast("array<string>")), mask_document_numbers), lambda w: F.trim(w) != "")
    blocking = F.filter(warnings, lambda w: ~unrelated_warning(w))
    only_unrelated = (F.size(warnings) > 0) & (F.size(blocking) == 0)
    conf = F.col("confidence")
    needs_review = (F.coalesce("review_required", F.lit(True)) & ~only_unrelated) | (F.size(blocking) > 0) | conf.isNull() | F.isnan(conf) | (conf < 0.8) | (conf > 1)
    kind = F.when(F.col("kind") == "personnel", "PERSONNEL_CERTIFICATE").otherwise(credential_kind(F.coalesce("cert_name", F.lit(""))))
    personnel = F.col("kind") == "personnel"
    reasons = F.concat(
        affiliation_reasons(F.col("credit_code"), F.col("holder_name"), F.col("company_credit"), F.col("company_name"), F.coalesce("affiliation_confirmed", F.lit(False)) & noted),
        date_consistency(F.col("issue_date"), F.col("valid_from"), F.col("expiry_date"), as_of),
        F.array_compact(F.array(
            F.when(F.col("cert_name").isNull() | F.col("cert_no").isNull(), "certificate name or number missing"),
            F.when(personnel & F.col("person_name").isNull(), "holder missing"),
            F.when(personnel & (F.coalesce("person_name", F.lit("")).rlike("[,，、;；/\n]") | F.exists(warnings, lambda w: w.rlike("多人|多个人|多个持证人|多位人员"))), "several holders"),
            F.when(~personnel & ((kind == "UNKNOWN") | F.concat_ws("", "document_title", "cert_name").rlike("报告|审核决定|监督审核")), "no clear class"),
            F.when(needs_review & ~content_ok, "content to be confirmed"),
            F.when(F.col("image_hash").isNull() & ~content_ok, "image not verified"),
        )),
    )
    invalid_value = F.size("errors") > 0
    good = each.withColumn("reasons", F.when(invalid_value, F.col("errors")).otherwise(reasons)).withColumn(
        "action", F.when(invalid_value, "INVALID").when(F.size("reasons") > 0, "REVIEW")
    ).withColumn("credential_kind", kind).withColumn("time_status", validity_status(F.col("valid_from"), F.col("expiry_date"), as_of)).withColumn(
        "fact_key", fact_key(F.col("kind"), F.col("cert_no"), F.col("cert_name"), F.col("person_name"))
    ).withColumn("field_code", F.when(personnel, FIELD_CODES["personnel"]).otherwise(FIELD_CODES["qualification"]))
    keep = ["entry_id", "source_hash", "kind", "index", "action", "reasons", "fact_key", "field_code", "credential_kind", "time_status", *values]
    return good.select(*keep).unionByName(invalid, allowMissingColumns=True)


def previously_imported(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Adds `imported`. history: (entry_id) of batches and stored values."""
    return candidates.join(history.select("entry_id", F.lit(True).alias("imported")).distinct(), "entry_id", "left").withColumn("imported", F.coalesce("imported", F.lit(False)))


def plan_candidates(candidates: DataFrame, existing: DataFrame, history: DataFrame, definitions: DataFrame, manual_blocks: DataFrame) -> DataFrame:
    """B2: final action and patch of every candidate.

    existing: (kind, source: business | manual | profile, target_id, cert_no, cert_name, person_name, person_role, cert_level, issue_date,
    expiry_date, issuing_authority); definitions: (field_code, value_type, is_enabled); manual_blocks: (field_code) whose manual value was
    cleared or is unusable. Precedence: earlier import, own action, duplicate in the batch, reasons, HISTORY, LINK_EVIDENCE, PATCH_EMPTY, INSERT.
    """
    c = previously_imported(candidates, history)
    values = ["cert_level", "issue_date", "expiry_date", "issuing_authority", "person_role", "cert_name", "cert_no", "person_name", "scope", "holder_name"]
    digest = stable_hash(*[F.col(v) for v in values])
    open_ = ~F.col("imported") & F.col("action").isNull()
    # a fact's first row by aggregation and no window: a fact that is everywhere stays bounded, and rows without a fact take no part
    c = c.withColumn("_open", open_).withColumn("_digest", digest).withColumn("_at", F.struct("source_hash", "index"))
    facts = c.filter("_open").groupBy("fact_key").agg(
        F.min("_at").alias("_first_at"), F.min_by("_digest", "_at").alias("_first"), (F.min("_digest") != F.max("_digest")).alias("_any"), F.lit(True).alias("_open")
    )
    c = c.join(facts, ["fact_key", "_open"], "left")
    differs, first = F.col("_digest") != F.col("_first"), F.col("_at") == F.col("_first_at")
    c = c.withColumn("_batch", F.when(F.col("_open"), F.when(differs | (first & F.col("_any")), "REVIEW").when(~first, "DUPLICATE")))

    known = existing.withColumn("fact_key", fact_key(F.col("kind"), F.col("cert_no"), F.col("cert_name"), F.col("person_name")))
    old = known.filter(compact(F.col("cert_no")) != "").groupBy("kind", "fact_key").agg(
        F.count_if(F.col("source") == "business").alias("n_business"), F.count_if(F.col("source") == "manual").alias("n_manual"), F.count(F.lit(1)).alias("n_matches"),
        F.min(F.when(F.col("source") == "business", F.col("target_id"))).alias("target_id"),
        F.collect_set(F.struct("source", *[F.col(v).cast("string").alias(v) for v in [*CHECKED, "person_role"]])).alias("olds"),
    )
    j = c.join(old, ["kind", "fact_key"], "left")
    numbers = known.filter("kind = 'personnel'").select(compact(F.col("cert_no")).alias("_no"), compact(F.col("person_name")).alias("_person"), F.col("fact_key").alias("_key"))
    clash = j.filter("kind = 'personnel' AND _open").select("entry_id", compact(F.col("cert_no")).alias("_no"), compact(F.col("person_name")).alias("_p"), F.col("fact_key").alias("_k")).join(numbers, "_no").groupBy("entry_id").agg(
        F.bool_or(F.col("_p") != F.col("_person")).alias("other_person"), F.bool_or((F.col("_p") == F.col("_person")) & (F.col("_k") != F.col("_key"))).alias("other_name")
    )
    j = j.join(clash, "entry_id", "left").join(small(definitions.select("field_code", (F.col("is_enabled") & (F.col("value_type") == "ARRAY")).alias("_defined"))), "field_code", "left")
    j = j.join(small(manual_blocks.select("field_code", F.lit(True).alias("_blocked")).distinct()), "field_code", "left")
    expired = F.col("time_status") == "EXPIRED"
    own = lambda v: compact(F.col(v).cast("string"))
    other_value = lambda v: lambda o: (compact(o[v]) != "") & (own(v) != "") & (compact(o[v]) != own(v))
    differ = [
        F.when(F.exists("olds", other_value(v)) & (~expired if v in ("cert_level", "issue_date", "expiry_date") else F.lit(True)), F.lit(f"{v} differs"))
        for v in [*CHECKED, "person_role"]
    ]
    reasons = F.array_compact(F.array(
        F.when(F.coalesce("n_business", F.lit(0)) > 1, "several business rows"), F.when(F.col("other_person"), "number of another person"), F.when(F.col("other_name"), "number under another name"),
        F.when(F.col("_blocked"), "manual value cleared"), F.when(~F.coalesce("_defined", F.lit(False)), "field is not an enabled array"), *differ,
    ))
    j = j.withColumn("_reasons", reasons)
    same_manual = F.exists("olds", lambda o: (o["source"] == "manual") & (compact(o["cert_level"]) == own("cert_level")) & (compact(o["issue_date"]) == own("issue_date")) & (compact(o["expiry_date"]) == own("expiry_date")))
    business = F.filter("olds", lambda o: o["source"] == "business")
    first = lambda v: F.try_element_at(business, F.lit(1))[v]
    patch = F.array_compact(F.array(*[
        F.when((F.col("kind") == k) & (compact(first(v)) == "") & (own(v) != ""), F.struct(F.lit(v).alias("field"), F.col(v).cast("string").alias("value")))
        for k, fields in PATCHED.items() for v in fields
    ]))
    patch = F.when((F.coalesce("n_business", F.lit(0)) == 1) & (F.coalesce("n_manual", F.lit(0)) == 0), patch)
    final = (
        F.when(F.col("imported"), "DUPLICATE").when(F.col("action").isNotNull(), F.col("action")).when(F.col("_batch").isNotNull(), F.col("_batch"))
        .when(F.size("_reasons") > 0, "REVIEW").when(expired & ~F.coalesce(same_manual, F.lit(False)), "HISTORY").when(F.coalesce("n_manual", F.lit(0)) > 0, "LINK_EVIDENCE")
        .when(F.size(patch) > 0, "PATCH_EMPTY").when(F.coalesce("n_matches", F.lit(0)) > 0, "LINK_EVIDENCE").otherwise("INSERT")
    )
    j = j.withColumn("final", final).withColumn("patch", F.when(F.col("final") == "PATCH_EMPTY", patch))
    # one person's number under several facts: nothing of it is written
    number = j.filter(F.col("final").isin(WRITABLE) & (F.col("kind") == "personnel")).groupBy(compact(F.col("person_name")).alias("_pn"), compact(F.col("cert_no")).alias("_cn")).agg((F.count_distinct("fact_key") > 1).alias("_clash"))
    j = j.withColumn("_pn", compact(F.col("person_name"))).withColumn("_cn", compact(F.col("cert_no"))).join(number, ["_pn", "_cn"], "left")
    clashed = F.coalesce("_clash", F.lit(False)) & F.col("final").isin(WRITABLE) & (F.col("kind") == "personnel")
    text = F.concat(F.coalesce("reasons", F.array().cast("array<string>")), F.when(F.col("imported"), F.array(F.lit("already imported"))).when(F.col("_batch") == "DUPLICATE", F.array(F.lit("repeated in this batch"))).when(F.col("_batch") == "REVIEW", F.array(F.lit("differs within this batch"))).when(clashed, F.array(F.lit("one number, several names"))).otherwise(F.when(F.col("_open"), F.col("_reasons")).otherwise(F.array().cast("array<string>"))))
    return j.select(
        *[c for c in candidates.columns if c not in ("action", "reasons")], F.when(clashed, "REVIEW").otherwise(F.col("final")).alias("action"), text.alias("reasons"),
        F.when(~clashed, F.col("patch")).alias("patch"), "target_id",
    )


def plan_hash(plan: DataFrame, columns: list[str]) -> DataFrame:
    """One hash of all rows, whatever their order: count and three commutative sums of row hashes."""
    row = F.struct(*[F.col(c) for c in columns])
    parts = [F.sum(F.pmod(F.xxhash64(F.to_json(row), F.lit(salt)), F.lit(1 << 31)).cast("decimal(38,0)")).cast("string") for salt in (1, 2, 3)]
    return plan.agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *parts), 256).alias("plan_hash"))


def approve_subset(plan: DataFrame, approved: DataFrame, most: int = 200) -> DataFrame:
    """Violations of an approval (entry_id): its size, repeats, unknown ids, ids that may not be written."""
    counts = approved.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("entry_id").alias("d"))
    size = counts.filter((F.col("n") < 1) | (F.col("n") > most) | (F.col("n") != F.col("d"))).select(F.lit(None).cast("string").alias("entry_id"), F.lit("one to 200 different entries").alias("rule"))
    unknown = approved.join(plan, "entry_id", "left_anti").select("entry_id", F.lit("unknown entry").alias("rule"))
    closed = approved.join(plan.filter(~F.col("action").isin(WRITABLE)), "entry_id", "left_semi").select("entry_id", F.lit("entry may not be written").alias("rule"))
    return size.unionByName(unknown).unionByName(closed)


def apply_batch(plan: DataFrame, approved: DataFrame, batch_uid: str, receipts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(business rows to insert or patch, profile values, receipt rows); nothing if the batch was applied before."""
    fresh = plan.join(approved.select("entry_id"), "entry_id", "left_semi").withColumn("batch_uid", F.lit(batch_uid)).join(receipts.select("batch_uid"), "batch_uid", "left_anti")
    business = fresh.filter("action IN ('INSERT', 'PATCH_EMPTY')")
    profile = fresh.select("entry_id", "field_code", "fact_key", "action", (F.col("action") == "HISTORY").alias("history_only"), F.lit(False).alias("decision_eligible"), F.lit(SOURCE_REF).alias("source_ref"))
    receipt = fresh.select("batch_uid", "entry_id", "action", "target_id", "patch")
    return business, profile, receipt


def batch_report(receipts: DataFrame, batch_uid: str) -> DataFrame:
    """B8."""
    return receipts.filter(F.col("batch_uid") == batch_uid)


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """A15."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def identity_name(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("identity_name", certificate_identity_name(F.col(name)))
