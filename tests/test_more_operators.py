"""Packages, readiness, entities, evidence, incremental filters and sinks on small rows."""

import datetime as dt

from pyspark.sql import functions as F

from docfacts.operators import entities, joins, merge, package, profile, tender, windows
from docfacts.sources import records, sinks
from docfacts.streaming import incremental


def test_readiness(spark):
    company = spark.createDataFrame([(1, "甲公司", "C", "甲公司"), (2, None, "C", None), (3, "乙公司", "C", "甲公司")], "doc_id int, company_name string, credit_code string, subject_company_name string")
    evidence = spark.createDataFrame([(d, p, "A") for d in (1, 2, 3) for p in ("company.companyName", "company.creditCode")], "doc_id int, field_path string, source_strength string")
    conflicts = spark.createDataFrame([], "doc_id int, entity_type string, field_path string, review_required boolean")
    none = spark.createDataFrame([], "doc_id int")
    got = {r["doc_id"]: (r["status"], r["blocking_issues"]) for r in package.creation_readiness(company, evidence, conflicts, none).collect()}
    assert got[1] == ("READY_FOR_DUPLICATE_CHECK", []) and got[2] == ("IDENTITY_INCOMPLETE", ["MISSING_COMPANY_NAME"]) and got[3][1] == ["SUBJECT_COMPANY_NAME_MISMATCH"]
    assert package.creation_readiness(company.filter("doc_id = 1"), evidence, conflicts, company.select("doc_id")).first()["status"] == "NEEDS_REVIEW"


def test_contract(spark):
    fields, dimensions = package.contract_table(spark)
    assert fields.count() == 30 and dimensions.select("dimension").distinct().count() == 8


def test_domain_evidence(spark):
    pages = spark.createDataFrame([("d", 1, "证书 编号 A1 电话13812345678", "QUALIFICATION_CERTIFICATE")], "doc_id string, physical_page int, text string, document_type string")
    rows = [("d", "q", "e1", 1, "certNo", "编号A1"), ("d", "q", "e2", 1, "certNo", "编号 B2"), ("d", "q", "e3", 2, "certNo", "编号A1"), ("d", "q", "e4", 1, "", "编号A1")]
    good, bad = entities.domain_evidence(spark.createDataFrame(rows, "doc_id string, domain string, local_id string, physical_page int, field_path string, source_text string"), pages, {"QUALIFICATION_CERTIFICATE": "A"})
    assert [(r["local_id"], r["source_strength"]) for r in good.collect()] == [("e1", "A")] and {r["local_id"] for r in bad.collect()} == {"e2", "e3", "e4"}


def test_record_normaliser(spark):
    schema = "source string, document_type string, holder string, entries array<struct<cert_name:string,cert_no:string,level:string,expiry_date:string>>, evidence array<struct<field:string,text:string>>, unclassified array<struct<label:string,value:string>>, warnings array<string>, confidence double, review_required boolean"
    rows = [
        ("a", "员工证书", "甲公司", [("建造师", "N", "一级", "2099年1月1日"), (None, None, None, None)], [], [], [], 0.95, False),
        ("b", "没见过", "乙公司", [("x", "N", None, "2024-02-30")], [], [], [], 0.5, False),
    ]
    got = {r["source"]: r for r in entities.normalize_records(spark.createDataFrame(rows, schema), F.lit(dt.date(2026, 1, 1)), F.lit("甲公司")).collect()}
    a, b = got["a"], got["b"]
    assert a["document_type"] == "employee_certificate" and len(a["entries"]) == 1 and a["entries"][0]["expiry_date"] == "2099-01-01" and a["entries"][0]["expiry_status"] == "VALID" and not a["review_required"]
    assert b["document_type"] == "unknown" and b["review_required"] and len(b["warnings"]) == 2 and b["company_match"] == "OTHER_COMPANY"


def test_overlay_and_refined(spark):
    pages = spark.createDataFrame([("d", 1, "原文", "NATIVE"), ("d", 2, " ", "NATIVE"), ("d", 3, "", "NATIVE")], "doc_id string, physical_page int, text string, content_source string")
    ocr = spark.createDataFrame([("d", 2, "识别出来的一段足够长的文字内容"), ("d", 3, " ")], "doc_id string, physical_page int, text string")
    vision = spark.createDataFrame([], "doc_id string, physical_page int, text string")
    got = {r["physical_page"]: r["content_source"] for r in joins.overlay_page_text(pages, ocr, vision).collect()}
    assert got == {1: "NATIVE", 2: "GLM_OCR", 3: "OCR_FAILED"}
    typed = spark.createDataFrame([("d", 1, "OTHER", True), ("d", 2, "OTHER", True)], "doc_id string, physical_page int, document_type string, asked boolean")
    answers = spark.createDataFrame([("d", 1, "CONTRACT")], "doc_id string, physical_page int, document_type string")
    assert {(r["document_type"], r["warning"]) for r in joins.apply_refined_types(typed, answers, ["CONTRACT"]).collect()} == {("CONTRACT", None), ("OTHER", "no refined type")}


def test_page_quality(spark):
    rows = [("d", 1, "native", "文字", None, None), ("d", 2, "initial", "", None, "timeout"), ("d", 3, "native", "", None, None), ("d", 4, "initial", "弱", 0.2, None)]
    results = spark.createDataFrame(rows, "doc_id string, physical_page int, pass string, text string, confidence double, error string")
    got = windows.page_quality_status(results, spark.createDataFrame([("d", 5)], "doc_id string, total_pages int"))
    assert [r["status"] for r in got.orderBy("physical_page").collect()] == ["AVAILABLE", "OCR_FAILED", "OCR_REQUIRED", "LOW_CONFIDENCE", "MISSING_RESULT"]
    assert package.page_quality_rollup(got).first()["status"] == "COMPLETE_WITH_WARNINGS"


def test_requirements(spark):
    blocks = spark.createDataFrame([("d", 1, 1, "投标人资格要求：1、具有独立法人资格的营业执照；2、具备建筑工程施工总承包二级资质；3、不接受联合体。")], "doc_id string, page int, ordinal int, text string")
    rows = tender.requirement_sources(blocks)
    assert {r["type"] for r in rows.collect()} >= {"BASIC", "PROFESSIONAL_QUALIFICATION", "CONSORTIUM"}
    merged = merge.merge_requirements(rows.unionByName(rows.withColumn("ordinal", F.col("ordinal") + 100)))
    assert {r["merge_type"] for r in merged.collect()} == {"EXACT_DUPLICATE"}


def test_incremental(spark):
    sources = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3"), ("e", "h5")], "source string, source_hash string")
    outputs = spark.createDataFrame([("a", "h1", "v2"), ("b", "x", "v2"), ("c", "h3", "v1")], "source string, source_hash string, pipeline string")
    assert {r["source"]: r["decision"] for r in incremental.resume_filter(sources, outputs, {"pipeline": "v2"}).collect()} == {"a": "REUSE", "b": "REFUSE", "c": "RECOMPUTE", "e": "RECOMPUTE"}
    chunks = spark.createDataFrame([("h", "c1"), ("h", "c2")], "source_hash string, chunk_hash string")
    cache = spark.createDataFrame([("h", "c1", "m", "p1", "r"), ("h", "c2", "m", "p0", "r")], "source_hash string, chunk_hash string, model string, prompt_version string, response string")
    done, todo = incremental.chunk_cache_filter(chunks, cache, "m", "p1")
    assert [r["chunk_hash"] for r in done.collect()] == ["c1"] and [r["chunk_hash"] for r in todo.collect()] == ["c2"]


def test_profile_values(spark):
    stored = spark.createDataFrame([("f", "s", [("e1", "v1")]), ("f", "other", [("x", "y")])], "field_code string, source_ref string, values array<struct<entry_id:string,value:string>>")
    new = spark.createDataFrame([("f", "s", "e1", "zzz"), ("f", "s", "e2", "v2")], "field_code string, source_ref string, entry_id string, value string")
    values, errors = sinks.upsert_profile_values(stored, new)
    got = {r["source_ref"]: [(v["entry_id"], v["value"]) for v in r["values"]] for r in values.collect()}
    assert got == {"s": [("e1", "v1"), ("e2", "v2")], "other": [("x", "y")]} and errors.count() == 0
    assert sinks.upsert_profile_values(stored, new, cap=10)[1].count() == 2


def test_capability_assessments(spark):
    rows = [("o", "personnel_resource_capability", "c", ["e"]), ("o", "amount_experience_capability", "c", ["e"]), ("o", "technical_capability", "c", None), ("p", "industry_capability", None, ["e"])]
    claims = spark.createDataFrame(rows, "owner string, dimension string, claim string, refs array<string>")
    conflicts = spark.createDataFrame([("o", "contract.amount_Yuan"), ("o", "tender.ranking"), ("p", "person.name")], "owner string, field_path string")
    got = {(r["owner"], r["dimension"]): r["status"] for r in profile.capability_assessments(claims, conflicts, claims.select("owner")).collect()}
    assert len(got) == 16 and {d for _, d in got} == set(package.DIMENSION_FIELDS)
    assert got["o", "personnel_resource_capability"] == "SUPPORTED" and got["o", "amount_experience_capability"] == "CONFLICTED"
    # a conflict without a claim, a claim without evidence and evidence without a claim are no support
    assert {s for k, s in got.items() if k not in {("o", "personnel_resource_capability"), ("o", "amount_experience_capability")}} == {"INSUFFICIENT_DATA"}


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"kind": "q", "n": 1}')
    (tmp_path / "b.json").write_text("{broken")
    got = records.read_certificate_records(spark, [f"file://{tmp_path}"], "kind string, n int")
    assert sorted((r["n"] is None, r["_corrupt"] is None) for r in got.collect()) == [(False, True), (True, False)]
    (tmp_path / "x.png").write_bytes(b"123")
    (tmp_path / "y.png").write_bytes(b"")
    images = {r["path"].rsplit("/", 1)[1]: r["error"] for r in records.scan_images(spark, f"file://{tmp_path}", 100).collect()}
    assert images == {"x.png": None, "y.png": "empty file"}
    assert records.scan_content_hash(spark, f"file://{tmp_path}", 2).filter("error IS NOT NULL").count() == 3


def test_reviews(spark):
    """An entry for each key of an answer; unreadable answers give none."""
    answers = spark.createDataFrame([('{"a": {"note": "seen", "companyId": 3}, "b": {"contentConfirmed": true}}',), ("{}",), (None,)], "t string")
    got = answers.select(F.explode(records.read_reviews(F.col("t"))).alias("r")).select("r.key", "r.value.*").orderBy("key").collect()
    assert [tuple(r) for r in got] == [("a", "seen", None, None, 3), ("b", None, True, None, None)]


def test_limits_and_status(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, ordinal int")
    assert [r["ordinal"] for r in windows.limit_input(df, ["k", "ordinal"], 2).collect()] == [1, 2]
    assert [r["k"] for r in windows.cap_breaches(df, ["k"], 1, "too many").collect()] == ["a"]
    assert windows.union_payloads([df, df.select("k")]).count() == 6
    status = spark.createDataFrame([("SUCCESS",), ("FAILED",)], "status string")
    assert package.run_status(status).first()["status"] == "PARTIAL"
    fields = spark.createDataFrame([("d", "x", "MISSING"), ("d", "y", "EXTRACTED")], "doc_id string, field string, status string")
    assert package.tender_warning_summary(fields).first()["open_fields"] == ["x"]
    awards = spark.createDataFrame([("p", "l", "w", 1, None, 2), ("p", "l", "w", 1, None, 1)], "project_name string, lot string, winner string, amount int, issue string, ordinal int")
    assert windows.distinct_awards(awards).first()["ordinal"] == 1 and windows.equivalent_outcomes(awards, ["project_name"], ["winner", "amount"]).count() == 1
