"""Nested merge, entity families and their allow-lists on golden rows."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from docfacts.operators import families, merge

AS_OF = dt.date(2026, 1, 1)


def test_nested_merge(spark):
    schema = "k string, o int, refs array<string>, name string, contract struct<no: string, amount: decimal(10,2), party: struct<name: string, tags: array<string>>>, items array<struct<a: int, b: string>>, qualityLevel string"
    rows = [
        ("x", 2, ["e2"], "Late", ("C1", Decimal("5.00"), ("P", ["t2", "t1"])), [(1, "u"), (2, "v")], "LOW"),
        ("x", 1, ["e1"], "First", ("", None, ("Q", ["t1"])), [(2, "v")], "HIGH"),
        ("x", 3, ["e3", "e4"], "Late", ("C2", Decimal("6.00"), None), None, None),
        ("y", 1, None, None, None, None, None),
        (None, 1, ["e9"], "Null", None, [], None),
    ]
    merged, conflicts, evidence = merge.merge_nested(spark.createDataFrame(rows, schema).repartition(3), ["k"], "o", "refs", ["name", "contract", "items", "qualityLevel"])
    got = {r["k"]: r.asDict(True) for r in merged.collect()}
    assert got["x"] == {"k": "x", "name": "First", "contract": {"no": "C1", "amount": Decimal("5.00"), "party": {"name": "Q", "tags": ["t1", "t2"]}}, "items": [{"a": 2, "b": "v"}, {"a": 1, "b": "u"}], "qualityLevel": "HIGH"}
    assert got["y"] == {"k": "y", "name": None, "contract": None, "items": [], "qualityLevel": None} and got[None]["name"] == "Null"
    assert merged.schema["contract"].dataType["party"].dataType.simpleString() == "struct<name:string,tags:array<string>>"
    found = sorted((r["field"], r["left_value"], r["right_value"], r["left_n"], r["right_n"]) for r in conflicts.collect())
    assert found == [("contract.amount", "5.00", "6.00", 1, 2), ("contract.no", "C1", "C2", 1, 2), ("contract.party.name", "Q", "P", 1, 1), ("name", "First", "Late", 1, 3)]
    assert {(r["field"], r["value"], r["ref"]) for r in evidence.filter("field = 'name' AND k = 'x'").collect()} == {("name", "First", "e1"), ("name", "Late", "e2"), ("name", "Late", "e3"), ("name", "Late", "e4")}


def test_conflicts_and_evidence_are_linear(spark):
    """Many values of one field: as many conflicts, and evidence rows as there were references."""
    cells = spark.range(3000).select(F.lit("k").alias("k"), F.lit("f").alias("field"), F.col("id").alias("ordinal"), F.col("id").cast("string").alias("value"), F.array(F.concat(F.lit("e"), F.col("id"))).alias("refs"))
    values, conflicts, evidence = merge.merge_with_conflicts(cells, ["k"])
    assert values.first()["value"] == "0" and conflicts.count() == 2999 and evidence.count() == 3000
    assert conflicts.agg(F.max("left_n")).first()[0] == 2999


def test_allow_lists_prune_at_any_depth(spark):
    raw = json.dumps({
        "projectName": "P", "secret": 1, "contract": {"contractNo": "C", "x": {"y": 1}, "amountYuan": 12.5}, "industry": ["a"], "isWinner": "yes", "evidenceRefs": ["e"], "profileAction": "X",
    })
    person = json.dumps({"personName": "N", "certificates": [{"certNo": "1", "bad": 1}, {"certNo": "2", "worse": 2, "bad": 3}], "employmentEvidence": {"asOfDate": "2025年1月2日", "salary": 9}})
    df = spark.createDataFrame([(raw, person), (None, "no json")], "a string, b string")
    (one, gone), (two, dropped) = families.pruned(F.col("a"), "performance"), families.pruned(F.col("b"), "personnel")
    r = df.select(one.alias("one"), gone.alias("gone"), two.alias("two"), dropped.alias("dropped")).collect()
    assert r[0]["gone"] == ["performance.contract.x", "performance.secret"]
    assert r[0]["dropped"] == ["personnel.certificates.bad", "personnel.certificates.worse", "personnel.employmentEvidence.salary"]
    assert r[0]["one"]["contract"]["contractNo"] == "C" and r[0]["one"]["isWinner"] is None and [c["certNo"] for c in r[0]["two"]["certificates"]] == ["1", "2"]
    assert r[1]["gone"] == [] and r[1]["dropped"] == []


def frames(spark):
    read = lambda family, rows: spark.createDataFrame([(d, o, json.dumps(v)) for d, o, v in rows], "doc_id string, ordinal int, raw string").select("doc_id", "ordinal", families.pruned(F.col("raw"), family)[0].alias("v")).select("doc_id", "ordinal", "v.*")
    return {
        "company": read("company", [("d1", 1, {"companyName": "甲有限公司", "registeredCapital": "100万元", "evidenceRefs": ["e1"]}), ("d2", 1, {"companyName": "甲有限公司", "legalPerson": "张三", "registeredCapital": "200万元", "evidenceRefs": ["e2", "gone"]})]),
        "qualification": read("qualification", [("d1", 1, {"certName": "资质", "certNo": "N1", "holderName": "甲有限公司", "expiryDate": "2025-01-01"}), ("d2", 1, {"certName": "资质", "certNo": "N1", "certLevel": "一级", "holderName": "甲有限公司"}), ("d2", 2, {"certName": "别的", "holderName": "乙有限公司", "issuingAuthority": "局", "status": "revoked"})]),
        "performance": read("performance", [
            ("d1", 1, {"projectName": "项目甲", "projectCode": "P1", "performanceStatus": "已验收", "contract": {"contractNo": "C-1", "rawAmountText": "296800元"}, "evidenceRefs": ["e1"]}),
            ("d2", 1, {"projectName": "项目甲", "projectCode": "P1", "contract": {"contractNo": "C-1", "amountYuan": "295800"}, "industry": ["水利"], "evidenceRefs": ["e2"]}),
            ("d3", 1, {"projectName": "项目甲", "contract": {"contractNo": "C-2"}, "customerName": "乙"}), ("d4", 1, {}),
        ]),
        "personnel": read("personnel", [("d1", 1, {"personName": "李四", "certificates": [{"certNo": "K1", "issueDate": "2020年1月1日"}], "projectExperienceRefs": ["nowhere"]}), ("d2", 1, {"personName": "李四", "personRole": "经理", "certificates": [{"certNo": "K1"}, {"certNo": "K2"}]}), ("d3", 1, {"personName": "李四", "roleInBid": "员"})]),
        "solution_claim": read("solution_claim", [("d1", 1, {"name": "S", "category": "x", "claimType": "PROVEN"})]),
    }


def test_domain_merge(spark):
    evidence = spark.createDataFrame([("e1", "C"), ("e2", "A")], "evidence_id string, source_strength string")
    out = families.merge_domains(frames(spark), evidence, F.lit(AS_OF))
    company = out["company"][0].collect()
    assert len(company) == 1 and company[0]["legalPerson"] == "张三" and company[0]["registeredCapital"]["amount_yuan"] == Decimal("1000000.00") and company[0]["evidenceRefs"] == ["e1", "e2"]
    assert company[0]["normalizedCompanyName"] and len(company[0]["conflictRefs"]) == 2  # the amount and its text
    c = {r["field"]: r for r in out["company"][1].collect()}
    assert (c["registeredCapital.amount_yuan"]["left_strength"], c["registeredCapital.amount_yuan"]["right_strength"]) == ("C", "A")
    quals = sorted((r["certName"], r["certLevel"], r["status"], r["subjectMatchStatus"]) for r in out["qualification"][0].collect())
    assert quals == [("别的", None, "REVOKED", "MISMATCH"), ("资质", "一级", "EXPIRED", "MATCH")]
    done = {r["contract"]["contractNo"]: r for r in out["performance"][0].collect()}
    assert set(done) == {"C-1", "C-2"} and done["C-1"]["contract"]["amountYuan"] == Decimal("296800.000000") and done["C-1"]["industry"] == ["水利"] and done["C-1"]["performanceStatus"] == "ACCEPTED"
    fields = {r["field"] for r in out["performance"][1].collect()}
    assert "contract.amountYuan" in fields and "projectName" not in fields
    people = sorted((r["personRole"] or "", [x["certNo"] for x in r["certificates"]], r["projectExperienceRefs"], r["unresolvedReferenceCandidates"]) for r in out["personnel"][0].collect())
    assert [p[0] for p in people] == ["", "经理"] and people[1][2:] == ([], ["nowhere"]) and len(people[1][1]) == 3
    claim = out["solution_claim"][0].first()
    assert (claim["category"], claim["claimType"], claim["profileAction"], claim["verificationStatus"]) == ("OTHER", "DECLARED", "CLAIM_ONLY", "UNVERIFIED")


def test_ranges_and_places_of_requirements(spark):
    from docfacts.operators import layout, tender

    ranges = spark.createDataFrame([("d", 0, 10, "A"), ("d", 5, 12, "B"), ("d", 12, 15, "A"), ("d", 14, 14, "C"), ("e", 3, 4, "A"), ("e", 3, 4, "B")], "doc_id string, start int, end int, role string")
    got = sorted((r["doc_id"], r["start"], r["end"], r["roles"]) for r in layout.merge_ranges(ranges, ["doc_id"]).collect())
    assert got == [("d", 0, 12, ["A", "B"]), ("d", 12, 15, ["A"]), ("e", 3, 4, ["A", "B"])]
    ann = "一、本次招标要求投标人具备：1.1提供安全生产许可证；1.2提供基本存款账户信息；投标人资格要求：提供安全生产许可证；招标文件的获取"
    front = "资质条件：项目投融资能力不低于三亿元；踏勘现场"
    texts = spark.createDataFrame([("d", "announcement", ann), ("d", "front", front), ("e", "front", "（1）资质要求：提供法定代表人授权委托书☑不组织"), ("f", "front", "无")], "doc_id string, section string, view_text string")
    rows = tender.requirements_of(texts, spark.createDataFrame([], "doc_id string, start int, end int")).collect()
    places = {("d", "announcement"): ann, ("d", "front"): front, ("e", "front"): "（1）资质要求：提供法定代表人授权委托书☑不组织"}
    assert all(places[r["doc_id"], r["section"]][r["start"]:r["end"]] == r["requirement"] for r in rows)
    assert {("d", "FINANCIAL"), ("d", "LICENCE"), ("d", "BANK_ACCOUNT"), ("e", "AUTHORIZATION")} <= {(r["doc_id"], r["type"]) for r in rows} and not any(r["doc_id"] == "f" for r in rows)
    assert len({(r["doc_id"], r["section"], r["start"]) for r in rows}) == len(rows)


def test_cut_at_solid_characters(spark):
    from docfacts.operators import layout

    rows = [("d", 1, 5, "a b\n c"), ("d", 2, 0, "  d e f"), ("e", 1, 0, "x")]
    got = layout.truncate_with_evidence(spark.createDataFrame(rows, "doc_id string, piece int, start int, text string"), ["doc_id"], "piece", F.lit(4))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["end"], r["text"]) for r in got.collect()) == [("d", 1, 5, 11, "a b\n c"), ("d", 2, 0, 3, "  d"), ("e", 1, 0, 1, "x")]


def test_values_end_at_major_sections(spark):
    from docfacts.operators import tender

    rows = [("d", "项目名称", "甲工程。二、招标范围"), ("d", "项目规模", "一座。"), ("d", "质量要求", "见附件"), ("d", "资金来源", "自筹；")]
    docs = spark.createDataFrame([("d",)], "doc_id string")
    got = {r["field"]: (r["value"], r["status"]) for r in tender.finalize_fields(spark.createDataFrame(rows, "doc_id string, field string, value string"), docs, [r[1] for r in rows]).collect()}
    assert got == {"项目名称": ("甲工程", "EXTRACTED"), "项目规模": ("一座。", "EXTRACTED"), "质量要求": (None, "MISSING"), "资金来源": ("自筹", "EXTRACTED")}


def test_long_pages_are_split(spark):
    from docfacts.operators import checks, windows

    pages = spark.createDataFrame([("d", 1, " short \n"), ("d", 2, "x" * 2500), ("d", 3, None)], "doc string, page int, text string")
    got = {(r["page"], r["part"]): r["block"] for r in windows.page_blocks(pages, ["doc"], "page", "text", 1200).collect()}
    assert got[1, 1] == "<!-- PDF page 1 -->\nshort" and got[3, 1] == "<!-- PDF page 3 -->\n" and len(got) == 5
    parts = [got[2, k].split("]\n")[1] for k in (1, 2, 3)]
    assert "".join(parts) == "x" * 2500 and [len(p) for p in parts] == [1101, 1101, 298] and "[本页分段 2/3]" in got[2, 2]
    ranges = spark.createDataFrame([("1-3, 7",), ("3-1",), ("a",), ("0",), ("9",), ("",), (None,), (" , ",)], "r string").select(checks.page_range_error(F.col("r"), F.lit(8)).alias("e"))
    limits = "pages have to lie in 1 to 8"
    assert [r["e"] for r in ranges.collect()] == [None, "start after end: 3-1", "no page range: a", limits, limits, None, None, limits]
