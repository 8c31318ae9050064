"""Golden cases of operators: conflicts, resolution, awards, planning, layout, checks."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from docfacts.operators import certificates, checks, classify, joins, layout, merge, package, profile, tender, windows
from docfacts.sources import records, sinks


def test_merge_keeps_conflicts(spark):
    cells = spark.createDataFrame([("p", "amount", 1, "296800", ["e1"]), ("p", "amount", 2, "295800", ["e2"]), ("p", "amount", 3, "296800", ["e3"])], "k string, field string, ordinal int, value string, refs array<string>")
    values, conflicts, evidence = merge.merge_with_conflicts(cells, ["k"])
    assert [r["value"] for r in values.collect()] == ["296800"]
    c = conflicts.collect()
    assert len(c) == 1 and (c[0]["left_value"], c[0]["right_value"], c[0]["left_n"], c[0]["right_n"]) == ("296800", "295800", 2, 1)
    assert sorted((r["value"], r["ref"], r["ordinal"]) for r in evidence.collect()) == [("295800", "e2", 2), ("296800", "e1", 1), ("296800", "e3", 3)]


def test_components_against_union_find(spark):
    import random

    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    got = {r["node"]: r["root"] for r in merge.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n for e in edges if e[0] != e[1] for n in e}
    assert set(got) == want
    for a, b in itertools.combinations(sorted(want)[:150], 2):
        assert (got[a] == got[b]) == (find(a) == find(b))


def test_resolution_voids_weak_tokens(spark):
    rows = [("1", "no", "no:A"), ("1", "name", "name:x"), ("2", "no", "no:B"), ("2", "name", "name:x"), ("3", "name", "name:x"), ("4", "name", "name:y"), ("5", "name", "name:y")]
    got = {r["row_id"]: r["entity"] for r in merge.resolve_entities(spark.createDataFrame(rows, "row_id string, label string, token string"), ["no"]).collect()}
    assert len({got["1"], got["2"], got["3"]}) == 3 and got["4"] == got["5"]


def test_awards(spark):
    projects = spark.createDataFrame([("城市道路改造工程项目",), ("城市道路改造工程项目 二标段",), ("未知",), ("相同项目一号工程",)], "project string")
    awards = spark.createDataFrame([
        ("城市道路改造工程项目", "一标段", "甲公司", 1, None, 1), ("城市道路改造工程项目", "二标段", "乙公司", 2, None, 2), ("相同项目一号工程", None, None, None, "无中标人", 3),
    ], "project_name string, lot string, winner string, amount int, issue string, ordinal int").withColumn("amount", F.col("amount").cast("decimal(20,4)"))
    got = {r["project"]: (r["status"], r["winner"]) for r in joins.resolve_award(projects, awards).collect()}
    assert got["城市道路改造工程项目"] == ("REVIEW_REQUIRED", None)
    assert got["城市道路改造工程项目 二标段"] == ("MATCHED", "乙公司")
    assert got["未知"] == ("REVIEW_REQUIRED", None) and got["相同项目一号工程"] == ("REVIEW_REQUIRED", None)


def candidate(spark, entries, **more):
    row = {"source_hash": "h", "kind": "qualification", "document_type": "qualification_certificate", "holder_name": "甲公司", "credit_code": None, "person_name": None, "person_role": None, "document_title": "证书", "warnings": [], "confidence": 0.95, "review_required": False, "image_hash": "i"} | more
    schema = "source_hash string, kind string, document_type string, holder_name string, credit_code string, person_name string, person_role string, document_title string, warnings array<string>, confidence double, review_required boolean, image_hash string, entries array<struct<cert_name:string,cert_no:string,cert_level:string,issue_date:string,expiry_date:string,valid_from:string,issuing_authority:string,scope:string>>"
    return spark.createDataFrame([(*[row[f.split()[0]] for f in schema.split(", ")[:-1]], entries)], schema)


def test_import(spark):
    as_of = F.lit(dt.date(2026, 1, 1))
    company = spark.createDataFrame([(1, "甲公司", "C")], "company_id int, company_name string, company_credit string")
    reviews = spark.createDataFrame([], "entry_id string, note string, content_confirmed boolean, affiliation_confirmed boolean")
    docs = candidate(spark, [
        ("建筑工程施工总承包一级", "N1", None, "2020-01-01", "2030-01-01", None, "省厅", None), ("建筑工程施工总承包一级", "N1", None, "2020-01-01", "2030-01-01", None, "省厅", None),
        ("专业承包资质", "N2", "二级", "2010-01-01", "2020-01-01", None, "省厅", None), ("专业承包资质", "N3", "二级", "2024-02-30", None, None, None, None), ("安全生产许可证", "N4", None, None, "2031-01-01", None, "省厅", None),
    ])
    cand = merge.written(certificates.normalize_candidates(docs, company, reviews, as_of), "candidates")
    existing = spark.createDataFrame([("qualification", "business", 7, "N4", "安全生产许可证", None, None, None, None, None, "省厅")], "kind string, source string, target_id int, cert_no string, cert_name string, person_name string, person_role string, cert_level string, issue_date string, expiry_date string, issuing_authority string")
    definitions = spark.createDataFrame([("qualification.items", "ARRAY", True)], "field_code string, value_type string, is_enabled boolean")
    none = spark.createDataFrame([], "entry_id string")
    blocks = spark.createDataFrame([], "field_code string")
    plan = merge.written(certificates.plan_candidates(cand, existing, none, definitions, blocks), "plan")
    rows = {r["index"]: r for r in plan.collect()}
    assert {i: r["action"] for i, r in rows.items()} == {0: "INSERT", 1: "DUPLICATE", 2: "HISTORY", 3: "INVALID", 4: "PATCH_EMPTY"}
    assert [p["field"] for p in rows[4]["patch"]] == ["expiry_date"] and rows[0]["cert_level"] == "一级"
    again = certificates.plan_candidates(cand, existing, plan.select("entry_id"), definitions, blocks)
    assert {r["action"] for r in again.collect()} == {"DUPLICATE"}
    hashes = [certificates.plan_hash(p, ["entry_id", "action"]).first()[0] for p in (plan, plan.repartition(3))]
    assert hashes[0] == hashes[1]
    business, values, receipt = certificates.apply_batch(plan, plan.filter("action = 'INSERT'").select("entry_id"), "b1", spark.createDataFrame([("b0",)], "batch_uid string"))
    assert (business.count(), values.count(), receipt.count()) == (1, 1, 1)
    assert certificates.apply_batch(plan, plan.select("entry_id"), "b1", receipt)[2].count() == 0
    assert certificates.approve_subset(plan, plan.filter("action = 'INVALID'").select("entry_id")).count() == 1


@pytest.mark.parametrize("text, want", [("提供安全生产许可证", "LICENCE"), ("提供基本存款账户信息", "BANK_ACCOUNT"), ("提供法定代表人授权委托书", "AUTHORIZATION"), ("项目投融资能力不低于三亿元", "FINANCIAL")])
def test_requirement_types(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(classify.classify_requirement(F.col("t"))["type"]).first()[0] == want
    assert len(classify.REQUIREMENT_TYPES) == 13


def test_page_types(spark):
    df = classify.classify_pages(spark.createDataFrame([("中标通知书",), ("合同协议书 甲方 乙方",), ("x",), (None,)], "text string"))
    assert [(r["document_type"], r["classification_confidence"]) for r in df.collect()] == [("AWARD_NOTICE", "MEDIUM"), ("CONTRACT", "HIGH"), ("OTHER", "LOW"), ("OTHER", "LOW")]
    assert classify.routes(spark).count() == sum(map(len, classify.DOMAINS.values()))


def nodes(spark):
    rows = [
        ("d", 1, 1, "a", "招标公告 招标条件 项目概况", 50.0, 700.0, 100.0, 10.0), ("d", 1, 2, "b", "1.1 项目名称：某 工程", 50.0, 650.0, 100.0, 10.0), ("d", 1, 3, "c", "续行", 50.0, 630.0, 50.0, 10.0),
        ("d", 1, 4, "d", "1.2 建设地点：北京", 50.0, 600.0, 100.0, 10.0), ("d", 1, 5, "p", "12", 300.0, 30.0, 10.0, 10.0), ("d", 2, 6, "e", "投标人须知前附表", 50.0, 700.0, 90.0, 10.0),
        ("d", 2, 7, "f", "1.1.4", 40.0, 600.0, 20.0, 10.0), ("d", 2, 8, "g", "资金来源", 100.0, 600.0, 60.0, 10.0), ("d", 2, 9, "h", "财政", 200.0, 610.0, 40.0, 10.0), ("d", 2, 10, "i", "资金", 200.0, 595.0, 40.0, 10.0),
        ("d", 2, 11, "j", "1.1.5", 40.0, 520.0, 20.0, 10.0), ("d", 2, 12, "k", "别的", 200.0, 520.0, 40.0, 10.0),
    ]
    return spark.createDataFrame(rows, "doc_id string, page int, ordinal long, item_id string, text string, x double, y double, width double, height double")


def test_layout(spark):
    n = layout.content_nodes(nodes(spark))
    assert n.count() == 11
    sections = {(r["section"], r["page"]) for r in layout.locate_sections(layout.page_texts(n)).collect()}
    assert sections == {("announcement", 1), ("front", 2)}
    view = layout.view_offsets(n.filter("page = 1"), ["doc_id"])
    texts = layout.section_text(view, ["doc_id"])
    clauses = layout.announcement_clauses(view, texts)
    got = {r["number"]: r["text"] for r in clauses.collect()}
    assert got == {"1.1": "项目名称：某工程续行", "1.2": "建设地点：北京"}
    fields = layout.clause_fields(clauses, {"项目名称": ["项目名称"], "项目地点": ["项目地点", "建设地点"]})
    assert {(r["field"], r["value"]) for r in fields.collect()} == {("项目名称", "某工程续行"), ("项目地点", "北京")}
    spans = fields.select("doc_id", F.col("field").alias("span_id"), "start", "end")
    evidence = layout.map_span_to_evidence(spans, view, ["doc_id"])
    assert [r["text"] for r in evidence.filter("span_id = '项目名称'").orderBy("item_id").collect()] == ["某 工程", "续行"]
    checked = joins.verify_spans(evidence, n)
    assert checked.filter("NOT valid").count() == 0
    assert layout.row_values(n, ["资金来源"]).first()["value"] == "资金"
    assert layout.row_band_values(n, ["资金来源"]).first()["value"] == "财政资金"


def test_fields(spark):
    c = spark.createDataFrame([("d", "招标编号", "A-1"), ("d", "招标编号", "A-1-2"), ("d", "质量要求", "合格"), ("d", "质量要求", "优良"), ("d", "资金来源", "见前附表")], "doc_id string, field string, value string")
    got = {r["field"]: (r["status"], r["value"]) for r in tender.finalize_fields(c, c, ["招标编号", "质量要求", "资金来源", "项目名称"], ["招标编号"]).collect()}
    assert got == {"招标编号": ("EXTRACTED", "A-1-2"), "质量要求": ("CONFLICT", None), "资金来源": ("MISSING", None), "项目名称": ("MISSING", None)}
    text = spark.createDataFrame([("d", "announcement", "招标编号：ZB-001，预算金额：300万元。招标代理机构：乙有限公司地址：北京联系人：张三")], "doc_id string, section string, view_text string")
    rules = {(r["field"], r["value"]) for r in tender.extract_rules(text).unionByName(tender.contact_blocks(text)).collect()}
    assert {("招标编号", "ZB-001"), ("预算金额", "300万元"), ("组织形式", "委托招标"), ("招标代理机构名称", "乙有限公司"), ("招标代理机构地址", "北京")} <= rules


@pytest.mark.parametrize("days, want", [(180, True), (181, False)])
def test_current_employment(spark, days, want):
    as_of = dt.date(2026, 1, 1)
    people = spark.createDataFrame([("p", True, ["e"])], "person_key string, claimed_current boolean, refs array<string>")
    evidence = spark.createDataFrame([("e", "SOCIAL_INSURANCE", as_of - dt.timedelta(days))], "evidence_id string, document_type string, as_of_date date")
    row = profile.current_employment(people, evidence, F.lit(as_of)).first()
    assert row["is_current"] is want and (row["warning"] is None) is want


def test_chunks_do_not_depend_on_partitions(spark):
    rows = [("d", i, (i * 37) % 50 + 1) for i in range(60)]
    one = sorted(windows.chunk_rows(spark.createDataFrame(rows, "d string, i int, n int").repartition(n), ["d"], ["i"], "n", 4, 90).collect() for n in (1, 8))
    assert one[0] == one[1]


def test_sources(spark):
    md = spark.createDataFrame([("a", "<!-- PDF page 1 -->x<!-- PDF page 3 -->y"), ("b", "<!-- PDF page 2 -->x<!-- PDF page 2 -->y"), ("c", "z")], "doc_id string, text string")
    pages, errors = records.explode_page_markers(md)
    assert {(r["doc_id"], r["physical_page"], r["text"]) for r in pages.collect()} == {("a", 1, "x"), ("a", 3, "y")} and errors.count() == 2
    cells = [("s", r, c, v) for r, row in enumerate([["title"], ["项目名称", "标段名称", "中标人", "中标金额"], ["p1", "l1", "甲", "12"], ["p1", "l2", "无数据", ""], ["group"]], 1) for c, v in enumerate(row, 1)]
    awards = records.read_award_rows(spark.createDataFrame(cells, "sheet string, row_no int, col_no int, value string")).orderBy("row_no").collect()
    assert [(r["project_name"], r["lot"], r["winner"]) for r in awards] == [("p1", "l1", "甲"), ("p1", "l2", None)]
    parsed = spark.createDataFrame([('say ```json\n{"a": 1}\n``` ok',), ("none",)], "t string").select(records.parse_json_object_text(F.col("t"), "a int").alias("o")).collect()
    assert parsed[0]["o"]["a"] == 1 and parsed[1]["o"] is None


def test_gap_reasons_of_the_contract(spark):
    contract, _ = package.contract_table(spark)
    have = spark.createDataFrame([(1, "enterprise.name"), (1, "quality.api_coverage")], "company int, field_code string")
    gaps = {r["field_code"]: r["reason"] for r in joins.profile_gaps(contract, have, spark.createDataFrame([(1,)], "company int")).collect()}
    assert len(gaps) == 28 and "enterprise.name" not in gaps
    assert gaps["preference.amount_range"] == "USER_NOT_PROVIDED" and gaps["evaluation.scores"] == "DEPENDENCY_MISSING" and gaps["tag.risks"] == "SOURCE_EMPTY"


def test_snapshot_and_receipts(spark, tmp_path):
    root = f"file://{tmp_path}/snap"
    for v in (1, 2):
        sinks.publish_snapshot({"t": spark.range(v)}, root, v)
    assert sinks.read_snapshot(spark, root, "t").count() == 2
    receipt = spark.createDataFrame([("b1", "e")], "batch_uid string, entry_id string")
    for _ in range(2):
        sinks.append_batch_receipt(receipt, f"file://{tmp_path}/receipts")
    assert spark.read.parquet(f"file://{tmp_path}/receipts").count() == 1


def test_checks(spark):
    df = spark.createDataFrame([(1, "A", "x"), (2, "Z", None)], "k int, e string, r string")
    got = {(r["k"], r["rule"]) for r in checks.validate_schema(df, ["k"], ["r"], {"e": ["A"]}, {"r": "^y"}, {}).collect()}
    assert got == {(1, "r has a wrong form"), (2, "r is missing"), (2, "e is not allowed")}
    assert spark.createDataFrame([("1-3,7,9-8,x",)], "t string").select(checks.expand_page_range(F.col("t"))).first()[0] == [1, 2, 3, 7]
