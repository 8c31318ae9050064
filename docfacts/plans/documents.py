"""Queries of page layout, tender fields, package checks and sinks over documents made from the test tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from docfacts.functions import nested as H
from docfacts.operators import certificates, checks, entities, joins, layout, package, tender
from docfacts.plans.columns import case, joined, pick
from docfacts.plans.queries import query, read
from docfacts.plans.tables import no_strings
from docfacts.sources import records, sinks


@query("""
SELECT conv_id, turn, md5(regexp_replace(text, '\\s', '', 'g')) AS page_text FROM conversations WHERE turn % 4 = 0""")
def content_pages(spark, sf_dir):
    """Text runs without placeholders and footers, as one text a page."""
    c = read(spark, sf_dir, "conversations")
    k = F.col("turn") % 4
    text = F.when(k == 0, F.col("text")).when(k == 1, "[Image: x]").when(k == 2, " 12 ").otherwise("https://a.b/c")
    nodes = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.lit(1).alias("ordinal"), text.alias("text"), F.when(k == 0, 700.0).otherwise(30.0).alias("y"))
    return layout.page_texts(layout.content_nodes(nodes)).select(F.col("doc_id").alias("conv_id"), F.col("page").alias("turn"), F.md5("text").alias("page_text"))


@query("""
SELECT c_custkey AS doc_id, s.section, s.page + (c_custkey % 2)::INT AS page FROM customer, (VALUES ('announcement', 1), ('front', 2)) s(section, page)""")
def document_sections(spark, sf_dir):
    """Odd documents have a table of contents before the announcement."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"))
    later = (F.col("doc_id") % 2).cast("int")
    page = lambda df, n, text: df.select("doc_id", n.alias("page"), F.lit(text).alias("text"))
    pages = page(c.filter("doc_id % 2 = 1"), F.lit(1), "目录").union(page(c, 1 + later, "招标公告招标条件项目概况")).union(page(c, 2 + later, "投标人须知前附表"))
    return layout.locate_sections(pages).select("doc_id", "section", "page")


@query("""
WITH n AS (SELECT o_custkey AS doc_id, o_orderkey, o_orderpriority AS name FROM orders)
SELECT doc_id, name AS field, string_agg(v, '' ORDER BY v) AS value FROM (SELECT doc_id, name, 'v' || o_orderkey AS v FROM n WHERE (doc_id, name, o_orderkey) IN (SELECT doc_id, name, min(o_orderkey) FROM n GROUP BY 1, 2)) GROUP BY 1, 2""")
def clause_values(spark, sf_dir):
    """`label：value` clauses, the label by its name."""
    o = read(spark, sf_dir, "orders")
    first = o.groupBy(F.col("o_custkey").alias("doc_id"), "o_orderpriority").agg(F.min("o_orderkey").alias("k"))
    text = F.concat(F.col("o_orderpriority"), F.lit("：v"), F.col("k").cast("string"))
    clauses = first.select("doc_id", F.col("k").cast("string").alias("number"), text.alias("text"), F.lit(0).alias("start"), F.length(text).alias("end"))
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return layout.clause_fields(clauses, {n: [n] for n in names}).select("doc_id", "field", "value")


@query("""
SELECT s_suppkey AS doc_id, f.field, CASE f.k WHEN 0 THEN 'T' || s_suppkey WHEN 1 THEN 'N' || s_suppkey || '有限公司' WHEN 2 THEN '北京' ELSE '张三' END AS value
FROM supplier, (VALUES ('招标编号', 0), ('招标代理机构名称', 1), ('招标代理机构地址', 2), ('招标代理机构联系人', 3)) f(field, k)""")
def tender_contacts(spark, sf_dir):
    """Numbers by rule, contacts by block."""
    k = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit("招标编号：T"), k, F.lit("，招标代理机构：N"), k, F.lit("有限公司地址：北京联系人：张三"))
    texts = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.lit("announcement").alias("section"), text.alias("view_text"))
    names = ["招标编号", "招标代理机构名称", "招标代理机构地址", "招标代理机构联系人"]
    none = texts.select("doc_id", F.lit("x").alias("field"), F.lit("y").alias("value"))
    got = tender.extract_tender_fields(texts, none, none, names)
    return got.filter("status = 'EXTRACTED'").select("doc_id", "field", "value")


@query("""
SELECT c_custkey AS doc_id, d.domain, CASE WHEN (c_custkey + d.k) % 2 = 0 THEN 1 ELSE 0 END AS n FROM customer, (VALUES ('a', 0), ('b', 1)) d(domain, k)""")
def domain_defaults(spark, sf_dir):
    """C19."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"))
    item = F.array(F.col("doc_id").cast("string")).alias("items")
    payloads = c.filter("doc_id % 2 = 0").select("doc_id", F.lit("a").alias("domain"), item).union(c.filter("doc_id % 2 = 1").select("doc_id", F.lit("b"), item))
    return tender.domain_output_defaults(c, payloads, ["a", "b"]).select("doc_id", "domain", F.size("items").alias("n"))


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'accepted' WHEN 1 THEN 'page outside the chunk' WHEN 2 THEN 'no field path' ELSE 'text is not on the page' END AS outcome, CASE WHEN c_custkey % 4 = 0 THEN CASE WHEN c_custkey % 8 = 0 THEN 'A' ELSE 'D' END END AS strength FROM customer""")
def evidence_on_pages(spark, sf_dir):
    """Evidence has to stand on its page."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 4
    pages = c.select(F.col("c_custkey").alias("doc_id"), F.lit(1).alias("physical_page"), F.concat(F.lit("Name: "), "c_name", F.lit(" tel 13900000000")).alias("text"), F.when(F.col("c_custkey") % 8 == 0, "CONTRACT").otherwise("COVER").alias("document_type"))
    evidence = c.select(
        F.col("c_custkey").alias("doc_id"), F.lit("d").alias("domain"), F.col("c_custkey").cast("string").alias("local_id"), F.when(k == 1, 2).otherwise(1).alias("physical_page"), F.when(k == 2, "").otherwise("a.b").alias("field_path"),
        F.when(k == 3, "elsewhere").otherwise(F.concat("c_name", F.lit("　tel 13900000000"))).alias("source_text"),
    )
    good, bad = entities.domain_evidence(evidence, pages, {"CONTRACT": "A"})
    none = F.lit(None).cast("string")
    return good.select(F.col("doc_id").alias("c_custkey"), F.lit("accepted").alias("outcome"), F.col("source_strength").alias("strength")).union(bad.select("doc_id", "reason", none))


@query("""
SELECT c_custkey AS k, rule FROM customer, (VALUES ('name is missing', 3), ('kind is not allowed', 5), ('code has a wrong form', 7), ('items has too few items', 11)) r(rule, m) WHERE c_custkey % m = 0""")
def schema_rules(spark, sf_dir):
    """B13."""
    k = F.col("c_custkey")
    df = read(spark, sf_dir, "customer").select(
        k.alias("k"), F.when(k % 3 != 0, F.col("c_name")).alias("name"), F.when(k % 5 == 0, "Z").otherwise("A").alias("kind"), F.when(k % 7 == 0, "bad").otherwise("c1").alias("code"), F.when(k % 11 == 0, no_strings()).otherwise(F.array(F.lit("x"))).alias("items"),
    )
    return checks.validate_schema(df, ["k"], ["name"], {"kind": ["A"]}, {"code": "^c[0-9]"}, {"items": 1}).select("k", "rule")


_RULES = [
    ("page number is not positive", 2), ("evidence without text", 3), ("sensitive text", 5), ("negative amount", 7), ("not an ISO date", 11), ("illegal profile action", 13), ("machine facts have to be UNVERIFIED", 17),
    ("dangling evidence", 19), ("dangling conflict", 23), ("several candidates of one field", 29), ("not all capability dimensions", 31),
]


@query(f"""
SELECT c_custkey AS doc_id, rule FROM customer, (VALUES {', '.join(map(str, _RULES))}) r(rule, m) WHERE c_custkey % m = 1""")
def package_rules(spark, sf_dir):
    """Each document breaks the rules that its number says."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"))
    off = {rule: F.col("doc_id") % m == 1 for rule, m in _RULES}
    page = F.when(off["page number is not positive"], 0).otherwise(1).alias("physical_page")
    text = F.when(off["evidence without text"] & off["sensitive text"], "").when(off["evidence without text"], " ").when(off["sensitive text"], "tel 13900000000").otherwise("t")
    both = off["evidence without text"] & off["sensitive text"]
    evidence = c.select("doc_id", F.lit("e").alias("evidence_id"), page, text.alias("source_text")).union(c.filter(both).select("doc_id", F.lit("f"), page, F.lit("tel 13900000000")))
    rows = c.select(
        "doc_id", F.lit("k").alias("entity_key"), F.when(off["dangling evidence"], F.array(F.lit("x"))).otherwise(F.array(F.lit("e"))).alias("refs"), F.when(off["dangling conflict"], F.array(F.lit("x"))).otherwise(no_strings()).alias("conflict_refs"),
        F.when(off["negative amount"], -1).otherwise(1).alias("amount"), F.when(off["not an ISO date"], "1999-02-30").otherwise("1999-02-28").alias("day"),
        F.when(off["illegal profile action"], "Z").otherwise("A").alias("profile_action"), F.when(off["machine facts have to be UNVERIFIED"], "VERIFIED").otherwise("UNVERIFIED").alias("verification_status"),
    )
    conflicts = c.select("doc_id", F.lit("c").alias("conflict_id"))
    candidate = c.select("doc_id", F.lit("f").alias("field_code"), F.lit("v").alias("value"))
    candidates = candidate.union(candidate.filter(off["several candidates of one field"]))
    assessments = c.select("doc_id", F.explode(F.sequence(F.lit(1), F.when(off["not all capability dimensions"], 7).otherwise(8))).alias("dimension"))
    return checks.validate_package(evidence, c.select("doc_id", page), rows, conflicts, candidates, assessments, ["A"]).select("doc_id", "rule")


@query("""
WITH k AS (SELECT c_custkey AS doc_id, c_custkey % 6 AS k FROM customer)
SELECT doc_id, CASE WHEN k IN (0, 1, 2) THEN 'IDENTITY_INCOMPLETE' WHEN k IN (3, 4) THEN 'NEEDS_REVIEW' ELSE 'READY_FOR_DUPLICATE_CHECK' END AS status,
  CASE k WHEN 0 THEN 'MISSING_COMPANY_NAME' WHEN 1 THEN 'CREDIT_CODE_WITHOUT_EVIDENCE' WHEN 2 THEN 'UNRESOLVED_COMPANY_IDENTITY_CONFLICT' ELSE '' END AS issues FROM k""")
def readiness(spark, sf_dir):
    """A25."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 6
    none = F.lit(None).cast("string")
    company = c.select(F.col("c_custkey").alias("doc_id"), F.when(k != 0, F.col("c_name")).alias("company_name"), F.lit("C1").alias("credit_code"), F.when(k == 0, none).otherwise(F.col("c_name")).alias("subject_company_name"))
    each = lambda path, strength, where: c.filter(where).select(F.col("c_custkey").alias("doc_id"), F.lit(path).alias("field_path"), strength.alias("source_strength"))
    evidence = each("company.companyName", F.when(k == 3, "B").otherwise("A"), k >= 0).union(each("company.creditCode", F.lit("A"), k != 1))
    conflicts = c.filter(k == 2).select(F.col("c_custkey").alias("doc_id"), F.lit("COMPANY").alias("entity_type"), F.lit("creditCode").alias("field_path"), F.lit(True).alias("review_required"))
    got = package.creation_readiness(company, evidence, conflicts, c.filter(k == 4).select(F.col("c_custkey").alias("doc_id")))
    return got.select("doc_id", "status", joined(F.col("blocking_issues")).alias("issues"))


@query("""
SELECT c_custkey, NULL AS phone_number, 'call [PHONE_REDACTED]' AS note, '13900000000' AS fact_key, 'n' AS inner_note, NULL AS person_name FROM customer""")
def clean_output(spark, sf_dir):
    """forbidden keys and person names go at any depth, strings are redacted except identifiers."""
    phone = F.lit("13900000000")
    df = read(spark, sf_dir, "customer").select("c_custkey", phone.alias("phone_number"), F.concat(F.lit("call "), phone).alias("note"), phone.alias("fact_key"), F.array(F.struct(F.lit("n").alias("note"), F.col("c_name").alias("person_name"))).alias("people"))
    got = H.drop_person_names(H.sanitize_output(df))
    return got.select("c_custkey", "phone_number", "note", "fact_key", F.col("people")[0]["note"].alias("inner_note"), F.col("people")[0]["person_name"].alias("person_name"))


@query("""
SELECT o_custkey::VARCHAR AS field_code, string_agg(e, '|' ORDER BY e) AS entries FROM (SELECT DISTINCT o_custkey, lpad(o_orderkey::VARCHAR, 9, '0') AS e FROM orders) GROUP BY 1""")
def stored_profile_values(spark, sf_dir):
    """K5: values that are stored stay, new ones are added once."""
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("field_code"), F.lit("s").alias("source_ref"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("entry_id"), F.col("o_orderstatus").alias("value"), "o_orderkey")
    stored = o.filter("o_orderkey % 2 = 0").groupBy("field_code", "source_ref").agg(F.array_sort(F.collect_list(F.struct("entry_id", "value"))).alias("values"))
    values, _ = sinks.upsert_profile_values(stored, o.drop("o_orderkey"))
    return values.select("field_code", joined(F.transform("values", lambda v: v["entry_id"])).alias("entries"))


@query("""
SELECT o_custkey AS project, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) > 1""")
def published_twice(spark, sf_dir):
    """Several published profiles of one company are an error."""
    o = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    profiles = o.select(F.col("o_custkey").alias("project"), F.lit("c").alias("company_key"), F.col("o_orderkey").cast("string").alias("path"), F.lit("d").alias("decision"), F.col("o_orderdate").alias("updated_at"))
    _, errors = sinks.profile_output_index(profiles)
    counts = certificates.count_by(profiles, ["project"])
    return counts.join(errors.select("project"), "project", "left_semi")


@query(f"""
SELECT c_nationkey AS sheet, c_custkey AS row_no, c_name AS project_name, c_mktsegment AS lot, CASE WHEN c_custkey % 3 <> 0 THEN {case('c_custkey', ['甲', '乙'])} END AS winner, '12' AS amount_text FROM customer""")
def award_rows(spark, sf_dir):
    """Sheets by nation; the header stands in row -1 after a title, group titles and "no data" are understood."""
    c = read(spark, sf_dir, "customer")
    heads = c.select(F.col("c_nationkey").alias("sheet")).distinct()
    cell = lambda df, row, col, value: df.select("sheet", row.alias("row_no"), F.lit(col).alias("col_no"), value.alias("value"))
    names = records.AWARD_HEADERS
    parts = [cell(heads, F.lit(-2).cast("long"), 1, F.lit("title"))] + [cell(heads, F.lit(-1).cast("long"), n, F.lit(f" {h} ")) for n, h in enumerate(names, 1)]
    body = c.withColumnRenamed("c_nationkey", "sheet")
    winner = F.when(F.col("c_custkey") % 3 == 0, "无数据").otherwise(pick("c_custkey", ["甲", "乙"]))
    row = F.col("c_custkey").cast("long")
    parts += [cell(body, row, n, v) for n, v in enumerate([F.col("c_name"), F.col("c_mktsegment"), winner, F.lit("12")], 1)]
    parts.append(cell(heads, F.lit(10_000_000).cast("long"), 1, F.lit("group title")))
    cells = parts[0]
    for p in parts[1:]:
        cells = cells.union(p)
    return records.read_award_rows(cells).select("sheet", "row_no", "project_name", "lot", "winner", "amount_text")


@query("""
SELECT o_orderkey, o_orderkey % 3 = 0 AS imported FROM orders""")
def imported_before(spark, sf_dir):
    """J10."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("entry_id"))
    history = o.filter("o_orderkey % 3 = 0").select("entry_id")
    return certificates.previously_imported(o, history.union(history)).select("o_orderkey", "imported")


@query("SELECT o_orderkey, 'b' || (o_orderkey % 3) AS batch_uid FROM orders WHERE o_orderkey % 3 = 1")
def batch_rows_of_one(spark, sf_dir):
    """B8."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("b"), (F.col("o_orderkey") % 3).cast("string")).alias("batch_uid"))
    return certificates.batch_report(o, "b1")


@query("""
SELECT l_orderkey AS doc_id, 'value without evidence' AS rule FROM lineitem GROUP BY 1 HAVING bool_or(l_linenumber % 3 = 0) UNION ALL
SELECT l_orderkey, 'wrong number of fields' FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) <> 3""")
def tender_guard(spark, sf_dir):
    """B15."""
    li = read(spark, sf_dir, "lineitem")
    fields = li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("field"), F.lit("v").alias("value"), F.when(F.col("l_linenumber") % 3 == 0, no_strings()).otherwise(F.array(F.lit("e"))).alias("evidence"))
    return tender.tender_result_guard(fields, 3, F.col("evidence"))


@query("""
SELECT s_suppkey AS doc_id, s_nationkey || '' AS contract FROM supplier""")
def package_parts(spark, sf_dir):
    """Parts nested under their document."""
    s = read(spark, sf_dir, "supplier")
    docs = s.select(F.col("s_suppkey").alias("doc_id"))
    part = s.select(F.col("s_suppkey").alias("doc_id"), F.col("s_nationkey").cast("string").alias("no"))
    got = package.build_package(docs, {"contracts": part.union(part.withColumn("no", F.lit("~")))})
    return got.filter("operation = 'CREATE_COMPANY' AND size(contracts) = 2").select("doc_id", F.col("contracts")[0]["no"].alias("contract"))


@query("""
SELECT l_orderkey AS doc_id, min(l_linenumber) AS start, max(l_linenumber) AS "end", bool_and(l_quantity > 5) AND count(DISTINCT l_linenumber) = max(l_linenumber) - min(l_linenumber) + 1 AS recovered FROM lineitem GROUP BY 1""")
def recovered_ranges(spark, sf_dir):
    """J12 over line numbers."""
    li = read(spark, sf_dir, "lineitem")
    pages = li.groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("physical_page")).agg(F.bool_and(F.col("l_quantity") > 5).alias("usable"))
    errors = li.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.min("l_linenumber").alias("start"), F.max("l_linenumber").alias("end"))
    return joins.recovered_errors(errors, pages)
