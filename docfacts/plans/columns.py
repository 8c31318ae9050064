"""Queries of single columns and small joins: each runs its operators on texts and numbers made from the test tables, beside the SQL that says what they give."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from docfacts.functions import nested as H
from docfacts.functions import text as T
from docfacts.functions import values as V
from docfacts.operators import classify, joins, merge, windows
from docfacts.plans.queries import query, read


def pick(number: str, texts: list[str]) -> Column:
    """One of the texts, by a number modulo their count."""
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col(number) % len(texts) + 1).cast("int"))


def case(number: str, values: list) -> str:
    """SQL: one of the values, by a number modulo their count."""
    show = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return f"CASE {number} % {len(values)} " + " ".join(f"WHEN {k} THEN {show(v)}" for k, v in enumerate(values)) + " END"


def joined(c: Column) -> Column:
    return F.array_join(c, "|")


@query(r"""
WITH c AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{3,}', E'\n\n', 'g'), E' \t\n\r') AS x, trim(text, E' \t\n\r') AS y FROM conversations)
SELECT conv_id, turn, md5(nullif(x, '')) AS verbatim, md5(CASE WHEN y <> '' AND length(y) <= 200 THEN y END) AS strict, length(y) > 200 AS too_long FROM c""")
def verbatim_and_strict_text(spark, sf_dir):
    """F2, F4."""
    strict, error = T.strict_text(F.col("text"), 200)
    return read(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.md5(T.clean_verbatim_text(F.col("text"), None)).alias("verbatim"), F.md5(strict).alias("strict"), error.isNotNull().alias("too_long")
    )


@query("""
SELECT o_orderkey, 'nr ' || CASE WHEN o_orderkey % 3 = 2 THEN lpad(o_orderkey::VARCHAR, 14, '7') ELSE '[证件号码已隐藏]' END || ' end' AS masked,
  'at [LOCAL_ROOT]/f' || o_orderkey || ' call [PHONE_REDACTED] key <secret>' AS message FROM orders""")
def masked_messages(spark, sf_dir):
    """F13, F16."""
    key = F.col("o_orderkey").cast("string")
    number = F.when(F.col("o_orderkey") % 3 == 0, F.lpad(key, 15, "7")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lpad(key, 17, "7"), F.lit("X"))).otherwise(F.lpad(key, 14, "7"))
    phone = F.concat(F.lit("139"), F.lpad((F.col("o_orderkey") % 10000).cast("string"), 8, "0"))
    message = F.concat(F.lit(" at /data/in/f"), key, F.lit(" call "), phone, F.lit(" key s3cr3t "))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", T.mask_document_numbers(F.concat(F.lit("nr "), number, F.lit(" end"))).alias("masked"), T.safe_error_message(message, ["/data", "/data/in"], ["s3cr3t"]).alias("message")
    )


@query("""
WITH h AS (SELECT o_orderkey, upper(left(md5(o_orderkey::VARCHAR), 18)) AS code FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN code END AS code FROM h""")
def credit_codes(spark, sf_dir):
    """F8: blanks and hyphens go, letters outside the alphabet and wrong lengths give none."""
    code = F.left(F.md5(F.col("o_orderkey").cast("string")), F.lit(18))
    k = F.col("o_orderkey") % 4
    written = F.when(k == 0, code).when(k == 1, F.concat(F.left(code, F.lit(4)), F.lit(" - "), F.substring(code, 5, 14))).when(k == 2, F.concat(F.lit("O"), F.substring(code, 2, 17))).otherwise(F.left(code, F.lit(17)))
    return read(spark, sf_dir, "orders").select("o_orderkey", T.normalize_credit_code(written).alias("code"))


@query("""
SELECT s_suppkey, '(甲)' || s_suppkey || 'Co' AS strict, '(甲)' || s_suppkey || 'co' AS award FROM supplier""")
def company_names(spark, sf_dir):
    """F6."""
    name = F.concat(F.lit("（甲） "), F.col("s_suppkey").cast("string"), F.lit("　Ｃo "))
    return read(spark, sf_dir, "supplier").select("s_suppkey", T.normalize_company_name(name).alias("strict"), T.award_company_name(name).alias("award"))


CERTIFICATES = [
    ("质量管理体系认证证书", "质量管理体系认证", "SYSTEM_CERTIFICATION"), ("中国职业健康安全管理体系认证", "职业健康安全管理体系认证", "SYSTEM_CERTIFICATION"),
    ("职业健康安全管理体系认证证书", "职业健康安全管理体系认证", "SYSTEM_CERTIFICATION"), ("环境管理体系 认证", "环境管理体系认证", "SYSTEM_CERTIFICATION"),
    ("建筑工程施工总承包一级", "建筑工程施工总承包", "INDUSTRY_QUALIFICATION"), ("安全生产许可证", "安全生产许可证", "BUSINESS_LICENSE"), ("工程设计 甲级", "工程设计", "INDUSTRY_QUALIFICATION"),
    ("荣誉证书", "荣誉证书", "UNKNOWN"),
]


@query(f"""
SELECT p_partkey, {case('p_partkey', [c[1] for c in CERTIFICATES])} AS identity_name, {case('p_partkey', [c[2] for c in CERTIFICATES])} AS kind FROM part""")
def certificate_names(spark, sf_dir):
    """F9, F10."""
    name = pick("p_partkey", [c[0] for c in CERTIFICATES])
    return read(spark, sf_dir, "part").select("p_partkey", T.certificate_identity_name(name).alias("identity_name"), T.credential_kind(name).alias("kind"))


WARNINGS = [("出生日期仅有年月", True), ("出生年月无法归一化", True), ("出生日期未给出具体日期", True), ("证书编号不清", False), ("出生日期与证书有效期冲突，无法归一化", False), ("出生日期", False)]


@query(f"SELECT p_partkey, {case('p_partkey', [int(w[1]) for w in WARNINGS])} = 1 AS unrelated FROM part")
def unrelated_warnings(spark, sf_dir):
    """F17."""
    return read(spark, sf_dir, "part").select("p_partkey", T.unrelated_warning(pick("p_partkey", [w[0] for w in WARNINGS])).alias("unrelated"))


@query("""
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN turn + 1 WHEN 1 THEN turn + 1 WHEN 2 THEN -1 ELSE turn + 2 END::INT AS page FROM conversations""")
def printed_pages(spark, sf_dir):
    """a page number in the last line, in the first one, out of range, or in both (the last counts)."""
    body, n = F.regexp_replace("text", "[0-9]", "x"), (F.col("turn") + 1).cast("string")
    k = F.col("turn") % 4
    page = F.when(k == 0, F.concat(body, F.lit("\n第 "), n, F.lit(" 页\n"))).when(k == 1, F.concat(F.lit("- "), n, F.lit(" -\n"), body)).when(k == 2, F.concat(body, F.lit("\n9999")))
    page = page.otherwise(F.concat(n, F.lit("\n"), body, F.lit("\n"), (F.col("turn") + 2).cast("string")))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(T.printed_page(page, F.lit(50)), F.lit(-1)).alias("page"))


@query("""
SELECT c_custkey, '（一）' || c_name || '|' || '(2)' || c_mktsegment || ' one' || '|' || '3、last one' AS clauses FROM customer""")
def numbered_clauses(spark, sf_dir):
    """cut before numbering and after sentence ends, edges trimmed, short pieces dropped."""
    block = F.concat(F.lit("（一）"), F.col("c_name"), F.lit("；ab。(2)"), F.col("c_mktsegment"), F.lit(" one，3、last one。"))
    return read(spark, sf_dir, "customer").select("c_custkey", joined(T.split_numbered_clauses(block)).alias("clauses"))


@query(f"""
SELECT s_suppkey, {case('s_suppkey', ['一级', '甲级', '特级', None])} AS level, lpad(s_suppkey::VARCHAR, 9, '0') || '有限公司' AS legal_name FROM supplier""")
def levels_and_legal_names(spark, sf_dir):
    """F21, F22."""
    need = pick("s_suppkey", ["施工总承包一级及以上", "设计甲级", "特级资质", "营业执照"])
    name = F.concat(F.lit("招标人："), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"), F.lit("第 3 页有限公司、别的公司"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", T.extract_level(need).alias("level"), T.legal_entity_name(name).alias("legal_name"))


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '1999-02-30' ELSE strftime(d, '%Y-%m-%d') END AS kept, o_orderkey % 3 = 0 AS warned,
  CASE WHEN o_orderkey % 3 <> 0 THEN strftime(d, '%Y-%m-%d') END AS strict, o_orderkey % 3 = 0 AS error,
  CASE WHEN o_orderkey % 3 <> 0 THEN strftime(d, '%Y-%m-%d') || ' 09:05至' || strftime(d + 1, '%Y-%m-%d') END AS span FROM d""")
def dates_kept(spark, sf_dir):
    """D2, D3, D4."""
    day = F.col("o_orderdate").cast("date")
    bad = F.col("o_orderkey") % 3 == 0
    written = F.when(bad, "1999-02-30").otherwise(F.date_format(day, "yyyy.M.d"))
    kept, warning = V.normalize_date_keep(written, "d")
    strict, error = V.strict_date(written)
    span = F.concat(F.lit("自"), F.when(bad, "1999年2月30日").otherwise(F.date_format(day, "yyyy年M月d日")), F.lit(" 9时05起，到"), F.date_format(F.date_add(day, 1), "yyyy/M/d"), F.lit("止"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", kept.alias("kept"), warning.isNotNull().alias("warned"), strict.cast("string").alias("strict"), error.isNotNull().alias("error"), V.tender_datetime(span).alias("span")
    )


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate::DATE + (o_orderkey % 900 - 450)::INT AS issue, o_orderdate::DATE + (o_orderkey % 700 - 300)::INT AS start, o_orderdate::DATE AS expiry FROM orders)
SELECT o_orderkey, (issue > DATE '1999-06-30')::INT + (issue > expiry)::INT + (start > expiry)::INT AS reasons FROM d""")
def date_reasons(spark, sf_dir):
    """D10."""
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    issue, start = F.date_add(day, (k % 900 - 450).cast("int")), F.date_add(day, (k % 700 - 300).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.size(V.date_consistency(issue, start, day, F.lit("1999-06-30").cast("date"))).alias("reasons"))


_DIGITS = "壹贰叁肆伍陆柒捌玖"


@query("""
WITH k AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(20,2)) AS p, (o_orderkey % 9 + 1) * 10000 + (o_orderkey // 9 % 9 + 1) * 1000 + (o_orderkey // 81 % 9 + 1) * 100 + (o_orderkey // 7 % 9 + 1) * 10 + (o_orderkey // 5 % 9 + 1) AS yuan FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN p::DOUBLE END AS finite, CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE p::DOUBLE END AS award,
  o_orderkey % 4 = 0 AS issue, yuan::DOUBLE AS words, (yuan + 0.35)::DOUBLE AS words_with_parts FROM k""")
def amounts_read(spark, sf_dir):
    """N1, N2, N4."""
    k = F.col("o_orderkey")
    plain = F.col("o_totalprice").cast("decimal(20,2)").cast("string")
    number = F.concat(F.when(k % 4 == 0, "-").otherwise(""), F.format_number(F.col("o_totalprice").cast("decimal(20,2)"), 2))
    text = F.when(k % 4 == 0, F.concat(plain, F.lit("元"))).otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(20,2)").cast("string")))
    award, issue = V.award_amount(text)
    digit = lambda n: F.substring(F.lit(_DIGITS), (n % 9 + 1).cast("int"), F.lit(1))
    words = F.concat(digit(k), F.lit("万"), digit(F.floor(k / 9)), F.lit("仟"), digit(F.floor(k / 81)), F.lit("佰"), digit(F.floor(k / 7)), F.lit("拾"), digit(F.floor(k / 5)), F.lit("元"))
    money = lambda tail: V.parse_chinese_money(F.concat(F.lit("人民币"), words, F.lit(tail))).cast("double")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", V.finite_number(number).cast("double").alias("finite"), award.cast("double").alias("award"), issue.isNotNull().alias("issue"), money("整").alias("words"), money("叁角伍分").alias("words_with_parts")
    )


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN (o_orderkey % 100)::DOUBLE / 100 WHEN 2 THEN (2 + o_orderkey % 90)::DOUBLE / 100 ELSE 1.0 END AS confidence, o_orderkey % 4 <> 1 AS warned,
  CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'OPEN' ELSE 'OTHER' END AS status,
  CASE o_orderkey % 3 WHEN 0 THEN 'employee_certificate' ELSE 'unknown' END AS document_type, o_orderkey % 3 = 2 AS unknown_type FROM orders""")
def confidences_and_enums(spark, sf_dir):
    """N6, N7, N8."""
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, "NaN").when(k % 4 == 1, ((k % 100) / 100).cast("string")).when(k % 4 == 2, (2 + k % 90).cast("string")).otherwise("250")
    confidence, warning = V.normalize_confidence(text)
    kind, unknown = V.normalize_document_type(pick("o_orderkey", ["员工证书", "其他文档", "奇怪的东西"]))
    status = V.normalize_enum(F.concat(F.lit(" "), F.lower("o_orderstatus")), ["DONE", "OPEN"], "OTHER", {"f": "DONE", "o": "OPEN"})
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", confidence.alias("confidence"), warning.isNotNull().alias("warned"), status.alias("status"), kind.alias("document_type"), unknown.isNotNull().alias("unknown_type")
    )


@query("""
SELECT p_partkey, p_brand || '|' || p_type || '|' || p_name AS list, p_type || '|' || p_brand AS warnings, p_name || '|' || p_brand AS names,
  'x' || p_partkey || '|c' AS refs, (p_partkey % 2 = 0)::INT + (p_partkey % 3 = 0)::INT AS present FROM part""")
def lists_and_references(spark, sf_dir):
    """H1, H6, H9, H13, H14."""
    brand, kind, name, k = F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.col("p_partkey")
    named = F.array(F.struct(name.alias("name"), brand.alias("value")), F.struct(F.lit(None).cast("string").alias("name"), brand.alias("value")), F.struct(F.lit("--").alias("name"), F.lit("z").alias("value")))
    mapping = F.create_map(F.lit("a"), F.concat(F.lit("x"), k.cast("string")), F.lit("b"), F.lit(""))
    there = H.present(F.when(k % 2 == 0, name).otherwise(""), T_.StringType()).cast("int") + H.present(F.when(k % 3 == 0, F.array(name)).otherwise(F.array().cast("array<string>")), T_.ArrayType(T_.StringType())).cast("int")
    return read(spark, sf_dir, "part").select(
        "p_partkey", joined(H.string_list(F.array(brand, F.upper(brand), F.lit(" "), kind, F.concat(F.lit(" "), name), F.lower(kind)))).alias("list"),
        joined(H.add_warnings(F.array(kind), brand, F.lit("-"), kind)).alias("warnings"), joined(H.names_of(named)).alias("names"),
        joined(H.remap_refs(F.array(F.lit("a"), F.lit("b"), F.lit("c")), mapping)).alias("refs"), there.alias("present"),
    )


@query("""
WITH j AS (SELECT p_partkey, '{"v":"qualification"}' || chr(31) || '{"v":"' || p_brand || '"}' || chr(31) || '{"v":"质量管理体系认证"}' AS fact,
  '{"v":"v1"}' || chr(31) || '{"v":' || p_partkey || '}' || chr(31) || '{"v":"' || md5(p_name) || '"}' || chr(31) || '{"v":"personnel"}' || chr(31) || '{"v":0}' AS entry FROM part)
SELECT p_partkey, left(sha256('{"v":"' || p_brand || '"}' || chr(31) || '{"v":' || p_partkey || '}'), 18) AS stable, sha256(fact || chr(31) || '{}') AS fact, sha256(entry) AS entry FROM part JOIN j USING (p_partkey)""")
def stable_hashes(spark, sf_dir):
    """H2, H3, H4."""
    k, brand = F.col("p_partkey"), F.col("p_brand")
    number = F.concat(F.left(brand, F.lit(2)), F.lit(" "), F.substring(brand, 3, 100))
    return read(spark, sf_dir, "part").select(
        "p_partkey", H.stable_hash(brand, k, length=18).alias("stable"), H.fact_key(F.lit("qualification"), number, F.lit("质量管理体系认证证书"), F.lit("x")).alias("fact"),
        H.entry_id("v1", k, F.md5("p_name"), F.lit("personnel"), F.lit(0)).alias("entry"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'o_totalprice|extra' ELSE 'o_totalprice' END AS dropped FROM orders""")
def dropped_payload_keys(spark, sf_dir):
    """H5."""
    row = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct("o_custkey", "o_totalprice", F.lit(1).alias("extra")))).otherwise(F.to_json(F.struct("o_custkey", "o_totalprice")))
    return read(spark, sf_dir, "orders").select("o_orderkey", joined(H.dropped_keys(row, ["o_custkey", "unused"])).alias("dropped"))


@query("""
SELECT c_custkey, 'company.name=' || c_name || '|certificates[0].no=[证件号码已隐藏]' AS evidence FROM customer""")
def kept_evidence(spark, sf_dir):
    """H7."""
    each = lambda field, value: F.struct(F.lit(field).alias("field"), value.alias("text"))
    number = F.lpad(F.col("c_custkey").cast("string"), 15, "3")
    evidence = F.array(each("company.name", F.col("c_name")), each("person.birth_date", F.lit("1970")), each("certificates[0].no", number), each("certificates[0].id_number", number), each("note", F.lit("n")))
    kept = F.transform(H.filter_certificate_evidence(evidence), lambda e: F.concat(e["field"], F.lit("="), e["text"]))
    return read(spark, sf_dir, "customer").select("c_custkey", joined(kept).alias("evidence"))


@query("""
SELECT c_custkey, c_name AS value, 'e' || c_custkey AS entry_id, false AS decision_eligible, c_custkey % 2 = 0 AS history_only, 'import:e' || c_custkey AS source_ref FROM customer""")
def stored_values(spark, sf_dir):
    """H15."""
    entry = F.concat(F.lit("e"), F.col("c_custkey").cast("string"))
    stored = H.stored_certificate_value(F.col("c_name"), entry, F.lit("b1"), F.col("c_nationkey"), F.md5("c_name"), F.when(F.col("c_custkey") % 2 == 0, "HISTORY").otherwise("INSERT"))
    d = read(spark, sf_dir, "customer").select("c_custkey", stored.alias("s"))
    return d.select("c_custkey", "s.value", *[f"s.certificate_import.{c}" for c in ("entry_id", "decision_eligible", "history_only", "source_ref")])


NEEDS = [
    ("项目投融资能力不低于三亿元", "FINANCIAL", "投融资能力要求", "financing_capacity"), ("近三年财务审计报告", "FINANCIAL", "财务要求", "financial"),
    ("在中华人民共和国境内依法注册", "BASIC", "基本资格要求", "legal_person"), ("不接受联合体投标", "CONSORTIUM", "联合体要求", "consortium"),
    ("外省企业须提供入晋登记截图", "REGIONAL_ACCESS", "省外登记备案", "regional_registration"), ("外地企业须入驻平台", "REGIONAL_ACCESS", "省外企业平台准入", "regional_platform"),
    ("提供法定代表人授权委托书", "AUTHORIZATION", "授权委托及身份证明", "authorization"), ("提供基本存款账户信息", "BANK_ACCOUNT", "基本账户证明", "bank_account"),
    ("提供安全生产许可证", "LICENCE", "提供安全生产许可证", "licence:提供安全生产许可证"), ("无行贿犯罪记录", "CREDIT", "信用及失信限制", "credit_bribery"),
    ("未被列入失信被执行人", "CREDIT", "信用及失信限制", "credit_platform"), ("有行贿行为的除外", "OTHER", "其他资格要求", None),
    ("企业具有类似项目", "PERFORMANCE", "业绩要求", "performance:企业"), ("近三年业绩", "PERFORMANCE", "业绩要求", "performance:bidder"),
    ("与运营机构存在控股", "RELATIONSHIP", "关联关系限制", "platform_relationship"), ("单位负责人为同一人", "RELATIONSHIP", "关联关系限制", "ownership_relationship"),
    ("须配备项目经理一名", "PERSONNEL", "项目经理", "personnel:项目经理"), ("施工总承包", "OTHER", "其他资格要求", None),
    ("建筑工程施工总承包二级资质", "PROFESSIONAL_QUALIFICATION", "企业专业资质", "qualification:建筑工程施工总承包二级资质"),
    ("持有营业执照", "BASIC", "基本资格要求", "business_license"), ("依法缴纳税收", "BASIC", "基本资格要求", "tax_social_security"), ("具有履行合同所必需的设备", "BASIC", "基本资格要求", "contract_capacity"),
    ("具有施工能力", "BASIC", "基本资格要求", "implementation_capacity"),
]


@query(f"""
WITH t AS (SELECT p_partkey, {case('p_partkey', [n[0] for n in NEEDS])} AS t FROM part)
SELECT p_partkey, {case('p_partkey', [n[1] for n in NEEDS])} AS type, {case('p_partkey', [n[2] for n in NEEDS])} AS name,
  coalesce({case('p_partkey', [n[3] for n in NEEDS])}, 'other:' || left(sha256(t), 12)) AS identity FROM t""")
def requirement_types(spark, sf_dir):
    """C5."""
    d = read(spark, sf_dir, "part").select("p_partkey", classify.classify_requirement(pick("p_partkey", [n[0] for n in NEEDS])).alias("r"))
    return d.select("p_partkey", "r.*")


@query("""
WITH p AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '13900000000 ' ELSE '' END || text AS text, CASE turn % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS conf, CASE WHEN turn % 5 = 1 THEN 'INVOICE' ELSE 'T' || turn END AS kind FROM conversations),
n AS (SELECT *, lag(turn) OVER w = turn - 1 AS before, lag(text) OVER w AS t1, lag(kind) OVER w AS k1, lead(turn) OVER w = turn + 1 AS after, lead(text) OVER w AS t2, lead(kind) OVER w AS k2 FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT *, left(text, 900) || CASE WHEN length(text) > 1100 THEN E'\\n...[页面中部省略]...\\n' || right(text, 200) ELSE '' END AS preview FROM n)
SELECT conv_id, turn, md5(replace(preview, '13900000000', '[PHONE_REDACTED]')) AS preview, CASE WHEN before THEN k1 END AS previous_type, CASE WHEN after THEN k2 END AS next_type,
  md5(CASE WHEN before THEN replace(left(t1, 240), '13900000000', '[PHONE_REDACTED]') END) AS previous_text, md5(CASE WHEN after THEN replace(left(t2, 240), '13900000000', '[PHONE_REDACTED]') END) AS next_text
FROM r WHERE conf <> 'HIGH' AND kind <> 'INVOICE' AND trim(text) <> ''""")
def ambiguous_pages(spark, sf_dir):
    """Previews and neighbours without personal numbers."""
    k = F.col("turn")
    pages = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("physical_page"), F.concat(F.when(k % 2 == 0, "13900000000 ").otherwise(""), "text").alias("text"),
        F.when(k % 3 == 0, "HIGH").when(k % 3 == 1, "MEDIUM").otherwise("LOW").alias("classification_confidence"), F.when(k % 5 == 1, "INVOICE").otherwise(F.concat(F.lit("T"), k.cast("string"))).alias("document_type"),
    )
    got = windows.select_ambiguous_pages(pages)
    return got.select(F.col("doc_id").alias("conv_id"), F.col("physical_page").alias("turn"), F.md5("preview").alias("preview"), "previous_type", "next_type", F.md5("previous_text").alias("previous_text"), F.md5("next_text").alias("next_text"))


@query("""
SELECT c.conv_id, c.turn, CASE WHEN c.turn % 4 = 0 THEN 'CONTRACT' ELSE 'OTHER' END AS document_type, CASE c.turn % 4 WHEN 0 THEN NULL WHEN 1 THEN 'illegal refined type' WHEN 2 THEN 'no refined type' END AS warning FROM conversations c""")
def refined_types(spark, sf_dir):
    """C3."""
    c = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("physical_page"))
    pages = c.withColumn("document_type", F.lit("OTHER")).withColumn("asked", F.col("physical_page") % 4 != 3)
    answers = c.filter("physical_page % 4 < 2").withColumn("document_type", F.when(F.col("physical_page") % 4 == 0, "CONTRACT").otherwise("NONSENSE"))
    return joins.apply_refined_types(pages, answers, ["CONTRACT", "OTHER"]).select(F.col("doc_id").alias("conv_id"), F.col("physical_page").alias("turn"), "document_type", "warning")


_ROUTES = [("AUDIT_REPORT", "enterprise"), ("AUDIT_REPORT", "finance"), ("CONTRACT", "performances"), ("COVER", "enterprise")]


@query(f"""
WITH p AS (SELECT p_partkey, {case('p_partkey', ['AUDIT_REPORT', 'CONTRACT', 'INVOICE', 'COVER'])} AS t FROM part), r(t, domain) AS (VALUES {', '.join(map(str, _ROUTES))})
SELECT p_partkey, t AS document_type, domain FROM p JOIN r USING (t)""")
def domain_routes(spark, sf_dir):
    """C4."""
    pages = read(spark, sf_dir, "part").select("p_partkey", pick("p_partkey", ["AUDIT_REPORT", "CONTRACT", "INVOICE", "COVER"]).alias("document_type"))
    return joins.route_domains(pages, classify.routes(spark))


@query("""
SELECT l_orderkey, min(chr(65 + (l_suppkey % 4)::INT)) AS source_strength FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY 1""")
def strengths(spark, sf_dir):
    """J5."""
    li = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.col("l_suppkey").cast("string")).alias("refs"))
    letter = F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    evidence = read(spark, sf_dir, "supplier").filter("s_suppkey % 5 <> 0").select(F.col("s_suppkey").cast("string").alias("evidence_id"), letter.alias("source_strength"))
    return joins.strength_of_refs(li, ["l_orderkey"], "refs", evidence)


@query("""
WITH r AS (SELECT DISTINCT l_orderkey, lpad(l_suppkey::VARCHAR, 6, '0') AS r, l_suppkey % 3 <> 0 AS hit FROM lineitem)
SELECT l_orderkey, coalesce(string_agg(r, '|' ORDER BY r) FILTER (hit), '') AS refs, coalesce(string_agg(r, '|' ORDER BY r) FILTER (NOT hit), '') AS unresolved FROM r GROUP BY 1""")
def resolved_refs(spark, sf_dir):
    """J6, A20."""
    ref = F.lpad(F.col("l_suppkey").cast("string"), 6, "0")
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", F.array(ref, ref).alias("refs"))
    once = merge.collect_refs(li, ["l_orderkey"], "refs")
    targets = read(spark, sf_dir, "supplier").filter("s_suppkey % 3 <> 0").select(F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("id"))
    return joins.resolve_refs(once, ["l_orderkey"], "refs", targets, "id").select("l_orderkey", joined(F.col("refs")).alias("refs"), joined(F.col("unresolved")).alias("unresolved"))


@query("""
SELECT c_custkey, c_mktsegment ILIKE '%auto%' OR c_mktsegment ILIKE '%HOUSE%' AS hit,
  CASE c_custkey % 4 WHEN 0 THEN 'MATCH' WHEN 1 THEN 'UNKNOWN' ELSE 'MISMATCH' END AS strict, CASE c_custkey % 4 WHEN 0 THEN 'MATCHED' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'PROBABLE' ELSE 'OTHER_COMPANY' END AS loose,
  CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 1 END AS reasons FROM customer""")
def company_matches(spark, sf_dir):
    """J9, J14, J15."""
    k, name = F.col("c_custkey") % 4, F.col("c_name")
    holder = F.when(k == 0, F.concat(F.lit(" "), name)).when(k == 1, "").when(k == 2, F.concat(name, F.lit(" branch"))).otherwise("Another")
    none = F.lit(None).cast("string")
    return read(spark, sf_dir, "customer").select(
        "c_custkey", joins.contains_any(F.col("c_mktsegment"), ["auto", "HOUSE"]).alias("hit"), joins.subject_match(holder, name).alias("strict"), joins.company_match(holder, name).alias("loose"),
        F.size(joins.affiliation_reasons(none, holder, none, name, F.lit(False))).alias("reasons"),
    )


@query("""
SELECT conv_id, turn, turn % 3 <> 1 AND length(text) > 8 AS valid FROM conversations""")
def span_checks(spark, sf_dir):
    """J16."""
    c = read(spark, sf_dir, "conversations")
    nodes = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("string").alias("item_id"), F.col("turn").alias("page"), "text")
    shift = F.when(F.col("page") % 3 == 1, 1).otherwise(0)
    spans = nodes.select("doc_id", "item_id", "page", F.lit(2).alias("start"), F.when(F.length("text") > 8, 8).otherwise(F.length("text") + 1).alias("end"), F.substring(F.col("text"), F.lit(3) + shift * 0, F.lit(6)).alias("text"))
    spans = spans.withColumn("text", F.when(F.col("page") % 3 == 1, F.concat(F.lit("~"), "text")).otherwise(F.col("text")))
    return joins.verify_spans(spans, nodes).select(F.col("doc_id").alias("conv_id"), F.col("page").alias("turn"), "valid")


@query("""
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'GLM_VISION' WHEN 1 THEN 'GLM_OCR' WHEN 2 THEN 'OCR_FAILED' ELSE 'NATIVE' END AS content_source,
  md5(CASE turn % 4 WHEN 0 THEN 'seen ' || turn WHEN 1 THEN 'a page that was read again' ELSE text END) AS text FROM conversations""")
def page_overlay(spark, sf_dir):
    """J18."""
    c = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("physical_page"), "text", F.lit("NATIVE").alias("content_source"))
    k = F.col("physical_page") % 4
    ocr = c.filter(k.isin(1, 2)).withColumn("text", F.when(k == 1, "a page that was read again").otherwise(" "))
    vision = c.filter(k == 0).withColumn("text", F.concat(F.lit("seen "), F.col("physical_page").cast("string")))
    got = joins.overlay_page_text(c, ocr, vision)
    return got.select(F.col("doc_id").alias("conv_id"), F.col("physical_page").alias("turn"), "content_source", F.md5("text").alias("text"))
