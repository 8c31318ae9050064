"""Tender fields and requirements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docfacts.functions.text import extract_level, legal_entity_name, split_numbered_clauses
from docfacts.operators.classify import classify_requirement
from docfacts.operators.layout import merge_ranges

# Forms of dates, amounts and numbers in running text.
DATE = r"[0-9]{4}(?:年|[-/.])[0-9]{1,2}(?:月|[-/.])[0-9]{1,2}日?(?:[0-9]{1,2}[时:][0-9]{1,2}分?)?"
MONEY = r"(?:[0-9][0-9,]*(?:\.[0-9]+)?(?:亿元|万元|元)|[零壹贰叁肆伍陆柒捌玖拾佰仟万亿元整]+[（(][0-9][0-9,]*(?:\.[0-9]+)?元[）)])"
NUMBER = r"[A-Za-z0-9][A-Za-z0-9_.\/-]+"
#: Ends of a value in running text.
STOP = r"(?=[一二三四五六七八九十]+[、.．]|[0-9]+\.[0-9]|招标人|采购人|代理机构|联系人|[。；;]|$)"

# The head of a major section, which no value reaches into, and fields that keep their last full stop.
MAJOR_SECTION = r"[一二三四五六七八九十]+[、.．](?:招标|投标|开标|资格|发布|其他|监督|联系)"
WHOLE_SENTENCES = ["项目规模", "申请人资格要求/投标人资格要求", "招标文件获取方式", "递交方法"]

# Labels of announcement clauses per field.
CLAUSE_LABELS = {
    "项目名称": ["项目名称", "招标项目名称"], "项目规模": ["项目规模", "项目概况", "建设内容"], "项目地点": ["项目地点", "建设地点"],
    "工期/服务期/供货日期": ["建设工期", "工期", "服务期", "供货日期", "交货期"], "质量要求": ["质量要求"], "招标内容与范围": ["招标范围", "招标内容与范围"],
    "交货地点": ["交货地点"],
}
# Labels of front-table rows per field.
ROW_LABELS = {"项目名称": ["项目名称", "招标项目名称"], "项目地点": ["建设地点"], "资金来源": ["资金来源", "资金来源及比例"], "交货地点": ["交货地点"]}
# Wordings of fields in running text.
#: (field, sections, pattern with one group, priority): a higher priority number is used only if the lower ones found nothing.
TEXT_RULES = [
    ("招标编号", ["announcement", "cover"], rf"(?<!项目)招标编号[：:]({NUMBER})", 1),
    ("招标编号", ["cover", "announcement"], rf"采购编号[：:]?({NUMBER})", 2),
    ("招标项目编号", ["announcement", "cover"], rf"招标项目编号[：:]?({NUMBER})", 1),
    ("招标项目编号", ["cover", "announcement"], rf"(?<!招标)项目编号[：:]?({NUMBER})", 2),
    ("项目名称", ["announcement"], rf"(?:采购)?项目名称[：:](.+?){STOP}", 2),
    ("项目总投资/估算金额", ["announcement", "front"], rf"(?:项目总投资|估算金额)(?:为)?[：:]?({MONEY})", 1),
    ("预算金额", ["announcement", "front", "general"], rf"预算金额[：:]?({MONEY})", 1),
    ("招标金额", ["announcement", "front", "general"], rf"招标金额[：:]?({MONEY})", 1),
    ("最高投标限价", ["announcement", "front", "general"], rf"(?:最高投标限价(?:（招标控制价）)?(?:为)?|招标控制总价)[：:]?({MONEY})", 1),
    ("最高投标限价", ["announcement", "front", "general"], r"最高限价[^。；;¥￥]{0,45}[¥￥][：:]?([0-9][0-9,]*(?:\.[0-9]+)?(?:万元|元))", 2),
    ("投标保证金", ["announcement", "front", "general"], rf"投标保证金(?:的)?金额(?:为)?[：:]?({MONEY})", 1),
    ("投标保证金", ["announcement", "front", "general"], "本项目(不收取)投标保证金", 2),
    ("资金来源", ["announcement"], "资金来源(?:为|[:：])?(.+?)(?=[，,]招标人(?:为|[：:]))", 1),
    ("开启方式", ["announcement", "front"], "(?:开标方式|开启方式|开标形式)[：:]?.{0,100}?(远程线上开标|线上开标|网上开标|线下开标|现场开标|不见面开标|远程开标|在线开标)", 1),
    ("招标文件获取时间", ["announcement"], rf"获取时间[：:]?({DATE}至{DATE})", 1),
    ("招标文件获取方式", ["announcement"], rf"获取(?:方式|方法)[：:]?(.+?){STOP}", 1),
    ("递交截止时间", ["announcement", "front"], rf"(?:递交)?截止时间[^0-9]{{0,30}}({DATE})", 1),
    ("开启时间", ["announcement", "front"], rf"(?:开标|开启)时间[：:]?({DATE})", 1),
    ("质量要求", ["announcement", "front"], "质量要求[：:]?(合格|优良)", 2),
    ("工期/服务期/供货日期", ["announcement", "front"], "(?:计划工期|服务期限|供货期限|供货期)[：:]?([0-9]+(?:日历天|天|个月|月|年))", 2),
    ("招标内容与范围", ["announcement"], rf"(?:招标范围|采购范围)[：:]?(.+?){STOP}", 2),
    ("项目地点", ["announcement"], rf"(?:服务地点|项目地址|建设地点)[：:]?(.+?){STOP}", 2),
    ("申请人资格要求/投标人资格要求", ["announcement"], "(?:供应商资格要求|申请人资格要求|投标人资格要求)[：:]?(.+?)(?=[一二三四五六七八九十]+[、.．](?:招标|投标|采购|获取)|$)", 1),
]
#: (field, section, pattern, value): a phrase that stands for a fixed value.
MAPPED = [("组织形式", "announcement", "(?:招标代理机构|采购代理机构|代理机构|招标代理)[：:]", "委托招标"), ("项目性质", "general", "根据《.+?已具备招标条件.+?公开招标", "依法")]
ROLES = {"招标人": "招标人|采购人", "招标代理机构": "招标代理机构|采购代理机构|代理机构", "监督部门": "监督部门|行政监督"}
PARTS = {"名称": "", "地址": "地址[：:]?", "联系人": "联系人[：:]?", "联系电话": "(?:联系)?电话[：:]?"}


def _candidate(field: str, priority: int):
    return lambda v: F.struct(F.lit(field).alias("field"), v.alias("value"), F.lit(priority).alias("priority"))


def extract_rules(texts: DataFrame, rules=TEXT_RULES) -> DataFrame:
    """Candidates (doc_id, field, value, priority, section) of a rule table, all rules of a text in one projection."""
    found = []
    for field, sections, pattern, priority in rules:
        hits = F.when(F.col("section").isin(sections), F.array_distinct(F.regexp_extract_all("view_text", F.lit(pattern), F.lit(1)))).otherwise(F.array().cast("array<string>"))
        found.append(F.transform(hits, _candidate(field, priority)))
    for field, section, pattern, value in MAPPED:
        hit = (F.col("section") == section) & F.col("view_text").rlike(pattern)
        found.append(F.when(hit, F.array(F.struct(F.lit(field).alias("field"), F.lit(value).alias("value"), F.lit(1).alias("priority")))).otherwise(F.array().cast("array<struct<field:string,value:string,priority:int>>")))
    return texts.select("doc_id", "section", F.explode(F.concat(*found)).alias("c")).select("doc_id", "section", "c.field", "c.value", "c.priority").filter("value <> ''")


def contact_blocks(texts: DataFrame) -> DataFrame:
    """Name, address, person and phone of each role from the text between its marker and the next one, so that no other party's data leak in."""
    every = "|".join(ROLES.values())
    parts = []
    for role, marker in ROLES.items():
        block = F.regexp_extract("view_text", rf"(?:{marker})[：:](.{{1,200}}?)(?=(?:{every})[：:]|$)", 1)
        for part, label in PARTS.items():
            value = F.regexp_extract(block, rf"{label}(.+?)(?=地址[：:]|联系人[：:]|(?:联系)?电话[：:]|电子邮|$)" if label else r"^(.+?)(?=地址[：:]|联系人[：:]|(?:联系)?电话[：:]|$)", 1)
            parts.append(F.struct(F.lit(f"{role}{part}").alias("field"), (legal_entity_name(value) if not label else value).alias("value"), F.lit(1).alias("priority")))
    return texts.filter("section = 'announcement'").select("doc_id", "section", F.explode(F.array(*parts)).alias("c")).select("doc_id", "section", "c.field", "c.value", "c.priority").filter("value <> ''")


def first_priority(candidates: DataFrame) -> DataFrame:
    """C13's conditional fallbacks: only the candidates of the lowest priority number of a field stay."""
    return candidates.withColumn("_r", F.rank().over(W.partitionBy("doc_id", "field").orderBy("priority"))).filter("_r = 1").drop("_r")


def finalize_fields(candidates: DataFrame, docs: DataFrame, names: list[str], longest: list[str] = (), shortest: list[str] = (), prose: bool = True) -> DataFrame:
    """One record per document and field: EXTRACTED, CONFLICT or MISSING.

    In prose, values end where a major section begins and, but for whole
    sentences, before the full stop. References to other places don't count. Of `longest` fields the longest
    value stands if it contains the others, of `shortest` ones the shortest if
    the others contain it.
    """
    cut = F.regexp_replace("value", f"(?s){MAJOR_SECTION}.*$", "")
    cut = F.when(F.col("field").isin(WHOLE_SENTENCES), cut).otherwise(F.regexp_replace(cut, "[。；;]+$", ""))
    good = candidates.withColumn("value", cut if prose else F.col("value")).filter(~F.col("value").rlike("^(?:(?:见|详见|同投标截止时间)|$)"))
    agg = good.groupBy("doc_id", "field").agg(F.array_sort(F.collect_set("value")).alias("values"))
    long = F.array_sort("values", lambda a, b: F.length(b) - F.length(a))
    top, low = F.element_at(long, 1), F.element_at(long, -1)
    one = (
        F.when(F.size("values") == 1, F.element_at("values", 1))
        .when(F.col("field").isin(list(longest)) & F.forall("values", lambda v: F.contains(top, v)), top)
        .when(F.col("field").isin(list(shortest)) & F.forall("values", lambda v: F.contains(v, low)), low)
    )
    wanted = docs.select("doc_id").distinct().crossJoin(F.broadcast(docs.sparkSession.createDataFrame([(n,) for n in names], "field string")))  # a fixed list of names
    out = wanted.join(agg.withColumn("value", one), ["doc_id", "field"], "left")
    return out.withColumn("status", F.when(F.col("values").isNull(), "MISSING").when(F.col("value").isNull(), "CONFLICT").otherwise("EXTRACTED"))


def extract_tender_fields(texts: DataFrame, clause_values: DataFrame, rows: DataFrame, names: list[str]) -> DataFrame:
    """C13, C15, C16 together. texts: (doc_id, section, view_text); clause_values and rows: (doc_id, field, value)."""
    layout = reduce(DataFrame.unionByName, [d.select("doc_id", F.lit("layout").alias("section"), "field", "value", F.lit(1).alias("priority")) for d in (clause_values, rows)])
    pool = first_priority(extract_rules(texts).unionByName(contact_blocks(texts)).unionByName(layout))
    return finalize_fields(pool, texts, names, ["招标编号", "招标项目编号"], [f"{r}名称" for r in ROLES])


# Where requirements begin and end in announcements and front tables, and how long they are if no end is found.
ANNOUNCED, ANNOUNCED_END, ANNOUNCED_LENGTH = "本次招标要求投标人|投标人资格要求|投标人应具备", "招标文件(?:的)?获取|投标文件(?:的)?递交|发布公告", 2500
FRONT = ["资质条件：", "资质条件:", "投标人资格条件：", "投标人资格要求：", "投标人资质、能力和信誉"]
FRONT_END, FRONT_LENGTH = "投标截止时间|是否接受联合体|踏勘现场|投标预备会", 2200
FRONT_WHOLE = r"([（(]1[）)]资质要求[：:].+?)(?=☑不组织|□不组织|踏勘现场)"
#: What is no requirement by itself.
NO_REQUIREMENT = (
    r"^(?:无|不要求|详见.+|业绩要求[：:]?[\\/]*|(?:[0-9]{3})?(?:第一标段|不分标段|本项目的特定资格要求|本次招标要求申请人应具备以下资格条件|法人资格|业绩资格要求|商业信誉的要求|投融资能力)[：:]?)$"
)


def _until(text: Column, start: Column, end: str, length: int) -> Column:
    """Where what begins at `start` (from 0) ends: at the pattern, or after `length` characters or the text."""
    found = F.regexp_instr(F.substring(text, start + 1, F.length(text)), F.lit(end))
    return F.when(found > 0, start + found - 1).otherwise(F.least(F.length(text), start + length))


def requirement_ranges(texts: DataFrame, clauses: DataFrame) -> DataFrame:
    """C17: (doc_id, section, start, end, roles): where a document's requirements stand, overlapping places put together.

    texts: (doc_id, section, view_text); clauses: (doc_id, start, end), the
    announcement's own requirement clauses. Three sources: the clauses, or else
    the first two markers of the announcement; the first marker of the front
    table; and only where these give nothing its numbered requirement cell.
    """
    t = F.col("view_text")
    ann, front = texts.filter("section = 'announcement'"), texts.filter("section = 'front'")
    given = clauses.select("doc_id", F.lit("announcement").alias("section"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.lit("ANNOUNCEMENT").alias("role"))
    # lengths of the pieces before each marker add up to where it stands
    lengths = F.transform(F.split(t, f"(?={ANNOUNCED})"), lambda x: F.length(x))
    sums = F.aggregate(lengths, F.array(F.lit(0)), lambda done, n: F.array_append(done, F.element_at(done, -1) + n))
    starts = F.filter(sums, lambda at: F.substring(t, at + 1, F.lit(10)).rlike(f"^(?:{ANNOUNCED})"))
    marked = ann.join(clauses.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "section", "view_text", F.explode(F.slice(starts, 1, 2)).alias("start"))
    marked = marked.select("doc_id", "section", "start", _until(t, F.col("start") + 5, ANNOUNCED_END, ANNOUNCED_LENGTH - 5).alias("end"), F.lit("ANNOUNCEMENT").alias("role"))
    first = F.coalesce(*[F.when(F.instr(t, m) > 0, F.instr(t, m) - 1 + len(m)) for m in FRONT])
    table = front.withColumn("start", first).filter("start IS NOT NULL").select("doc_id", "section", "start", _until(t, F.col("start"), FRONT_END, FRONT_LENGTH).alias("end"), F.lit("FRONT_TABLE").alias("role"))
    found = given.unionByName(marked).unionByName(table)
    cell = F.regexp_extract(t, FRONT_WHOLE, 1)
    whole = front.join(found.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("cell", cell).filter("cell <> ''")
    whole = whole.withColumn("start", F.instr(t, F.col("cell")) - 1).select("doc_id", "section", "start", (F.col("start") + F.length("cell")).alias("end"), F.lit("FRONT_TABLE").alias("role"))
    return merge_ranges(found.unionByName(whole), ["doc_id", "section"])


def requirement_sources(blocks: DataFrame) -> DataFrame:
    """C17: requirement rows (doc_id, page, ordinal, requirement, type, name, identity, level) of text blocks (doc_id, page, ordinal, text); a block names each requirement once."""
    head = "^(?:资质条件|资格要求|投标人资格要求)[：:]?"
    parts = F.array_distinct(F.transform(split_numbered_clauses(F.col("text")), lambda x: F.regexp_replace(x, head, "")))
    each = blocks.select("doc_id", "page", "ordinal", F.posexplode(parts).alias("part", "requirement"))
    each = each.filter((F.length("requirement") >= 4) & ~F.col("requirement").rlike(NO_REQUIREMENT))
    kind = classify_requirement(F.col("requirement"))
    rows = each.withColumn("k", kind)
    level = F.when(F.col("k.type").isin("PROFESSIONAL_QUALIFICATION", "PERSONNEL"), extract_level(F.col("requirement")))
    return rows.select("doc_id", "page", (F.col("ordinal") * 1000 + F.col("part")).alias("ordinal"), "requirement", "k.type", "k.name", "k.identity", level.alias("level"))


def requirements_of(texts: DataFrame, clauses: DataFrame) -> DataFrame:
    """C17: requirement rows of documents with their place: (doc_id, section, start, end, roles, requirement, type, name, identity, level), offsets in the section's text."""
    ranges = requirement_ranges(texts, clauses).join(texts, ["doc_id", "section"])
    blocks = ranges.withColumn("text", F.substring(F.col("view_text"), F.col("start") + 1, F.col("end") - F.col("start")))
    rows = requirement_sources(blocks.select("doc_id", F.struct("section", "start").alias("page"), F.lit(0).alias("ordinal"), "text"))
    placed = rows.join(blocks.select("doc_id", F.struct("section", "start").alias("page"), "roles", F.col("text").alias("_text")), ["doc_id", "page"])
    at = F.col("page.start") + F.instr(F.col("_text"), F.col("requirement")) - 1
    return placed.select("doc_id", "page.section", at.alias("start"), (at + F.length("requirement")).alias("end"), "roles", "requirement", "type", "name", "identity", "level")


def jcebid_requirement_sources(blocks: DataFrame, words: dict[str, str]) -> DataFrame:
    """The second rule profile: proof materials named in the text, identified by a word list."""
    pattern = "([\\u4e00-\\u9fff]{0,20}(?:" + "|".join(words) + ")[\\u4e00-\\u9fff]{0,10})"
    each = blocks.select("doc_id", "page", "ordinal", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("part", "requirement"))
    identity = F.coalesce(*[F.when(F.contains(F.col("requirement"), F.lit(w)), F.lit(i)) for w, i in words.items()])
    return each.select("doc_id", "page", (F.col("ordinal") * 1000 + F.col("part")).alias("ordinal"), "requirement", F.lit("OTHER").alias("type"), F.col("requirement").alias("name"), identity.alias("identity"), extract_level(F.col("requirement")).alias("level"))


def domain_output_defaults(docs: DataFrame, payloads: DataFrame, domains: list[str]) -> DataFrame:
    """An empty payload for each document and domain without one. payloads: (doc_id, domain, items)."""
    wanted = docs.select("doc_id").crossJoin(F.broadcast(docs.sparkSession.createDataFrame([(d,) for d in domains], "domain string")))
    kind = payloads.schema["items"].dataType
    return wanted.join(payloads, ["doc_id", "domain"], "left").withColumn("items", F.coalesce("items", F.array().cast(kind)))


def tender_result_guard(fields: DataFrame, expected: int, evidence: Column) -> DataFrame:
    """Documents whose result breaks the contract: number of distinct fields, values without evidence."""
    agg = fields.groupBy("doc_id").agg(F.count_distinct("field").alias("n"), F.count_if(F.col("value").isNotNull() & (F.coalesce(F.size(evidence), F.lit(0)) == 0)).alias("bare"))
    rules = F.array_compact(F.array(F.when(F.col("n") != expected, "wrong number of fields"), F.when(F.col("bare") > 0, "value without evidence")))
    return agg.select("doc_id", F.explode(rules).alias("rule"))
