"""Rule classification and requirement types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Page types with their patterns, in the order in which ties are decided.
PAGE_TYPES = [
    ("TABLE_OF_CONTENTS", [r"目\s*录", r"contents"]),
    ("BUSINESS_LICENSE", ["营业执照", "统一社会信用代码", "法定代表人"]),
    ("COMPANY_PROFILE", ["投标人基本情况", "企业基本情况", "公司简介"]),
    ("QUALIFICATION_CERTIFICATE", ["资质证书", "建筑业企业资质", "认证证书", "高新技术企业"]),
    ("INTELLECTUAL_PROPERTY_CERTIFICATE", ["软件著作权", "计算机软件著作权", "专利证书", "商标注册证"]),
    ("SOCIAL_INSURANCE", ["社会保险", "社保缴费", "参保证明"]),
    ("PERSONNEL_CERTIFICATE", ["注册证书", "执业资格证", "专业技术资格", "安全生产考核合格"]),
    ("PERSONNEL_RESUME", ["人员简历", "项目经理简历", "主要人员简历", "拟投入.*人员"]),
    ("AWARD_NOTICE", ["中标通知书", "成交通知书"]),
    ("ACCEPTANCE_REPORT", ["验收报告", "竣工验收", "验收意见", "验收证书"]),
    ("CONTRACT", ["合同协议书", "合同书", r"甲\s*方", r"乙\s*方", "合同金额"]),
    ("INVOICE", ["增值税.*发票", "发票号码", "价税合计"]),
    ("PERFORMANCE_SUMMARY", ["类似项目业绩", "已完成项目", "在建项目", "业绩一览表"]),
    ("AUDIT_REPORT", ["审计报告", "资产负债表", "利润表", "现金流量表"]),
    ("CREDIT_REPORT", ["信用报告", "信用中国", "企业信用信息公示"]),
    ("LITIGATION_STATEMENT", ["诉讼", "仲裁", "被执行人", "失信被执行"]),
    ("TAX_CERTIFICATE", ["纳税证明", "完税证明", "税收缴款"]),
    ("PRODUCT_CERTIFICATE", ["产品认证证书", "检测报告", "检验报告", "厂家授权"]),
    ("PRODUCT_SPECIFICATION", ["技术参数", "产品参数", "设备参数", "规格型号"]),
    ("IMPLEMENTATION_PLAN", ["实施方案", "施工组织", "进度计划"]),
    ("QUALITY_PLAN", ["质量保证", "质量管理", "质量控制"]),
    ("AFTER_SALES_PLAN", ["售后服务", "运维服务", "服务承诺"]),
    ("TRAINING_PLAN", ["培训方案", "培训计划"]),
    ("ACCEPTANCE_PLAN", ["验收方案", "验收计划"]),
    ("RISK_PLAN", ["风险管理", "应急预案"]),
    ("TECHNICAL_SOLUTION", ["技术方案", "系统架构", "功能设计", "总体设计"]),
    ("PRICE_SCHEDULE", ["报价一览表", "投标报价", "分项报价"]),
    ("COMMERCIAL_DEVIATION", ["商务偏离表"]),
    ("TECHNICAL_DEVIATION", ["技术偏离表"]),
    ("BID_GUARANTEE", ["投标保证金", "保函"]),
    ("AUTHORIZATION", ["授权委托书", "法定代表人授权"]),
    ("LEGAL_REPRESENTATIVE", ["法定代表人身份证明"]),
    ("BID_LETTER", ["投标函", "投标书"]),
    ("COVER", ["投标文件", "正本", "副本"]),
]
# Domains of a page type.
DOMAINS = {
    "enterprise": ["COVER", "LEGAL_REPRESENTATIVE", "AUTHORIZATION", "BUSINESS_LICENSE", "COMPANY_PROFILE", "CREDIT_REPORT", "AUDIT_REPORT"],
    "qualifications": ["QUALIFICATION_CERTIFICATE"],
    "intellectual_properties": ["INTELLECTUAL_PROPERTY_CERTIFICATE"],
    "finance": ["AUDIT_REPORT"],
    "risk": ["CREDIT_REPORT", "LITIGATION_STATEMENT", "TAX_CERTIFICATE"],
    "personnel": ["PERSONNEL_RESUME", "PERSONNEL_CERTIFICATE", "SOCIAL_INSURANCE"],
    "performances": ["PERFORMANCE_SUMMARY", "CONTRACT", "ACCEPTANCE_REPORT", "AWARD_NOTICE"],
    "products": ["PRODUCT_CERTIFICATE", "PRODUCT_SPECIFICATION"],
    "solutions": ["TECHNICAL_SOLUTION"],
    "delivery": ["IMPLEMENTATION_PLAN", "QUALITY_PLAN", "RISK_PLAN", "AFTER_SALES_PLAN", "TRAINING_PLAN", "ACCEPTANCE_PLAN"],
    "bid": ["BID_LETTER", "BID_GUARANTEE", "COMMERCIAL_DEVIATION", "TECHNICAL_DEVIATION", "PRICE_SCHEDULE"],
}


def best_type(text: Column, rules: list[tuple[str, list[str]]] = PAGE_TYPES, preview: int | None = 12000) -> Column:
    """Struct (s, o, t) of the type with most matching patterns, the first one on ties; with a preview only so many characters count."""
    head = F.coalesce(text, F.lit(""))
    head = F.left(head, F.lit(preview)) if preview else head
    scored = []
    for k, (name, patterns) in enumerate(rules):
        score = sum((head.rlike(f"(?i){p}").cast("int") for p in patterns[1:]), head.rlike(f"(?i){patterns[0]}").cast("int"))
        scored.append(F.struct(score.alias("s"), F.lit(-k).alias("o"), F.lit(name).alias("t")))
    return F.array_max(F.array(*scored))


def classify_pages(pages: DataFrame, text: str = "text", rules: list[tuple[str, list[str]]] = PAGE_TYPES, preview: int | None = 12000) -> DataFrame:
    """Adds document_type, classification_confidence and score. The best type is a column of its own, so that patterns are tried once."""
    s = F.col("_best")["s"]
    return pages.withColumn("_best", best_type(F.col(text), rules, preview)).select(
        *pages.columns,
        F.when(s > 0, F.col("_best")["t"]).otherwise("OTHER").alias("document_type"),
        F.when(s >= 2, "HIGH").when(s == 1, "MEDIUM").otherwise("LOW").alias("classification_confidence"),
        s.alias("score"),
    )


def routes(spark) -> DataFrame:
    """C4's fixed table (document_type, domain)."""
    return spark.createDataFrame([(t, d) for d, types in DOMAINS.items() for t in types], "document_type string, domain string")


# Fixed value: a professional qualification by name.
QUALIFICATION = (
    "([\u4e00-\u9fff]{2,30}(?:施工总承包|专业承包|设计资质|勘察资质|监理资质|工程咨询|工程设计|工程勘察)"
    "[\u4e00-\u9fff甲乙丙壹贰叁一二三级综合行业专项]*资质?)"
)
# Requirement types in order, with the pattern that decides, name, and identities with the words they ask for (the last asks for none).
REQUIREMENTS = [
    ("FINANCIAL", "投融资能力|资金筹措|净资产不低于|融资能力", "投融资能力要求", [("", "financing_capacity")]),
    ("FINANCIAL", "财务会计制度|财务|审计报告|资产负债|流动比率|破产|亏损", "财务要求", [("", "financial")]),
    ("BASIC", "依法设立|依法注册|独立承担民事责任", "基本资格要求", [("", "legal_person")]),
    ("CONSORTIUM", "联合体", "联合体要求", [("", "consortium")]),
    ("REGIONAL_ACCESS", "省外|外省|入晋|入省|跨省|外地企业", "省外企业平台准入", [("截图|登记|备案", "regional_registration"), ("", "regional_platform")]),
    ("AUTHORIZATION", "授权委托|法定代表人身份证|被授权人身份证", "授权委托及身份证明", [("", "authorization")]),
    ("BANK_ACCOUNT", "基本账户|基本存款账户|开户许可证", "基本账户证明", [("", "bank_account")]),
    ("LICENCE", "许可证", None, [("", "licence:")]),
    (
        "CREDIT",
        "信用中国|失信被执行人|严重违法失信|信用信息公示|行贿犯罪|黑名单|信用评价|不良行为记录|商业信誉|被责令停业|吊销执照|不良信用记录|不良状况|重大违法记录|取消.+投标资格",
        "信用及失信限制", [("行贿", "credit_bribery"), ("", "credit_platform")],
    ),
    ("PERFORMANCE", "业绩|类似项目|合同额|累计完成", "业绩要求", [("", "performance:")]),
    (
        "RELATIONSHIP", "单位负责人|控股|管理关系|利害关系|关联关系|投资参股|运营机构.+?投标", "关联关系限制",
        [("平台|运营机构", "platform_relationship"), ("", "ownership_relationship")],
    ),
    ("PERSONNEL", "项目经理|项目负责人|技术负责人|设计负责人|施工负责人|总监理工程师|建造师|拟派人员|社保", None, [("", "personnel:")]),
    ("PROFESSIONAL_QUALIFICATION", f"{QUALIFICATION}|资质证书|资质等级|相应资质", "企业专业资质", [("", "qualification:")]),
    (
        "BASIC",
        "独立法人|法人资格|营业执照|依法设立|依法注册|实施能力|施工能力|承担能力|独立承担民事责任|履行合同所必需|依法缴纳税收|社会保障资金|法律、行政法规规定",
        "基本资格要求",
        [
            ("营业执照", "business_license"), ("独立承担民事责任", "civil_liability"), ("缴纳税收|社会保障资金", "tax_social_security"),
            ("履行合同所必需", "contract_capacity"), ("能力", "implementation_capacity"), ("", "legal_person"),
        ],
    ),
]
# Captures that complete an identity, and names that depend on it.
CAPTURES = {
    "licence:": "([\u4e00-\u9fff]{0,12}许可证)", "performance:": "(企业|投标人|项目经理|项目负责人|设计负责人|总监)",
    "personnel:": "(项目经理|项目负责人|技术负责人|设计负责人|施工负责人|总监理工程师|建造师)",
    "qualification:": QUALIFICATION,
}
NAMES = {"regional_registration": "省外登记备案"}
REQUIREMENT_TYPES = [*dict.fromkeys(r[0] for r in REQUIREMENTS), "OTHER"]


def normalized_requirement(c: Column) -> Column:
    out = F.regexp_replace(c, r"(?U)[\s，,。；;：:（）()\[\]【】]", "")
    return F.replace(F.replace(out, F.lit("应当"), F.lit("须")), F.lit("应"), F.lit("须"))


def classify_requirement(text: Column) -> Column:
    """Struct of type, name and identity, by the first pattern found; where nothing is captured a hash of the normalised text identifies."""
    c = F.coalesce(text, F.lit(""))
    digest = lambda n: F.left(F.sha2(normalized_requirement(c), 256), F.lit(n))
    answer = lambda kind, name, identity: F.struct(F.lit(kind).alias("type"), name.alias("name"), identity.alias("identity"))
    out = answer("OTHER", F.lit("其他资格要求"), F.concat(F.lit("other:"), digest(12)))
    for kind, pattern, name, identities in reversed(REQUIREMENTS):
        own = None
        for words, identity in reversed(identities):
            if identity in CAPTURES:
                got = F.nullif(F.regexp_extract(c, CAPTURES[identity], 1), F.lit(""))
                tail = normalized_requirement(got) if identity == "qualification:" else got
                key = F.concat(F.lit(identity), F.coalesce(tail, F.lit("bidder") if identity == "performance:" else digest(10)))
                one = answer(kind, F.lit(name) if name else F.coalesce(got, F.lit("人员要求")), key)
            else:
                one = answer(kind, F.lit(NAMES.get(identity, name)), F.lit(identity))
            own = one if own is None else F.when(c.rlike(words), one).otherwise(own)
        out = F.when(c.rlike(pattern), own).otherwise(out)
    return out
