"""Text columns: cleaning, normalised names, redaction, page text quality. All native expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TEXTS = ["", "null", "none", "unknown", "未知", "未识别", "未显示", "--", "—", "-"]
# Those of the strict reader (an empty text is null there, too).
STRICT_NULL_TEXTS = ["null", "none", "未知", "未识别", "未显示", "--", "—"]
# Patterns of control characters, sensitive numbers and certificate levels.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
WHITE = r"(?U)\s+"
PERSONAL_ID = r"(?<![0-9A-Z])[0-9]{17}[0-9Xx](?![0-9A-Z])"
PHONE = r"(?<![0-9])1[3-9][0-9]{9}(?![0-9])"
ACCOUNT = r"(?<![0-9])[0-9]{16,19}(?![0-9])"
#: Applied in this order: an 18-digit id must not count as an account.
SENSITIVE = [("PERSONAL_ID", PERSONAL_ID), ("PHONE", PHONE), ("BANK_ACCOUNT_CANDIDATE", ACCOUNT)]
DOCUMENT_NUMBER = r"(?<![0-9])(?:[0-9]{17}[0-9Xx]|[0-9]{15})(?![0-9])"
LEVEL_SUFFIX = "(特级|一级|二级|三级|甲级|乙级|丙级|不分等级|不分级)$"

# Ranges of characters with compatibility forms: Latin-1, letters, blanks, super- and subscripts, letterlike, numbers, circled, radicals, CJK signs, widths.
COMPATIBLE = [
    (0xA0, 0xBF), (0x1C4, 0x1F3), (0x2B0, 0x2B8), (0x2000, 0x200A), (0x2070, 0x209C), (0x2100, 0x217F), (0x2460, 0x24FF), (0x2E80, 0x2FD5),
    (0x3000, 0x303A), (0x32C0, 0x33FF), (0xF900, 0xFAD9), (0xFF01, 0xFFEE),
]
_FORMS = {chr(c): unicodedata.normalize("NFKC", chr(c)) for a, b in COMPATIBLE for c in range(a, b + 1)}
_WIDE = "".join(k for k, v in _FORMS.items() if len(v) == 1 and v != k)
_NARROW = "".join(_FORMS[k] for k in _WIDE)


def fold_width(c: Column) -> Column:
    """NFKC of the characters whose compatibility form is one character (widths, blanks, circled digits, radicals, compatibility ideographs ...).

    Forms of several characters and combining marks stay as they are: they have no native expression.
    """
    return F.translate(c, _WIDE, _NARROW)


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c) with c evaluated once, however often `use` names it."""
    return F.element_at(F.transform(F.array(c), use), 1)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


#: Longest of the texts that mean nothing, before their widths are folded.
_LONGEST_NULL = 8


def _cleaned(limit: int | None, shown: Column) -> Column:
    def use(x: Column) -> Column:
        null = (F.length(x) <= _LONGEST_NULL) & F.lower(fold_width(x)).isin(NULL_TEXTS)
        return F.when(~null, F.left(x, F.lit(limit)) if limit else x)

    return once(shown, use)


def clean_verbatim_text(c: Column, limit: int | None = 12000) -> Column:
    """drop control characters, collapse blanks and blank lines, trim; texts that mean nothing become null. Without a limit the whole text stays."""
    out = F.regexp_replace(F.regexp_replace(c, CONTROL, ""), r"[ \t]+", " ")
    return _cleaned(limit, strip(F.regexp_replace(out, r"\n{3,}", "\n\n")))


def clean_text(c: Column, limit: int | None = 12000) -> Column:
    """the same after width folding."""
    return clean_verbatim_text(fold_width(c), limit)


def clean_inline_text(c: Column) -> Column:
    """any white space to one blank."""
    return once(strip(F.regexp_replace(c, WHITE, " ")), lambda x: F.when((F.length(x) > _LONGEST_NULL) | ~F.lower(x).isin(NULL_TEXTS), x))


def strict_text(c: Column, limit: int = 200) -> tuple[Column, Column]:
    """(value, error); too long a text is an error and is not cut."""
    out = strip(fold_width(c))
    missing = c.isNull() | F.lower(out).isin(STRICT_NULL_TEXTS) | (out == "")
    error = F.when(~missing & (F.length(out) > limit), F.lit(f"text is longer than {limit} characters"))
    return F.when(~missing & error.isNull(), out), error


def compact(c: Column) -> Column:
    """width folded, without white space; null as ''."""
    return F.coalesce(F.regexp_replace(fold_width(c), WHITE, ""), F.lit(""))


def normalize_company_name(c: Column) -> Column:
    """F6, strict: brackets folded, no white space."""
    return F.regexp_replace(clean_text(c, 200), WHITE, "")


def award_company_name(c: Column) -> Column:
    """F6, award variant: also lower case."""
    return F.lower(compact(c))


def normalize_project_name(c: Column) -> Column:
    """without blanks, hyphens, underscores and dashes; lower case."""
    return F.lower(F.regexp_replace(F.coalesce(fold_width(c), F.lit("")), r"(?U)[\s\-_–—]+", ""))


def normalize_credit_code(c: Column) -> Column:
    """F8: 18 characters of the code alphabet, or null."""
    out = F.upper(F.regexp_replace(clean_text(c, 64), r"(?U)[\s\-]", ""))
    return F.when(out.rlike("^[0-9A-HJ-NPQRTUWXY]{18}$"), out)


# Confirmed variants of three management systems.
SYSTEM_NAMES = {
    "质量管理体系认证": ["质量管理体系认证证书", "质量管理体系认证", "建设施工行业质量管理体系认证"],
    "环境管理体系认证": ["环境管理体系认证", "环境管理体系认证证书"],
    "职业健康安全管理体系认证": ["中国职业健康安全管理体系认证", "中国职业健康安全管理体系认证证书", "职业健康安全管理体系认证", "职业健康安全管理体系认证证书"],
}


def certificate_identity_name(c: Column) -> Column:
    """without a level suffix, confirmed variants folded."""
    name = F.regexp_replace(compact(c), LEVEL_SUFFIX, "")
    out = name
    for kept, variants in SYSTEM_NAMES.items():
        out = F.when(name.isin(variants), F.lit(kept)).otherwise(out)
    return out


# Kinds of credentials, first match wins.
CREDENTIAL_KINDS = [
    ("SYSTEM_CERTIFICATION", "管理体系|体系认证"), ("BUSINESS_LICENSE", "许可证|经营许可|生产许可|行政许可"), ("INDUSTRY_QUALIFICATION", "资质|总承包|专业承包|工程设计|工程监理"),
]


def credential_kind(c: Column) -> Column:
    """ordered rules."""
    kind = F.lit("UNKNOWN")
    for name, pattern in reversed(CREDENTIAL_KINDS):
        kind = F.when(c.rlike(pattern), name).otherwise(kind)
    return kind


def level_suffix(c: Column) -> Column:
    return F.nullif(F.regexp_extract(compact(c), LEVEL_SUFFIX, 1), F.lit(""))


def redact_sensitive(c: Column) -> tuple[Column, dict[str, Column]]:
    """(redacted text, findings per type); each type is counted on the text as redacted so far."""
    found = {}
    for kind, pattern in SENSITIVE:
        found[kind] = F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0))
        c = F.regexp_replace(c, pattern, f"[{kind}_REDACTED]")
    return c, found


def mask_document_numbers(c: Column) -> Column:
    """F13."""
    return F.regexp_replace(c, DOCUMENT_NUMBER, "[证件号码已隐藏]")


def safe_error_message(c: Column, roots: list[str], secrets: list[str]) -> Column:
    """F16: without local paths and secrets, redacted, at most 1500 characters."""
    for root in sorted(roots, key=len, reverse=True):
        c = F.replace(c, F.lit(root), F.lit("[LOCAL_ROOT]"))
    for secret in secrets:
        c = F.replace(c, F.lit(secret), F.lit("<secret>"))
    return F.left(strip(redact_sensitive(c)[0]), F.lit(1500))


# What a warning about the birth date speaks of, must not speak of, and says.
BIRTH_WARNINGS = [
    r"出生日期|出生年月|person\.birth_date",
    "姓名|证书|编号|有效|发证|签发|专业|等级|单位|注册|毕业|冲突|逻辑|偏差|手写",
    r"无法.*归一化|仅.*(?:月|年月)|缺.*(?:日|日期)|未.*(?:具体|完整).*日期|归一化为[0-9]{4}-[0-9]{2}",
]


def unrelated_warning(c: Column) -> Column:
    """a warning about the birth date only."""
    about, other, vague = (c.rlike(p) for p in BIRTH_WARNINGS)
    return about & ~other & vague


def printed_page(c: Column, total: Column) -> Column:
    """the first line among the last six (from below) and first six that looks like a page number within total + 100."""
    lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")
    n = F.size(lines)
    tail = F.reverse(F.slice(lines, F.greatest(n - 5, F.lit(1)), F.lit(6)))
    numbers = F.transform(F.concat(tail, F.slice(lines, 1, 6)), lambda x: F.regexp_extract(x, r"^(?:第\s*)?[-—]?\s*([0-9]{1,4})\s*[-—]?(?:\s*页)?$", 1).try_cast("int"))
    return F.try_element_at(F.filter(numbers, lambda x: x.isNotNull() & (x >= 1) & (x <= total + 100)), F.lit(1))


# Marks that count as readable, and what counts as garbled.
READABLE = r"[^\p{L}\p{N}，。；：！？、（）()\[\]【】%￥¥.\-_/]"
GARBLED = r"[^�□■?\x00-\x1F]"


def text_readability(c: Column) -> dict[str, Column]:
    """readable ratio, garbled ratio, status, needs_ocr (12 characters, 0.55, 0.08)."""
    text = F.coalesce(c, F.lit(""))
    solid = F.regexp_replace(text, WHITE, "")
    n = F.length(solid)
    readable = F.when(n == 0, 0.0).otherwise(F.length(F.regexp_replace(solid, READABLE, "")) / n)
    garbled = F.when(n == 0, 0.0).otherwise(F.length(F.regexp_replace(solid, GARBLED, "")) / n)
    status = F.when(n < 12, "EMPTY").when((readable < 0.55) | (garbled > 0.08), "GARBLED").otherwise("READABLE")
    return {"readable_ratio": F.round(readable, 4), "garbled_ratio": F.round(garbled, 4), "text_status": status, "needs_ocr": status != "READABLE", "text_length": F.length(text)}


def split_numbered_clauses(c: Column) -> Column:
    """cut before numbering and after sentence ends, trim edge marks, drop pieces under four characters."""
    cut = F.regexp_replace(c, r"(?=(?:（[一二三四五六七八九十0-9]{1,3}）|\([0-9]{1,2}\)|[0-9]{1,2}[、.．](?![0-9])))|(?<=[；;。])", "\u0001")
    pieces = F.transform(F.split(cut, "\u0001"), lambda x: F.regexp_replace(x, r"(?U)^[\s；;，,。、.]+|[\s；;，,。、]+$", ""))
    return F.filter(pieces, lambda x: F.length(x) >= 4)


def extract_level(c: Column) -> Column:
    """a grade in a requirement."""
    return F.nullif(F.regexp_extract(c, "(特级|[一二三四壹贰叁]级|甲级|乙级|丙级)", 1), F.lit(""))


def legal_entity_name(c: Column) -> Column:
    """without page marks and label, the first company or authority name."""
    plain = F.regexp_replace(F.regexp_replace(c, r"第\s*[0-9]+\s*页", ""), r"^(?:名\s*称|招标人|采购人)[:：]\s*", "")
    name = F.regexp_extract(plain, r"([\p{IsHan}A-Za-z0-9（）()·]+?(?:有限责任公司|股份有限公司|有限公司|集团公司|公司|中心|局|委员会|大学|医院|学校))", 1)
    return F.coalesce(F.nullif(name, F.lit("")), plain)
