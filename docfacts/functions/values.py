"""Dates, validity, numbers, money, confidences and enumerations. Native expressions only; invalid input gives null, never an error."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from docfacts.functions.text import clean_text, fold_width, once

MONEY = "decimal(20,2)"
# Fixed value: notations of a date.
DATE_PATTERN = r"^([0-9]{4})\s*(?:年|[-./])\s*([0-9]{1,2})\s*(?:月|[-./])\s*([0-9]{1,2})\s*日?$"


def _calendar(text: Column, pattern: str) -> Column:
    """The date of a text that fits; its three numbers are joined by one replacement, and what does not fit stays no date."""
    return F.try_to_date(once(text, lambda x: F.when(x.rlike(pattern), F.regexp_replace(x, pattern, "$1-$2-$3"))), "y-M-d")


def normalize_date(c: Column) -> Column:
    """A date of one of four notations; what the calendar doesn't have is null."""
    return _calendar(clean_text(c, 32), DATE_PATTERN)


def normalize_date_keep(c: Column, field: str) -> tuple[Column, Column]:
    """(ISO date or the original text, warning if it could not be read)."""
    day = normalize_date(c)
    return F.coalesce(day.cast("string"), clean_text(c)), F.when(clean_text(c).isNotNull() & day.isNull(), F.lit(f"{field}: date could not be normalised"))


def strict_date(c: Column) -> tuple[Column, Column]:
    """D3: (date, error)."""
    text = clean_text(c, 64)
    day = _calendar(text, r"^([0-9]{4})[-/.年]([0-9]{1,2})[-/.月]([0-9]{1,2})日?$")
    return day, F.when(text.isNotNull() & day.isNull(), F.lit("not a plain calendar date"))


def tender_datetime(c: Column) -> Column:
    """All dates (with times) of a text as `a至b`; null if one of them is invalid or none is there."""
    pattern = r"([0-9]{4})[年/.-]([0-9]{1,2})[月/.-]([0-9]{1,2})日?(?:\s*([0-9]{1,2})[:：时点]([0-9]{1,2})?)?"
    parts = F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))

    def canonical(x: Column) -> Column:
        day = F.try_to_date(F.concat_ws("-", *[F.regexp_extract(x, pattern, i) for i in (1, 2, 3)]), "y-M-d")
        hour, minute = F.regexp_extract(x, pattern, 4), F.regexp_extract(x, pattern, 5)
        clock = F.concat(F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":"), F.lpad(F.when(minute == "", "00").otherwise(minute), 2, "0"))
        valid = (hour == "") | (hour.try_cast("int").between(0, 24) & (F.coalesce(minute.try_cast("int"), F.lit(0)) < 60))
        return F.when(day.isNotNull() & valid, F.concat(day.cast("string"), F.when(hour == "", "").otherwise(clock)))

    found = F.transform(parts, canonical)
    return F.when((F.size(found) > 0) & F.forall(found, lambda x: x.isNotNull()), F.array_join(F.array_distinct(found), "至"))


def validity_status(valid_from: Column, expiry: Column, as_of: Column) -> Column:
    """D5."""
    return F.when(expiry < as_of, "EXPIRED").when(valid_from > as_of, "NOT_YET_VALID").when(expiry.isNotNull(), "VALID").otherwise("UNKNOWN")


def certificate_status(issue: Column, expiry: Column, reported: Column, as_of: Column, soon: int = 90) -> Column:
    """A revocation wins; a future issue date is unknown; otherwise by expiry, else as reported."""
    return (
        F.when(F.upper(reported) == "REVOKED", "REVOKED").when(issue > as_of, "UNKNOWN").when(expiry < as_of, "EXPIRED")
        .when(expiry <= F.date_add(as_of, soon), "EXPIRING").when(expiry.isNotNull(), "VALID")
        .when(reported.isin("VALID", "EXPIRING", "EXPIRED", "UNKNOWN"), reported).otherwise("UNKNOWN")
    )


def expiry_status(expiry: Column, as_of: Column, days: int | None = None) -> Column:
    """EXPIRING only if days is given."""
    out = F.when(expiry.isNull(), "UNKNOWN").when(expiry < as_of, "EXPIRED")
    if days is not None:
        out = out.when(expiry <= F.date_add(as_of, days), "EXPIRING")
    return out.otherwise("VALID")


def within_last_years(day: Column, as_of: Column, years: int = 3) -> Column:
    """29 February counts back to 28 February."""
    return day.between(F.add_months(as_of, -12 * years), as_of)


def date_consistency(issue: Column, valid_from: Column, expiry: Column, as_of: Column) -> Column:
    """Reasons."""
    return F.array_compact(F.array(
        F.when(issue > as_of, "issue date lies ahead"), F.when(issue > expiry, "issue date after expiry"), F.when(valid_from > expiry, "start after expiry"),
    ))


def finite_signed_number(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast("decimal(38,6)")


def finite_number(c: Column) -> Column:
    """Not negative."""
    n = finite_signed_number(c)
    return F.when(n >= 0, n)


def plain_number(n: Column) -> Column:
    """A decimal without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(n.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def award_amount(c: Column) -> tuple[Column, Column]:
    """(amount, issue)."""
    text = F.replace(F.regexp_replace(fold_width(c), r"(?U)\s+", ""), F.lit(","), F.lit(""))
    n = F.when(text.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), text.try_cast("decimal(20,4)"))
    issue = F.when(c.isNull() | (text == ""), "amount is empty").when(n.isNull(), "amount is no plain number").when(n < 0, "amount is negative")
    return F.when(issue.isNull(), n), issue


def parse_arabic_money(c: Column) -> Column:
    """Number and unit, in yuan."""
    text = F.replace(fold_width(c), F.lit(","), F.lit(""))
    pattern = r"(?<![0-9])([0-9]+(?:\.[0-9]+)?)\s*(亿元|万元|万|千元|元)(?![0-9万亿])"

    def use(found: Column) -> Column:  # number and unit as one text
        times = F.when(found.endswith("亿元"), 100000000).when(found.endswith("万元") | found.endswith("万"), 10000).when(found.endswith("千元"), 1000).otherwise(1)
        return (F.regexp_extract(found, r"^[0-9.]+", 0).try_cast("decimal(18,4)") * times).try_cast(MONEY)

    return once(F.nullif(F.regexp_extract(text, pattern, 0), F.lit("")), use)


# Numerals and units.
DIGITS = {c: i for i, pair in enumerate(["零〇", "一壹", "二贰", "三叁", "四肆", "五伍", "六陆", "七柒", "八捌", "九玖"]) for c in pair}
SMALL = {"十": 10, "拾": 10, "百": 100, "佰": 100, "千": 1000, "仟": 1000}
BIG = {"万": 10_000, "萬": 10_000, "亿": 100_000_000, "億": 100_000_000}


def parse_chinese_money(c: Column) -> Column:
    """Numerals folded from left to right into (total, section, digit)."""
    numerals = "".join([*DIGITS, *SMALL, *BIG])
    digits = "".join(DIGITS)
    text = F.regexp_replace(fold_width(c), r"(?U)[人民币￥¥\s,，]", "")
    pattern = f"([{numerals}]+)元((?:[{digits}][角分]){{0,2}})(?:整|正)?"
    table = lambda d: F.create_map(*[F.lit(x) for x in chain(*d.items())])
    digit, small, big = table(DIGITS), table(SMALL), table(BIG)
    zero = F.struct(*[F.lit(0).cast("long").alias(k) for k in ("total", "section", "number")])

    def step(s: Column, x: Column) -> Column:
        d, u, b = (F.try_element_at(t, x).cast("long") for t in (digit, small, big))
        unit = F.when(s["number"] == 0, F.lit(1)).otherwise(s["number"])
        nil = F.lit(0).cast("long")
        return F.struct(
            F.when(b.isNotNull(), s["total"] + (s["section"] + s["number"]) * b).otherwise(s["total"]).alias("total"),
            F.when(b.isNotNull(), nil).when(u.isNotNull(), s["section"] + unit * u).otherwise(s["section"]).alias("section"),
            F.when(d.isNotNull(), d).otherwise(nil).alias("number"),
        )

    chars = F.filter(F.split(F.regexp_extract(text, pattern, 1), ""), lambda x: x != "")
    whole = F.aggregate(chars, zero, step, lambda s: s["total"] + s["section"] + s["number"])
    rest = F.regexp_extract(text, pattern, 2)
    of = lambda unit: F.coalesce(F.try_element_at(digit, F.regexp_extract(rest, f"([{digits}]){unit}", 1)), F.lit(0))
    return F.when(text.rlike(pattern), whole.cast(MONEY) + (of("角") / F.lit(10).cast("decimal(4,0)") + of("分") / F.lit(100).cast("decimal(4,0)")).cast(MONEY)).cast(MONEY)


def parse_money(c: Column) -> Column:
    return F.coalesce(parse_arabic_money(c), parse_chinese_money(c))


def normalize_money(raw: Column, amount: Column | None = None, currency: Column | None = None, unit: Column | None = None) -> Column:
    """Struct of amount, currency, raw text, raw unit and the rule that gave the amount."""
    given = finite_number(amount).cast(MONEY) if amount is not None else F.lit(None).cast(MONEY)
    money = F.coalesce(clean_text(currency, 8), F.lit("CNY")) if currency is not None else F.lit("CNY")
    name = clean_text(unit, 32) if unit is not None else F.lit(None).cast("string")

    def value(text: Column, parsed: Column) -> Column:
        rule = F.when(given.isNull() & parsed.isNotNull(), "MONEY_TEXT_TO_YUAN")
        fields = {"amount_yuan": F.coalesce(given, parsed), "currency": money, "raw_text": text, "raw_unit": name, "normalization_rule": rule}
        return F.when(given.isNotNull() | text.isNotNull(), F.struct(*[c.alias(k) for k, c in fields.items()]))

    return once(clean_text(raw, 200), lambda text: once(parse_money(text), lambda parsed: value(text, parsed)))


def normalize_confidence(c: Column) -> tuple[Column, Column]:
    """(confidence in 0..1 to four places, warning)."""
    n = c.try_cast("double")
    bad = n.isNull() | F.isnan(n) | (F.abs(n) == float("inf"))
    scaled = F.when((n > 1) & (n <= 100), n / 100).otherwise(n)
    value = F.when(bad, 0.0).otherwise(F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)).cast("decimal(20,12)"), 4).cast("double"))
    return value, F.when(bad, "confidence missing or not finite").when((n > 1) & (n <= 100), "confidence given in per cent").when((n < 0) | (n > 100), "confidence out of range")


def normalize_enum(c: Column, allowed: list[str], fallback: str, aliases: dict[str, str] | None = None) -> Column:
    """N7."""
    text = clean_text(c, 100)
    out = F.upper(text)
    if aliases:
        out = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*aliases.items())]), F.lower(text)), out)
    return F.when(out.isin(allowed), out).otherwise(fallback)


# Names under which employee certificates are reported.
EMPLOYEE_TYPES = {a: "employee_certificate" for a in ["employee_certificate", "员工证书", "人员证书", "职业资格证书", "执业资格证书", "注册证书", "职称证书", "安全生产考核证书"]} | {"其他文档": "unknown", "unknown": "unknown"}


def normalize_document_type(c: Column, aliases: dict[str, str] = EMPLOYEE_TYPES) -> tuple[Column, Column]:
    """(type, warning if the reported type is not known)."""
    text = clean_text(c, 100)
    found = F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*aliases.items())]), F.lower(text))
    return F.coalesce(found, F.lit("unknown")), F.when(text.isNotNull() & found.isNull(), F.concat(F.lit("unknown document type: "), text))
