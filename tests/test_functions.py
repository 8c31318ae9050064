"""Golden cases of the column functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docfacts.functions import nested as N
from docfacts.functions import text as T
from docfacts.functions import values as V

AS_OF = dt.date(2026, 1, 15)


def one(spark, column, **values):
    names = list(values)
    kinds = {str: "string", int: "int", dt.date: "date", float: "double", type(None): "string", list: "array<string>"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {kinds[type(values[n])]}" for n in names))
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("days, want", [(-1, "EXPIRED"), (0, "EXPIRING"), (90, "EXPIRING"), (91, "VALID")])
def test_certificate_status(spark, days, want):
    day = AS_OF + dt.timedelta(days)
    assert one(spark, V.certificate_status(F.lit(None).cast("date"), F.col("d"), F.lit(None).cast("string"), F.lit(AS_OF)), d=day) == want


def test_certificate_status_precedence(spark):
    d = dt.date(2030, 1, 1)
    assert one(spark, V.certificate_status(F.lit(None).cast("date"), F.col("d"), F.lit("revoked"), F.lit(AS_OF)), d=d) == "REVOKED"
    assert one(spark, V.certificate_status(F.col("d"), F.col("d"), F.lit("VALID"), F.lit(AS_OF)), d=d) == "UNKNOWN"


@pytest.mark.parametrize("days, want", [(-1, "EXPIRED"), (10, "EXPIRING"), (181, "VALID")])
def test_expiry_status(spark, days, want):
    assert one(spark, V.expiry_status(F.col("d"), F.lit(AS_OF), 180), d=AS_OF + dt.timedelta(days)) == want


@pytest.mark.parametrize("text, want", [("1,234.5万元", "12345000.00"), ("3亿元", "300000000.00"), ("贰佰壹拾肆万伍仟捌佰贰拾元整", "2145820.00"), ("壹佰元伍角贰分", "100.52"), ("12万5千", None), ("无", None)])
def test_money(spark, text, want):
    assert one(spark, V.parse_money(F.col("t")), t=text) == (Decimal(want) if want else None)


@pytest.mark.parametrize("text, want", [("2099年1月1日", dt.date(2099, 1, 1)), ("2024-02-30", None), ("2024/2/29", dt.date(2024, 2, 29)), ("2024.12.1", dt.date(2024, 12, 1)), ("2024", None)])
def test_date(spark, text, want):
    assert one(spark, V.normalize_date(F.col("t")), t=text) == want


def test_redaction_order(spark):
    redacted, found = T.redact_sensitive(F.col("t"))
    row = one(spark, F.struct(redacted.alias("r"), *[v.alias(k) for k, v in found.items()]), t="id 110101199001011234 tel 13812345678 acc 6222021234567890123")
    assert (row["PERSONAL_ID"], row["PHONE"], row["BANK_ACCOUNT_CANDIDATE"]) == (1, 1, 1)
    assert row["r"] == "id [PERSONAL_ID_REDACTED] tel [PHONE_REDACTED] acc [BANK_ACCOUNT_CANDIDATE_REDACTED]"


def test_text(spark):
    assert one(spark, T.clean_text(F.col("t")), t=" Ａ\tＢ\n\n\n\nｃ　") == "A B\n\nc"
    assert one(spark, T.clean_text(F.col("t")), t=" 未识别 ") is None
    assert one(spark, T.normalize_company_name(F.col("t")), t="某 公司（北京）") == "某公司(北京)"
    assert one(spark, T.normalize_project_name(F.col("t")), t="A-b_C — d") == "abcd"
    assert one(spark, T.normalize_credit_code(F.col("t")), t="91110000-100000000A") == "91110000100000000A"
    assert one(spark, T.certificate_identity_name(F.col("t")), t="环境管理体系认证证书") == "环境管理体系认证"
    assert one(spark, T.credential_kind(F.col("t")), t="安全生产许可证") == "BUSINESS_LICENSE"
    assert one(spark, T.printed_page(F.col("t"), F.lit(10)), t="head\nbody\n- 12 -") == 12
    assert one(spark, T.split_numbered_clauses(F.col("t")), t="（1）具有独立法人资格；（2）财务状况良好。") == ["（1）具有独立法人资格", "（2）财务状况良好"]


def test_arrays(spark):
    assert one(spark, N.string_list(F.col("t")), t=["a", " A ", None, "b", "none"]) == ["a", "b"]
    assert one(spark, N.add_warnings(F.col("t"), F.lit("x"), F.lit("y")), t=["x"]) == ["x", "y"]
    assert len(one(spark, N.stable_hash(F.col("t"), length=24), t="a")) == 24


def test_confidence(spark):
    for text, want in (("95", 0.95), ("0.5", 0.5), ("x", 0.0), ("-1", 0.0)):
        assert one(spark, V.normalize_confidence(F.col("t"))[0], t=text) == want


def test_nested_rewrites(spark):
    df = spark.createDataFrame([(1, ("13812345678", "110"), [("n", "13812345678")])], "id int, a struct<note:string,id_number:string>, b array<struct<person_name:string,cert_no:string>>")
    row = N.sanitize_output(df).first()
    assert row["a"]["note"] == "[PHONE_REDACTED]" and row["a"]["id_number"] is None and row["b"][0]["cert_no"] == "13812345678"
    assert N.drop_person_names(df).first()["b"][0]["person_name"] is None
