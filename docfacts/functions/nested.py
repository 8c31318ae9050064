"""Arrays, maps, JSON and hashes. Native expressions; schema walks happen while a plan is built."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfacts.functions.text import certificate_identity_name, clean_text, compact, redact_sensitive

SEPARATOR = "\u001f"
# Keys whose strings are dropped, and keys whose strings stay as they are.
FORBIDDEN_KEYS = ["idnumber", "identitynumber", "bankaccount", "bankcardnumber", "phonenumber", "signatureimage"]
IDENTIFIER_KEYS = [
    "creditcode", "sha256", "evidenceid", "runid", "requestid", "conflictid", "assessmentuid", "snapshotuid", "sourceref", "certno",
    "projectcode", "tendercode", "contractno", "registrationno", "applicationno", "evidencejson",
]


def string_list(c: Column, limit: int = 200, item_limit: int = 500) -> Column:
    """H1: first items, cleaned, deduplicated without regard to case, in order."""
    items = F.filter(F.transform(F.slice(c, 1, limit), lambda x: clean_text(x, item_limit)), lambda x: x.isNotNull())
    keep = lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x))
    return F.coalesce(F.aggregate(items, F.array().cast("array<string>"), keep), F.array().cast("array<string>"))


def stable_hash(*parts: Column, length: int = 64) -> Column:
    """H2: SHA-256 of the parts' JSON, cut."""
    return F.left(F.sha2(F.concat_ws(SEPARATOR, *[F.to_json(F.struct(p.alias("v"))) for p in parts]), 256), F.lit(length))


def fact_key(kind: Column, cert_no: Column, cert_name: Column, person: Column) -> Column:
    """H3: level and dates are left out on purpose."""
    return stable_hash(kind, compact(cert_no), certificate_identity_name(cert_name), F.when(kind == "personnel", compact(person)))


def entry_id(version: str, company: Column, source_hash: Column, kind: Column, index: Column) -> Column:
    """H4."""
    return stable_hash(F.lit(version), company, source_hash, kind, index)


def dropped_keys(raw_json: Column, allowed: list[str]) -> Column:
    """H5: keys of a JSON object that the allow-list doesn't have (from_json with a fixed schema prunes them)."""
    return F.array_except(F.coalesce(F.json_object_keys(raw_json), F.array().cast("array<string>")), F.array(*[F.lit(a) for a in allowed]))


def remap_refs(refs: Column, mapping: Column) -> Column:
    """H6: an empty target removes the reference."""
    return F.filter(F.transform(refs, lambda x: F.coalesce(F.try_element_at(mapping, x), x)), lambda x: x != "")


def filter_certificate_evidence(evidence: Column) -> Column:
    """H7: evidence (field, text) of the fields that may be kept, masked."""
    from docfacts.functions.text import mask_document_numbers

    field = lambda e: F.coalesce(e["field"], F.lit(""))
    kept = F.filter(evidence, lambda e: field(e).rlike(r"^(company\.(name|unified_social_credit_code)|person\.(name|company_name|position|title)|qualifications\[|certificates\[)") & ~field(e).rlike("id_number|birth|gender"))
    return F.transform(kept, lambda e: F.struct(e["field"].alias("field"), mask_document_numbers(e["text"]).alias("text")))


def _cells(value: Column, kind: T.DataType, path: str) -> Column:
    """Array of (path, value) of all scalar fields below a value; arrays of structs are entered as `path[]`."""
    if isinstance(kind, T.StructType):
        parts = [_cells(value.getField(f.name), f.dataType, f"{path}.{f.name}" if path else f.name) for f in kind.fields]
        return F.concat(*parts) if parts else F.array().cast("array<struct<path:string,value:string>>")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        inner = F.flatten(F.transform(value, lambda x: _cells(x, kind.elementType, path + "[]")))
        return F.coalesce(inner, F.array().cast("array<struct<path:string,value:string>>"))
    text = F.to_json(value) if isinstance(kind, (T.ArrayType, T.MapType)) else value.cast("string")
    return F.array(F.struct(F.lit(path).alias("path"), text.alias("value")))


def walk_fields(df: DataFrame, key: str) -> DataFrame:
    """H8: (key, path, value) of every scalar field that is not null; arrays of structs give one row an element. One pass: a row's cells are one array."""
    cells = F.concat(*[_cells(F.col(f.name), f.dataType, f.name) for f in df.schema.fields if f.name != key])
    return df.select(key, F.explode(cells).alias("c")).select(key, "c.path", "c.value").filter("value IS NOT NULL")


def present(c: Column, kind: T.DataType) -> Column:
    """H9: neither null nor empty."""
    if isinstance(kind, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def add_warnings(warnings: Column, *more: Column) -> Column:
    """Append what is not there yet, cleaned to 500 characters."""
    base = F.coalesce(warnings, F.array().cast("array<string>"))
    return F.array_distinct(F.array_compact(F.concat(base, F.array(*[clean_text(m, 500) for m in more]))))


def names_of(c: Column) -> Column:
    """Cleaned names of a list of (name, value)."""
    return F.filter(F.transform(c, lambda x: clean_text(F.coalesce(x["name"], x["value"]))), lambda x: x.isNotNull())


def _rewrite(value: Column, kind: T.DataType, key: str, leaf: Callable[[Column, str], Column], drop: Callable[[str], bool]) -> Column:
    if isinstance(kind, T.StructType):
        fields = [
            (F.lit(None).cast(f.dataType) if drop(f.name) else _rewrite(value.getField(f.name), f.dataType, f.name, leaf, drop)).alias(f.name)
            for f in kind.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _rewrite(x, kind.elementType, key, leaf, drop))
    return leaf(value, key) if isinstance(kind, T.StringType) else value


def _plain(key: str) -> str:
    return key.replace("_", "").lower()


def sanitize_output(df: DataFrame) -> DataFrame:
    """null forbidden keys at any depth and redact all strings except identifiers."""

    def leaf(value: Column, key: str) -> Column:
        k = _plain(key)
        return value if k in IDENTIFIER_KEYS or k.endswith(("key", "refs")) else redact_sensitive(value)[0]

    drop = lambda name: _plain(name) in FORBIDDEN_KEYS
    return df.select(*[(F.lit(None).cast(f.dataType) if drop(f.name) else _rewrite(F.col(f.name), f.dataType, f.name, leaf, drop)).alias(f.name) for f in df.schema.fields])


def drop_person_names(df: DataFrame) -> DataFrame:
    """null every person name at any depth."""
    drop = lambda name: _plain(name) == "personname"
    return df.select(*[(F.lit(None).cast(f.dataType) if drop(f.name) else _rewrite(F.col(f.name), f.dataType, f.name, lambda v, _: v, drop)).alias(f.name) for f in df.schema.fields])


def stored_certificate_value(value: Column, entry: Column, batch: Column, target: Column, key: Column, action: Column) -> Column:
    """The stored value with import metadata; history entries can't serve decisions."""
    return F.struct(
        value.alias("value"),
        F.struct(
            entry.alias("entry_id"), batch.alias("batch_uid"), target.alias("target_id"), key.alias("fact_key"), F.lit(False).alias("decision_eligible"),
            (action == "HISTORY").alias("history_only"), F.concat(F.lit("import:"), entry).alias("source_ref"),
        ).alias("certificate_import"),
    )
