"""Entity families: allow-lists with pruning (H5), normalisers (H11) and the domain merge (A4).

A family is a tree of fields with the way each one is cleaned. The same tree
gives the schema that raw JSON is read with (fields outside of it are dropped
and named, at any depth), the normaliser, and the plan of the nested merge, so
the three never differ. Names are those of the extracted JSON.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from docfacts.functions.nested import stable_hash, string_list
from docfacts.functions.text import clean_text, clean_verbatim_text, normalize_company_name, normalize_credit_code, once
from docfacts.functions.values import certificate_status, finite_number, finite_signed_number, normalize_date, normalize_enum, normalize_money, parse_arabic_money
from docfacts.operators.joins import resolve_refs, subject_match
from docfacts.operators.merge import dealt, identity_hash, merge_nested, resolve_entities
from docfacts.storage import written


@dataclass(frozen=True)
class Kind:
    """How a field is read from JSON and cleaned."""

    raw: str
    clean: Callable[[Column], Column]


@dataclass(frozen=True)
class Items:
    """A list of objects with these fields."""

    fields: dict


def text(limit: int = 12000) -> Kind:
    return Kind("string", lambda c: clean_text(c, limit))


def strings(limit: int, each: int) -> Kind:
    return Kind("array<string>", lambda c: string_list(c, limit, each))


def enum(allowed: str, fallback: str, aliases: dict[str, str] | None = None) -> Kind:
    return Kind("string", lambda c: normalize_enum(c, allowed.split(), fallback, aliases))


DAY, NUMBER, SIGNED = Kind("string", normalize_date), Kind("string", finite_number), Kind("string", finite_signed_number)
FLAG, REFS = Kind("boolean", lambda c: c), Kind("array<string>", lambda c: F.coalesce(F.array_sort(F.array_distinct(F.array_compact(c))), F.array().cast("array<string>")))
TEXT = text()
PERFORMED = "AWARDED CONTRACTED ONGOING COMPLETED ACCEPTED UNKNOWN"
YEAR = Kind("string", lambda c: F.when(finite_number(c).between(1900, 2200), finite_number(c).cast("int")))

# The fields of every family, their lengths and legal values.
CONTRACT = {
    "contractNo": TEXT, "contractName": TEXT, "amountYuan": NUMBER, "rawAmountText": text(200), "rawUnit": TEXT, "currency": TEXT, "signDate": DAY,
    "startDate": DAY, "plannedEndDate": DAY, "actualEndDate": DAY, "contractContent": text(20000), "performanceStatus": enum(PERFORMED, "UNKNOWN"), "evidenceRefs": REFS,
}
PERSON_CERTIFICATE = {
    "certName": TEXT, "certNo": TEXT, "qualificationType": TEXT, "certLevel": TEXT, "profession": TEXT, "additionalProfessions": strings(20, 128),
    "issuingAuthority": TEXT, "issueDate": DAY, "validFrom": DAY, "expiryDate": DAY, "registrationStatus": TEXT, "scope": TEXT, "evidenceRefs": REFS,
}
EMPLOYMENT = {"asOfDate": DAY, "hasSocialInsuranceEvidence": FLAG, "currentEmploymentConfirmed": Kind("boolean", lambda c: F.coalesce(c, F.lit(False))), "evidenceRefs": REFS}
PROPERTY_STATUS = {
    "有效": "VALID", "授权": "ACTIVE", "已授权": "ACTIVE", "登记": "ACTIVE", "已登记": "ACTIVE", "申请中": "PENDING", "审核中": "PENDING", "已过期": "EXPIRED",
    "失效": "INVALID", "无效": "INVALID", "撤销": "REVOKED", "已撤销": "REVOKED",
}
PERFORMANCE_STATUS = {"已中标": "AWARDED", "已签约": "CONTRACTED", "在建": "ONGOING", "进行中": "ONGOING", "已完成": "COMPLETED", "已验收": "ACCEPTED"}


def claim(categories: str) -> dict:
    return {
        "category": enum(categories, "OTHER"), "name": TEXT, "description": TEXT, "keywords": strings(100, 100),
        "claimType": Kind("string", lambda c: F.lit("DECLARED")), "supportedByPerformanceRefs": REFS,  # a claim never becomes more than that by itself
    }


@dataclass(frozen=True)
class Family:
    """Fields, and what makes rows one entity: tokens (label, paths of their parts), those of strong labels first, or identity fields."""

    fields: dict
    tokens: tuple[tuple[str, tuple[str, ...]], ...] = ()
    strong: tuple[str, ...] = ()
    identity: tuple[str, ...] = ()
    action: str = "REVIEW_REQUIRED"
    quality: str = "UNRESOLVED"
    performance_refs: str | None = None


# Families with their tokens or identities, and the label that the machine gives to what it merged.
FAMILIES = {
    "company": Family({
        "companyName": Kind("string", lambda c: clean_verbatim_text(c, 200)), "creditCode": Kind("string", normalize_credit_code), "legalPerson": text(64),
        "registeredCapital": Kind("string", normalize_money), "establishedDate": DAY, "companyType": text(128), "businessScope": text(20000), "registeredAddress": text(1000),
        "province": text(64), "city": text(64), "employeeCount": NUMBER, "documentAsOfDate": DAY,
    }, identity=()),
    "alias": Family({"aliasName": TEXT, "aliasType": TEXT}, identity=("aliasName",)),
    "qualification": Family({
        "certName": text(200), "certLevel": text(64), "certNo": text(128), "issuingAuthority": text(200), "issueDate": DAY, "expiryDate": DAY, "status": TEXT,
        "certScope": text(5000), "holderName": text(200),
    }, (("00:cert_no", ("certNo",)), ("01:name_level_expiry", ("certName", "certLevel", "expiryDate")), ("02:name_holder_issuer", ("certName", "holderName", "issuingAuthority"))), ("00:cert_no",)),
    "intellectual_property": Family({
        "propertyType": enum("PATENT TRADEMARK SOFTWARE_COPYRIGHT STANDARD OTHER", "OTHER"), "propertyName": text(512), "registrationNo": text(128), "applicationNo": text(128),
        "holderName": text(200), "status": enum("VALID ACTIVE PENDING EXPIRED REVOKED INVALID UNKNOWN", "UNKNOWN", PROPERTY_STATUS), "applicationDate": DAY, "issueDate": DAY, "expiryDate": DAY,
    }, (("00:registration_no", ("registrationNo",)), ("01:application_no", ("applicationNo",)), ("02:type_name", ("propertyType", "propertyName"))), ("00:registration_no", "01:application_no")),
    "financial_history": Family({
        "fiscalYear": YEAR, "currency": Kind("string", lambda c: F.coalesce(clean_text(c, 8), F.lit("CNY"))), "unit": text(32), "totalAssets": NUMBER, "totalLiabilities": NUMBER,
        "revenue": NUMBER, "operatingProfit": SIGNED, "netProfit": SIGNED, "netAssets": SIGNED, "cashFlow": SIGNED, "auditorName": text(200), "auditOpinion": text(2000), "reportDate": DAY,
    }, identity=("fiscalYear",), action="HISTORY_ONLY"),
    "risk": Family({
        "riskType": enum("ADMIN_PENALTY DISHONESTY LITIGATION ENFORCEMENT BUSINESS_ANOMALY TAX QUALIFICATION_EXPIRY OTHER", "OTHER"), "title": text(1000), "status": TEXT,
        "severity": TEXT, "occurredAt": DAY, "resolvedAt": DAY, "amountYuan": NUMBER, "queryAsOfDate": DAY,
    }, identity=("riskType", "title", "occurredAt")),
    "personnel": Family({
        "personnelType": enum("CORE_MEMBER PROFESSIONAL BID_TEAM_ONLY", "BID_TEAM_ONLY"), "personName": text(64), "personRole": text(128), "roleInBid": text(128), "profession": text(128),
        "professionalTitle": text(128), "education": text(128), "workExperience": TEXT, "certificates": Items(PERSON_CERTIFICATE), "projectExperienceRefs": REFS, "employmentEvidence": EMPLOYMENT,
    }, (("00:name_cert", ("personName", "certificates[].certNo")), ("01:name_role", ("personName", "personRole|roleInBid"))), action="HISTORY_ONLY", performance_refs="projectExperienceRefs"),
    "performance": Family({
        "projectName": TEXT, "projectCode": TEXT, "tenderCode": TEXT, "projectNature": TEXT, "tenderMethod": TEXT, "organizationForm": TEXT, "customerName": TEXT, "ownerCompanyName": TEXT,
        "agencyCompanyName": TEXT, "industry": strings(20, 100), "projectType": TEXT, "province": TEXT, "city": TEXT, "locationText": TEXT,
        "role": enum("OWNER CONTRACTOR SUPPLIER SERVICE_PROVIDER CONSORTIUM_MEMBER UNKNOWN", "UNKNOWN"), "relationType": TEXT, "ranking": TEXT, "isWinner": FLAG, "isConsortium": FLAG,
        "isConsortiumLeader": FLAG, "consortiumMembers": strings(200, 500), "projectPersonnel": strings(200, 500), "awardDate": DAY, "bidAmountYuan": NUMBER, "estimatedAmountYuan": NUMBER,
        "contract": CONTRACT, "performanceStatus": enum(PERFORMED, "UNKNOWN", PERFORMANCE_STATUS), "acceptanceDate": DAY, "duration": TEXT, "qualityRequirement": TEXT,
        "scopeItems": strings(100, 1000), "deliveredCapabilities": strings(100, 300),
    }, (
        ("00:contract_no", ("contract.contractNo",)), ("01:project_code", ("projectCode",)), ("02:tender_code", ("tenderCode",)), ("03:name_customer", ("projectName", "customerName")),
        ("03:name_customer", ("projectName", "ownerCompanyName")), ("04:name_contract", ("projectName", "contract.contractName")), ("05:name_amount_date", ("projectName", "contract.amountYuan", "awardDate")),
    ), ("00:contract_no", "01:project_code", "02:tender_code")),
    "business_relation": Family({
        "relatedCompanyName": TEXT, "relationType": enum("CUSTOMER SUPPLIER PARTNER CONSORTIUM", "CUSTOMER"), "firstRelationshipDate": DAY, "lastRelationshipDate": DAY, "projectRefs": REFS,
        "projectCount": NUMBER, "totalAmountYuan": NUMBER,
    }, identity=("relatedCompanyName", "relationType")),
    "product": Family({
        "productName": TEXT, "brand": TEXT, "model": TEXT, "manufacturer": TEXT, "rightHolder": TEXT,
        "companyRole": enum("OWNER MANUFACTURER AUTHORIZED_RESELLER INTEGRATOR PROPOSED_SUPPLIER UNKNOWN", "UNKNOWN"), "specifications": strings(200, 1000), "certificates": strings(200, 500),
        "usedInPerformanceRefs": REFS,
    }, identity=("manufacturer", "brand", "model", "productName"), performance_refs="usedInPerformanceRefs"),
    "solution_claim": Family(claim("SOFTWARE_SOLUTION SYSTEM_INTEGRATION TECHNICAL_CAPABILITY PRODUCT OTHER"), identity=("category", "name"), action="CLAIM_ONLY", quality="MEDIUM", performance_refs="supportedByPerformanceRefs"),
    "delivery_claim": Family(claim("IMPLEMENTATION QUALITY AFTER_SALES TRAINING ACCEPTANCE RISK_MANAGEMENT OTHER"), identity=("category", "name"), action="BID_ONLY", quality="MEDIUM", performance_refs="supportedByPerformanceRefs"),
    "bid_specific": Family({
        "projectName": TEXT, "tenderCode": TEXT, "buyerName": TEXT, "bidAmountYuan": NUMBER, "durationCommitment": TEXT, "qualityCommitment": TEXT, "guaranteeAmountYuan": NUMBER,
        "deviations": strings(200, 1000),
    }, identity=(), action="BID_ONLY"),
}
#: Fields that every family may carry beside its own.
COMMON = ["profileAction", "qualityLevel", "evidenceRefs", "conflictRefs"]


def raw_schema(fields: dict) -> str:
    """The DDL of the JSON that the family reads."""
    own = []
    for name, kind in fields.items():
        inner = f"struct<{raw_schema(kind)}>" if isinstance(kind, dict) else f"array<struct<{raw_schema(kind.fields)}>>" if isinstance(kind, Items) else kind.raw
        own.append(f"{name}: {inner}")
    return ", ".join(own)


def _members(objects: Column, key: str) -> Column:
    """The JSON texts under a key of each object."""
    return F.filter(F.transform(objects, lambda o: F.get_json_object(o, f"$.{key}")), lambda x: x.isNotNull())


def _objects(raw: Column, fields: dict, name: str) -> Iterator[tuple[str, Column, list[str]]]:
    """(path, JSON texts of the objects there, fields allowed in them) of an array of JSON objects and of all objects nested in it."""
    yield name, raw, list(fields)
    for key, kind in fields.items():
        if isinstance(kind, Kind):
            continue
        inner = _members(raw, key)
        if isinstance(kind, Items):
            yield from _objects(F.flatten(F.transform(inner, lambda x: F.coalesce(F.from_json(x, "array<string>"), F.array().cast("array<string>")))), kind.fields, f"{name}.{key}")
        else:
            yield from _objects(inner, kind, f"{name}.{key}")


def _below(keys: Column, path: str) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(f"{path}."), k))


def pruned(raw: Column, family: str) -> tuple[Column, Column]:
    """H5: (typed object, dropped paths) of a JSON object: fields outside the allow-list are dropped at any depth and named with their path."""
    fields = FAMILIES[family].fields
    allowed_on_top = [*fields, *COMMON]
    dropped = []
    for path, objects, allowed in _objects(F.array_compact(F.array(raw)), fields, family):
        allowed = allowed_on_top if path == family else [*allowed, "conflictRefs"]
        keys = F.flatten(F.transform(objects, lambda o: F.coalesce(F.json_object_keys(o), F.array().cast("array<string>"))))
        extra = F.array_except(keys, F.array(*[F.lit(a) for a in allowed]))
        dropped.append(_below(extra, path))
    return F.from_json(raw, f"struct<{raw_schema(fields)}, evidenceRefs: array<string>>"), F.array_sort(F.array_distinct(F.concat(*dropped)))


def _cleaned(c: Column | None, kind, given: DataType | None) -> Column:
    if isinstance(kind, dict):
        names = given.names if isinstance(given, StructType) else []
        return F.struct(*[_cleaned(c[n] if n in names else None, k, given[n].dataType if n in names else None).alias(n) for n, k in kind.items()])
    if isinstance(kind, Items):
        if c is None:
            return F.array().cast(ArrayType(StructType())) if not kind.fields else F.filter(F.array(_cleaned(None, kind.fields, None)), lambda x: F.lit(False))
        return F.coalesce(F.transform(c, lambda x: _cleaned(x, kind.fields, given.elementType)), F.filter(F.array(_cleaned(None, kind.fields, None)), lambda x: F.lit(False)))
    return kind.clean(c if c is not None else F.lit(None).cast(kind.raw))


def normalize_entity(df: DataFrame, family: str, as_of: Column) -> DataFrame:
    """A family's rows cleaned field by field at every depth; columns outside the family are dropped but doc_id, ordinal and evidenceRefs. Fields that a row set lacks are null."""
    fields, given = FAMILIES[family].fields, {f.name: f.dataType for f in df.schema}
    columns = [_cleaned(F.col(f"`{n}`") if n in given else None, k, given.get(n)).alias(n) for n, k in fields.items()]
    refs = REFS.clean(F.col("evidenceRefs")) if "evidenceRefs" in given else F.array().cast("array<string>")
    out = df.select("doc_id", "ordinal", *columns, refs.alias("evidenceRefs"))
    if family == "qualification":
        known = F.when(F.upper("status").isin("VALID", "EXPIRING", "EXPIRED", "REVOKED", "UNKNOWN"), F.upper("status")).otherwise("UNKNOWN")
        out = out.withColumn("status", certificate_status(F.col("issueDate"), F.col("expiryDate"), known, as_of))
    if family == "intellectual_property":
        out = out.withColumn("status", F.when(F.col("expiryDate") < as_of, "EXPIRED").otherwise(F.col("status")))
    if family == "performance":
        amount = F.coalesce(F.col("contract.amountYuan"), parse_arabic_money(F.col("contract.rawAmountText")).cast("decimal(38,6)"))
        out = out.withColumn("contract", F.col("contract").withField("amountYuan", amount))
    return out


def _parts(path: str) -> Column:
    """The texts of a token's part, an array: one for a field (the first present of alternatives), one per item for `list[].field`."""
    if "[]." in path:
        items, field = path.split("[].")
        found = F.transform(F.col(items), lambda x: x[field].cast("string"))
    else:
        found = F.array(F.coalesce(*[F.nullif(F.col(p).cast("string"), F.lit("")) for p in path.split("|")]))
    return F.filter(F.transform(found, lambda x: F.lower(clean_text(x, 1000))), lambda x: x.isNotNull())


def _each_with(done: Column, more: Column) -> Column:
    """Every list of parts with every further part."""
    return F.flatten(F.transform(done, lambda parts: F.transform(more, lambda x: F.array_append(parts, x))))


def _labelled(combined: Column, label: str) -> Column:
    token = lambda parts: F.concat(F.lit(f"{label}:"), F.left(F.sha2(F.to_json(parts), 256), F.lit(24)))
    return F.transform(combined, lambda parts: F.struct(F.lit(label).alias("label"), token(parts).alias("token")))


def _tokens_of(family: str) -> Column:
    """A row's tokens (label, token), an array: what it has in common with others if they are one entity; a row with none has a token of all it says."""
    own = FAMILIES[family]
    found = []
    for label, paths in own.tokens:
        combined = F.transform(_parts(paths[0]), lambda x: F.array(x))
        for p in paths[1:]:
            combined = _each_with(combined, _parts(p))
        found.append(_labelled(combined, label))
    everything = stable_hash(*[F.col(n) for n in own.fields], length=24)
    alone = F.array(F.struct(F.lit("99:fallback").alias("label"), F.concat(F.lit("99:fallback:"), everything).alias("token")))
    return once(F.array_distinct(F.concat(*found)), lambda x: F.when(F.size(x) > 0, x).otherwise(alone))


def entity_tokens(rows: DataFrame, family: str) -> DataFrame:
    """(row_id, label, token): what rows have in common if they are one entity; a row with none has a token of all it says."""
    return rows.select("row_id", F.explode(_tokens_of(family)).alias("t")).select("row_id", "t.label", "t.token")


def _filled(df: DataFrame, fields: dict) -> Column:
    """Whether a cleaned row says anything: enumerations fall back on a value, so the fields are looked at before they are cleaned."""
    names = [n for n in fields if n in df.columns]
    said = [F.nullif(F.to_json(F.struct(F.col(f"`{n}`"))), F.lit("{}")) for n in names]
    empty = [F.lit(v) for n in names for v in (f'{{"{n}":""}}', f'{{"{n}":[]}}', f'{{"{n}":{{}}}}')]
    return F.exists(F.array(*said), lambda x: x.isNotNull() & ~x.isin(*empty)) if names else F.lit(False)


def keyed_rows(df: DataFrame, family: str, as_of: Column) -> DataFrame:
    """A family's rows cleaned, with the key of their entity (entityKey) and their place (at), in a stored table.

    A token that only rows without other tokens have is an entity by itself; rows that have several tokens, and those that share one with them, are resolved.
    """
    own = FAMILIES[family]
    rows = normalize_entity(df.filter(_filled(df, own.fields)), family, as_of).withColumn("at", F.struct("doc_id", "ordinal"))
    prefix = F.lit(f"{family.replace('_', '-')}:sha256:")
    if not own.tokens:
        said = identity_hash(list(own.identity), list(own.fields)) if own.identity else F.lit("current")
        if family == "alias":
            said = stable_hash(F.lower(normalize_company_name(F.col("aliasName"))), length=24)
        return written(rows.withColumn("entityKey", F.concat(prefix, said) if own.identity else F.lit(f"{family.split('_')[0]}:current")), "keyed")
    rows = written(rows.withColumn("_tokens", _tokens_of(family)), "rows")  # several aggregations read them
    named = lambda found: found.withColumn("entityKey", F.concat(prefix, stable_hash(F.col("canonical_token"), length=24))).drop("canonical_token", "_tokens")
    several, one = rows.filter(F.size("_tokens") > 1), rows.filter(F.size("_tokens") == 1).withColumn("canonical_token", F.col("_tokens")[0]["token"])
    links = written(several.select(F.explode("_tokens.token").alias("canonical_token")).distinct(), "links")
    if links.isEmpty():
        return named(one)
    tied = several.unionByName(one.join(links, "canonical_token", "left_semi").drop("canonical_token")).withColumn("row_id", stable_hash(F.col("doc_id"), F.col("ordinal"), length=32))
    tied = written(tied, "tied")
    tokens = tied.select("row_id", F.explode("_tokens").alias("t")).select("row_id", "t.label", "t.token")
    found = tied.join(resolve_entities(tokens, list(own.strong)).select("row_id", "canonical_token"), "row_id").drop("row_id")
    return written(named(found.unionByName(one.join(links, "canonical_token", "left_anti"))), "keyed")


def merge_entities(keyed: DataFrame, family: str, fields: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged, conflicts, evidence) of the fields named, all by default, of keyed rows; nothing is stored, so what is not read is not computed."""
    merged, conflicts, evidence = merge_nested(dealt(keyed, "entityKey"), ["entityKey"], "at", "evidenceRefs", fields or [*FAMILIES[family].fields, "evidenceRefs"])
    conflicts = conflicts.withColumn("conflict_id", F.regexp_replace("conflict_id", "^conflict:", f"conflict:{family}:")).withColumn("entity_type", F.lit(family.upper()))
    return merged, conflicts, evidence


def merge_family(df: DataFrame, family: str, as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A4 for one family: (entities, conflicts, evidence). Rows become entities by tokens or identity and are merged at every depth."""
    own = FAMILIES[family]
    merged, conflicts, evidence = merge_entities(keyed_rows(df, family, as_of), family)
    evidence = written(evidence, "evidence")
    conflicts = written(conflicts, "conflicts")
    ids = conflicts.groupBy("entityKey").agg(F.array_sort(F.collect_set("conflict_id")).alias("conflictRefs"))
    labelled = merged.join(ids, "entityKey", "left").withColumn("conflictRefs", F.coalesce("conflictRefs", F.array().cast("array<string>")))
    if family == "company":
        labelled = labelled.withColumn("normalizedCompanyName", normalize_company_name(F.col("companyName")))
    policy = {"profileAction": own.action, "qualityLevel": own.quality, "verificationStatus": "UNVERIFIED"}
    return written(labelled.withColumns({n: F.lit(v) for n, v in policy.items()}), "entities"), conflicts, evidence


def merge_domains(frames: dict[str, DataFrame], evidence: DataFrame, as_of: Column) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """A4: every family (rows with doc_id, ordinal, evidenceRefs and fields) merged: references without evidence are dropped, certificates and properties say
    whether they are the company's own, references to performances stay only where these exist, and conflicts carry the best strength of both sides."""
    out = {}
    for family, df in frames.items():
        if "evidenceRefs" in df.columns:
            df = resolve_refs(df, ["doc_id", "ordinal"], "evidenceRefs", evidence, "evidence_id").drop("unresolved")
        merged, conflicts, refs = merge_family(df, family, as_of)
        out[family] = merged, with_strengths(conflicts, refs, evidence), refs
    company = out["company"][0].select(F.col("companyName").alias("_company")) if "company" in out else None
    for family in ("qualification", "intellectual_property"):
        if family in out and company is not None:
            merged, *rest = out[family]
            named = merged.join(F.broadcast(company), how="left")  # one row by its key
            out[family] = named.withColumn("subjectMatchStatus", subject_match(F.col("holderName"), F.col("_company"))).drop("_company"), *rest
    if "performance" in out:
        keys = out["performance"][0].select("entityKey")
        for family, (merged, *rest) in out.items():
            column = FAMILIES[family].performance_refs
            if column:
                kept = resolve_refs(merged, ["entityKey"], column, keys.withColumnRenamed("entityKey", "_key"), "_key").withColumnRenamed("unresolved", "unresolvedReferenceCandidates")
                none = F.array().cast("array<string>")
                out[family] = kept.withColumns({c: F.coalesce(c, none) for c in (column, "unresolvedReferenceCandidates")}), *rest
    return out


def with_strengths(conflicts: DataFrame, refs: DataFrame, evidence: DataFrame) -> DataFrame:
    """The best strength (A before D) of the evidence of a conflict's two values."""
    strength = refs.join(evidence.select(F.col("evidence_id").alias("ref"), "source_strength"), "ref").filter(F.col("source_strength").isin("A", "B", "C", "D"))
    best = strength.groupBy("entityKey", "field", "value").agg(F.min("source_strength").alias("s"))
    for side in ("left", "right"):
        conflicts = conflicts.join(best.toDF("entityKey", "field", f"{side}_value", f"{side}_strength"), ["entityKey", "field", f"{side}_value"], "left")
    return conflicts
