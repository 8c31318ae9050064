"""Matching, references, gaps and overlays (J1-J18, C3, C4, T-type filters on keys)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docfacts.functions.text import award_company_name, compact, normalize_company_name, normalize_project_name

#: A rule or registry table is broadcast up to this many rows; more are joined by shuffle.
SMALL_ROWS = 200_000


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """df with a broadcast hint if it is small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def longest_contained(texts: DataFrame, text: str, keys: DataFrame, key: str, least: int = 6) -> DataFrame:
    """L3: every row of texts with its longest contained keys (all of the greatest length).

    Keys are found through substrings of their lengths: a text gives one row
    for each start and key length, joined to keys by equality. No row pairs
    are compared, so neither side has to be small.
    """
    keys = keys.filter(F.length(key) >= least).select(key).distinct()
    lengths = [r[0] for r in keys.select(F.length(key)).distinct().collect()]  # distinct key lengths
    if not lengths:
        return texts.withColumn(key, F.lit(None).cast("string")).limit(0)
    numbered = texts.withColumn("_id", F.monotonically_increasing_id())
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    parts = numbered.select("*", F.explode(F.array(*[F.lit(n) for n in sorted(lengths)])).alias("_len")).filter(F.length(text) >= F.col("_len"))
    parts = parts.select("*", F.explode(starts).alias("_at")).withColumn(key, F.substring(text, F.col("_at"), F.col("_len"))).filter(F.length(key) == F.col("_len"))
    hits = parts.join(keys, key, "left_semi").select(*texts.columns, "_id", key).distinct()
    ranked = hits.withColumn("_r", F.rank().over(W.partitionBy("_id").orderBy(F.length(key).desc())))
    return ranked.filter("_r = 1").select(*texts.columns, key)


def resolve_award(projects: DataFrame, awards: DataFrame) -> DataFrame:
    """The award of each project: (project, status, winner, amount, message).

    projects: (project); awards: (project_name, lot, winner, amount, issue, ordinal).
    Exact key first, else the longest contained one; several keys, several
    outcomes or no winner go to review.
    """
    named = awards.withColumn("key", normalize_project_name(F.col("project_name")))
    wanted = projects.select("project", normalize_project_name(F.col("project")).alias("text")).distinct()
    keys = named.select("key").distinct()
    exact = wanted.join(keys.withColumnRenamed("key", "text"), "text", "left_semi").withColumn("key", F.col("text"))
    rest = wanted.join(keys.withColumnRenamed("key", "text"), "text", "left_anti")
    found = exact.unionByName(longest_contained(rest, "text", keys, "key"))
    matched = wanted.join(found.groupBy("project").agg(F.count(F.lit(1)).alias("n_keys"), F.min("key").alias("key")), "project", "left")
    sig = [F.coalesce(normalize_project_name(F.col("lot")), F.lit("")), award_company_name(F.col("winner")), F.col("amount"), F.col("issue")]
    records = named.withColumn("sig", F.struct(*[s.alias(f"s{i}") for i, s in enumerate(sig)]))
    distinct = records.groupBy("key", "sig").agg(F.min_by(F.struct("winner", "amount", "issue", "lot"), "ordinal").alias("rec"), F.min("ordinal").alias("ordinal"))
    each = matched.filter("n_keys = 1").join(distinct, "key")
    lot = normalize_project_name(F.col("rec.lot"))
    each = each.withColumn("lot_hit", (lot != "") & F.contains(F.col("text"), lot))
    by = each.groupBy("project").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("lot_hit").alias("n_lot"),
        F.count_distinct(F.struct(award_company_name(F.col("rec.winner")).alias("w"), F.coalesce(F.col("rec.amount").cast("string"), F.lit("")).alias("a"), F.coalesce("rec.issue", F.lit("")).alias("i"))).alias("n_outcomes"),
        F.min_by("rec", "ordinal").alias("first_rec"), F.min_by("rec", F.when(F.col("lot_hit"), F.col("ordinal"))).alias("lot_rec"),
    )
    rec = F.when(F.col("n") == 1, F.col("first_rec")).when(F.col("n_lot") == 1, F.col("lot_rec")).when(F.col("n_outcomes") == 1, F.col("first_rec"))
    out = matched.join(by.withColumn("rec", rec), "project", "left")
    winner = F.nullif(F.trim(F.col("rec.winner")), F.lit(""))
    message = (
        F.when(F.col("text") == "", "no project name").when(F.col("n_keys").isNull(), "no award for this project").when(F.col("n_keys") > 1, "several award projects fit")
        .when(F.col("rec").isNull(), "several different awards").when(winner.isNull(), F.coalesce("rec.issue", F.lit("award without winner"))).otherwise(F.col("rec.issue"))
    )
    ok = (F.col("text") != "") & winner.isNotNull()
    return out.select("project", F.when(ok, "MATCHED").otherwise("REVIEW_REQUIRED").alias("status"), F.when(ok, winner).alias("winner"), F.when(ok, F.col("rec.amount")).alias("amount"), message.alias("message"))


def award_decisions(bidders: DataFrame, awards: DataFrame) -> DataFrame:
    """WINNER / NOT_WINNER / REVIEW_REQUIRED per (project, company); the amount only for the winner; whether the winner is among the bidders."""
    joined = bidders.join(awards, "project", "left")
    won = award_company_name(F.col("company")) == award_company_name(F.col("winner"))
    status = F.when(F.coalesce(F.col("status"), F.lit("")) != "MATCHED", "REVIEW_REQUIRED").when(won, "WINNER").otherwise("NOT_WINNER")
    marked = joined.select("project", "company", status.alias("decision"), F.when(status == "WINNER", F.col("amount")).alias("amount"))
    present = marked.groupBy("project").agg(F.bool_or(F.col("decision") == "WINNER").alias("winner_present"))
    return marked.join(present, "project")


def match_existing(candidates: DataFrame, existing: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Candidates with the existing rows of their key; `reasons` lists the fields in which both have a value and differ."""
    right = existing.select(*key, F.lit(True).alias("matched"), *[F.col(f).alias(f"old_{f}") for f in fields])
    joined = candidates.join(right, key, "left")
    differs = [F.when((compact(F.col(f)) != "") & (compact(F.col(f"old_{f}")) != "") & (compact(F.col(f)) != compact(F.col(f"old_{f}"))), F.lit(f)) for f in fields]
    return joined.withColumn("matched", F.coalesce("matched", F.lit(False))).withColumn("reasons", F.array_compact(F.array(*differs)))


def resolve_refs(df: DataFrame, key: list[str], refs: str, targets: DataFrame, target: str) -> DataFrame:
    """References with a target, and the unresolved ones."""
    each = df.select(*key, F.explode(refs).alias("_r")).distinct()
    hit = each.join(targets.select(F.col(target).alias("_r"), F.lit(True).alias("_hit")).distinct(), "_r", "left")
    sides = hit.groupBy(*key).agg(F.array_sort(F.collect_set(F.when(F.col("_hit"), F.col("_r")))).alias(refs), F.array_sort(F.collect_set(F.when(F.col("_hit").isNull(), F.col("_r")))).alias("unresolved"))
    return df.drop(refs).join(sides, key, "left")


def dangling_refs(df: DataFrame, key: list[str], refs: str, targets: DataFrame, target: str) -> DataFrame:
    """(key, ref) of references without a target."""
    each = df.select(*key, F.explode(refs).alias("ref"))
    return each.join(targets.select(F.col(target).alias("ref")).distinct(), "ref", "left_anti")


def nearby(df: DataFrame, key: list[str], at: str, distance: int, left: Column, right: Column) -> DataFrame:
    """(key, at, near) pairs of a left and a right row within a distance, by equality of buckets and no range join."""
    width = distance + 1
    cell = F.floor(F.col(at) / width)
    a = df.filter(left).select(*key, F.col(at).alias("at"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"))
    b = df.filter(right).select(*key, F.col(at).alias("near"), cell.alias("_cell"))
    return a.join(b, [*key, "_cell"]).filter((F.abs(F.col("at") - F.col("near")) <= distance) & (F.col("at") != F.col("near"))).drop("_cell").distinct()


def contains_any(c: Column, fragments: list[str]) -> Column:
    """Whether any fragment is in the text (rules are unrolled into the plan)."""
    out = F.lit(False)
    for f in fragments:
        out = out | F.contains(F.lower(c), F.lit(f.lower()))
    return out


def recovered_errors(errors: DataFrame, pages: DataFrame) -> DataFrame:
    """An error range (doc_id, start, end) is recovered if all of its pages are usable."""
    each = errors.filter("start <= end").select("doc_id", "start", "end", F.explode(F.sequence("start", "end")).alias("physical_page"))
    joined = each.join(pages.select("doc_id", "physical_page", "usable"), ["doc_id", "physical_page"], "left")
    return joined.groupBy("doc_id", "start", "end").agg(F.bool_and(F.coalesce("usable", F.lit(False))).alias("recovered"))


# Why a field has no value, by its extraction mode; of all other modes the sources held none.
GAP_REASONS = {"USER_CONFIRMED_ONLY": "USER_NOT_PROVIDED", "POST_IMPORT_DERIVED": "DEPENDENCY_MISSING", "EXTERNAL_ONLY": "NOT_COLLECTED"}


def profile_gaps(contract: DataFrame, candidates: DataFrame, owners: DataFrame) -> DataFrame:
    """Contract fields (field_code, mode) without a candidate, per owner, with the reason by extraction mode."""
    wanted = owners.crossJoin(small(contract))
    reason = F.coalesce(*[F.when(F.col("mode") == mode, F.lit(said)) for mode, said in GAP_REASONS.items()], F.lit("SOURCE_EMPTY"))
    return wanted.join(candidates, [*owners.columns, "field_code"], "left_anti").withColumn("reason", reason)


def subject_match(holder: Column, company: Column) -> Column:
    """J14, strict."""
    h, c = normalize_company_name(holder), normalize_company_name(company)
    return F.when(h.isNull() | c.isNull(), "UNKNOWN").when(h == c, "MATCH").otherwise("MISMATCH")


def company_match(candidate: Column, target: Column) -> Column:
    """J14, loose."""
    a, b = compact(candidate), compact(target)
    return F.when(b == "", "NOT_CHECKED").when(a == "", "UNKNOWN").when(a == b, "MATCHED").when(F.contains(a, b) | F.contains(b, a), "PROBABLE").otherwise("OTHER_COMPANY")


def affiliation_reasons(credit: Column, holder: Column, company_credit: Column, company_name: Column, confirmed: Column) -> Column:
    """J15."""
    missing = (compact(credit) == "") & (compact(holder) == "")
    return F.array_compact(F.array(
        F.when((compact(credit) != "") & (F.upper(compact(credit)) != F.upper(compact(company_credit))), "credit code differs"),
        F.when((compact(holder) != "") & (compact(holder) != compact(company_name)), "holder differs"),
        F.when(missing & ~F.coalesce(confirmed, F.lit(False)), "no affiliation in the material"),
    ))


def verify_spans(evidence: DataFrame, nodes: DataFrame) -> DataFrame:
    """Evidence (doc_id, item_id, page, start, end, text) against nodes (doc_id, item_id, page, text): adds valid."""
    right = nodes.select("doc_id", "item_id", F.col("page").alias("_page"), F.col("text").alias("_text"))
    inside = (F.col("start") >= 0) & (F.col("end") > F.col("start")) & (F.col("end") <= F.length("_text"))
    same = F.substring(F.col("_text"), F.col("start") + 1, F.col("end") - F.col("start")) == F.col("text")
    return evidence.join(right, ["doc_id", "item_id"], "left").withColumn("valid", F.coalesce(inside & same & (F.col("page") == F.col("_page")), F.lit(False))).drop("_page", "_text")


def overlay_page_text(pages: DataFrame, ocr: DataFrame, vision: DataFrame) -> DataFrame:
    """Page text replaced by OCR text, then by vision text, where those are not empty; with its source."""
    from docfacts.functions.text import text_readability

    key = ["doc_id", "physical_page"]
    joined = pages.join(ocr.select(*key, F.col("text").alias("_ocr"), F.lit(True).alias("_tried")), key, "left").join(vision.select(*key, F.col("text").alias("_vision")), key, "left")
    o, v = (F.nullif(F.trim(F.col(c)), F.lit("")) for c in ("_ocr", "_vision"))
    low = text_readability(o)["needs_ocr"]
    source = F.when(v.isNotNull(), "GLM_VISION").when(o.isNotNull() & low, "OCR_LOW_QUALITY").when(o.isNotNull(), "GLM_OCR").when(F.col("_tried"), "OCR_FAILED").when(F.nullif(F.trim("text"), F.lit("")).isNull(), "UNAVAILABLE").otherwise(F.col("content_source"))
    return joined.withColumn("content_source", source).withColumn("text", F.coalesce(v, o, "text")).drop("_ocr", "_vision", "_tried")


def strength_of_refs(df: DataFrame, key: list[str], refs: str, evidence: DataFrame) -> DataFrame:
    """The best strength (A before D) of the referenced evidence."""
    each = df.select(*key, F.explode(refs).alias("evidence_id")).join(evidence.select("evidence_id", "source_strength"), "evidence_id")
    return each.groupBy(*key).agg(F.min("source_strength").alias("source_strength"))


def apply_refined_types(pages: DataFrame, answers: DataFrame, legal: list[str]) -> DataFrame:
    """Legal refined types replace local ones; a page that was asked for and not answered keeps its own with a warning."""
    joined = pages.join(answers.select("doc_id", "physical_page", F.col("document_type").alias("_new")), ["doc_id", "physical_page"], "left")
    ok = F.col("_new").isin(legal)
    warning = F.when(F.col("asked") & F.col("_new").isNull(), "no refined type").when(F.col("_new").isNotNull() & ~ok, "illegal refined type")
    return joined.withColumn("document_type", F.when(ok, F.col("_new")).otherwise(F.col("document_type"))).withColumn("warning", warning).drop("_new")


def route_domains(pages: DataFrame, routes: DataFrame) -> DataFrame:
    """C4: (page, domain) for the domains of its type; invoices go nowhere. routes: (document_type, domain), a fixed table."""
    return pages.filter("document_type <> 'INVOICE'").join(F.broadcast(routes), "document_type")
