"""Merging facts without losing any (A1, A2, A5-A7, A16-A20) and entity resolution (A3).

Rows are long, one per (entity, field, ordinal) with a value and its evidence, or
nested (`merge_nested`). The first present value of a field wins; every other
value goes to a conflict row, and evidence stays in rows of its own.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from docfacts.functions.nested import stable_hash
from docfacts.functions.text import clean_text
from docfacts.storage import written

META_FIELDS = ["qualityLevel", "profileAction", "conflictRefs"]


#: Rows of one key that a task may get at once; buckets in which they are counted.
MOST_OF_A_KEY, BUCKETS = 100_000, 1 << 16


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df dealt out by a key, so that all aggregations of the key's rows find them together; as it is where a key may have many rows, which are better reduced before they move."""
    counts = df.groupBy(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    most, n = counts.agg(F.max("n"), F.sum("n")).first()  # a key has at most the rows of its bucket
    return df.repartition(key) if (most or 0) <= max(MOST_OF_A_KEY, 4 * (n or 0) // BUCKETS) else df


def long_form(df: DataFrame, key: list[str], ordinal: str, refs: str, fields: list[str]) -> DataFrame:
    """(key, field, ordinal, value, refs) of the present scalar fields."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return df.select(*key, F.col(ordinal).alias("ordinal"), F.col(refs).alias("refs"), F.explode(cells).alias("c")).select(
        *key, "c.field", "ordinal", "c.value", "refs"
    ).filter("value IS NOT NULL AND value <> ''")


def merge_with_conflicts(cells: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A1: (merged values, conflicts, evidence) of long rows (key, field, ordinal, value, refs).

    Equal values are put together before anything is compared, so a hot entity
    is reduced map-side to its distinct values. A conflict stands for a value
    that differs from the winner, with the number of references seen under
    earlier values (left_n) and under its own (right_n); the references
    themselves are the rows of evidence (key, field, value, ref, ordinal), as
    many as there were in the cells.
    """
    named = [*key, "field", "value"]
    evidence = cells.select(*named, "ordinal", F.explode("refs").alias("ref")).groupBy(*named, "ref").agg(F.min("ordinal").alias("ordinal"))
    found = evidence.groupBy(*named).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast(cells.schema["ordinal"].dataType).alias("at"))
    seen = cells.groupBy(*named).agg(F.lit(0).cast("long").alias("n"), F.min("ordinal").alias("at"))
    distinct = seen.unionByName(found).groupBy(*named).agg(F.sum("n").alias("right_n"), F.min("at").alias("first_ordinal"))
    w = W.partitionBy(*key, "field").orderBy("first_ordinal", "value")
    ranked = distinct.withColumn("_n", F.row_number().over(w)).withColumn("winner", F.first("value").over(w))
    ranked = ranked.withColumn("left_n", F.sum("right_n").over(w.rowsBetween(W.unboundedPreceding, -1)))
    merged = ranked.filter("_n = 1").select(*key, "field", "value")
    conflicts = ranked.filter((F.col("_n") > 1) & ~F.substring_index("field", ".", -1).isin(META_FIELDS)).select(
        *key, "field", F.col("winner").alias("left_value"), "left_n", F.col("value").alias("right_value"), "right_n", "first_ordinal",
        F.concat(F.lit("conflict:"), stable_hash(*[F.col(k) for k in key], F.col("field"), F.col("winner"), F.col("value"), length=18)).alias("conflict_id"),
        F.lit("UNRESOLVED").alias("resolution"), F.lit(True).alias("review_required"),
    )
    return merged, conflicts, evidence


class Leaf(NamedTuple):
    """A scalar or a list inside nested rows: its dotted path, whether it is a list, and its type (of an item, for lists)."""

    path: str
    is_list: bool
    kind: DataType


def leaves(schema: StructType, names: list[str], before: str = "") -> list[Leaf]:
    """What a nested merge compares, in schema order: structs are walked, lists and scalars are leaves."""
    out = []
    for name in names:
        kind, path = schema[name].dataType, f"{before}{name}"
        if isinstance(kind, StructType):
            out += leaves(kind, kind.names, f"{path}.")
        else:
            out.append(Leaf(path, isinstance(kind, ArrayType), kind.elementType if isinstance(kind, ArrayType) else kind))
    return out


def merge_nested(df: DataFrame, key: list[str], ordinal: str, refs: str, fields: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A1 for nested rows: (merged, conflicts, evidence). merged has the key and the fields with their types.

    Structs are merged member by member: of each scalar the first present value
    stands and others become conflicts with a dotted path; lists become the
    union of their items in the order of first sight. Values are present unless
    null, empty texts or empty lists, a struct if one of its members is. The
    plan is made from the schema; rows are aggregated, never collected: of a hot
    entity only distinct values and distinct items meet.
    """
    found = leaves(df.schema, fields)
    at = lambda path: reduce(lambda c, name: c[name], path.split(".")[1:], F.col(path.split(".")[0]))
    scalars, lists = [f for f in found if not f.is_list], [f for f in found if f.is_list]

    def present(leaf: Leaf) -> Column:
        c = at(leaf.path)
        return c.isNotNull() & (c != "") if isinstance(leaf.kind, StringType) else c.isNotNull()

    firsts = [F.min(F.when(present(f), F.struct(F.col(ordinal).alias("o"), at(f.path).alias("v"))))["v"].alias(f"s{k}") for k, f in enumerate(scalars)]
    merged = df.groupBy(*key).agg(*(firsts or [F.count(F.lit(1)).alias("_n")]))
    if lists:
        empty = lambda f: F.array().cast(ArrayType(f.kind))

        def listed(k: int, leaf: Leaf) -> Column:
            """The items of one list with their place, a hash, and a struct that has one member for each list."""

            def item(x: Column, i: Column) -> Column:
                slot = F.struct(*[(x if j == k else F.lit(None).cast(f.kind)).alias(f"l{j}") for j, f in enumerate(lists)])
                return F.struct(F.lit(k).alias("_list"), i.cast("long").alias("_place"), F.unhex(F.sha2(F.to_json(F.struct(x.alias("v"))), 256)).alias("_hash"), slot.alias("_item"))

            return F.transform(F.coalesce(at(leaf.path), empty(leaf)), item)

        items = F.concat(*[listed(k, f) for k, f in enumerate(lists)])
        each = df.select(*key, F.col(ordinal).alias("_o"), F.explode_outer(items).alias("_t")).select(*key, "_o", "_t.*")
        once = each.groupBy(*key, "_list", "_hash").agg(F.min(F.struct("_o", "_place")).alias("_at"), F.min_by("_item", F.struct("_o", "_place")).alias("_item"))
        own = lambda k: F.when(F.col("_list") == k, F.struct("_at", "_hash", F.col(f"_item.l{k}").alias("v")))
        gathered = [F.transform(F.array_sort(F.collect_list(own(k))), lambda y: y["v"]).alias(f"l{k}") for k in range(len(lists))]
        theirs = once.groupBy(*key).agg(*gathered)
        if scalars:
            on = [merged[c].eqNullSafe(theirs[c]) for c in key]
            merged = merged.join(theirs, on).select(*[merged[c] for c in key], *[merged[f"s{k}"] for k in range(len(scalars))], *[theirs[f"l{k}"] for k in range(len(lists))])
        else:
            merged = theirs
    number = {f.path: f"s{k}" for k, f in enumerate(scalars)} | {f.path: f"l{k}" for k, f in enumerate(lists)}

    def rebuilt(kind: StructType, names: list[str], before: str = "") -> list[Column]:
        out = []
        for name in names:
            own, path = kind[name].dataType, f"{before}{name}"
            if isinstance(own, StructType):
                inside = [F.col(number[x.path]) for x in leaves(own, own.names, f"{path}.")]
                some = reduce(lambda a, b: a | b, [(F.size(c) > 0) if number_is_list else c.isNotNull() for c, number_is_list in zip(inside, [x.is_list for x in leaves(own, own.names, f"{path}.")], strict=True)])
                out.append(F.when(some, F.struct(*rebuilt(own, own.names, f"{path}."))).alias(name))
            else:
                out.append(F.col(number[path]).alias(name))
        return out

    cells = F.array(*[F.struct(F.lit(f.path).alias("field"), F.when(present(f), at(f.path).cast("string")).alias("value")) for f in scalars]) if scalars else F.array().cast("array<struct<field:string,value:string>>")
    long = df.select(*key, F.col(ordinal).alias("ordinal"), F.col(refs).alias("refs"), F.explode(cells).alias("c")).select(*key, "c.field", "ordinal", "c.value", "refs").filter("value IS NOT NULL")
    _, conflicts, evidence = merge_with_conflicts(long, key)
    return merged.select(*key, *rebuilt(df.schema, fields)), conflicts, evidence


def merge_lists(df: DataFrame, key: list[str], ordinal: str, items: str) -> DataFrame:
    """A1 for lists: the union in first-seen order."""
    each = df.select(*key, F.col(ordinal).alias("_o"), F.posexplode(items).alias("_p", "item"))
    firsts = each.groupBy(*key, "item").agg(F.min(F.struct("_o", "_p")).alias("at"))
    return firsts.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias(items))


def identity_hash(parts: list[str], fallback: list[str]) -> Column:
    """A2: hash of the meaningful identity parts, or of the whole row if none is."""
    named = F.array_compact(F.array(*[F.lower(clean_text(F.col(p).cast("string"), 500)) for p in parts]))
    return F.when(F.size(named) > 0, stable_hash(named, length=24)).otherwise(stable_hash(*[F.col(c) for c in fallback], length=24))


def group_entities(df: DataFrame, entity_type: str, identity: list[str], fields: list[str], ordinal: str, refs: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A2: rows of one identity merged under a stable key; empty rows are left out."""
    kept = df.filter(F.coalesce(*[F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields]).isNotNull())
    key = F.concat(F.lit(entity_type.lower().replace("_", "-") + ":sha256:"), identity_hash(identity, fields))
    return merge_with_conflicts(long_form(kept.withColumn("entity_key", key), ["entity_key"], ordinal, refs, fields), ["entity_key"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge list (a, b).

    Each round joins every node to its least neighbour (by hash) and rewrites
    the edges; chains shrink by a constant factor, and only the question
    whether an edge is left reaches the driver.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges, maps = written(edges.filter("a <> b").distinct(), "edges"), []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        to = written(least.select(F.col("a").alias("node"), F.when(F.col("m") < rank("a"), F.col("m.v")).otherwise(F.col("a")).alias("root")), "map")
        maps.append(to)
        edges = edges.join(to.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(to.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        edges = written(edges.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    for to in maps[1:]:
        out = out.join(to.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return out


def token_components(tokens: DataFrame) -> DataFrame:
    """(row_id, component): rows that share a token, transitively; the component is the least row of it.

    tokens: (row_id, token). Rows are linked to the least row of each token, so
    a token that is everywhere gives one edge a row.
    """
    firsts = tokens.groupBy("token").agg(F.min("row_id").alias("b"))
    found = components(tokens.join(firsts, "token").select(F.col("row_id").alias("a"), "b"))
    rows = tokens.select("row_id").distinct().join(found.withColumnRenamed("node", "row_id"), "row_id", "left").withColumn("root", F.coalesce("root", "row_id"))
    least = rows.groupBy("root").agg(F.min("row_id").alias("component"))
    return rows.join(least, "root").select("row_id", "component")


def resolve_entities(tokens: DataFrame, strong_labels: list[str]) -> DataFrame:
    """A3: (row_id, entity, canonical_token). tokens: (row_id, label, token).

    Order-free: components over strong tokens first; a weak token that touches
    components holding disjoint strong values of one label is void; the rest links.
    """
    strong = tokens.filter(F.col("label").isin(strong_labels))
    base = written(token_components(strong.select("row_id", "token")), "strong")
    of = tokens.join(base, "row_id", "left").withColumn("part", F.coalesce("component", "row_id"))
    values = strong.join(base, "row_id").select("component", "label", "token").distinct()
    weak = of.filter(~F.col("label").isin(strong_labels)).select("token", "part").distinct()
    # a label is disjoint for a token if no strong value is in every component that has the label
    touched = weak.join(values.withColumnRenamed("token", "value"), weak["part"] == values["component"])
    per_value = touched.groupBy("token", "label", "value").agg(F.count_distinct("part").alias("n"))
    per_label = touched.groupBy("token", "label").agg(F.count_distinct("part").alias("parts"))
    void = per_label.join(per_value.groupBy("token", "label").agg(F.max("n").alias("shared")), ["token", "label"]).filter("parts > 1 AND shared < parts").select("token").distinct()
    usable = strong.select("row_id", "token").unionByName(tokens.filter(~F.col("label").isin(strong_labels)).join(void, "token", "left_anti").select("row_id", "token"))
    linked = token_components(usable)
    rows = tokens.select("row_id").distinct().join(linked, "row_id", "left").withColumn("entity", F.coalesce("component", "row_id"))
    least = tokens.join(rows.select("row_id", "entity"), "row_id").groupBy("entity").agg(F.min("token").alias("canonical_token"))
    return rows.select("row_id", "entity").join(least, "entity")


def merge_requirements(df: DataFrame) -> DataFrame:
    """A5: one row per (doc_id, type, identity): longest text, how the texts relate, the level if there is one only."""
    agg = df.groupBy("doc_id", "type", "identity").agg(
        F.max_by("requirement", F.struct(F.length("requirement"), -F.col("ordinal"))).alias("requirement"), F.min_by("name", "ordinal").alias("name"),
        F.collect_set("requirement").alias("texts"), F.collect_set("level").alias("levels"), F.array_sort(F.collect_set("page")).alias("pages"), F.count(F.lit(1)).alias("n"),
    )
    contained = F.exists("texts", lambda t: F.exists("texts", lambda o: (o != t) & F.contains(o, t)))
    kind = F.when(F.col("n") == 1, "NONE").when(F.size("texts") == 1, "EXACT_DUPLICATE").when(contained, "SUPPLEMENT").otherwise("SEMANTIC_DUPLICATE")
    return agg.withColumn("merge_type", kind).withColumn("level", F.when(F.size("levels") == 1, F.element_at("levels", 1))).drop("texts", "levels", "n")


def merge_requirement_parts(df: DataFrame) -> DataFrame:
    """Parts contained in others dropped, the rest joined; several levels are a CONFLICT."""
    agg = df.groupBy("doc_id", "type", "identity").agg(F.array_sort(F.collect_list(F.struct("ordinal", "requirement"))).alias("p"), F.collect_set("level").alias("levels"))
    texts = F.array_distinct(F.transform("p", lambda x: x["requirement"]))
    kept = F.filter("texts", lambda t: ~F.exists("texts", lambda o: (o != t) & F.contains(o, t)))
    return agg.withColumn("texts", texts).select(
        "doc_id", "type", "identity", F.array_join(kept, "；").alias("requirement"),
        F.when(F.size("levels") > 1, "CONFLICT").when(F.size("levels") == 1, F.element_at("levels", 1)).alias("level"),
    )


def choose_profile(df: DataFrame) -> DataFrame:
    """Per doc_id the rule profile with more items; the first on ties. df: (doc_id, profile, ordinal)."""
    counts = df.groupBy("doc_id", "profile", "ordinal").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("doc_id").agg(F.max_by("profile", F.struct("n", -F.col("ordinal"))).alias("profile"), F.max("n").alias("n"))


def sensitive_summary(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Findings per key and type."""
    from docfacts.functions.text import redact_sensitive

    _, found = redact_sensitive(F.col(text))
    cells = F.array(*[F.struct(F.lit(k).alias("type"), v.cast("long").alias("n")) for k, v in found.items()])
    return df.select(*keys, F.explode(cells).alias("c")).filter("c.n > 0").groupBy(*keys, F.col("c.type").alias("type")).agg(F.sum("c.n").alias("findings"))


def value_conflicts(df: DataFrame, key: list[str], fields: list[str], source: str) -> DataFrame:
    """Fields with several distinct values per key, with the sources of each."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    long = df.select(*key, F.col(source).alias("source"), F.explode(cells).alias("c")).select(*key, "c.field", "c.value", "source").filter("value <> ''")
    by = long.groupBy(*key, "field", "value").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    return by.groupBy(*key, "field").agg(F.array_sort(F.collect_list(F.struct("value", "sources"))).alias("values")).filter(F.size("values") > 1)


def duplicate_numbers(df: DataFrame, number: str, name: str, source: str) -> DataFrame:
    """Certificate numbers that occur more than once."""
    from docfacts.functions.text import compact

    return df.withColumn("number", F.upper(compact(F.col(number)))).filter("number <> ''").groupBy("number").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(name)).alias("names"), F.array_sort(F.collect_set(source)).alias("sources")
    ).filter("n > 1")


def status_summary(df: DataFrame, keys: list[str], holder: str, status: str, review: str, statuses: list[str]) -> DataFrame:
    """Holders, counts per status, rows to review."""
    return df.groupBy(*keys).agg(F.count_distinct(holder).alias("holders"), *[F.count_if(F.col(status) == s).alias(s.lower()) for s in statuses], F.count_if(review).alias("review_required"))


def collect_refs(df: DataFrame, keys: list[str], refs: str) -> DataFrame:
    """Sorted distinct references."""
    return df.select(*keys, F.explode(refs).alias("r")).groupBy(*keys).agg(F.array_sort(F.collect_set("r")).alias(refs))
