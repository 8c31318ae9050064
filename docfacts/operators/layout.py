"""Page layout: sections, clauses, table rows and evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docfacts.functions.text import WHITE
from docfacts.operators.windows import running_offset

NODE = ["doc_id", "page", "ordinal", "item_id", "text", "x", "y", "width", "height"]


def solid(c: Column) -> Column:
    """Text without white space, characters as they are written."""
    return F.coalesce(F.regexp_replace(c, WHITE, ""), F.lit(""))


def content_nodes(nodes: DataFrame) -> DataFrame:
    """Without image placeholders and footers."""
    text = solid(F.col("text"))
    return nodes.filter(~F.col("text").startswith("[Image:") & ~((F.col("y") < 70) & text.rlike(r"^([0-9]+|https?://\S+)$")))


def page_texts(nodes: DataFrame) -> DataFrame:
    """(doc_id, page, text) in node order, without white space."""
    return nodes.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("ordinal", solid(F.col("text")).alias("t")))).alias("n")).select("doc_id", "page", F.array_join(F.transform("n", lambda x: x["t"]), "").alias("text"))


def _any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


# Words that open the sections of a tender document.
ANCHORS = {
    "titles": ["招标公告", "投标邀请书", "采购公告", "谈判采购公告", "单一来源采购公告"],
    "front": ["投标人须知前附表", "申请人须知前附表", "供应商须知前附表"],
    "general": ["投标人须知正文", "申请人须知正文", "供应商须知正文"],
    "evaluation": ["评标办法", "评审办法"],
    "evaluation_with": ["评标委员会", "评审小组", "评审标准", "综合评估法", "综合评分法"],
    "contract": ["合同条款及格式", "通用合同条款", "合同草案", "合同文本"],
}


def locate_sections(pages: DataFrame) -> DataFrame:
    """(doc_id, section, page): announcement, front table, general part and evaluation, each from its first anchor to the next one.

    pages: (doc_id, page, text without white space). Limits where the next anchor is missing: 8, 12, 20 and 20 pages.
    """
    t = F.col("text")
    titles = _any(t, ANCHORS["titles"]) & ~t.rlike(r"\.{6,}")
    meaning = (_any(t, ["招标条件"]) & _any(t, ["项目概况", "招标范围"])) | (_any(t, ["项目概况"]) & _any(t, ["采购需求", "采购范围", "供应商资格"]))
    front = _any(t, ANCHORS["front"]) | (_any(t, ["1.1.2"]) & _any(t, ["1.3.1"]) & _any(t, ["资金来源"]))
    general = _any(t, ANCHORS["general"]) | (_any(t, ["1.1.1"]) & _any(t, ["见投标人须知前附表"]))
    strong = t.rlike(r"^.{0,179}(?:第三|第四)章(?:入围)?(?:评标|评审)办法") & (_any(t, ["办法前附表", "评审方法"]) | t.rlike("(?:评标|评审)办法[（(].+?法[）)]"))
    loose = _any(t, ANCHORS["evaluation"]) & _any(t, ANCHORS["evaluation_with"])
    contract = _any(t, ANCHORS["contract"])
    marks = {"ann": titles | meaning, "front": front, "general": general, "strong": strong, "loose": loose, "contract": contract}
    marked = pages.select("doc_id", "page", *[m.alias(k) for k, m in marks.items()])

    def first(df: DataFrame, mark: Column, after: str | None, name: str) -> DataFrame:
        w = W.partitionBy("doc_id")
        ok = mark if after is None else mark & (F.col("page") > F.col(after))
        return df.withColumn(name, F.min(F.when(ok, F.col("page"))).over(w))

    last = F.max("page").over(W.partitionBy("doc_id")) + 1
    d = first(marked, F.col("ann"), None, "start").withColumn("start", F.coalesce("start", F.lit(1))).withColumn("last", last)
    d = first(d, F.col("front"), "start", "f0")
    d = first(d, F.col("general"), "f0", "g0").withColumn("base", F.coalesce("f0", "start"))
    d = first(first(d, F.col("strong"), "base", "s0"), F.col("loose"), "base", "l0").withColumn("e0", F.coalesce("s0", "l0"))
    d = first(d, F.col("contract"), "e0", "c0")
    ends = {
        "announcement": ("start", F.coalesce("f0", F.least("last", F.col("start") + 8))),
        "front": ("f0", F.coalesce("g0", "e0", F.least("last", F.col("f0") + 12))),
        "general": ("g0", F.coalesce("e0", "c0", F.least("last", F.col("g0") + 20))),
        "evaluation": ("e0", F.coalesce("c0", F.least("last", F.col("e0") + 20))),
    }
    inside = F.array_compact(F.array(*[F.when((F.col("page") >= F.col(a)) & (F.col("page") < b), F.lit(s)) for s, (a, b) in ends.items()]))
    return d.select("doc_id", "page", F.explode(inside).alias("section"))


def view_offsets(nodes: DataFrame, key: list[str]) -> DataFrame:
    """Nodes of a view with start and end in its text without white space."""
    return running_offset(nodes.withColumn("solid", solid(F.col("text"))), key, "ordinal", F.length("solid"))


def section_text(view: DataFrame, key: list[str]) -> DataFrame:
    """The text of each view (a section of one document)."""
    return view.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start_off", "solid"))).alias("n")).select(*key, F.array_join(F.transform("n", lambda x: x["solid"]), "").alias("view_text"))


def announcement_clauses(view: DataFrame, texts: DataFrame) -> DataFrame:
    """Numbered nodes start clauses that run to the next number: (doc_id, number, start, end, text)."""
    pattern = r"^([0-9]+(?:\.[0-9]+)+)[、.]?"
    starts = view.filter(F.col("solid").rlike(pattern)).select("doc_id", "start_off", F.regexp_extract("solid", pattern, 1).alias("number"), F.length(F.regexp_extract("solid", pattern, 0)).alias("skip"))
    nxt = F.lead("start_off").over(W.partitionBy("doc_id").orderBy("start_off"))
    rows = starts.withColumn("next", nxt).join(texts.select("doc_id", "view_text"), "doc_id")
    rows = rows.withColumn("start", F.col("start_off") + F.col("skip")).withColumn("end", F.coalesce("next", F.length("view_text")))
    return rows.select("doc_id", "number", "start", "end", F.substring(F.col("view_text"), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("text"))


def clause_fields(clauses: DataFrame, labels: dict[str, list[str]]) -> DataFrame:
    """Clauses that begin with a field's label: (doc_id, field, value, start, end)."""
    hits = F.array_compact(F.array(*[
        F.when(F.col("text").rlike(f"^{label}[：:]?."), F.struct(F.lit(field).alias("field"), F.regexp_replace("text", f"^{label}[：:]?", "").alias("value")))
        for field, names in labels.items() for label in names
    ]))
    rows = clauses.select("doc_id", "number", "start", "end", "text", F.explode(hits).alias("h"))
    return rows.select("doc_id", F.col("h.field").alias("field"), F.col("h.value").alias("value"), (F.col("end") - F.length("h.value")).alias("start"), "end")


def _joined(pairs: DataFrame, order: list[Column]) -> DataFrame:
    got = pairs.groupBy("doc_id", "page", "label_id", "label").agg(F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col("item_id"), F.col("solid").alias("s")))).alias("n"))
    return got.select("doc_id", "page", "label_id", "label", F.array_join(F.transform("n", lambda x: x["s"]), "").alias("value"), F.transform("n", lambda x: x["item_id"]).alias("items"))


def _labels(nodes: DataFrame, labels: list[str]) -> DataFrame:
    found = nodes.filter(solid(F.col("text")).isin(labels))
    return found.select("doc_id", "page", F.col("item_id").alias("label_id"), solid(F.col("text")).alias("label"), F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("width").alias("lw"))


def row_values(nodes: DataFrame, labels: list[str]) -> DataFrame:
    """Nodes right of a label on its baseline, from left to right: an equi-join on the page with a residual."""
    cells = nodes.select("doc_id", "page", "item_id", "x", "y", solid(F.col("text")).alias("solid"))
    pairs = _labels(nodes, labels).join(cells, ["doc_id", "page"]).filter((F.col("x") > F.col("lx") + F.col("lw") + 2) & (F.abs(F.col("y") - F.col("ly")) < 8))
    return _joined(pairs, [F.col("x")])


def row_counts(nodes: DataFrame, labels: list[str]) -> DataFrame:
    """How many nodes row_values has for a label: (doc_id, page, label_id, label, cells), labels without any left out.

    Lines (the distinct y of a page) are joined to the baselines within 8 units by equality of buckets. A label asks each of its lines for the nodes right of it,
    a running count from right to left, so a page costs its nodes plus a row for each label and line, not all pairs.
    """
    on, cells = ["doc_id", "page"], nodes.filter("x IS NOT NULL AND y IS NOT NULL").select("doc_id", "page", "x", "y")
    asking, cell = _labels(nodes, labels), F.floor(F.col("y") / 8)
    baselines = asking.select(*on, "ly").distinct().withColumn("_near", F.floor(F.col("ly") / 8)).select(*on, "ly", F.explode(F.array(*[F.col("_near") + k for k in (-1, 0, 1)])).alias("_cell"))
    lines = baselines.join(cells.select(*on, "y", cell.alias("_cell")).distinct(), [*on, "_cell"]).filter(F.abs(F.col("y") - F.col("ly")) < 8).select(*on, "ly", "y")
    asks = asking.join(lines, [*on, "ly"]).select(*on, "y", (F.col("lx") + F.col("lw") + 2).alias("x"), "label_id", "label", F.lit(0).alias("_is")).filter("x IS NOT NULL")
    none = F.lit(None).cast("string")
    both = cells.select(*on, "y", "x", none.alias("label_id"), none.alias("label"), F.lit(1).alias("_is")).unionByName(asks)
    w = W.partitionBy(*on, "y").orderBy(F.col("x").desc(), "_is").rowsBetween(W.unboundedPreceding, W.currentRow)  # a label before the nodes at its edge, which are not right of it
    counted = both.withColumn("n", F.sum("_is").over(w)).filter("_is = 0 AND n > 0")
    return counted.groupBy(*on, "label_id", "label").agg(F.sum("n").alias("cells"))


def row_band_values(nodes: DataFrame, labels: list[str]) -> DataFrame:
    """A wrapped value cell: nodes in the band between the midpoints to the neighbouring clause numbers (45 units without one)."""
    cells = nodes.select("doc_id", "page", "item_id", "x", "y", solid(F.col("text")).alias("solid"))
    lab = _labels(nodes, labels)
    anchors = lab.join(cells.filter(F.col("solid").rlike(r"^[0-9]+(?:\.[0-9]+)+$")), ["doc_id", "page"]).filter("x < lx")
    w = W.partitionBy("doc_id", "page", "label_id").orderBy("y")
    anchors = anchors.withColumn("below", F.lag("y").over(w)).withColumn("above", F.lead("y").over(w))
    near = anchors.groupBy("doc_id", "page", "label_id", "label").agg(F.min_by(F.struct("y", "below", "above", "lx", "lw"), F.abs(F.col("y") - F.col("ly"))).alias("a"))
    band = near.select("doc_id", "page", "label_id", "label", (F.col("a.lx") + F.col("a.lw") + 2).alias("left"), F.coalesce((F.col("a.y") + F.col("a.above")) / 2, F.col("a.y") + 45).alias("upper"), F.coalesce((F.col("a.y") + F.col("a.below")) / 2, F.col("a.y") - 45).alias("lower"))
    return _joined(band.join(cells, ["doc_id", "page"]).filter("x > left AND y > lower AND y < upper"), [-F.col("y"), F.col("x")])


def front_value_columns(nodes: DataFrame) -> DataFrame:
    """C11: nodes of the value column: right of the median x of long texts, less 25."""
    edge = nodes.filter(F.length(solid(F.col("text"))) > 20).groupBy("doc_id", "page").agg((F.percentile("x", 0.5) - 25).alias("edge"))
    return nodes.join(edge, ["doc_id", "page"]).filter("x >= edge").drop("edge")


def solid_marks(text: Column) -> Column:
    """The index from solid characters to raw ones: where in the text its first, second, ... character that is no white space stands."""
    marks = F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike(r"(?U)\S"), i))
    return F.filter(marks, lambda i: i.isNotNull())


def map_span_to_evidence(spans: DataFrame, view: DataFrame, key: list[str]) -> DataFrame:
    """Spans (key, span_id, start, end) of a view's text as one evidence row per node, with offsets in the node's own text."""
    pairs = spans.join(view, key).filter("start < end_off AND end > start_off")
    a = F.greatest(F.col("start") - F.col("start_off"), F.lit(0)).cast("int")
    b = (F.least(F.col("end"), F.col("end_off")) - F.col("start_off")).cast("int")
    rows = pairs.withColumn("marks", solid_marks(F.col("text"))).withColumn("from", F.element_at("marks", a + 1)).withColumn("to", F.element_at("marks", b) + 1)
    return rows.select(*key, "span_id", "item_id", "page", F.col("from").alias("start"), F.col("to").alias("end"), F.array("x", "y", "width", "height").alias("bbox"), F.substring(F.col("text"), F.col("from") + 1, F.col("to") - F.col("from")).alias("text"))


def truncate_with_evidence(evidence: DataFrame, key: list[str], order: str, length: Column) -> DataFrame:
    """C14: evidence pieces (start, end, text) cut to the first `length` solid characters of their value, to the raw character at which these end."""
    w = W.partitionBy(*key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    rows = evidence.withColumn("_marks", solid_marks(F.col("text")))
    rows = rows.withColumn("_room", length - F.coalesce(F.sum(F.size("_marks")).over(w), F.lit(0))).filter("_room > 0")
    cut = F.when(F.col("_room") < F.size("_marks"), F.element_at("_marks", F.col("_room").cast("int")) + 1).otherwise(F.length("text"))
    return rows.withColumn("text", F.left("text", cut)).withColumn("end", F.col("start") + F.length("text")).drop("_marks", "_room")


def merge_ranges(ranges: DataFrame, key: list[str]) -> DataFrame:
    """(key, start, end, roles): ranges (key, start, end, role) that overlap are one; a sweep over their starts with the furthest end so far. Empty ones are left out."""
    w = W.partitionBy(*key).orderBy("start", "end")
    reached = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    once = ranges.filter(F.col("end") > F.col("start")).groupBy(*key, "start", "end").agg(F.collect_set("role").alias("_roles"))  # so that the order has no ties
    rows = once.withColumn("_new", (reached.isNull() | (F.col("start") >= reached)).cast("int"))
    grouped = rows.withColumn("_range", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return grouped.groupBy(*key, "_range").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_roles")))).alias("roles")).drop("_range")
