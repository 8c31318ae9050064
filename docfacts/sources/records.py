"""Scans of records, pages, markers, cells and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.functions.text import once

IMAGE_SUFFIXES = r"(?i)\.(jpg|jpeg|png|bmp|webp|tif|tiff|pdf)$"
AWARD_HEADERS = ["项目名称", "标段名称", "中标人", "中标金额"]


def read_certificate_records(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON records; one that can't be read gives a row with its text in _corrupt and stops nothing."""
    return (
        spark.read.schema(schema + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(paths)
        .withColumn("source_path", F.col("_metadata.file_path")).withColumn("source_dir", F.regexp_extract("source_path", "^(.*)/[^/]*$", 1))
    )


def several_directories(records: DataFrame) -> DataFrame:
    """Kinds whose records come from more than one directory (an error of the caller)."""
    return records.groupBy("kind").agg(F.count_distinct("source_dir").alias("directories")).filter("directories > 1")


def scan_content_hash(spark: SparkSession, path: str, cap: int) -> DataFrame:
    """(path, length, sha256) of regular files; larger ones than the cap have an error instead of a hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ok = F.col("length") <= cap
    return files.select("path", "length", F.when(ok, F.sha2("content", 256)).alias("sha256"), F.when(~ok, "file is too large").alias("error"))


def scan_images(spark: SparkSession, path: str, cap: int, recursive: bool = True) -> DataFrame:
    """S3: supported files by suffix; empty and too large ones carry an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).filter(F.col("path").rlike(IMAGE_SUFFIXES))
    error = F.when(F.col("length") > cap, "file is too large")
    found = files.select("path", "length", F.when(error.isNull(), F.sha2("content", 256)).alias("sha256"), error.alias("error"))
    empty = [(p, 0, None, "empty file") for p in empty_files(spark, path, recursive)]
    return found.unionByName(spark.createDataFrame(empty, "path string, length long, sha256 string, error string").filter(F.col("path").rlike(IMAGE_SUFFIXES)))


def empty_files(spark: SparkSession, path: str, recursive: bool = True) -> list[str]:
    """Paths of empty files, which Spark's file sources leave out of their listing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    listing, out = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, recursive), []
    while listing.hasNext():
        f = listing.next()
        if f.getLen() == 0:
            out.append(f.getPath().toString())
    return out


def read_award_rows(cells: DataFrame, headers: list[str] = AWARD_HEADERS, no_winner: str = "无数据") -> DataFrame:
    """Award rows of a cell table (sheet, row_no, col_no, value): the header is the first of 20 rows and 100 columns that has all headers; rows without project and title rows are left out."""
    text = F.regexp_replace(F.coalesce("value", F.lit("")), r"(?U)\s+", "")
    near = cells.filter("row_no <= 20 AND col_no <= 100").withColumn("t", text)
    rows = near.groupBy("sheet", "row_no").agg(F.collect_set("t").alias("have")).filter(F.size(F.array_intersect("have", F.array(*[F.lit(h) for h in headers]))) == len(headers))
    head = rows.groupBy("sheet").agg(F.min("row_no").alias("header_row"))
    names = near.join(head, "sheet").filter("row_no = header_row").filter(F.col("t").isin(headers)).groupBy("sheet", "header_row", "t").agg(F.min("col_no").alias("col_no")).withColumnRenamed("t", "name")
    body = cells.join(names, ["sheet", "col_no"]).filter("row_no > header_row")
    wide = body.groupBy("sheet", "row_no").pivot("name", headers).agg(F.first(F.trim("value")))
    project, lot, winner, amount = (F.nullif(F.col(f"`{h}`"), F.lit("")) for h in headers)
    kept = wide.filter(project.isNotNull() & F.coalesce(lot, winner, amount).isNotNull())
    return kept.select("sheet", "row_no", project.alias("project_name"), lot.alias("lot"), F.when(winner != no_winner, winner).alias("winner"), amount.alias("amount_text"))


MARKER = r"<!--\s*PDF page ([0-9]+)\s*-->"


def explode_page_markers(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages, errors) of Markdown documents (doc_id, text) with page markers; missing, repeated or falling markers reject the document."""
    numbers = F.transform(F.regexp_extract_all("text", F.lit(MARKER), F.lit(1)), lambda x: x.cast("int"))
    parts = F.slice(F.split("text", MARKER), 2, 1_000_000)
    d = docs.select("doc_id", numbers.alias("numbers"), parts.alias("parts"))
    rising = F.forall(F.sequence(F.lit(1), F.greatest(F.size("numbers") - 1, F.lit(1))), lambda i: F.coalesce(F.try_element_at("numbers", i) < F.try_element_at("numbers", i + 1), F.lit(True)))
    d = d.withColumn("error", F.when(F.size("numbers") == 0, "no page marker").when(~rising, "page markers do not rise"))
    pages = d.filter("error IS NULL").select("doc_id", F.explode(F.arrays_zip("numbers", "parts")).alias("p")).select("doc_id", F.col("p.numbers").alias("physical_page"), F.trim(F.col("p.parts")).alias("text"))
    return pages, d.filter("error IS NOT NULL").select("doc_id", "error")


def read_front_matter(c: Column, most_lines: int = 100) -> Column:
    """`key: json` lines between the first two `---` of the first lines, as a map of JSON texts."""
    head = F.array_join(F.slice(F.split(c, "\r?\n"), 1, most_lines), "\n")
    block = F.regexp_extract(head, r"^---\n((?s:.*?))\n---", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^[A-Za-z_][A-Za-z0-9_]*:\s"))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^([A-Za-z0-9_]+):", 1).alias("k"), F.regexp_extract(x, r"^[A-Za-z0-9_]+:\s*(.*)$", 1).alias("v")))
    last = F.filter(pairs, lambda p: F.element_at(F.filter(pairs, lambda q: q["k"] == p["k"]), -1)["v"] == p["v"])
    return F.map_from_entries(F.array_distinct(last))


# An optional project id, and the words that say what a file is.
PROJECT_ID, TENDER, BID = "[0-9a-fA-F]{32}", "招标文件", "投标文件"


def project_inputs(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of files (project_key: their folder, name) by the grammar of file names.

    A name is `prefix`, an optional 32-digit id, then what the file is; without an id it ends in that word. Only PDF files
    count, hidden and temporary ones don't. A project has exactly one tender; a bid's id, if both have one, is the tender's.
    documents: (project_key, name, kind, project_id of the tender, company: prefix of a bid).
    """
    plain = ~F.col("name").startswith(".") & ~F.col("name").startswith("~$") & F.lower("name").endswith(".pdf")
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    d = files.filter(plain).withColumn("_stem", stem).withColumn("_ids", F.regexp_extract_all("_stem", F.lit(f"({PROJECT_ID})"), F.lit(1)))
    one = F.size("_ids") == 1
    with_id = lambda group: F.regexp_extract("_stem", f"^(.*?){PROJECT_ID}(.*)$", group)
    prefix = F.when(one, with_id(1)).otherwise(F.regexp_extract("_stem", f"^(.*)(?:{TENDER}|{BID})$", 1))
    what = F.when(one, F.regexp_replace(with_id(2), "^[ _-]+", "")).otherwise(F.regexp_extract("_stem", f"({TENDER}|{BID})$", 1))
    d = d.withColumn("_prefix", F.regexp_replace(prefix, "[ _-]+$", "")).withColumn("_what", what)
    kind = F.when(F.col("_what").startswith(TENDER), "tender").when(F.col("_what").startswith(BID), "bid")
    d = d.withColumn("kind", kind).withColumn("_id", F.when(one, F.lower(F.element_at("_ids", 1))))
    wrong = F.when(F.size("_ids") > 1, "several project ids in the name").when(F.col("kind").isNull(), "name does not say tender or bid").when(F.col("_prefix") == "", "no name before the kind")
    d = d.withColumn("_error", wrong)
    good = d.filter("_error IS NULL")
    by = files.select("project_key").distinct().join(
        good.groupBy("project_key").agg(F.count_if(F.col("kind") == "tender").alias("_n"), F.max(F.when(F.col("kind") == "tender", F.col("_id"))).alias("project_id")), "project_key", "left"
    ).withColumn("_n", F.coalesce("_n", F.lit(0)))
    j = good.join(by, "project_key")
    clash = (F.col("kind") == "bid") & (F.col("_n") == 1) & (F.col("_id") != F.col("project_id"))
    kept = j.filter((F.col("kind") == "tender") | (F.col("_n") == 1)).filter(~F.coalesce(clash, F.lit(False)))
    documents = kept.select("project_key", "name", "kind", F.when(F.col("_n") == 1, F.col("project_id")).alias("project_id"), F.when(F.col("kind") == "bid", F.col("_prefix")).alias("company"))
    none = F.lit(None).cast("string")
    errors = d.filter("_error IS NOT NULL").select("project_key", "name", F.col("_error").alias("error"))
    errors = errors.unionByName(j.filter(clash).select("project_key", "name", F.lit("id differs from the tender's").alias("error")))
    count = F.when(F.col("_n") == 0, "no tender").otherwise("several tenders")
    return documents, errors.unionByName(by.filter("_n <> 1").select("project_key", none.alias("name"), count.alias("error")))


def selected_projects(documents: DataFrame, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, unknown) of selections (selection) by a project's key or id, whatever their case."""
    want = selected.select(F.lower("selection").alias("_s")).distinct()
    names = documents.select("project_key", F.explode(F.array_compact(F.array(F.lower("project_key"), F.lower("project_id")))).alias("_s")).distinct()
    hits = names.join(want, "_s")
    return documents.join(hits.select("project_key").distinct(), "project_key", "left_semi"), want.join(hits, "_s", "left_anti").withColumnRenamed("_s", "selection")


def select_image_location(documents: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(located, errors): each record's image by its exact file name in the folder of its kind; kinds without a folder keep their source path.

    documents: (kind, source_file, source_path); images: (kind, name, path) of all images of the folders that were given.
    """
    base = F.regexp_extract(F.coalesce("source_path", F.lit("")), r"([^/\\]*)$", 1)
    d = documents.withColumn("_name", F.coalesce("source_file", base))
    given = images.select("kind", F.lit(True).alias("_given")).distinct()
    d = d.join(given, "kind", "left")
    bad = F.col("_given") & ~F.coalesce(F.col("_name").rlike(r"(?i)^[^/\\]+\.(png|jpe?g)$"), F.lit(False))
    found = d.filter(~F.coalesce(bad, F.lit(False))).join(images.select("kind", F.col("name").alias("_name"), F.col("path").alias("_path")), ["kind", "_name"], "left")
    located = found.withColumn("image_path", F.when(F.col("_given"), F.col("_path")).otherwise(F.col("source_path")))
    return located.select(*documents.columns, "image_path"), d.filter(bad).select(*documents.columns, F.lit("source_file has to be the bare name of an image").alias("error"))


def load_state(tables: dict[str, DataFrame], company_id: int, field_codes: list[str]) -> dict[str, DataFrame]:
    """The company's part of every state table; filters and columns reach the source."""
    out = {n: t.where(F.col("company_id") == company_id) for n, t in tables.items() if "company_id" in t.columns}
    if "profile_value" in out:
        out["profile_value"] = out["profile_value"].where(F.col("field_code").isin(field_codes))
    if "field_definition" in tables:
        out["field_definition"] = tables["field_definition"].where(F.col("field_code").isin(field_codes))
    return out


def read_profile_inputs(docs: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(inputs, errors): documents (path, project, company_key, meta map) with complete front matter, one for each company of a project."""
    from docfacts.operators.windows import first_row

    complete = F.forall(F.array(*[F.lit(k) for k in required]), lambda k: F.coalesce(F.try_element_at("meta", k), F.lit("")) != "")
    d = docs.withColumn("complete", F.coalesce(complete, F.lit(False)))
    first = first_row(d.filter("complete"), ["project", "company_key"], [F.col("path")])
    errors = d.filter("NOT complete").select("path", F.lit("front matter is incomplete").alias("error")).unionByName(d.filter("complete").join(first, "path", "left_anti").select("path", F.lit("another document of the company is used").alias("error")))
    return first.drop("complete"), errors


def read_model_responses(spark: SparkSession, path: str, payload: str) -> DataFrame:
    """Stored responses (chunk_key, data, usage, cached, request_count)."""
    return spark.read.schema(f"chunk_key string, data {payload}, usage map<string,string>, cached boolean, request_count int").json(path)


def first_object(c: Column) -> Column:
    """The first balanced JSON object in a text: braces in strings don't count, nor do escaped quotes. Null if none closes."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(s: Column, x: Column) -> Column:
        ch, i = x["ch"], x["i"]
        inside = s["depth"] > 0
        quote = inside & (ch == '"') & ~s["escaped"]
        opens, closes = ~s["quoted"] & (ch == "{"), inside & ~s["quoted"] & (ch == "}")
        depth = s["depth"] + opens.cast("int") - closes.cast("int")
        now = F.struct(
            depth.alias("depth"), F.when(quote, ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"), (s["quoted"] & ~s["escaped"] & (ch == "\\")).alias("escaped"),
            F.when(opens & ~inside, i).otherwise(s["first"]).alias("first"), F.when(closes & (depth == 0), i).otherwise(s["last"]).alias("last"),
        )
        return F.when(s["last"] >= 0, s).otherwise(now)

    chars = F.transform(F.split(c, ""), lambda ch, i: F.struct(ch.alias("ch"), i.alias("i")))
    found = F.aggregate(chars, start, step)
    return once(found, lambda s: F.when(s["last"] >= 0, F.substring(c, s["first"] + 1, s["last"] - s["first"] + 1)))


def parse_json_object_text(c: Column, schema: str) -> Column:
    """The first balanced object of a model's answer, read with a schema."""
    return F.from_json(first_object(c), schema)


def read_reviews(c: Column) -> Column:
    """Manual confirmations {entry id: {...}} as an array of (key, value), the entry's id and its review."""
    return F.map_entries(F.from_json(c, "map<string,struct<note:string,contentConfirmed:boolean,affiliationConfirmed:boolean,companyId:int>>"))


def review_errors(reviews: DataFrame, known: DataFrame) -> DataFrame:
    """Reviews (entry_id, note) with a bad key, no note, or an unknown entry."""
    bad = reviews.filter(~F.col("entry_id").rlike("^[0-9a-f]{64}$") | (F.trim(F.coalesce("note", F.lit(""))) == "")).select("entry_id", F.lit("key or note is missing").alias("error"))
    return bad.unionByName(reviews.join(known, "entry_id", "left_anti").select("entry_id", F.lit("unknown entry").alias("error")))


def assemble_block_text(blocks: DataFrame, expected: DataFrame) -> DataFrame:
    """Page text of layout blocks (doc_id, page, index, content); pages that are expected (doc_id, total_pages) and missing are ''."""
    got = blocks.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("index", "content"))).alias("b")).select("doc_id", "page", F.array_join(F.transform("b", lambda x: x["content"]), "\n").alias("text"))
    pages = expected.filter("total_pages > 0").select("doc_id", F.explode(F.sequence(F.lit(1), "total_pages")).alias("page"))
    return pages.join(got, ["doc_id", "page"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def page_candidates(native: DataFrame, initial: DataFrame, retry: DataFrame) -> DataFrame:
    """The passes in one schema; empty text needs OCR; a confidence that is not finite is null."""
    def one(df: DataFrame, name: str) -> DataFrame:
        c = F.col("confidence").cast("double")
        return df.select("doc_id", "physical_page", F.lit(name).alias("pass"), "text", F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c).alias("confidence"), (F.trim(F.coalesce("text", F.lit(""))) == "").alias("needs_ocr"))

    return one(native, "native").unionByName(one(initial, "initial")).unionByName(one(retry, "retry"))
