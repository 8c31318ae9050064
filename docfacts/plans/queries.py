"""Queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docfacts.functions import text as T
from docfacts.functions import values as V
from docfacts.operators import classify, joins, merge, profile, windows

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
AS_OF = "1999-06-30"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query(r"""
WITH c AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', E'\n\n', 'g'), E' \t\n\r') AS x,
  trim(regexp_replace(text, '\s+', ' ', 'g')) AS y, regexp_replace(text, '\s+', '', 'g') AS z FROM documents)
SELECT doc_id, md5(nullif(x, '')) AS cleaned, md5(nullif(y, '')) AS inline, coalesce(length(z), 0)::INT AS solid_chars FROM c""")
def text_normalize(spark, sf_dir):
    """F1, F3, F5."""
    d, c = read(spark, sf_dir, "documents"), F.col("text")
    return d.select("doc_id", F.md5(T.clean_text(c, None)).alias("cleaned"), F.md5(T.clean_inline_text(c)).alias("inline"), F.length(T.compact(c)).alias("solid_chars"))


@query("""
SELECT lang, source, count(*) AS documents, count(*) FILTER (regexp_matches(text, '(^|[^0-9])[0-9]{16,19}($|[^0-9])')) AS with_account,
  count(*) FILTER (regexp_matches(text, '(^|[^0-9])1[3-9][0-9]{9}($|[^0-9])')) AS with_phone FROM documents GROUP BY lang, source""")
def redact_findings(spark, sf_dir):
    """F12."""
    _, found = T.redact_sensitive(F.col("text"))
    d = read(spark, sf_dir, "documents").select("lang", "source", (found["BANK_ACCOUNT_CANDIDATE"] + found["PERSONAL_ID"] > 0).alias("a"), (found["PHONE"] > 0).alias("p"))
    return d.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("a").alias("with_account"), F.count_if("p").alias("with_phone"))


TEXT_RULES = [
    ("TABULAR", [r" \| ", r"\|$"]), ("SHOUTED", ["!! [A-Z]", "[A-Z]{4,}!!"]), ("MARKED", [r"[$]{3}", "[#]{3}", "[%]{3}"]),
    ("LICENSED", ["licen[sc]e", "copyright"]), ("CONTACT", ["[a-z0-9]+@[a-z0-9.]+", "https?://"]), ("PROSE", [" the ", " der ", " les ", " los "]),
]
_SCORES = ", ".join(f"({' + '.join(f'''regexp_matches(text, '(?i){p}')::INT''' for p in ps)}) AS s{k}" for k, (_, ps) in enumerate(TEXT_RULES))
_BEST = f"greatest({', '.join(f's{k}' for k in range(len(TEXT_RULES)))})"
_PICK = " ".join(f"WHEN s{k} = best THEN '{n}'" for k, (n, _) in enumerate(TEXT_RULES))


@query(f"""
WITH s AS (SELECT doc_id, {_SCORES} FROM documents), b AS (SELECT *, {_BEST} AS best FROM s)
SELECT doc_id, CASE WHEN best = 0 THEN 'OTHER' {_PICK} END AS document_type, CASE WHEN best >= 2 THEN 'HIGH' WHEN best = 1 THEN 'MEDIUM' ELSE 'LOW' END AS classification_confidence, best AS score FROM b""")
def classify_documents(spark, sf_dir):
    """C1."""
    return classify.classify_pages(read(spark, sf_dir, "documents").select("doc_id", "text"), rules=TEXT_RULES, preview=None).drop("text")


@query(f"""
WITH s AS (SELECT source, {_SCORES} FROM documents), b AS (SELECT *, {_BEST} AS best FROM s)
SELECT source, CASE WHEN best = 0 THEN 'OTHER' {_PICK} END AS document_type, count(*) AS n FROM b GROUP BY 1, 2""")
def count_document_types(spark, sf_dir):
    """C1 with a count; `plan_counts` runs A15."""
    return classify.classify_pages(read(spark, sf_dir, "documents").select("source", "text"), rules=TEXT_RULES, preview=None).groupBy("source", "document_type").agg(F.count(F.lit(1)).alias("n"))


@query(r"""
WITH s AS (SELECT doc_id, length(text) AS text_length, regexp_replace(text, '\s+', '', 'g') AS z FROM documents),
r AS (SELECT *, length(z) AS n, length(regexp_replace(z, '[^\p{L}\p{N}，。；：！？、（）()\[\]【】%￥¥.\-_/]', '', 'g')) AS good, length(regexp_replace(z, '[^�□■?\x00-\x1F]', '', 'g')) AS bad FROM s)
SELECT doc_id, text_length::INT AS text_length, CASE WHEN n < 12 THEN 'EMPTY' WHEN good::DOUBLE / n < 0.55 OR bad::DOUBLE / n > 0.08 THEN 'GARBLED' ELSE 'READABLE' END AS text_status FROM r""")
def readability(spark, sf_dir):
    """F19."""
    got = T.text_readability(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", got["text_length"].alias("text_length"), got["text_status"].alias("text_status"))


@query("""
SELECT conv_id, turn, CASE WHEN lag(turn) OVER w = turn - 1 THEN md5(left(lag(text) OVER w, 240)) END AS previous_md5,
  CASE WHEN lead(turn) OVER w = turn + 1 THEN md5(left(lead(text) OVER w, 240)) END AS next_md5 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def page_neighbours(spark, sf_dir):
    """W10."""
    n = windows.neighbours(read(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", 240)
    return n.select("conv_id", "turn", F.md5("previous_text").alias("previous_md5"), F.md5("next_text").alias("next_md5"))


@query("""
WITH d AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
f AS (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY pos) = event_type THEN 0 ELSE 1 END AS fresh FROM d),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY pos) AS run FROM f)
SELECT user_id, event_type, min(pos) AS start, max(pos) AS "end", count(*) AS n FROM g GROUP BY user_id, event_type, run""")
def section_runs(spark, sf_dir):
    """W2."""
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return windows.section_runs(read(spark, sf_dir, "events").withColumn("at", at), ["user_id"], "at", ["event_type"])


@query("""
WITH d AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders), i AS (SELECT *, o_orderkey - row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS g FROM d),
p AS (SELECT *, (o_orderkey - min(o_orderkey) OVER (PARTITION BY o_custkey, g)) // 2 AS part FROM i)
SELECT o_custkey, min(o_orderkey) AS start, max(o_orderkey) AS "end", count(*) AS n FROM p GROUP BY o_custkey, g, part""")
def contiguous_ranges(spark, sf_dir):
    """W3."""
    return windows.contiguous_ranges(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", 2)


@query("""
WITH RECURSIVE o AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
g AS (SELECT conv_id, turn, size, rn, 0 AS chunk, 1 AS n, size AS total FROM o WHERE rn = 1
  UNION ALL SELECT o.conv_id, o.turn, o.size, o.rn, CASE WHEN g.n >= 3 OR g.total + o.size > 600 THEN g.chunk + 1 ELSE g.chunk END,
    CASE WHEN g.n >= 3 OR g.total + o.size > 600 THEN 1 ELSE g.n + 1 END, CASE WHEN g.n >= 3 OR g.total + o.size > 600 THEN o.size ELSE g.total + o.size END
  FROM g JOIN o ON o.conv_id = g.conv_id AND o.rn = g.rn + 1)
SELECT conv_id, turn, size::INT AS size, chunk FROM g""")
def chunk_pages(spark, sf_dir):
    """W4."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return windows.chunk_rows(c, ["conv_id"], ["turn"], "size", 3, 600)


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_extendedprice DESC, l_linenumber) AS n FROM lineitem) WHERE n = 1""")
def best_candidate(spark, sf_dir):
    """W1."""
    best = windows.best_page_candidate(read(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.col("l_quantity"), F.col("l_extendedprice")], "l_linenumber")
    return best.select("l_orderkey", "l_linenumber", "l_quantity")


@query("""
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def latest_source(spark, sf_dir):
    """W6."""
    return windows.latest_source(read(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "event_type")


@query("""
WITH d AS (SELECT doc_id, md5(text) AS fact, lang || '/' || source AS digest FROM documents),
f AS (SELECT *, first_value(digest) OVER w AS f1, row_number() OVER w AS n FROM d WINDOW w AS (PARTITION BY fact ORDER BY doc_id)),
g AS (SELECT *, bool_or(digest <> f1) OVER (PARTITION BY fact) AS differs FROM f)
SELECT doc_id, fact, CASE WHEN digest <> f1 OR (n = 1 AND differs) THEN 'REVIEW' WHEN n > 1 THEN 'DUPLICATE' ELSE 'KEEP' END AS batch_action FROM g""")
def batch_duplicates(spark, sf_dir):
    """W7, H3."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("fact"), F.concat_ws("/", "lang", "source").alias("digest"))
    return windows.batch_duplicates(d, ["fact"], "digest", "doc_id").drop("digest")


@query("""
WITH k AS (SELECT l_orderkey, l_suppkey, count(DISTINCT l_partkey) > 1 AS collision FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, collision FROM lineitem JOIN k USING (l_orderkey, l_suppkey)""")
def collisions(spark, sf_dir):
    """W8."""
    return windows.collisions(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"], "l_partkey").select("l_orderkey", "l_linenumber", "collision")


@query("""
SELECT conv_id, turn, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 2)::BIGINT AS batch FROM conversations""")
def fixed_batches(spark, sf_dir):
    """W13."""
    return windows.fixed_batches(read(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], 2).select("conv_id", "turn", "batch")


@query("""
SELECT conv_id, turn, (sum(length(text)) OVER w - length(text))::BIGINT AS start_off, (sum(length(text)) OVER w)::BIGINT AS end_off FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""")
def running_offsets(spark, sf_dir):
    """W11."""
    return windows.running_offset(read(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.length("text")).select("conv_id", "turn", "start_off", "end_off")


_CELLS = "(SELECT o_custkey, o_orderkey, 'status' AS field, o_orderstatus AS value FROM orders UNION ALL SELECT o_custkey, o_orderkey, 'priority', o_orderpriority FROM orders)"


def _order_cells(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.array(F.col("o_orderkey").cast("string")).alias("refs"))
    return merge.merge_with_conflicts(merge.long_form(o, ["o_custkey"], "o_orderkey", "refs", ["status", "priority"]), ["o_custkey"])


@query(f"SELECT o_custkey, field, arg_min(value, o_orderkey) AS value FROM {_CELLS} GROUP BY o_custkey, field")
def merge_values(spark, sf_dir):
    """A1: the first value of each field."""
    return _order_cells(spark, sf_dir)[0]


@query(f"""
WITH v AS (SELECT o_custkey, field, value, min(o_orderkey) AS first, count(*) AS n FROM {_CELLS} GROUP BY ALL),
w AS (SELECT *, arg_min(value, first) OVER (PARTITION BY o_custkey, field) AS winner, sum(n) OVER (PARTITION BY o_custkey, field ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v)
SELECT o_custkey, field, winner AS left_value, value AS right_value, before::BIGINT AS left_n, n AS right_n FROM w WHERE value <> winner""")
def merge_conflicts(spark, sf_dir):
    """A1: conflicts with the number of references of both sides."""
    return _order_cells(spark, sf_dir)[1].select("o_custkey", "field", "left_value", "right_value", "left_n", "right_n")


@query()
def entity_components(spark, sf_dir):
    """A3: documents that share their text or their first line, transitively."""
    d = read(spark, sf_dir, "documents").filter("text IS NOT NULL")
    tokens = d.select("doc_id", F.explode(F.array(F.md5("text"), F.md5(F.substring_index("text", "\n", 1)))).alias("token"))
    return merge.token_components(tokens.withColumnRenamed("doc_id", "row_id"))


@query("""
SELECT c.c_nationkey, c.c_mktsegment AS segment, count(*) AS value, CAST(round(count(*)::DECIMAL(18,0) / sum(count(*)) OVER (PARTITION BY c.c_nationkey), 3) AS DOUBLE) AS ratio FROM customer c GROUP BY 1, 2""")
def weighted_distribution(spark, sf_dir):
    """A8, L1 (ratios compared to three places)."""
    m = windows.most_common(read(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "segment"), ["c_nationkey"], "segment", "c_custkey")
    total = F.sum("value").over(Window.partitionBy("c_nationkey"))
    return m.select("c_nationkey", "segment", "value", F.round(F.col("value").cast("double") / total, 3).alias("ratio"))


@query("""
WITH s AS (SELECT c_mktsegment, sum(CAST(CAST(o_totalprice AS DECIMAL(20,2)) * 100 AS HUGEINT)) AS total, count(*)::HUGEINT AS n, min(o_totalprice) AS min_amount, max(o_totalprice) AS max_amount
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_mktsegment, (total // n + CASE WHEN 2 * (total % n) > n OR (2 * (total % n) = n AND (total // n) % 2 = 1) THEN 1 ELSE 0 END)::DOUBLE / 100 AS average_amount, min_amount, max_amount FROM s""")
def amount_stats(spark, sf_dir):
    """A9."""
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("none", F.lit(None).cast("decimal(20,2)")).withColumn("bid", F.col("o_totalprice").cast("decimal(20,2)"))
    s = profile.amount_stats(o.filter("o_orderstatus = 'F'"), ["c_mktsegment"], "none", "bid", F.col("o_orderstatus") == "F")
    return s.select("c_mktsegment", F.col("average_amount").cast("double").alias("average_amount"), F.col("min_amount").cast("double").alias("min_amount"), F.col("max_amount").cast("double").alias("max_amount"))


@query(f"""
SELECT o_custkey, count(*) FILTER (o_orderdate::DATE BETWEEN DATE '{AS_OF}' - INTERVAL 36 MONTH AND DATE '{AS_OF}') AS recent FROM orders GROUP BY o_custkey""")
def recent_count(spark, sf_dir):
    """D8, A10."""
    o = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return profile.recent_award_count(o, ["o_custkey"], "day", F.lit(AS_OF).cast("date"))


@query(f"""
WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS start, o_orderdate::DATE + 365 AS expiry, DATE '{AS_OF}' AS t, o_orderstatus FROM orders)
SELECT o_orderkey, CASE WHEN expiry < t THEN 'EXPIRED' WHEN start > t THEN 'NOT_YET_VALID' ELSE 'VALID' END AS validity,
  CASE WHEN start > t THEN 'UNKNOWN' WHEN expiry < t THEN 'EXPIRED' WHEN expiry <= t + 90 THEN 'EXPIRING' ELSE 'VALID' END AS certificate,
  CASE WHEN expiry < t THEN 'EXPIRED' WHEN expiry <= t + 180 THEN 'EXPIRING' ELSE 'VALID' END AS expiry_status FROM d""")
def validity_status(spark, sf_dir):
    """D5-D7."""
    start, as_of = F.to_date("o_orderdate"), F.lit(AS_OF).cast("date")
    expiry = F.date_add(start, 365)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", V.validity_status(start, expiry, as_of).alias("validity"), V.certificate_status(start, expiry, F.lit(None).cast("string"), as_of).alias("certificate"), V.expiry_status(expiry, as_of, 180).alias("expiry_status")
    )


@query(r"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(round(o_totalprice, 2) AS DOUBLE) AS yuan, CAST(floor(o_totalprice) * 10000 AS DOUBLE) AS from_wan FROM orders""")
def dates_and_money(spark, sf_dir):
    """Dates and amounts written out in words and read back."""
    o = read(spark, sf_dir, "orders")
    written = F.date_format("o_orderdate", "yyyy年M月d日")
    money = F.concat(F.lit("合同价 "), F.format_number("o_totalprice", 2), F.lit("元整"))
    wan = F.concat(F.floor("o_totalprice").cast("string"), F.lit("万元"))
    return o.select("o_orderkey", V.normalize_date(written).cast("string").alias("day"), V.normalize_money(money)["amount_yuan"].cast("double").alias("yuan"), V.parse_money(wan).cast("double").alias("from_wan"))


@query("""
SELECT c.c_custkey, s.s_suppkey, count(DISTINCT l.l_orderkey) AS project_count, min(o.o_orderdate::DATE)::VARCHAR AS first_date, max(o.o_orderdate::DATE)::VARCHAR AS last_date,
  CAST(sum(CAST(l.l_extendedprice AS DECIMAL(20,2))) AS DOUBLE) AS total_amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2""")
def relationships(spark, sf_dir):
    """Customers of suppliers, evidenced by orders."""
    li, o, c, s = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    projects = j.select(F.col("s_suppkey").alias("owner"), F.col("l_orderkey").cast("string").alias("project_key"), F.col("c_custkey").cast("string").alias("customer"), F.col("l_extendedprice").cast("decimal(20,2)").alias("amount"), F.to_date("o_orderdate").alias("date"), F.array(F.lit("order")).alias("refs"), F.lit(True).alias("demonstrated"))
    declared = projects.limit(0).select("owner", F.col("customer").alias("name"), F.lit("CUSTOMER").alias("relation_type"), F.col("date").alias("first_date"), F.col("date").alias("last_date"), "refs")
    r = profile.derive_relationships(declared, projects)
    return r.select(F.col("name").cast("long").alias("c_custkey"), F.col("owner").alias("s_suppkey"), "project_count", F.col("first_date").cast("string").alias("first_date"), F.col("last_date").cast("string").alias("last_date"), F.col("total_amount").cast("double").alias("total_amount"))


@query("""
SELECT l_suppkey, p_type, l_returnflag AS claim_type, count(DISTINCT l_orderkey) AS n_refs, min(l_shipdate::DATE)::VARCHAR AS first_observed, max(l_shipdate::DATE)::VARCHAR AS last_observed, min(l_linestatus) AS source_strength
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def capability_rollup(spark, sf_dir):
    """Counts, dates and strengths of claims by plain grouping; `capabilities` runs the operator."""
    li, p = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    rows = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    each = rows.groupBy("l_suppkey", "p_type", F.col("l_returnflag").alias("claim_type"))
    return each.agg(F.count_distinct("l_orderkey").alias("n_refs"), F.min(F.to_date("l_shipdate")).cast("string").alias("first_observed"), F.max(F.to_date("l_shipdate")).cast("string").alias("last_observed"), F.min("l_linestatus").alias("source_strength"))


@query("""
SELECT n_nationkey, t.p_type AS field_code, CASE WHEN t.p_type = 'PROMO' THEN 'USER_NOT_PROVIDED' WHEN t.p_type = 'STANDARD' THEN 'DEPENDENCY_MISSING' WHEN t.p_type = 'SMALL' THEN 'NOT_COLLECTED' ELSE 'SOURCE_EMPTY' END AS reason FROM nation, (SELECT DISTINCT p_type FROM part) t
WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part p ON l_partkey = p.p_partkey WHERE s_nationkey = n_nationkey AND p.p_type = t.p_type AND l_quantity >= 50)""")
def profile_gaps(spark, sf_dir):
    """J13."""
    li, s, p, n = (read(spark, sf_dir, t) for t in ("lineitem", "supplier", "part", "nation"))
    have = li.filter("l_quantity >= 50").join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("s_nationkey").alias("n_nationkey"), F.col("p_type").alias("field_code")).distinct()
    contract = p.select(F.col("p_type").alias("field_code")).distinct()
    code = F.col("field_code")
    mode = F.when(code == "PROMO", "USER_CONFIRMED_ONLY").when(code == "STANDARD", "POST_IMPORT_DERIVED").when(code == "SMALL", "EXTERNAL_ONLY").otherwise("DIRECT")
    contract = contract.withColumn("mode", mode)
    return joins.profile_gaps(contract, have, n.select("n_nationkey")).select("n_nationkey", "field_code", "reason")


@query("""
SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def dangling_refs(spark, sf_dir):
    """Documents whose label is missing."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", F.array("doc_id").alias("refs"))
    return joins.dangling_refs(d, ["doc_id", "source"], "refs", read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query("""
SELECT a.conv_id, a.turn AS at, b.turn AS near FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND abs(a.turn - b.turn) <= 3 AND a.turn <> b.turn WHERE a.role = 'user' AND b.role <> 'user'""")
def nearby_rows(spark, sf_dir):
    """J8."""
    return joins.nearby(read(spark, sf_dir, "conversations"), ["conv_id"], "turn", 3, F.col("role") == "user", F.col("role") != "user")


@query("""
WITH old AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'OTHER' ELSE c_mktsegment END AS m, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS n FROM customer WHERE c_custkey % 7 <> 0)
SELECT c.c_custkey, o.c_custkey IS NOT NULL AS matched, (CASE WHEN o.m <> '' AND o.m <> replace(c.c_mktsegment, ' ', '') THEN 'c_mktsegment;' ELSE '' END || CASE WHEN o.n <> '' AND o.n <> c.c_name THEN 'c_name;' ELSE '' END) AS reasons
FROM customer c LEFT JOIN old o ON c.c_custkey = o.c_custkey""")
def existing_match(spark, sf_dir):
    """J3, J4."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    old = c.filter("c_custkey % 7 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_name")).alias("c_name"))
    m = joins.match_existing(c, old, ["c_custkey"], ["c_mktsegment", "c_name"])
    return m.select("c_custkey", "matched", F.concat_ws("", F.transform("reasons", lambda r: F.concat(r, F.lit(";")))).alias("reasons"))


@query("""
WITH p AS (SELECT s_suppkey, lower(regexp_replace(n_name || ' ' || r_name || ' ' || s_name, '[ _-]', '', 'g')) AS t FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
k AS (SELECT DISTINCT lower(regexp_replace(r_name, '[ _-]', '', 'g')) AS key FROM region UNION SELECT lower(regexp_replace(n_name, '[ _-]', '', 'g')) FROM nation),
h AS (SELECT s_suppkey, key, rank() OVER (PARTITION BY s_suppkey ORDER BY length(key) DESC) AS r FROM p JOIN k ON contains(t, key) WHERE length(key) >= 6)
SELECT s_suppkey, key FROM h WHERE r = 1""")
def award_longest_match(spark, sf_dir):
    """The longest region or nation name contained in a supplier's written address."""
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    p = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))  # nation and region are fixed tables
    texts = p.select("s_suppkey", T.normalize_project_name(F.concat_ws(" ", "n_name", "r_name", "s_name")).alias("text"))
    keys = r.select(T.normalize_project_name(F.col("r_name")).alias("key")).union(n.select(T.normalize_project_name(F.col("n_name"))))
    return joins.longest_contained(texts, "text", keys, "key").select("s_suppkey", "key")


@query("""
WITH b AS (SELECT DISTINCT l_orderkey AS project, l_suppkey AS company FROM lineitem), a AS (SELECT l_orderkey AS project, arg_min(l_suppkey, l_linenumber * 1000000 + l_suppkey) AS winner FROM lineitem WHERE l_orderkey % 4 <> 0 GROUP BY 1)
SELECT b.project, b.company, CASE WHEN winner IS NULL THEN 'REVIEW_REQUIRED' WHEN winner = company THEN 'WINNER' ELSE 'NOT_WINNER' END AS decision, winner IS NOT NULL AS winner_present FROM b LEFT JOIN a USING (project)""")
def award_decision(spark, sf_dir):
    """J2."""
    li = read(spark, sf_dir, "lineitem")
    bidders = li.select(F.col("l_orderkey").alias("project"), F.col("l_suppkey").cast("string").alias("company")).distinct()
    awards = li.filter("l_orderkey % 4 <> 0").groupBy(F.col("l_orderkey").alias("project")).agg(F.min_by(F.col("l_suppkey").cast("string"), F.struct("l_linenumber", "l_suppkey")).alias("winner")).select("project", "winner", F.lit("MATCHED").alias("status"), F.lit(1).alias("amount"))
    return joins.award_decisions(bidders, awards).select("project", F.col("company").cast("long").alias("company"), "decision", "winner_present")


@query("""
SELECT o_orderpriority, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS complete, count(*) FILTER (o_orderstatus = 'P') AS partial, count(*) FILTER (o_totalprice <= 0) AS failed,
  CASE WHEN bool_and(o_orderstatus = 'F') THEN 'SUCCESS' WHEN bool_or(o_orderstatus = 'F') THEN 'PARTIAL' ELSE 'FAILED' END AS status FROM orders GROUP BY 1""")
def quality_metrics(spark, sf_dir):
    """A24 per priority; `document_metrics` runs A22."""
    from docfacts.operators.package import rollup_status

    done = F.col("o_orderstatus") == "F"
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(done).alias("complete"), F.count_if(F.col("o_orderstatus") == "P").alias("partial"), F.count_if(F.col("o_totalprice") <= 0).alias("failed"), rollup_status(done).alias("status")
    )


@query("""
WITH v AS (SELECT s_nationkey, 'segment' AS field, left(s_name, 9) AS value, s_suppkey AS source FROM supplier UNION ALL SELECT s_nationkey, 'balance', CASE WHEN s_acctbal < 0 THEN 'debit' ELSE 'credit' END, s_suppkey FROM supplier)
SELECT s_nationkey, field, count(DISTINCT value) AS n_values, count(DISTINCT source) AS n_sources FROM v GROUP BY 1, 2 HAVING count(DISTINCT value) > 1""")
def value_conflicts(spark, sf_dir):
    """A17."""
    s = read(spark, sf_dir, "supplier").select("s_nationkey", F.left("s_name", F.lit(9)).alias("segment"), F.when(F.col("s_acctbal") < 0, "debit").otherwise("credit").alias("balance"), "s_suppkey")
    c = merge.value_conflicts(s, ["s_nationkey"], ["segment", "balance"], "s_suppkey")
    return c.select("s_nationkey", "field", F.size("values").cast("long").alias("n_values"), F.aggregate("values", F.lit(0).cast("long"), lambda a, x: a + F.size(x["sources"])).alias("n_sources"))


@query("""
SELECT upper(replace(p_brand, ' ', '')) AS number, count(*) AS n, count(DISTINCT p_type) AS n_names FROM part GROUP BY 1 HAVING count(*) > 1""")
def duplicate_numbers(spark, sf_dir):
    """A18."""
    d = merge.duplicate_numbers(read(spark, sf_dir, "part"), "p_brand", "p_type", "p_name")
    return d.select("number", "n", F.size("names").cast("long").alias("n_names"))


@query("""
SELECT l_suppkey, count(DISTINCT l_partkey) AS holders, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r, count(*) FILTER (l_discount > 0.05) AS review_required FROM lineitem GROUP BY 1""")
def status_summary(spark, sf_dir):
    """A19."""
    li = read(spark, sf_dir, "lineitem").withColumn("review", F.col("l_discount") > 0.05)
    return merge.status_summary(li, ["l_suppkey"], "l_partkey", "l_returnflag", "review", ["A", "N", "R"])


@query("""
WITH s AS (SELECT doc_id, unnest(string_split(text, '.')) AS piece FROM documents)
SELECT doc_id, count(*) AS clauses, sum(length(trim(piece, E' \\n\\t\\r')))::BIGINT AS chars FROM s WHERE length(trim(piece, E' \\n\\t\\r')) >= 4 GROUP BY doc_id""")
def clauses(spark, sf_dir):
    """Sentences of at least four characters; `numbered_clauses` runs the operator."""
    each = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", r"\.")).alias("piece")).withColumn("piece", T.strip(F.col("piece"))).filter(F.length("piece") >= 4)
    return each.groupBy("doc_id").agg(F.count(F.lit(1)).alias("clauses"), F.sum(F.length("piece")).alias("chars"))
