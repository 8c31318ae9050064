"""Merkle manifest of a dataset, proofs by butterfly exchange (operator 12).

Every row is a leaf. The leaves of a source, in ascending order, are cut into
aligned runs of `RUN` = 3**7, one task's work each, and a task hashes its run
to one subtree root. From there on no task waits for another that sits above
it: in round r each run asks two partners, the runs at its own offset in the
neighbouring subtrees of 3**r runs, for their current ancestors, and hashes the
common parent itself. All runs of a subtree do so redundantly, so after
log3(runs) rounds each of them holds the source's subroot and every sibling on
the way, and nothing is sent back down. Where the last subtree is short, its
runs serve several partners. The subroots go through the same exchange once
more, which gives the root and the upper end of each proof.

A round moves at most two digests a run. Texts are hashed where they are read;
what is sorted are 32-byte digests.

Edge cases: nulls are hashed as `-`; a null source or doc_id comes first, and a
row without doc_id is not tampered with. Rows that repeat a doc_id are leaves
of their own, ordered by leaf digest; of rows equal in everything any order
gives the same tree. Texts of any length are hashed whole by Spark. An empty
table gives no row. Only the five columns of the contract count, further ones
are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docfacts.llm.shared import arrow_schema, batch_rows, discard, global_rank, materialize, partitions, read, rows_to_batch

FANOUT = 3
#: Height of a run's subtree, and leaves of a run.
HEIGHT = 7
RUN = FANOUT**HEIGHT
#: Offsets or subroots of up to this many rows are broadcast; more are joined.
MOST = 500_000

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(columns: list[Column]) -> Column:
    """Hex sha256 of the values, each `-` if null, else its length in bytes, `:` and itself."""
    each = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*each), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, other): other is the leaf after tampering; digests as 32 bytes."""
    own = [F.col(c) for c in COLUMNS]
    touched = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    changed = leaf_digest([*own[:-1], F.replace("text", F.lit("\n"), F.lit(""))])
    out = docs.select(*COLUMNS, F.unhex(leaf_digest(own)).alias("leaf"))
    return out.select("doc_id", "source", "leaf", F.when(touched, F.unhex(changed)).otherwise(F.col("leaf")).alias("other"))


def attach(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join by keys that may be null; the right side is broadcast only if it is small."""
    right = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns])
    right = F.broadcast(right) if right.count() <= MOST else right
    on = [left[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(right, on).drop(*[f"_{k}" for k in keys])


def placed(rows: DataFrame) -> DataFrame:
    """Adds position (from 0 in the row's source) and total (leaves of the source).

    Rows are range-partitioned in the total order; what joins them again are
    counts by (partition, source), so a source may hold any share of the rows.
    """
    base = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    order = ["source", "doc_id", "leaf", "other", "_row"]
    sorted_rows = base.repartitionByRange(max(partitions(rows.sparkSession), 1), *order).sortWithinPartitions(*order)
    numbered = sorted_rows.drop("_row").withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    numbered = materialize(numbered, "ordered")
    counts = numbered.groupBy("_part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
    by = W.partitionBy("source")
    before = F.coalesce(F.sum("n").over(by.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = materialize(counts.select("_part", "source", "_first", before.alias("_start"), F.sum("n").over(by).alias("total")), "starts")
    discard(base)
    out = attach(numbered, starts, ["_part", "source"])
    return out.withColumn("position", F.col("_at") - F.col("_first") + F.col("_start")).drop("_at", "_part", "_first", "_start")


def levels_of(leaves: list[str], height: int) -> list[list[str]]:
    """The nodes of a run's subtree level by level, leaves first; each run of three becomes its digest, a lone node too."""
    out = [leaves]
    for _ in range(height):
        nodes = out[-1]
        out.append([sha256("".join(nodes[i:i + FANOUT]).encode()).hexdigest() for i in range(0, len(nodes), FANOUT)])
    return out


def height_of(total: int) -> int:
    """Levels above the leaves."""
    height, room = 0, 1
    while room < total:
        height, room = height + 1, room * FANOUT
    return height


RUNS = "source string, run long, runs long, node string, doc_ids array<long>, leaves binary, others binary"


def runs_of(rows: DataFrame) -> DataFrame:
    """One row for each aligned run of a source: its leaves in order and the root of their subtree."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(RUNS)
        for batch in batches:
            for row in batch.to_pylist():
                members = [m["leaf"].hex() for m in row["members"]]
                top = levels_of(members, min(height_of(row["total"]), HEIGHT))[-1][0]
                packed = [b"".join(m[c] for m in row["members"]) for c in ("leaf", "other")]
                yield rows_to_batch([(row["source"], row["run"], -(-row["total"] // RUN), top, [m["doc_id"] for m in row["members"]], *packed)], schema)

    each = F.struct("position", "doc_id", "leaf", "other")
    runs = rows.withColumn("run", F.floor(F.col("position") / RUN)).groupBy("source", "run").agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(each)).alias("members")  # RUN members at most
    )
    batch_rows(rows.sparkSession, 50)
    return materialize(runs.mapInArrow(build, RUNS), "runs")


def partners(run: Column, runs: Column, width: int) -> Column:
    """(digit, partner) of the neighbouring subtrees of `width` runs: the run there at the same offset, or one that stands in for it."""
    own = F.floor(run / width)
    first = own - own % FANOUT
    there = F.filter(F.array(*[first + k for k in range(FANOUT)]), lambda t: (t != own) & (t * width < runs))
    room = lambda t: F.least(F.lit(width).cast("long"), runs - t * width)
    return F.transform(there, lambda t: F.struct((t % FANOUT).cast("int").alias("digit"), (t * width + run % width % room(t)).alias("partner")))


def butterfly(state: DataFrame) -> DataFrame:
    """(source, run, node, proof): the root above each run, and the siblings on the way as (digit of the own node, others), lowest first.

    state: (source, run, runs, node). Every round writes its table, so a lost
    executor repeats one round at most.
    """
    state = materialize(state.withColumn("proof", F.array().cast("array<struct<digit:int,others:array<string>>>")), "exchange")
    most, width = state.agg(F.coalesce(F.max("runs"), F.lit(0)).alias("n")).first()["n"], 1
    while width < most:
        asked = state.select("source", "run", F.explode(partners(F.col("run"), F.col("runs"), width)).alias("p"))
        theirs = state.select(F.col("source").alias("_source"), F.col("run").alias("_run"), "node")
        met = asked.join(theirs, F.col("source").eqNullSafe(F.col("_source")) & (F.col("p.partner") == F.col("_run")))
        got = met.groupBy("source", "run").agg(F.array_sort(F.collect_list(F.struct("p.digit", "node"))).alias("others"))  # two at most
        got = got.select(F.col("source").alias("_source"), F.col("run").alias("_run"), "others")
        both = state.join(got, F.col("source").eqNullSafe(F.col("_source")) & (F.col("run") == F.col("_run")), "left")
        digit = (F.floor(F.col("run") / width) % FANOUT).cast("int")
        others = F.coalesce(F.transform("others", lambda x: x["node"]), F.array().cast("array<string>"))
        family = F.array_sort(F.concat(F.array(F.struct(digit.alias("digit"), F.col("node"))), F.coalesce("others", F.array().cast("array<struct<digit:int,node:string>>"))))
        parent = F.sha2(F.array_join(F.transform(family, lambda x: x["node"]), ""), 256)
        grows = F.col("runs") > width
        step = F.array(F.struct(digit.alias("digit"), others.alias("others")))
        after = materialize(both.select("source", "run", "runs", F.when(grows, parent).otherwise(F.col("node")).alias("node"), F.when(grows, F.concat("proof", step)).otherwise(F.col("proof")).alias("proof")), "exchange")
        discard(state)
        state, width = after, width * FANOUT
    return state.select("source", "run", "node", "proof")


def with_proofs(runs: DataFrame) -> DataFrame:
    """The runs with node (now the root above them) and proof of the exchange."""
    upper = butterfly(runs.select("source", "run", "runs", "node"))
    return attach(runs.drop("node"), upper, ["source", "run"])


VERIFIED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, levels int"


def folded(own: str, steps: list[tuple[str, str]]) -> str:
    for left, right in steps:
        own = sha256((left + own + right).encode()).hexdigest()
    return own


def siblings(level: list[str], at: int) -> tuple[str, str]:
    """What stands left and right of a node in its run of three."""
    first = at - at % FANOUT
    return "".join(level[first:at]), "".join(level[at + 1:first + FANOUT])


def sides(proof: list[dict]) -> list[tuple[str, str]]:
    """The steps of an exchange as what stands left and right; missing members are the last of a run, so others[:digit] are left."""
    return [("".join(s["others"][:s["digit"]]), "".join(s["others"][s["digit"]:])) for s in proof]


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, levels) of every row."""
    spark = docs.sparkSession
    runs = runs_of(placed(leaves(docs)))
    below = materialize(with_proofs(runs), "below")
    subroots = global_rank(below.filter("run = 0").select("source", "node"), ["source"], "subroots")
    n = subroots.count()
    tops = subroots.select(
        F.lit(None).cast("string").alias("source"), F.col("rank").alias("position"), F.lit(n).cast("long").alias("total"),
        F.lit(None).cast("long").alias("doc_id"), F.unhex("node").alias("leaf"), F.unhex("node").alias("other"),
    )
    named = runs_of(tops)
    above = materialize(with_proofs(named), "above")

    def upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("rank long, root string, lefts array<string>, rights array<string>")
        for batch in batches:
            for row in batch.to_pylist():
                members = [row["leaves"][i:i + 32].hex() for i in range(0, len(row["leaves"]), 32)]
                levels, high = levels_of(members, min(height_of(n), HEIGHT)), sides(row["proof"])
                rows = []
                for i in range(len(members)):
                    steps = [siblings(level, i // FANOUT**k) for k, level in enumerate(levels[:-1])] + high
                    rows.append((row["run"] * RUN + i, row["node"], [s[0] for s in steps], [s[1] for s in steps]))
                yield rows_to_batch(rows, schema)

    ends = above.mapInArrow(upper, "rank long, root string, lefts array<string>, rights array<string>")
    ends = materialize(subroots.select("source", "rank").join(ends, "rank").drop("rank"), "ends")
    batch_rows(spark, 50)
    whole = attach(below.withColumnRenamed("node", "subroot"), ends, ["source"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(VERIFIED)
        for batch in batches:
            for row in batch.to_pylist():
                own, other = ([row[c][i:i + 32].hex() for i in range(0, len(row[c]), 32)] for c in ("leaves", "others"))
                high = sides(row["proof"]) + list(zip(row["lefts"], row["rights"], strict=True))
                height = HEIGHT if row["runs"] > 1 else height_of(len(own))
                levels, rows = levels_of(own, height), []
                for i, doc_id in enumerate(row["doc_ids"]):
                    steps = [siblings(level, i // FANOUT**k) for k, level in enumerate(levels[:-1])] + high
                    proof = sha256("".join(left + right for left, right in steps).encode()).hexdigest()
                    end = folded(other[i], steps)
                    rows.append((doc_id, own[i], row["subroot"], row["root"], proof, end, end == row["root"], len(steps)))
                yield rows_to_batch(rows, schema)

    return whole.mapInArrow(verify, VERIFIED)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read(spark, sf_dir, "documents"))


#: crc32 of a decimal number, its characters being ASCII.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)))"""
_FIELD = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in COLUMNS[:-1]) + " || " + _FIELD + ")"
ORACLE = f"""WITH RECURSIVE leaf AS (
    SELECT doc_id, source, {_LEAF.format("text")} AS leaf,
        CASE WHEN {_CRC32} % 2 = 0 THEN {_LEAF.format("replace(text, chr(10), '')")} ELSE {_LEAF.format("text")} END AS other
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS total,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaf),
low AS (
    SELECT 0 AS level, tree, pos, total AS nodes, leaf AS node FROM placed
    UNION ALL
    SELECT level + 1, tree, pos // 3, (nodes + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE nodes > 1 GROUP BY level, tree, pos // 3, nodes),
subroots AS (SELECT tree, level AS height, node AS subroot FROM low WHERE nodes = 1),
high AS (
    SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS nodes, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (nodes + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE nodes > 1 GROUP BY level, pos // 3, nodes),
nodes AS (
    SELECT tree, level, pos, nodes, node FROM low WHERE nodes > 1
    UNION ALL
    SELECT s.tree, s.height + h.level, h.pos, h.nodes, h.node FROM high h, subroots s WHERE h.nodes > 1),
path AS (
    SELECT p.doc_id, p.tree, p.pos AS leaf_at, n.level, CASE WHEN n.level < s.height THEN p.pos // CAST(3 ** n.level AS BIGINT) ELSE p.tree // CAST(3 ** (n.level - s.height) AS BIGINT) END AS own, n.pos, n.node
    FROM placed p JOIN subroots s USING (tree) JOIN nodes n ON n.tree = p.tree
        AND n.pos // 3 = CASE WHEN n.level < s.height THEN p.pos // CAST(3 ** (n.level + 1) AS BIGINT) ELSE p.tree // CAST(3 ** (n.level - s.height + 1) AS BIGINT) END),
steps AS (
    SELECT tree, leaf_at, level, coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos < own), '') AS lefts, coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos > own), '') AS rights
    FROM path GROUP BY tree, leaf_at, level),
fold AS (
    SELECT tree, pos AS leaf_at, 0 AS level, other AS node FROM placed
    UNION ALL
    SELECT f.tree, f.leaf_at, f.level + 1, sha256(s.lefts || f.node || s.rights) FROM fold f JOIN steps s ON s.tree = f.tree AND s.leaf_at = f.leaf_at AND s.level = f.level),
ends AS (SELECT tree, leaf_at, arg_max(node, level) AS folded_root, max(level) AS levels FROM fold GROUP BY tree, leaf_at),
proofs AS (SELECT tree, leaf_at, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY tree, leaf_at),
top AS (SELECT node AS root FROM high WHERE nodes = 1)
SELECT p.doc_id, p.leaf, s.subroot, top.root, coalesce(r.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = top.root AS verified, CAST(e.levels AS INT) AS levels
FROM placed p JOIN subroots s USING (tree) JOIN ends e ON e.tree = p.tree AND e.leaf_at = p.pos LEFT JOIN proofs r ON r.tree = p.tree AND r.leaf_at = p.pos, top"""
