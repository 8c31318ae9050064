"""SimHash near-duplicates through a byte-position inverted index (operator 6).

Each text gets a fingerprint: bit b is 1 if more than half of its shingle
hashes have it. Two fingerprints that differ in at most d bits differ in at
most d of their bytes, so of B bytes at least B - d agree. The index posts
fingerprints under combinations of byte positions and their values; the
positions are chosen so that every set of B - d agreeing bytes contains one
posted combination. Pairs that meet are tallied (number of agreeing bytes),
those below the guaranteed minimum are dropped, and the rest is verified by
counting differing bits.

Equal fingerprints are one node. Large posting lists are dealt out in blocks,
each pair of blocks being one group, and a list gives a spanning forest of its
links rather than all pairs: components stay the same and rows stay linear.
Components come from repeated contraction: every node joins its least
neighbour (by hash), edges are rewritten, and rounds are few.

The pipeline's stage (`kept`) takes its first links from the same fingerprints
and index, and checks them on sets of shingles.

Edge cases: null and empty texts have fingerprint zero and are linked like any
other; fewer words than a shingle give one shingle of all words; texts of any
length count whole. Repeated rows fall in one component, and so do rows that
share a doc_id and a fingerprint; a null doc_id is less than any other. An
empty table gives no row; columns other than doc_id and text are not looked at,
whatever their names, and `kept` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.jaccard import near_copies
from docfacts.llm.shared import arrow_schema, batch_rows, materialize, only_rows, partitions, read, slices, texts, to_batch, without_rows
from docfacts.llm.shingles import mixed, shingle_hashes
from docfacts.operators.merge import components

#: Members of a posting list compared in one group; longer lists are cut into blocks.
BLOCK = 1500
#: Longer posting lists than this are reduced by growing components instead of shifting.
SHORT = 48


def fingerprint(hashes: np.ndarray, bits: int = 64) -> bytes:
    """bits // 8 bytes, most significant first; zero if there is no hash."""
    if not len(hashes):
        return bytes(bits // 8)
    parts = []
    for copy in range(bits // 64):
        view = mixed(hashes, copy).astype(">u8").view(np.uint8).reshape(-1, 8)
        count = np.zeros(64, dtype=np.int64)
        for at in range(0, len(view), 4096):
            count += np.unpackbits(view[at:at + 4096], axis=1).sum(0, dtype=np.int64)
        parts.append(np.packbits(count * 2 > len(hashes)).tobytes())
    return b"".join(parts)


def fingerprints(docs: DataFrame, words: int = 3, bits: int = 64) -> DataFrame:
    """(doc_id, fp) of every document, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, fp binary")
        for batch in batches:
            for part in slices(batch, "text"):
                yield to_batch([part.column(0), [fingerprint(shingle_hashes(t.as_py(), words), bits) for t in part.column(1)]], schema)

    return texts(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fp binary")


def cover(positions: int, agree: int, size: int) -> list[tuple[int, ...]]:
    """Combinations of `size` positions such that any `agree` agreeing positions contain one: parts of the positions, each with all its combinations."""
    parts = max(1, (agree - 1) // (size - 1)) if size > 1 else 1
    groups = np.array_split(np.arange(positions), parts)
    return [tuple(int(x) for x in c) for g in groups for c in combinations(g, size)]


def postings(nodes: DataFrame, keys: list[tuple[int, ...]]) -> DataFrame:
    """(k, fp): the inverted index, one row per node and posted combination of positional bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("k long, fp binary")
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(0)
            fps = np.array(raw.to_pylist(), dtype=object)
            matrix = np.frombuffer(b"".join(fps), dtype=np.uint8).reshape(len(fps), -1).astype(np.int64)
            for n, key in enumerate(keys):
                k = np.full(len(fps), n, dtype=np.int64)
                for p in key:
                    k = k << 8 | matrix[:, p]
                yield pa.RecordBatch.from_arrays([pa.array(k), raw], schema=schema)

    return nodes.select("fp").mapInArrow(run, "k long, fp binary")


def links_of(run: np.ndarray, agree: int, distance: int) -> list[tuple[int, int]]:
    """Links of one posting list (rows of bytes) that keep its components: a least spanning forest, each node joined to the nearest one."""
    words, n, out = run.view(np.uint64), len(run), []
    best, parent = np.full(n, distance + 1), np.zeros(n, dtype=np.int64)
    left = np.arange(n)
    while len(left):
        k = int(best[left].argmin())
        i, left = int(left[k]), np.delete(left, k)
        if best[i] <= distance:
            out.append((int(parent[i]), i))
        far = np.bitwise_count(words[left] ^ words[i]).sum(-1, dtype=np.int64)
        far[(run[left] == run[i]).sum(-1) < agree] = distance + 1
        nearer = far < best[left]
        best[left[nearer]], parent[left[nearer]] = far[nearer], i
    return out


def _distance(a, a_words, b, b_words, agree: int, distance: int) -> np.ndarray:
    """Count filter (agreeing positional bytes), then differing bits; distance + 1 for pairs that the filter drops."""
    far = np.full(len(a), distance + 1, dtype=np.int64)
    ok = np.flatnonzero((a == b).sum(-1) >= agree)
    far[ok] = np.bitwise_count(a_words[ok] ^ b_words[ok]).sum(-1)
    return far


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of pairs (distance, i, j), nearest first, those that join two trees: a least spanning forest of each list."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    out = []
    for _, i, j in pairs[np.lexsort(pairs.T[::-1])].tolist():
        x, y = find(i), find(j)
        if x != y:
            parent[x] = y
            out.append((i, j))
    return out


def links(lists: DataFrame, agree: int, distance: int, block: int = BLOCK) -> DataFrame:
    """(a, b): linked fingerprints, from posting lists (k, fp). Lists are made twice, which is cheaper than storing them."""
    spark = lists.sparkSession
    batch_rows(spark, 10_000)
    large = lists.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = materialize(large.select("k", F.ceil(F.col("n") / block).cast("int").alias("s")), "large")
    cut = lists.join(large, "k", "left").withColumn("s", F.coalesce("s", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("s")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.expr("sequence(0, s - 1)")))
    cut = cut.select("k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    dealt = cut.repartition(partitions(spark), "k", "i", "j").sortWithinPartitions("k", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("a binary, b binary")
        rest: list[np.ndarray] = []

        def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            starts = np.concatenate([[0], change])
            sizes = np.diff(np.concatenate([starts, [len(keys)]]))
            left_in = np.repeat(starts + sizes, sizes) - np.arange(len(keys))  # members from here to the list's end
            words = fps.view(np.uint64)
            pairs = []
            short = np.repeat(sizes <= SHORT, sizes)
            for shift in range(1, SHORT):
                i = np.flatnonzero(short & (left_in > shift))
                if not len(i):
                    break
                far = _distance(fps[i], words[i], fps[i + shift], words[i + shift], agree, distance)
                ok = far <= distance
                pairs.append(np.stack([far[ok], i[ok], i[ok] + shift], 1))
            at = forest(np.concatenate(pairs)) if pairs else []
            for r in np.flatnonzero(sizes > SHORT):
                own = links_of(fps[starts[r]:starts[r] + sizes[r]], agree, distance)
                at += [(starts[r] + x, starts[r] + y) for x, y in own]
            flat = np.ascontiguousarray(fps)
            edges = {(flat[x].tobytes(), flat[y].tobytes()) for x, y in at}
            return to_batch([[e[0] for e in edges], [e[1] for e in edges]], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("k", "i", "j")], 1)
            fps = np.frombuffer(b"".join(batch.column("fp").to_pylist()), dtype=np.uint8).reshape(len(keys), -1)
            if rest:
                keys, fps = np.concatenate([rest[0], keys]), np.concatenate([rest[1], fps])
            tail = len(keys) - int(np.argmax((keys[::-1] != keys[-1]).any(1))) if (keys != keys[-1]).any() else 0
            rest = [keys[tail:], np.ascontiguousarray(fps[tail:])]
            if tail:
                yield found(keys[:tail], np.ascontiguousarray(fps[:tail]))
        if rest:
            yield found(*rest)

    return dealt.mapInArrow(run, "a binary, b binary")


def linked(nodes: DataFrame, bits: int = 64, distance: int = 3, keys: list[tuple[int, ...]] | None = None, agree: int | None = None) -> DataFrame:
    """(a, b): links of distinct fingerprints (fp). Without keys, combinations of three positional bytes cover every pair
    within `distance` exactly (bits // 8 - distance bytes agree at least)."""
    positions = bits // 8
    agree = positions - distance if agree is None else agree
    return links(postings(nodes, keys or cover(positions, agree, 3)), agree, distance)


def near_duplicates(
    docs: DataFrame, words: int = 3, bits: int = 64, distance: int = 3, keys: list[tuple[int, ...]] | None = None, agree: int | None = None
) -> DataFrame:
    """(doc_id, fp, component_id) of every document: the least doc_id reachable over links."""
    marked = materialize(fingerprints(docs, words, bits), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(linked(nodes, bits, distance, keys, agree))
    # written before they are joined: the join can then split a large component's rows
    joined = materialize(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    least = materialize(joined.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = joined.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp")


def proposed_pairs(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): of nodes (node, key), key being the hash of a text, those whose texts' fingerprints are linked or equal: each with the
    least node of its fingerprint, and these among one another."""
    by_text = fingerprints(docs.select(F.xxhash64("text").alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "fp").distinct()
    marked = materialize(nodes.join(by_text, "key").select("node", "fp"), "fingerprints")
    leasts = materialize(marked.groupBy("fp").agg(F.min("node").alias("least")), "nodes")
    found = materialize(linked(leasts), "linked")
    near = found.join(leasts.toDF("a", "x"), "a").join(leasts.toDF("b", "y"), "b").select("x", "y")
    same = marked.join(leasts, "fp").filter("node <> least").select("node", "least")
    return near.union(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def kept(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one with the least doc_id (null ones first), then hash of the text.

    Fingerprints propose the first links, which are verified on the sets of
    shingles; the search over prefixes then finds the pairs that lie further
    apart in bits. Of rows that repeat doc_id and text, the least in all columns
    stays.
    """
    copies = near_copies(docs, proposed=lambda nodes: proposed_pairs(docs, nodes)).withColumn("own", F.struct("doc_id", "key"))
    gone = copies.filter("own <> first").select("own.*")
    again = copies.filter("own = first").groupBy("own").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("own.*")
    again = materialize(again, "again")
    if not again.limit(1).count():
        return without_rows(docs, gone)
    one = only_rows(docs, again).groupBy("doc_id", F.xxhash64("text")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("r")).select("r.*")
    return without_rows(docs, gone.union(again)).unionByName(one)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


#: Wide fingerprints: five-word shingles, 256 bits of which texts of a similarity of 0.8 differ in 39 on average (54 is 2.6
#: standard deviations more). They miss some pairs; in the pipeline near_copies finds those that fingerprints miss.
WIDE = {"words": 5, "bits": 256, "distance": 54, "agree": 2}


def wide_keys(positions: int = 32, count: int = 96) -> list[tuple[int, ...]]:
    """Pairs of byte positions at several strides, each position in equally many."""
    return [(i, (i + stride) % positions) for stride in (1, 3, 7) for i in range(positions)][:count]
