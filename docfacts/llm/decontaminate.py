"""Benchmark decontamination with a BM25 index and block-max pruning (operator 7).

The benchmark's items form an inverted index; its scores are divided by the
item's score for itself, so one threshold holds for all. Every document is cut
into overlapping passages that cover all its words; items are dealt by length
(one class per doubling) and passages are twice as long as the longest item of
their class and overlap by half, so an item of any length lies whole in one. A
passage is dropped once
an upper bound stays below the threshold: first the sum of its terms' largest
scores, then, per block of items, the sum of the terms' largest scores in that
block. What is left is scored exactly; pairs above the threshold are verified
by the overlap of word shingles with the item's question and with its answer.

Term frequencies, the number of items and their mean length are those of the
whole benchmark, so a score doesn't depend on how items are grouped. The index
is collected in groups of about `GROUP` items, one pass over the documents
each; a group's matches are written and its broadcast index is released before
the next one is collected, so the index held at a time stays bounded whatever
the benchmark's size.

Bounds are taken for all passages of a batch at a time, block by block, rather
than by cursors that move through one passage's lists; both find the same pairs.

Edge cases: null and empty texts match nothing, and an empty table of either
kind gives no match; items without words are left out; an item of one sentence
has its last third as answer; repeated items and rows match on their own, and
rows that share a doc_id are told apart by their text where rows are dropped.
Texts of any length are read whole. Passages of a document are joined to the
best one per (document, item), the first one if scores are equal. Columns other
than doc_id, text and item_id are not looked at, and `kept` returns them as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import Shipped, arrow_schema, filter_rows, materialize, read, rows_to_batch, texts, to_batch

#: Words of a passage for items of up to half as many; longer items double it. Passages start every half window.
WINDOW = 96
K1, B = 0.9, 0.4
#: Share of an item's score for itself that a passage must reach.
THRESHOLD = 0.5
QUESTION, ANSWER = 0.6, 0.5
BLOCK, GROUP = 8, 20_000
#: Texts with an item are looked up by a broadcast up to this many.
MOST_FOUND = 1_000_000
SHINGLE = 3

#: ASCII punctuation becomes a blank; letters are lower-cased before.
PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return [] if not text else text.lower().encode("utf-8", "surrogatepass").translate(PLAIN).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence or line is the answer; a text of one sentence is cut after two thirds of its words."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if words_of(p)]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in words_of(p)], words_of(parts[-1])
    words = words_of(text)
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def shingles(words: list, n: int = SHINGLE) -> set[tuple]:
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def overlap(part: list, passage: list) -> float:
    """Share of the part's shingles in the passage; 1 for an empty part. Parts shorter than a shingle compare at their own length."""
    if not part:
        return 1.0
    n = min(SHINGLE, len(part))
    own = shingles(part, n)
    return len(own & shingles(passage, n)) / len(own)


def window_of(words: int) -> int:
    """Words of the passages for an item of so many words: twice as many at least."""
    window = WINDOW
    while window < 2 * words:
        window *= 2
    return window


class Corpus:
    """Number of items with words, their mean length, and in how many of them each term occurs."""

    def __init__(self, items: int, mean: float, df: dict[bytes, int]):
        self.items, self.mean, self.df = items, mean, df


class Index:
    """Inverted index of items with normalised BM25 scores; rows of term t are ptr[t]:ptr[t + 1], in item order."""

    def __init__(self, items: list[tuple[int, str]], window: int | None = None, corpus: "Corpus | None" = None):
        """Scores follow the corpus's statistics (without one, the items'); with a window only items that belong to it are listed."""
        items = [(i, words_of(t), t) for i, t in items if words_of(t)]
        self.ids = [i for i, _, _ in items]
        self.parts = [question_and_answer(t) for _, _, t in items]
        lengths = np.array([len(w) for _, w, _ in items], dtype=float)
        self.terms: dict[bytes, int] = {}
        found: dict[tuple[int, int], int] = {}
        for k, (_, words, _) in enumerate(items):
            for w in words:
                t = self.terms.setdefault(w, len(self.terms))
                found[t, k] = found.get((t, k), 0) + 1
        keys = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        tf = np.array([found[t, k] for t, k in keys.tolist()], dtype=float)
        term, self.item = keys[:, 0], keys[:, 1]
        df = np.bincount(term, minlength=len(self.terms))
        every = corpus or Corpus(len(items), float(lengths.mean()) if len(items) else 0.0, dict(zip(self.terms, df.tolist(), strict=True)))
        seen = np.array([every.df[t] for t in self.terms], dtype=float)
        idf = np.log(1 + (every.items - seen + 0.5) / (seen + 0.5))
        norm = K1 * (1 - B + B * lengths / max(every.mean, 1))
        score = idf[term] * tf * (K1 + 1) / (tf + norm[self.item])
        own = np.bincount(self.item, score, len(items))
        self.score = score / own[self.item]
        self.window = window or WINDOW
        if window:
            mine = np.array([window_of(len(w)) == window for _, w, _ in items])
            rows = mine[self.item]
            term, self.item, self.score = term[rows], (np.cumsum(mine) - 1)[self.item[rows]], self.score[rows]
            self.ids, self.parts = ([x for x, own in zip(xs, mine, strict=True) if own] for xs in (self.ids, self.parts))
            df = np.bincount(term, minlength=len(self.terms))
        self.ptr = np.concatenate([[0], np.cumsum(df)])
        # largest score per term, and per (term, block of items)
        self.term_max = np.zeros(len(self.terms) + 1)
        np.maximum.at(self.term_max, term, self.score)
        blocks = np.stack([term, self.item // BLOCK], 1)
        first = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]).any(1)]) if len(blocks) else np.zeros(0, np.int64)
        self.block, self.block_max = blocks[first, 1], np.maximum.reduceat(self.score, first) if len(first) else self.score
        self.block_ptr = np.concatenate([[0], np.cumsum(np.bincount(blocks[first, 0], minlength=len(self.terms)))])

    def expand(self, passage: np.ndarray, term: np.ndarray, blocks: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, block or item, score) of all index rows of (passage, term) pairs."""
        ptr = self.block_ptr if blocks else self.ptr
        n = ptr[term + 1] - ptr[term]
        at = np.repeat(ptr[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.repeat(passage, n), (self.block if blocks else self.item)[at], (self.block_max if blocks else self.score)[at]


def _sums(passage: np.ndarray, other: np.ndarray, score: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, inverse = np.unique(passage * width + other, return_inverse=True)
    return keys // width, keys % width, np.bincount(inverse, score, len(keys))


def search(index: Index, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, score) of every pair at or above the threshold; ids are term numbers (-1: not in the index)."""
    bound = np.concatenate([[0.0], np.cumsum(index.term_max[ids])])  # term_max[-1] is 0
    alive = np.flatnonzero(bound[ends] - bound[starts] >= threshold)
    if not len(alive):
        return alive, alive, np.zeros(0)
    n = ends[alive] - starts[alive]
    at = np.repeat(starts[alive] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    known = ids[at] >= 0
    pairs = np.unique((np.repeat(alive, n) * len(index.terms) + ids[at])[known])  # a passage asks each term once
    pairs = np.stack(np.divmod(pairs, len(index.terms)), 1)
    p, block, most = _sums(*index.expand(pairs[:, 0], pairs[:, 1], True), len(index.ids) // BLOCK + 1)
    keep = most >= threshold
    p, block = p[keep], block[keep]
    if not len(p):
        return p, p, np.zeros(0)
    pairs = pairs[np.isin(pairs[:, 0], p)]
    width = len(index.ids) // BLOCK + 1
    passage, item, score = index.expand(pairs[:, 0], pairs[:, 1], False)
    inside = np.isin(passage * width + item // BLOCK, p * width + block)
    p, item, total = _sums(passage[inside], item[inside], score[inside], len(index.ids))
    keep = total >= threshold - 1e-9
    return p[keep], item[keep], total[keep]


def found_in(index: Index, words: list[list[bytes]], threshold: float, question: float, answer: float) -> list[tuple]:
    """(row, item number, passage start, passage words, score, overlaps) of the verified items of each text's words, best passage each."""
    number, window, stride = index.terms.get, index.window, index.window // 2
    ids = np.array([number(w, -1) for ws in words for w in ws], dtype=np.int64)
    starts, ends, owner, base = [], [], [], 0
    for k, ws in enumerate(words):
        for s in range(0, max(1, len(ws) - (window - stride)), stride):
            starts.append(base + s)
            ends.append(base + min(s + window, len(ws)))
            owner.append((k, s))
        base += len(ws)
    p, item, score = search(index, ids, np.array(starts), np.array(ends), threshold)
    best: dict[tuple[int, int], tuple] = {}
    for i, m, x in zip(p.tolist(), item.tolist(), score.tolist(), strict=True):
        k, s = owner[i]
        passage = words[k][s:s + window]
        q, a = (overlap(o, passage) for o in index.parts[m])
        if q >= question and a >= answer:
            row = (x, -s, len(passage), q, a)
            best[k, m] = max(row, best.get((k, m), row))
    return [(k, m, -s, n, x, q, a) for (k, m), (x, s, n, q, a) in sorted(best.items())]


def by_length(items: list[tuple[int, str]], corpus: Corpus | None = None) -> list[Index]:
    """One index for each class of lengths."""
    return [Index(items, w, corpus) for w in sorted({window_of(len(words_of(t))) for _, t in items if words_of(t)})]


def item_terms(benchmark: DataFrame) -> DataFrame:
    """(n_words, terms) of every item with words: its distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("g", pa.int64()), ("n_words", pa.int64()), ("terms", pa.list_(pa.binary()))])
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            yield to_batch([batch.column(0), [len(w) for w in words], [sorted(set(w)) for w in words]], schema)

    return benchmark.select("g", "text").mapInArrow(run, "g long, n_words long, terms array<binary>").filter("n_words > 0")


class Groups:
    """The benchmark's items in groups of about `group`, each sent to executors when asked for."""

    def __init__(self, benchmark: DataFrame, group: int):
        self.spark = benchmark.sparkSession
        self.number = max(1, -(-benchmark.count() // group))
        key = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.number))
        self.items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("g", key)
        terms = materialize(item_terms(self.items), "item_terms")
        sums = terms.agg(F.count(F.lit(1)).alias("n"), F.avg("n_words").alias("mean")).first()
        self.n, self.mean = sums["n"], sums["mean"] or 0.0
        each = terms.select("g", F.explode("terms").alias("term"))
        self.df = each.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        self.own = each.distinct()
        if self.number > 1:
            self.df = materialize(self.df, "item_df")

    def index(self, g: int) -> Shipped:
        """A group's indexes, one for each class of lengths. What is collected is bounded by the group."""
        df = self.df if self.number == 1 else self.df.join(self.own.filter(F.col("g") == g), "term", "left_semi")
        corpus = Corpus(self.n, self.mean, {bytes(r["term"]): r["n"] for r in df.collect()})
        items = [(r["item_id"], r["text"]) for r in self.items.filter(F.col("g") == g).collect()]
        items.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        return Shipped(self.spark, by_length(items, corpus))


MATCHES = "doc_id long, item_id long, passage_start long, passage_words long, bm25 double, question_overlap double, answer_overlap double"


def _in_parts(batch: pa.RecordBatch, column: int, shared: Shipped, limits: tuple) -> Iterator[tuple]:
    """(row of the batch, item_id, rest of found_in) of all verified items."""
    for at in range(0, batch.num_rows, 256):
        words = [words_of(t) for t in batch.column(column).slice(at, 256).to_pylist()]
        for index in shared.value:
            for k, m, *rest in found_in(index, words, *limits):
                yield (at + k, index.ids[m], *rest)


def matches(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER, group: int = GROUP
) -> DataFrame:
    """Verified (document, item) pairs with the best passage of each."""
    groups, out = Groups(benchmark, group), None
    for g in range(groups.number):
        shared = groups.index(g)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            schema = arrow_schema(MATCHES)
            for batch in batches:
                doc = batch.column(0).to_pylist()
                rows = [(doc[k], *rest) for k, *rest in _in_parts(batch, 1, shared, (threshold, question, answer))]
                if rows:
                    yield rows_to_batch(rows, schema)

        part = texts(docs, "doc_id", "text").mapInArrow(run, MATCHES)
        if groups.number > 1:
            part = materialize(part, f"matches{g}")
            shared.release()
        out = part if out is None else out.unionByName(part)
    return out


def kept(docs: DataFrame, benchmark: DataFrame, group: int = GROUP) -> DataFrame:
    """The rows without a verified item, with all their columns: one pass if the items are one group, else by the hashes of the texts found."""
    groups, found = Groups(benchmark, group), None
    for g in range(groups.number):
        shared = groups.index(g)

        def hits(batch: pa.RecordBatch, column: int, shared=shared) -> np.ndarray:
            out = np.zeros(batch.num_rows, dtype=bool)
            out[[k for k, *_ in _in_parts(batch, column, shared, (THRESHOLD, QUESTION, ANSWER))]] = True
            return out

        if groups.number == 1:
            return filter_rows(docs, lambda batch: ~hits(batch, batch.schema.get_field_index("text")))  # noqa: B023
        keyed = docs.select(F.xxhash64("text").alias("key"), "text")
        part = materialize(filter_rows(keyed, lambda batch: hits(batch, 1)).select("key"), f"found{g}")  # noqa: B023
        shared.release()
        found = part if found is None else found.unionByName(part)
    found = found.distinct()
    return docs.join(F.broadcast(found) if found.count() <= MOST_FOUND else found, F.xxhash64(docs["text"]) == found["key"], "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
