"""N-gram Jaccard join by multiple global orders (operator 13).

Two sets of n-grams whose similarity reaches a threshold share a token of their
prefixes, the first tokens in any one order of all tokens, whatever the order
is. So a pair has to pass the same test under several orders:

1. order 0 has rare tokens first; it gives an inverted index over prefixes, and
   pairs that meet in a list and whose sizes and positions allow the threshold;
2. orders 1 and 2 are independent hash orders; a pair that shares no prefix
   token under one of them goes, and so does one whose parity bits (about as
   many as tokens) differ too much. Prefixes travel as 32-bit tokens, a sixth
   of the sets;
3. what passes all of them is verified on the sets, in integers.

Which tokens are common is counted over all documents: tasks count by lossy
counting and send what is in a thousandth of their documents or more. Counts
only order the tokens, so they change the length of lists and no result.

Sets that are equal are one node. In the first round a list gives stars, its
centre with all others, and verified links make components. (Lists of very
common tokens are dealt out by node for these stars; then stars are repeated
among one node of each component, where the parts meet.) In the last round only lists that hold
several components are looked at, this time at all pairs between components. So
a large group of near copies costs few pairs a node and still no link between
components is lost. Pairs that another search proposes (for `near_copies` the
SimHash index of operator 6) are verified before the first round, and stars
inside the components that they make are left out. Lists over `BLOCK` nodes are compared in pairs of blocks.

Edge cases: null and empty texts, and texts without words, have an empty set:
`op13_ngram_jaccard` links them with nothing, `near_copies` counts them as
equal. Fewer words than n give one token of all words; texts of any length
count whole. Repeated rows fall in one component; a null doc_id is less than
any other. An empty table gives no row; columns other than doc_id and text are
not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import Shipped, arrow_schema, batch_rows, discard, materialize, only_rows, partitions, read, slices, texts, to_batch, trim
from docfacts.llm.shingles import LOWER, mixed
from docfacts.operators.merge import components

#: Orders whose prefixes a pair has to share tokens of, the first one included.
ORDERS = 3
#: Tokens known as common at most; a token is one if it is in this share of a task's documents, and in three of them.
COMMON, SHARE = 500_000, 0.001
#: Nodes of a list compared in one group, and nodes up to which all lists of a batch are compared at once.
BLOCK, SHORT = 1500, 48
#: Documents of a common token that are gathered in one list for the stars.
GATHERED = 50_000
#: Bits of a set's parities.
PARITY = 512
#: Tokens that a task counts before it drops rare ones, and words whose hashes it keeps.
COUNTED, WORDS = 1 << 20, 250_000


class Threshold(NamedTuple):
    """A similarity of num / den or more, in integers; works on arrays too."""

    num: int
    den: int

    def prefix(self, n):
        """Length of the prefixes of which similar sets share a token."""
        return n - (self.num * n + self.den - 1) // self.den + (n > 0)

    def need(self, a, b):
        """Tokens that sets of these sizes have to share."""
        return (self.num * (a + b) + self.num + self.den - 1) // (self.num + self.den)

    def sizes(self, a, b):
        return self.den * np.minimum(a, b) >= self.num * np.maximum(a, b)

    def reached(self, shared: int, a: int, b: int) -> bool:
        return self.den * shared >= self.num * (a + b - shared)


class WordHashes(dict):
    """XXH64 of words by word, kept between texts; the store starts anew beyond `WORDS`."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def token_set(text: str | None, words: int, known: WordHashes) -> tuple[int, np.ndarray]:
    """(node, sorted distinct tokens): a token is a 64-bit hash of n words, made of theirs, and the node one of the set."""
    own = [] if text is None else text.encode().translate(LOWER).split()  # \x0b and \x0c are white space to bytes.split() too, and no other byte is
    if own:
        w = np.fromiter(map(known.__getitem__, own), np.uint64, len(own))
        n = min(words, len(own))
        token = np.full(len(own) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            token = (token ^ w[k:len(own) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            token ^= token >> np.uint64(29)
        token = np.unique(token * np.uint64(0xBF58476D1CE4E5B9))
    else:
        token = np.zeros(0, dtype=np.uint64)
    h = xxhash.xxh64_intdigest(token.tobytes(), 7)
    return h - (1 << 64) if h >> 63 else h, token


def parity(own: np.ndarray, bits: int = PARITY) -> bytes:
    """Of how many of the tokens fall on each bit, whether the number is odd. Of two sets at least so many members are in one only as bits differ."""
    return np.packbits(np.bincount((own >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) & 1).tobytes()


def wide(n: int) -> int:
    """Bits of the second parity of a set of n tokens: as many as tokens, to a power of two; 0 for small sets, for which the first one does."""
    return 0 if n <= PARITY else min(1 << (n - 1).bit_length(), 1 << 16)


def signature(own: np.ndarray, at_least: Threshold, orders: int) -> bytes:
    """The set's parities and, for each order from 1 on, 32 bits of each token of its prefix."""
    n, parts = at_least.prefix(len(own)), [parity(own)]
    if wide(len(own)):
        parts.append(parity(own, wide(len(own))))
    for k in range(1, orders):
        rank = mixed(own, k)
        first = own[np.argpartition(rank, n - 1)[:n]] if 0 < n < len(own) else own[:n]
        parts.append(first.astype(np.uint32).tobytes())
    return b"".join(parts)


def _parities(x: bytes, y: bytes, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The widest parities that both signatures have: a wider one is folded by halves."""
    bits = min(wide(a), wide(b))
    if not bits:
        return np.frombuffer(x, np.uint64, PARITY // 64), np.frombuffer(y, np.uint64, PARITY // 64)
    out = []
    for sign, own in ((x, wide(a)), (y, wide(b))):
        p = np.frombuffer(sign, np.uint64, own // 64, PARITY // 8)
        while len(p) > bits // 64:
            p = p[:len(p) // 2] ^ p[len(p) // 2:]
        out.append(p)
    return out[0], out[1]


def few_bits_differ(x: bytes, y: bytes, a: int, b: int, at_least: Threshold) -> bool:
    """Whether the parities of sets of a and b tokens allow the similarity."""
    p, q = _parities(x, y, a, b)
    return int(np.bitwise_count(p ^ q).sum()) <= a + b - 2 * at_least.need(a, b)


def prefixes_meet(x: bytes, y: bytes, a: int, b: int, at_least: Threshold, orders: int) -> bool:
    """Whether sets of a and b tokens share a prefix token under each order from 1 on."""
    n, m = at_least.prefix(a), at_least.prefix(b)
    for k in range(orders - 1):
        mine, theirs = np.frombuffer(x, np.uint32, n, 4 * n * k), np.frombuffer(y, np.uint32, m, 4 * m * k)
        if set(mine.tolist()).isdisjoint(theirs.tolist()):
            return False
    return True


def may_link(x: bytes, y: bytes, a: int, b: int, at_least: Threshold, orders: int) -> bool:
    """Both filters on two signatures. No pair of the similarity is refused."""
    p, q = ((PARITY + wide(n)) // 8 for n in (a, b))
    return few_bits_differ(x, y, a, b, at_least) and prefixes_meet(x[p:], y[q:], a, b, at_least, orders)


class Tally:
    """Lossy counting of tokens: after each COUNTED tokens those are dropped whose count is not above the number of rounds."""

    def __init__(self):
        self.tokens, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.held, self.rounds = 0, 0

    def add(self, own: np.ndarray) -> None:
        self.waiting.append(own)
        self.held += len(own)
        if self.held >= COUNTED:
            self.rounds += 1
            self.merge(self.rounds)

    def merge(self, least: int) -> None:
        new, n = np.unique(np.concatenate([*self.waiting, np.zeros(0, dtype=np.uint64)]), return_counts=True)
        every, at = np.unique(np.concatenate([self.tokens, new]), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([self.counts, n]), minlength=len(every)).astype(np.int64)
        self.tokens, self.counts = every[total > least], total[total > least]
        self.waiting, self.held = [], 0


MARKED = "doc_id long, key long, node long, size int, sign binary, token long, count long"


def marked_sets(docs: DataFrame, words: int, at_least: Threshold, orders: int) -> DataFrame:
    """A row for each document (doc_id, hash of the text, node, size, and at a node's first row in a task its signature), and rows (token, count) of what is common in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen, tally, documents, known = arrow_schema(MARKED), set(), Tally(), 0, WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc_id, key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    node, own = token_set(text.as_py(), words, known)
                    new = node not in seen
                    if new:
                        seen.add(node)
                        tally.add(own)
                    rows.append((doc_id, key, node, len(own), signature(own, at_least, orders) if new else None))
                documents += len(rows)
                yield to_batch([*zip(*rows, strict=True), [None] * len(rows), [None] * len(rows)], schema)
        tally.merge(max(2, int(documents * SHARE)))
        if len(tally.tokens):
            none = [None] * len(tally.tokens)
            yield to_batch([none, none, none, none, none, tally.tokens.view(np.int64), tally.counts], schema)
        trim()

    return texts(docs, "doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(run, MARKED)


class CommonTokens:
    """Common tokens, sorted, with their place in the order (from 1, most frequent last) and the number of lists that each is dealt out to."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        rank = np.empty(len(tokens), dtype=np.int64)
        rank[np.lexsort((tokens, counts))] = np.arange(1, len(tokens) + 1)
        by = np.argsort(tokens)
        self.tokens, self.rank = tokens[by], rank[by]
        self.lists = np.maximum(-(-counts[by] // GATHERED), 1)

    def _find(self, own: np.ndarray, values: np.ndarray, other: int) -> np.ndarray:
        if not len(self.tokens):
            return np.full(len(own), other)
        at = np.minimum(np.searchsorted(self.tokens, own), len(self.tokens) - 1)
        return np.where(self.tokens[at] == own, values[at], other)

    def prefix(self, own: np.ndarray, n: int) -> np.ndarray:
        """The first n tokens of a sorted set in order 0."""
        return own[np.argsort(self._find(own, self.rank, 0), kind="stable")[:n]]

    def list_of(self, own: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return nodes.view(np.uint64) % self._find(own, self.lists, 1).astype(np.uint64)

    def dealt(self, own: np.ndarray) -> np.ndarray:
        """Whether a token's nodes are in several lists."""
        return self._find(own, self.lists, 1) > 1


def common_tokens(marked: DataFrame) -> CommonTokens:
    often = marked.filter("token IS NOT NULL").groupBy("token").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    return CommonTokens(often.column("token").to_numpy().astype(np.int64).view(np.uint64), often.column("n").to_numpy().astype(np.int64))


LISTS = "k long, node long, size int, at int, other long"


def prefix_lists(docs: DataFrame, words: int, at_least: Threshold, common: CommonTokens) -> DataFrame:
    """The inverted index of order 0, (k, node, size, position), of nodes that may match another one in their list; and, where k is null, the pairs (node, other) of its stars.

    Postings travel packed, a row for each slice of a batch and bucket of
    tokens. A node posts once a task, so copies add no postings.
    """
    spark, buckets = docs.sparkSession, 3 * partitions(docs.sparkSession)
    shipped = Shipped(spark, common)
    ddl = "bucket int, k binary, owner binary, at binary, node binary, size binary"

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known, seen, hashes = arrow_schema(ddl), shipped.value, set(), WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, nodes, sizes = [], [], []
                for text in part.column(0):
                    node, own = token_set(text.as_py(), words, hashes)
                    if node in seen or not len(own):
                        continue
                    seen.add(node)
                    keys.append(known.prefix(own, at_least.prefix(len(own))))
                    nodes.append(node)
                    sizes.append(len(own))
                if not nodes:
                    continue
                n = np.array([len(k) for k in keys])
                k, nodes, sizes = np.concatenate(keys), np.array(nodes, dtype=np.int64), np.array(sizes, dtype=np.int32)
                owner = np.repeat(np.arange(len(n)), n)
                at = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                bucket = ((k ^ known.list_of(k, nodes[owner]) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int32)
                by = np.argsort(bucket, kind="stable")
                rows = []
                for some in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
                    docs_of, own = np.unique(owner[some], return_inverse=True)
                    packed = (k[some], own.astype(np.uint32), at[some].astype(np.uint32), nodes[docs_of], sizes[docs_of])
                    rows.append((int(bucket[some[0]]), *(x.tobytes() for x in packed)))
                yield to_batch(list(zip(*rows, strict=True)), schema)
        trim()

    def lists(k, node, size, at) -> Iterator[pa.RecordBatch]:
        """The shared lists of a bucket and their stars."""
        schema, known = arrow_schema(LISTS), shipped.value
        part = known.list_of(k, node)
        by = np.lexsort((node, part, k))
        k, node, size, at, part = (x[by] for x in (k, node, size, at, part))
        like = np.r_[False, (k[1:] == k[:-1]) & (part[1:] == part[:-1])]
        new = ~(like & np.r_[False, node[1:] == node[:-1]])  # copies may have come from several tasks
        k, node, size, at, like = (x[new] for x in (k, node, size, at, like))
        shared = like | np.r_[like[1:], False] | known.dealt(k)
        k, node, size, at, like = (x[shared] for x in (k, node, size.astype(np.int32), at.astype(np.int32), like))
        if not len(k):
            return
        whole = Lists(k, node, size, at, np.cumsum(~like), at_least)
        left = whole.partnered() | known.dealt(whole.k)
        for cut in np.array_split(np.flatnonzero(left), int(left.sum()) // 50_000 + 1):
            some = [x[cut] for x in (whole.k.view(np.int64), whole.node, whole.size.astype(np.int32), whole.at.astype(np.int32))]
            yield to_batch([*some, pa.nulls(len(cut), pa.int64())], schema)
        a, b = whole.stars()
        none = [pa.nulls(len(a), t) for t in (pa.int64(), pa.int32())]
        yield to_batch([none[0], a, none[1], none[1], b], schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(6)), strict=True):
                if row[0].as_py() != bucket and parts:
                    yield from lists(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                    parts.clear()
                bucket = row[0].as_py()
                k, owner, at, node, size = (x.as_py() for x in row[1:])
                own = np.frombuffer(owner, np.uint32)
                parts.append((np.frombuffer(k, np.uint64), np.frombuffer(node, np.int64)[own], np.frombuffer(size, np.int32)[own], np.frombuffer(at, np.uint32)))
        if parts:
            yield from lists(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        parts.clear()
        trim()

    packed = texts(docs, "text").mapInArrow(post, ddl)
    return packed.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(gather, LISTS)


class Lists:
    """Some whole lists: arrays of key, node, size, position; and which list each entry is in, ascending."""

    def __init__(self, k, node, size, at, number, at_least: Threshold, root=None, parities=None, block=None):
        by = np.lexsort((node, size, number))
        pick = lambda x: None if x is None else x[by]
        self.k, self.node, self.size, self.at, self.list = pick(k), pick(node), pick(size).astype(np.int64), pick(at).astype(np.int64), pick(number)
        self.root, self.parity, self.block, self.at_least = pick(root), pick(parities), pick(block), at_least
        self.starts = np.flatnonzero(np.r_[True, self.list[1:] != self.list[:-1]])
        self.sizes = np.diff(np.r_[self.starts, len(by)])
        self.found: list[np.ndarray] = []
        self.waiting = 0

    def may_match(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether roots, sizes, what follows the shared token, and the bits that differ allow the similarity. No pair that has it is refused."""
        a, b = self.size[i], self.size[j]
        need = self.at_least.need(a, b)
        ok = (self.node[i] != self.node[j]) & self.at_least.sizes(a, b)
        ok &= np.minimum(a - self.at[i], b - self.at[j]) >= need
        if self.root is not None:
            ok &= self.root[i] != self.root[j]
        if self.block is not None:  # pairs of one block are looked at where the block meets itself
            ok &= (self.block[i] != self.block[j]) | (self.block[i] < 0)
        if self.parity is not None:
            left = np.flatnonzero(ok)
            for some in np.array_split(left, len(left) // 200_000 + 1):
                differ = np.bitwise_count(self.parity[i[some]] ^ self.parity[j[some]]).sum(1, dtype=np.int64)
                ok[some] = differ <= a[some] + b[some] - 2 * need[some]
        return ok

    def add(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Keeps the pairs that may match; returns which do."""
        ok = self.may_match(i, j)
        a, b = self.node[i[ok]], self.node[j[ok]]
        self.found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        self.waiting += len(a)
        if self.waiting > 1 << 21:
            self.found = [self.pairs()]
            self.waiting = self.found[0].shape[1]
        return ok

    def pairs(self) -> np.ndarray:
        """The distinct pairs (a, b), a < b, that were kept."""
        return np.unique(np.concatenate(self.found, axis=1), axis=1) if self.found else np.zeros((2, 0), dtype=np.int64)

    def stars(self, rounds: int = 3) -> np.ndarray:
        """Pairs of each list's centre with all others that may match it; those that don't get a centre of their own in the next round.

        The centre is the node with the fewest rarer tokens before the shared
        one, and so the fewest edits of its own: of copies with edits, the one
        that most of the others are similar to. Nodes alike share many lists
        and so their centres: a large group has few pairs a node."""
        left = np.lexsort((self.node, self.at, self.list))
        for _ in range(rounds):
            if len(left) < 2:
                break
            first = np.r_[True, self.list[left][1:] != self.list[left][:-1]]
            centre = left[np.maximum.accumulate(np.where(first, np.arange(len(left)), 0))]
            others = ~first
            ok = self.add(left[others], centre[others])
            left = left[others][~ok]
        return self.pairs()

    def partnered(self) -> np.ndarray:
        """Which entries may match another one of their list. In long lists only the sizes next to an entry's are looked at."""
        out = np.zeros(len(self.node), dtype=bool)
        left_in = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.node))
        i = np.flatnonzero(np.repeat(self.sizes <= SHORT, self.sizes))
        for shift in range(1, SHORT):
            i = i[left_in[i] > shift]
            i = i[self.at_least.sizes(self.size[i], self.size[i + shift])]  # a list ascends in size
            if not len(i):
                break
            ok = i[self.may_match(i, i + shift)]
            out[ok] = out[ok + shift] = True
        i = np.flatnonzero(np.repeat(self.sizes > SHORT, self.sizes) & (left_in > 1))
        ok = i[self.at_least.sizes(self.size[i], self.size[i + 1])]
        out[ok] = out[ok + 1] = True
        return out

    def between_roots(self) -> np.ndarray:
        """All pairs of different roots that may match."""
        several = np.minimum.reduceat(self.root, self.starts) != np.maximum.reduceat(self.root, self.starts)
        left_in = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.node))
        i = np.flatnonzero(np.repeat(several & (self.sizes <= SHORT), self.sizes))
        for shift in range(1, SHORT):
            i = i[left_in[i] > shift]
            i = i[self.at_least.sizes(self.size[i], self.size[i + shift])]  # a list ascends in size
            if not len(i):
                break
            self.add(i, i + shift)
        for r in np.flatnonzero(several & (self.sizes > SHORT)):
            own = np.arange(self.starts[r], self.starts[r] + self.sizes[r])
            names, count = np.unique(self.root[own], return_counts=True)
            for x in own[self.root[own] != names[count.argmax()]]:  # pairs inside the largest component need no look
                self.add(np.full(len(own), x), own)
        return self.pairs()


PAIRS = "a long, b long"


def with_roots(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(k, node, size, at, root): the lists that hold several components."""
    rooted = lists.join(roots, "node", "left").select("k", "node", "size", "at", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "rooted")
    several = rooted.groupBy("k").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("k")
    out = materialize(rooted.join(several, "k", "left_semi"), "several")
    discard(rooted)
    return out


def _grouped(df: DataFrame, keys: list[str], pairs_of, ddl: str = PAIRS) -> DataFrame:
    """Pairs that pairs_of(arrays by column) gives for some whole groups of rows of equal keys at a time."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rest = arrow_schema(ddl), None
        for batch in batches:
            if not batch.num_rows:
                continue
            got = {}
            for c in names:
                raw = pa.types.is_binary(batch.column(c).type)
                got[c] = np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) if raw else batch.column(c).to_numpy()
            if rest is not None:
                got = {c: np.concatenate([rest[c], got[c]]) for c in names}
            last = np.ones(len(got[keys[0]]), dtype=bool)
            for c in keys:
                last &= got[c] == got[c][-1]
            tail = len(last) - int(last.sum())
            rest = {c: x[tail:] for c, x in got.items()}
            if tail:
                yield to_batch(list(pairs_of({c: x[:tail] for c, x in got.items()})), schema)
        if rest is not None:
            yield to_batch(list(pairs_of(rest)), schema)
        trim()

    return df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(run, ddl)


def _number(columns: list[np.ndarray]) -> np.ndarray:
    """The number of each row's group, groups being runs of equal rows."""
    change = np.zeros(len(columns[0]), dtype=bool)
    for x in columns:
        change[1:] |= x[1:] != x[:-1]
    return np.cumsum(change)


def stars_of_components(several: DataFrame, at_least: Threshold) -> DataFrame:
    """(a, b): stars again, among one node of each component of a list: what was dealt out to several lists meets here."""
    one = several.groupBy("k", "root").agg(F.min(F.struct("at", "node", "size")).alias("m")).select("k", "root", "m.*")
    batch_rows(several.sparkSession, 50_000)
    return _grouped(one, ["k"], lambda g: Lists(g["k"], g["node"], g["size"], g["at"], _number([g["k"]]), at_least, g["root"]).stars())


def pairs_between(several: DataFrame, signs: DataFrame, at_least: Threshold) -> DataFrame:
    """(a, b): all pairs of nodes of different components that meet in a list and may have the similarity. Long lists are compared in pairs of blocks."""
    sizes = several.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    sizes = materialize(sizes.select("k", F.ceil(F.col("n") / BLOCK).cast("int").alias("s")), "long_lists")
    parities = several.select("node").distinct().join(signs, "node").groupBy("node").agg(F.min(F.substring("sign", 1, PARITY // 8)).alias("parity"))
    cut = several.join(parities, "node").join(sizes, "k", "left").withColumn("s", F.coalesce("s", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("s")).cast("int")).withColumn("o", F.explode(F.expr("sequence(0, s - 1)")))
    cut = cut.select("k", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "node", "size", "at", "root", "parity")

    def compare(g: dict[str, np.ndarray]) -> np.ndarray:
        block = np.where(g["i"] == g["j"], -1, g["own"])
        return Lists(g["k"], g["node"], g["size"], g["at"], _number([g["k"], g["i"], g["j"]]), at_least, g["root"], g["parity"], block).between_roots()

    batch_rows(several.sparkSession, 20_000)
    return _grouped(cut, ["k", "i", "j"], compare)


def verified(pairs: DataFrame, nodes: DataFrame, signs: DataFrame, docs: DataFrame, words: int, at_least: Threshold, orders: int) -> DataFrame:
    """Of pairs (a, b), those of the similarity: first the filters of all orders, then the sets; only texts of pairs that pass the filters are read again."""
    pairs = materialize(pairs.distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    own = materialize(signs.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("sign").alias("sign"), F.min("size").alias("size")), "signatures")
    grown = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest("size", F.lit(1)).cast("double")))).cast("int")
    bits = PARITY + F.when(F.col("size") <= PARITY, 0).otherwise(F.least(grown, F.lit(1 << 16)))
    batch_rows(docs.sparkSession, 1000)

    def passing(left: DataFrame, part, name: str, test) -> DataFrame:
        """The pairs of which test(x, y, sizes) holds, x and y being one part of the signatures: small parts are moved first."""
        parts = own.select("node", part.alias("part"), "size")
        both = left.join(parts.toDF("a", "x", "m"), "a").join(parts.toDF("b", "y", "n"), "b").select("a", "b", "x", "y", "m", "n")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [test(*(v.as_py() for v in row)) for row in zip(*(batch.column(c) for c in range(2, 6)), strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            trim()

        return materialize(both.mapInArrow(run, PAIRS), name)

    near = passing(pairs, F.substring(F.col("sign"), F.lit(1), (bits / 8).cast("int")), "near_in_bits", lambda x, y, m, n: few_bits_differ(x, y, m, n, at_least))
    rest = F.substring(F.col("sign"), (bits / 8).cast("int") + 1, F.length("sign"))
    left = passing(near, rest, "candidates", lambda x, y, m, n: prefixes_meet(x, y, m, n, at_least, orders))
    wanted = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    rows = materialize(nodes.join(wanted, "node", "left_semi").select("first.*"), "wanted")

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known = arrow_schema("node long, tokens binary"), WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [token_set(t.as_py(), words, known) for t in part.column("text")]
                yield to_batch([[node for node, _ in found], [tokens.tobytes() for _, tokens in found]], schema)
        trim()

    sets = texts(only_rows(docs.select("doc_id", "text"), rows), "text").mapInArrow(read_sets, "node long, tokens binary")
    sets = materialize(sets.dropDuplicates(["node"]), "sets")
    both = left.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                keep.append(at_least.reached(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        trim()

    batch_rows(docs.sparkSession, 200)
    found = materialize(both.mapInArrow(verify, PAIRS), "links")
    discard(pairs, own, near, left, rows, sets)
    return found


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes of different components."""
    both = pairs.join(roots.toDF("a", "x"), "a", "left").join(roots.toDF("b", "y"), "b", "left")
    return both.filter(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def linked_sets(
    docs: DataFrame, words: int, at_least: Threshold, orders: int = ORDERS, proposed: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): of every document (doc_id, key, node, size), key being a hash of its text; of every node the least (doc_id, key) reachable over links.

    `proposed` is another search: of nodes (node, key), it gives pairs (a, b).
    They are verified first, and what they join needs no further look.
    """
    both = materialize(marked_sets(docs, words, at_least, orders), "marked")
    marked, signs = both.filter("node IS NOT NULL").select("doc_id", "key", "node", "size"), both.filter("sign IS NOT NULL").select("node", "sign", "size")
    nodes = materialize(marked.groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("first")), "nodes")
    known = (nodes, signs, docs, words, at_least, orders)
    if proposed:
        given = verified(proposed(nodes.select("node", "first.key")), *known)
        together = materialize(components(given), "together")
    common = common_tokens(both)
    lists = materialize(prefix_lists(docs, words, at_least, common), "lists")
    stars, lines = lists.filter("k IS NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), lists.filter("k IS NOT NULL").drop("other")
    links = given.union(verified(apart(stars, together), *known)) if proposed else verified(stars, *known)
    several = with_roots(lines, components(links))
    if (common.lists > 1).any():
        links = links.union(verified(stars_of_components(several, at_least), *known))
        discard(several)
        several = with_roots(lines, components(links))
    links = links.union(verified(pairs_between(several, signs, at_least), *known))
    roots = components(links)
    joined = materialize(nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "roots")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    classes = materialize(joined.join(least, "root").select("node", F.col("least").alias("first")), "classes")
    discard(lists, several, joined, nodes, *([together] if proposed else []))
    return marked, classes


def near_copies(
    docs: DataFrame, words: int = 5, least: tuple[int, int] = (4, 5), proposed: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(doc_id, key, first) of every document: first is the least (doc_id, key) reachable over pairs of a similarity of `least` (a fraction) or more."""
    marked, classes = linked_sets(docs, words, Threshold(*least), proposed=proposed)
    return marked.join(classes, "node").select("doc_id", "key", "first")


def ngram_join(docs: DataFrame, words: int = 4, least: tuple[int, int] = (85, 100), orders: int = ORDERS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    marked, classes = linked_sets(docs, words, Threshold(*least), orders)
    own = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return marked.join(classes, "node").select("doc_id", F.col("size").cast("long").alias("n_shingles"), own.alias("component_id"))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read(spark, sf_dir, "documents"))
