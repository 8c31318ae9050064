"""Language-model scores from an Elias-Fano n-gram trie (operator 5).

The model is a trigram model over every word of the training documents with
Dirichlet-smoothed probabilities: a seen pair has (c(u,w) + mu P1(w)) /
(c(u) + mu), an unseen one mu P1(w) / (c(u) + mu); P1 adds one to each count.
Pairs seen LEAST times or more are contexts of level 3, where P2 takes the
place of P1. The model grows with the corpus, so it is dealt out: level 1 by
word, levels 2 and 3 by context (very frequent contexts by context and word).
A part of level 2 or 3 is a trie level in a file that is mapped into memory:
contexts and pointers to their successor ranges as monotone Elias-Fano
sequences, successors as one monotone sequence of context rank and word number,
and one byte an entry for the quantised log probability. Queries find the
context, then the word by successor search inside the context's range, all on
the packed form; only the counts of zeros before each 64-bit word are added.

Levels 2 and 3 use the same numbers of words; ids of level 3 are not made
relative to level 2, whose parts lie on other machines. A pair's count is read
back from its quantised probability, which is the same in every block.

Texts are cut into blocks of some megabytes of whole documents. A block asks
each part once for its distinct words, pairs and triples, so what is everywhere
costs one entry a block. The blocks are a bucketed table in the shared folder,
removed at the end: joining answers to them moves the answers only.

Words are numbered by a 64-bit hash of their bytes; two different words share
one with a probability of about V^2 / 2^65.

Edge cases: null and empty texts have the end token alone; unknown words have
the probability of a count of zero; without training rows all counts are zero.
Repeated rows and doc_ids are scored one by one, and each trains. Texts of any
length are read whole; an empty table gives no row. Columns other than doc_id,
text and train are not looked at.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import arrow_schema, discard, fold, materialize, partitions, read, rows_to_batch, shared_dir, slices, texts, to_batch

#: Strength of the prior towards the shorter context, and the count from which a pair is a context of level 3.
MU, LEAST = 100.0, 4
#: Text bytes hashed at once, and text bytes of a block.
SLICE_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
#: Pairs of a part of level 2, words of a part of level 1.
PART_PAIRS, PART_WORDS = 3_000_000, 2_000_000
END = np.uint64(0)
#: Stands for a null doc_id inside blocks.
NO_ID = -(1 << 63)
#: One byte holds a log10 probability down to FLOOR; code 0 says that a pair is absent.
FLOOR = -14.0
BOOK = np.concatenate([[0.0], FLOOR * (1 - (np.arange(255) + 0.5) / 255)])


def quantise(log10p: np.ndarray) -> np.ndarray:
    return (1 + np.clip((1 - log10p / FLOOR) * 255, 0, 254)).astype(np.uint8)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0xD6E8FEB86659FD93


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse modulo 2**64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit numbers of all words of the texts in order, each text followed by END; and tokens per text, END included."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    word = ~_SPACE[data]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
        words = _mix((sums[ends] - sums[starts]) * down[starts])
    words[words == END] = np.uint64(1)
    closes = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return np.insert(words, closes, END), np.diff(np.concatenate([[0], closes])) + 1


BLOCKS = "block long, docs binary, sizes binary, train binary, vocabulary binary, tokens binary, n_tokens long, n_train long, n_train_docs long, n_words long"


def blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, text, train) as blocks of hashed tokens: distinct words, and per token its number among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, task, made = arrow_schema(BLOCKS), TaskContext.get().partitionId(), 0

        def block(parts):
            nonlocal made
            doc, train, words, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
            vocabulary, tokens = np.unique(words, return_inverse=True)
            row = (task << 32 | made, doc.tobytes(), sizes.astype(np.int32).tobytes(), train.tobytes(), vocabulary.tobytes(), tokens.astype(np.int32).tobytes(), len(tokens), int(sizes[train].sum()), int(train.sum()), len(vocabulary))
            made += 1
            return rows_to_batch([row], schema)

        parts, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column(1)]
                words, sizes = hash_words(texts)
                parts.append((np.array([NO_ID if d is None else d for d in part.column(0).to_pylist()], dtype=np.int64), np.array(part.column(2).to_pylist(), dtype=bool), words, sizes))
                size += sum(map(len, texts))
                if size >= BLOCK_BYTES:
                    yield block(parts)
                    parts, size = [], 0
        if parts:
            yield block(parts)

    return texts(docs, "doc_id", "text", F.coalesce("train", F.lit(False)).alias("train")).mapInArrow(run, BLOCKS)


def bucketed(df: DataFrame, key: str) -> tuple[DataFrame, Callable[[], None]]:
    """Write df as a table bucketed by key in the shared folder, so that joins on key move the other side only; and what removes it."""
    spark = df.sparkSession
    name = f"docfacts_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}/table"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(max(1, partitions(spark)), key).saveAsTable(name)
    table = spark.table(name)
    table._docfacts_path = path

    def drop() -> None:
        spark.sql(f"DROP TABLE {name}")
        discard(table)

    return table, drop


def _array(value, kind) -> np.ndarray:
    return np.frombuffer(value, dtype=kind)


def _narrow(a: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes: planes of small numbers compress away."""
    return a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _wide(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


# level 1 ------------------------------------------------------------------


def word_parts(table: DataFrame, parts: int) -> DataFrame:
    """A block's distinct words and their training counts, cut by the hash's range into the parts of level 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("part int, block long, words binary, counts binary")
        edges = (np.arange(1, parts, dtype=object) * (1 << 64) // parts).astype(np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                words, tokens = _array(row["vocabulary"], np.uint64), _array(row["tokens"], np.int32)
                train = np.repeat(_array(row["train"], bool), _array(row["sizes"], np.int32))
                counts = np.bincount(tokens[train], minlength=len(words))
                cuts = [0, *np.searchsorted(words, edges).tolist(), len(words)]
                yield rows_to_batch([(k, row["block"], words[a:b].tobytes(), _narrow(counts[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a], schema)

    return table.select("block", "sizes", "train", "vocabulary", "tokens").mapInArrow(run, "part int, block long, words binary, counts binary")


def word_counts(asked: DataFrame) -> DataFrame:
    """(block, part, counts, ranks, known): for each block's words the corpus count and the rank among the part's known words."""

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = [_array(r["words"], np.uint64) for r in rows]
        every, inverse = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([_wide(r["counts"]) for r in rows])).astype(np.int64)
        rank = np.cumsum(total > 0) - (total > 0)
        out, at = [], 0
        for r, w in zip(rows, words, strict=True):
            own = inverse[at:at + len(w)]
            at += len(w)
            out.append((r["block"], r["part"], _narrow(total[own]), _narrow(rank[own]), int((total > 0).sum())))
        return pa.Table.from_batches([rows_to_batch(out, arrow_schema("block long, part int, counts binary, ranks binary, known long"))])

    return asked.groupBy("part").applyInArrow(count, "block long, part int, counts binary, ranks binary, known long")


# level 2 ------------------------------------------------------------------


class Words:
    """A block with the answers of level 1: tokens, counts and global word numbers (1.. for known words, 0 for the start)."""

    def __init__(self, row: dict, offsets: np.ndarray):
        answers = sorted(row["words"], key=lambda a: a["part"])
        n = int(row["n_words"])
        self.count = np.concatenate([_wide(a["counts"]) for a in answers]).astype(np.int64) if n else np.zeros(0, np.int64)
        self.number = np.concatenate([_wide(a["ranks"]).astype(np.int64) + offsets[a["part"]] + 1 for a in answers]) if n else np.zeros(0, np.int64)
        self.tokens = _array(row["tokens"], np.int32)
        self.sizes = _array(row["sizes"], np.int32)
        self.train = _array(row["train"], bool)

    def pairs(self, start_count: int, total: int, parts: int):
        """Distinct known pairs in the order in which they are asked: keys (context, word), part of level 2, training count, and each token's place (-1 if unknown)."""
        first = np.zeros(len(self.tokens), dtype=bool)
        first[np.cumsum(self.sizes)[:-1]] = True
        first[:1] = True
        number, count = self.number[self.tokens], self.count[self.tokens]
        context = np.where(first, 0, np.roll(number, 1))
        self.context_count = np.where(first, start_count, np.roll(count, 1))
        known = (count > 0) & (self.context_count > 0)
        keys, place = np.unique((context[known] << 32) | number[known], return_inverse=True)
        train = np.bincount(place[np.repeat(self.train, self.sizes)[known]], minlength=len(keys))
        context_count = np.zeros(len(keys), dtype=np.int64)
        context_count[place] = self.context_count[known]
        hot = context_count > total // (2 * parts)  # such a context's successors are dealt out by pair
        by = np.where(hot, keys, keys >> 32).astype(np.uint64)
        part = (_mix(by) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        back = np.empty(len(keys), dtype=np.int64)
        back[order] = np.arange(len(keys))
        at = np.full(len(self.tokens), -1, dtype=np.int64)
        at[known] = back[place]
        word_p1 = np.zeros(len(keys), dtype=np.int64)
        word_p1[place] = count[known]
        return keys[order], part[order], train[order], word_p1[order], np.where(hot, context_count, 0)[order], at


PAIRS = "part int, block long, contexts binary, runs binary, words binary, p1 binary, train binary, more binary, hot binary"


def pair_parts(joined: DataFrame, offsets: np.ndarray, start_count: int, total: int, vocabulary: int, parts: int) -> DataFrame:
    """A block's distinct pairs for each part of level 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PAIRS)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                keys, part, train, count, hot, _ = Words(row, offsets).pairs(start_count, total, parts)
                p1 = quantise(np.log10((count + 1) / (total + vocabulary + 1)))
                cuts = np.searchsorted(part, np.arange(parts + 1))
                rows = []
                for p in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[p], cuts[p + 1])
                    context = keys[own] >> 32
                    starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                    big = train[own] >= 255
                    rows.append((int(p), row["block"], _narrow(context[starts]), _narrow(np.diff(np.r_[starts, len(context)])), _narrow(keys[own] & 0xFFFFFFFF), p1[own].tobytes(), np.minimum(train[own], 255).astype(np.uint8).tobytes(), train[own][big].astype(np.int64).tobytes(), _narrow(hot[own][starts]) if hot[own].any() else b""))
                yield rows_to_batch(rows, schema)

    return joined.mapInArrow(run, PAIRS)


#: Position of the k-th set bit of a byte, by byte and k.
_SELECT = np.array([[([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for k in range(8)] for byte in range(256)], dtype=np.int64)


class EliasFano:
    """A monotone sequence of n numbers below `universe`: low bits packed, high bits in unary, and the zeros before each 64-bit word of these.

    Nothing is decoded as a whole: elements and successors are found by select on the packed words.
    """

    def __init__(self, n: int, universe: int, low: np.ndarray, high: np.ndarray, before: np.ndarray):
        self.n, self.l, self.low, self.words, self.before = n, self.low_bits(n, universe), low, high.view(np.uint64), before

    @staticmethod
    def low_bits(n: int, universe: int) -> int:
        return max(0, (universe // max(n, 1)).bit_length() - 1)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low words, high bytes in whole words, zeros before each of them)."""
        n, l = len(values), cls.low_bits(len(values), universe)
        values = values.astype(np.uint64)
        size = n + int(universe >> l) + 2
        bits = np.zeros(size + -size % 64, dtype=np.uint8)
        bits[(values >> np.uint64(l)).astype(np.int64) + np.arange(n)] = 1
        low = np.zeros(n * l // 64 + 2, dtype=np.uint64)
        if l:
            rest = values & np.uint64((1 << l) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(l)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, rest << shift)
            over = shift + np.uint64(l) > 64
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
        high = np.packbits(bits, bitorder="little")
        zeros = 64 - np.bitwise_count(high.view(np.uint64)).astype(np.int64)
        return low, high, (np.cumsum(zeros) - zeros).astype(np.uint32)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.l)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> shift
        over = shift + np.uint64(self.l) > 64
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.l) - 1)

    @staticmethod
    def _in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Position of the k-th set bit of each word."""
        parts = words.view(np.uint8).reshape(-1, 8)
        # sums of set bits up to each byte, all eight in one word
        sums = np.bitwise_count(parts).view(np.uint64).ravel() * np.uint64(0x0101010101010101)
        each = sums.view(np.uint8).reshape(-1, 8)
        byte = np.count_nonzero(each <= k.astype(np.uint8)[:, None], axis=1)
        before = (sums << np.uint64(8)).view(np.uint8).reshape(-1, 8)
        row = np.arange(len(words))
        return 8 * byte + _SELECT[parts[row, byte], k - before[row, byte]]

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero of the unary part."""
        word = np.searchsorted(self.before, k, side="right") - 1
        return 64 * word + self._in_word(~self.words[word], k - self.before[word])

    def _one(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th one of the unary part."""
        before = 64 * np.arange(len(self.words)) - self.before
        word = np.searchsorted(before, k, side="right") - 1
        return 64 * word + self._in_word(self.words[word], k - before[word])

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element >= x (successor search)."""
        return self._search(x, None, None)[0]

    def index_of(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of the element x between `first` and `last`, -1 where it is none."""
        at, end, want = self._search(x, first, last)
        found = np.flatnonzero(at < end)
        found = found[self._low(at[found]) == want[found]]
        out = np.full(len(x), -1)
        out[found] = at[found]
        return out

    def _search(self, x: np.ndarray, first: np.ndarray | None, last: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(successor of x, end of the elements with its high bits, its low bits): the unary part gives the range of equal high bits, then the low bits are bisected."""
        x = x.astype(np.uint64)
        h = (x >> np.uint64(self.l)).astype(np.int64)
        want = x & np.uint64((1 << self.l) - 1)
        lo = np.where(h > 0, self._zero(np.maximum(h - 1, 0)) - np.maximum(h - 1, 0), 0)
        end = self._zero(h) - h
        if first is not None:
            lo, end = np.clip(lo, first, last), np.clip(end, first, last)
        hi = end.copy()
        while (active := np.flatnonzero(lo < hi)).size:
            mid = (lo[active] + hi[active]) // 2
            less = self._low(mid) < want[active]
            lo[active[less]] = mid[less] + 1
            hi[active[~less]] = mid[~less]
        return lo, end, want

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self._one(i) - i).astype(np.uint64) << np.uint64(self.l)) | self._low(i)


class Level:
    """One part of a level in a mapped file: contexts, pointers, successors, quantised probabilities. Queries read the packed form."""

    def __init__(self, keys: np.ndarray, codes: np.ndarray, folder: str):
        contexts, starts = np.unique(keys >> 32, return_index=True)
        self.width = max(1, int((keys & 0xFFFFFFFF).max()).bit_length()) if len(keys) else 1
        rank = np.repeat(np.arange(len(contexts)), np.diff(np.r_[starts, len(keys)]))
        sequences = [
            (contexts, int(contexts[-1]) + 1 if len(contexts) else 1),
            (np.r_[starts, len(keys)], len(keys) + 1),
            (rank << self.width | keys & 0xFFFFFFFF, max(1, len(contexts)) << self.width),
        ]
        arrays, self.shapes = [], []
        for values, universe in sequences:
            own = EliasFano.encode(values, universe)
            self.shapes.append((len(values), universe, *map(len, own)))
            arrays += [*own[:2], np.r_[own[2], np.zeros(len(own[2]) % 2, np.uint32)]]
        self.path, self.n, self.last = os.path.join(folder, f"level-{uuid.uuid4().hex}"), len(keys), int(contexts[-1]) if len(contexts) else -1
        with open(self.path, "wb") as f:
            for a in [*arrays, codes]:
                f.write(a.tobytes())
            f.write(b"\0")

    def __enter__(self):
        self.file = open(self.path, "rb")  # noqa: SIM115
        os.unlink(self.path)  # the open file stays readable, and nothing is left behind if the worker is killed
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        view, at, found = np.frombuffer(self.map, dtype=np.uint8), 0, []
        for n, universe, lows, highs, words in self.shapes:
            low, high = view[at:at + 8 * lows].view(np.uint64), view[at + 8 * lows:at + 8 * lows + highs]
            at += 8 * lows + highs
            found.append(EliasFano(n, universe, low, high, view[at:at + 4 * words].view(np.uint32)))
            at += 4 * (words + words % 2)
        self.contexts, self.pointers, self.successors = found
        self.codes = view[at:at + self.n]
        return self

    def __exit__(self, *_):
        del self.contexts, self.pointers, self.successors, self.codes
        self.file.close()

    def codes_of(self, keys: np.ndarray) -> np.ndarray:
        """Code of each (context, word) key, 0 if it is not in the level. Keys of one context should lie together: the context is found once."""
        out = np.zeros(len(keys), dtype=np.uint8)
        if not self.n or not len(keys):
            return out
        context, word = keys >> 32, keys & 0xFFFFFFFF
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(keys)]))
        asked = context[first]
        known = asked <= self.last
        rank = np.full(len(first), -1)
        rank[known] = self.contexts.index_of(asked[known])
        known = rank >= 0
        start, end = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
        start[known] = self.pointers.at(rank[known])
        end[known] = self.pointers.at(rank[known] + 1)
        left = np.flatnonzero(known[own] & (word < 1 << self.width))
        for some in np.array_split(left, len(left) // (1 << 18) + 1):
            o = own[some]
            value = rank[o] << self.width | word[some]
            at = self.successors.index_of(value, start[o], end[o])  # inside the context's own range
            out[some[at >= 0]] = self.codes[at[at >= 0]]
        return out


def pair_codes(asked: DataFrame, mu: float) -> DataFrame:
    """(block, part, codes): builds each part's trie level from the training pairs and answers all its blocks."""

    def answer(table: pa.Table) -> pa.Table:
        rows = [(r["part"], r["block"], np.repeat(_wide(r["contexts"]).astype(np.int64), _wide(r["runs"])) << 32 | _wide(r["words"]).astype(np.int64), r) for r in table.to_pylist()]
        rows.sort(key=lambda r: r[1])
        keys, train, p1, hot = [], [], [], {}
        for _, _, own, r in rows:
            t = _array(r["train"], np.uint8).astype(np.int64)
            t[t == 255] = _array(r["more"], np.int64)
            seen = t > 0
            keys.append(own[seen])
            train.append(t[seen])
            p1.append(_array(r["p1"], np.uint8)[seen])
            if r["hot"]:
                totals = _wide(r["hot"])
                hot |= {int(c): int(n) for c, n in zip(_wide(r["contexts"])[totals > 0], totals[totals > 0], strict=True)}
        every, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        count = np.bincount(inverse, np.concatenate(train), len(every))
        contexts, starts = np.unique(every >> 32, return_index=True)
        sums = np.add.reduceat(count, starts) if len(every) else count
        if hot:
            sums = np.array([hot.get(int(c), n) for c, n in zip(contexts, sums, strict=True)], dtype=float)
        total = np.repeat(sums, np.diff(np.r_[starts, len(every)]))
        prior = 10.0 ** BOOK[np.concatenate(p1)[first]]
        codes = quantise(np.log10((count + mu * prior) / (total + mu)))
        with Level(every, codes, tempfile.gettempdir()) as level:
            out = [(block, part, level.codes_of(own).tobytes()) for part, block, own, _ in rows]
        return pa.Table.from_batches([rows_to_batch(out, arrow_schema("block long, part int, codes binary"))])

    return asked.groupBy("part").applyInArrow(answer, "block long, part int, codes binary")


# level 3 ------------------------------------------------------------------


class Pairs:
    """A block with the answers of levels 1 and 2: per token the log10 probability after one word, and the pairs that are contexts of level 3."""

    def __init__(self, row: dict, model: "Model"):
        self.words = words = Words(row, model.offsets)
        self.keys, *_, self.at = words.pairs(model.starts, model.total, model.parts)
        codes = np.frombuffer(b"".join(a["codes"] for a in sorted(row["pairs"] or [], key=lambda a: a["part"])), dtype=np.uint8)
        known = self.at >= 0
        code = np.zeros(len(self.at), dtype=np.uint8)
        code[known] = codes[self.at[known]]
        self.p1 = np.log10((words.count + 1) / (model.total + model.vocabulary + 1))
        prior = BOOK[quantise(self.p1)][words.tokens]
        self.each = np.where(code > 0, BOOK[code], prior + np.log10(model.mu / (words.context_count + model.mu)))
        # the pair's count, from its quantised probability: the same number in every block
        found = 10.0 ** BOOK[code] * (words.context_count + model.mu) - model.mu * 10.0 ** prior
        self.found = np.where(code > 0, np.rint(found), 0).astype(np.int64)

    def triples(self, model: "Model"):
        """As Words.pairs, of known words after a pair that is a context: (context pair, word) keys in the order in which they are asked."""
        words = self.words
        first = np.zeros(len(words.tokens), dtype=bool)
        first[np.cumsum(words.sizes)[:-1]] = True
        first[:1] = True
        place, seen = np.roll(self.at, 1), np.roll(self.found, 1)
        asked = ~first & (place >= 0) & (seen >= model.least) & (words.count[words.tokens] > 0)
        number = words.number[words.tokens]
        keys, where = np.unique((place[asked] << 32) | number[asked], return_inverse=True)
        train = np.bincount(where[np.repeat(words.train, words.sizes)[asked]], minlength=len(keys))
        of = lambda values: _placed(len(keys), where, values[asked])
        prior, seen = of(quantise(self.each)), of(seen)
        context = self.keys[keys >> 32]
        hot = seen > model.total // (2 * model.parts)
        mixed = _mix(context.astype(np.uint64))
        part = (np.where(hot, _mix(mixed ^ (keys & 0xFFFFFFFF).astype(np.uint64)), mixed) % np.uint64(model.parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        back = np.empty(len(keys), dtype=np.int64)
        back[order] = np.arange(len(keys))
        at = np.full(len(words.tokens), -1, dtype=np.int64)
        at[asked] = back[where]
        return context[order], (keys & 0xFFFFFFFF)[order], part[order], train[order], prior[order], np.where(hot, seen, 0)[order], at


def _placed(n: int, where: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(n, dtype=values.dtype)
    out[where] = values
    return out


class Model:
    """What all blocks share: sizes of the training corpus and of the model."""

    def __init__(self, offsets: np.ndarray, starts: int, total: int, parts: int, mu: float, least: int):
        self.offsets, self.starts, self.total, self.parts, self.mu, self.least = offsets, starts, total, parts, mu, least
        self.vocabulary = int(offsets[-1])


TRIPLES = "part int, block long, before binary, contexts binary, runs binary, words binary, prior binary, train binary, more binary, hot binary"


def triple_parts(joined: DataFrame, model: Model) -> DataFrame:
    """A block's distinct triples for each part of level 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(TRIPLES)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                context, word, part, train, prior, hot, _ = Pairs(row, model).triples(model)
                cuts = np.searchsorted(part, np.arange(model.parts + 1))
                rows = []
                for p in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[p], cuts[p + 1])
                    c, t = context[own], train[own]
                    starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
                    rows.append((
                        int(p), row["block"], _narrow(c[starts] >> 32), _narrow(c[starts] & 0xFFFFFFFF), _narrow(np.diff(np.r_[starts, len(c)])), _narrow(word[own]), prior[own].tobytes(),
                        np.minimum(t, 255).astype(np.uint8).tobytes(), t[t >= 255].astype(np.int64).tobytes(), _narrow(hot[own][starts]) if hot[own].any() else b"",
                    ))
                yield rows_to_batch(rows, schema)

    return joined.mapInArrow(run, TRIPLES)


def triple_codes(asked: DataFrame, mu: float) -> DataFrame:
    """(block, part, codes): builds each part's trie level from the training triples and answers all its blocks, unseen triples too."""

    def answer(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        contexts = [_wide(r["before"]).astype(np.int64) << 32 | _wide(r["contexts"]).astype(np.int64) for r in rows]
        every = np.unique(np.concatenate(contexts))
        totals, given, own, train, prior = np.zeros(len(every)), np.zeros(len(every)), [], [], []
        for r, c in zip(rows, contexts, strict=True):
            rank = np.searchsorted(every, c)
            if r["hot"]:
                given[rank] = np.maximum(given[rank], _wide(r["hot"]))
            own.append(np.repeat(rank, _wide(r["runs"])) << 32 | _wide(r["words"]).astype(np.int64))
            t = _array(r["train"], np.uint8).astype(np.int64)
            t[t == 255] = _array(r["more"], np.int64)
            train.append(t)
            prior.append(_array(r["prior"], np.uint8))
        seen = [t > 0 for t in train]
        keys, first, inverse = np.unique(np.concatenate([k[s] for k, s in zip(own, seen, strict=True)]), return_index=True, return_inverse=True)
        count = np.bincount(inverse, np.concatenate([t[s] for t, s in zip(train, seen, strict=True)]), len(keys))
        np.add.at(totals, keys >> 32, count)
        totals = np.where(given > 0, given, totals)  # a hot context is dealt out: its total comes with it
        before = 10.0 ** BOOK[np.concatenate([p[s] for p, s in zip(prior, seen, strict=True)])[first]]
        codes = quantise(np.log10((count + mu * before) / (totals[keys >> 32] + mu)))
        out, fall = [], np.log10(mu / (totals + mu))
        with Level(keys, codes, tempfile.gettempdir()) as level:
            for r, k, p in zip(rows, own, prior, strict=True):
                got = level.codes_of(k)
                rest = np.flatnonzero(got == 0)
                got[rest] = quantise(BOOK[p[rest]] + fall[k[rest] >> 32])
                out.append((r["block"], r["part"], got.tobytes()))
        return pa.Table.from_batches([rows_to_batch(out, arrow_schema("block long, part int, codes binary"))])

    return asked.groupBy("part").applyInArrow(answer, "block long, part int, codes binary")


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def scores(joined: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCORES)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                pairs = Pairs(row, model)
                words, (*_, at) = pairs.words, pairs.triples(model)
                codes = np.frombuffer(b"".join(a["codes"] for a in sorted(row["triples"] or [], key=lambda a: a["part"])), dtype=np.uint8)
                each = pairs.each
                each[at >= 0] = BOOK[codes[at[at >= 0]]]
                starts = np.concatenate([[0], np.cumsum(words.sizes)[:-1]])
                yield to_batch([
                    pa.array(ids := _array(row["docs"], np.int64), mask=ids == NO_ID), words.sizes.astype(np.int64), np.add.reduceat((words.count > 0)[words.tokens].astype(np.int64), starts),
                    np.add.reduceat(pairs.p1[words.tokens], starts), np.add.reduceat(each, starts),
                ], schema)

    return joined.mapInArrow(run, SCORES)


def score_documents(docs: DataFrame, mu: float = MU, least: int = LEAST) -> tuple[DataFrame, int]:
    """docs: (doc_id, text, train). Scores of every document, and the number of training tokens."""
    table, drop = bucketed(blocks(docs), "block")
    sums = table.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_train", "n_train_docs", "n_words")]).first()
    total = sums["n_train"]
    word_n = max(1, -(-sums["n_words"] // PART_WORDS))
    pair_n = max(1, -(-sums["n_tokens"] // PART_PAIRS))
    counts = materialize(word_counts(word_parts(table, word_n)), "words")
    known = {r["part"]: r["known"] for r in counts.groupBy("part").agg(F.max("known").alias("known")).collect()}  # one row a part
    model = Model(np.concatenate([[0], np.cumsum([known.get(k, 0) for k in range(word_n)])]), sums["n_train_docs"], total, pair_n, mu, least)
    answers = lambda df, name, *columns: df.groupBy("block").agg(F.collect_list(F.struct("part", *columns)).alias(name))  # noqa: E731 a block has one row a part
    with_words = table.select("block", "docs", "sizes", "train", "tokens", "n_words").join(answers(counts, "words", "counts", "ranks"), "block")
    codes = materialize(pair_codes(pair_parts(with_words, model.offsets, model.starts, total, model.vocabulary, pair_n), mu), "pairs")
    with_pairs = with_words.join(answers(codes, "pairs", "codes"), "block", "left")
    triples = materialize(triple_codes(triple_parts(with_pairs, model), mu), "triples")
    out = materialize(scores(with_pairs.join(answers(triples, "triples", "codes"), "block", "left"), model), "scores")
    discard(counts, codes, triples)
    drop()
    return out, total


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    docs = read(spark, sf_dir, "documents").withColumn("train", ~held_out)
    out, total = score_documents(docs)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
