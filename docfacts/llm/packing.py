"""Pattern packing by non-negative least squares (operator 9).

Documents become token sequences (public BPE vocabulary plus one end id), long
ones are cut into pieces of at most 4096 tokens, and the pieces are packed into
as few sequences as possible:

1. one histogram of piece lengths over the whole corpus (at most 4096 counts);
2. patterns of one to eight lengths that fill a sequence exactly, with repeat
   counts from a non-negative least squares fit to that histogram, rounded so
   that running sums are kept; the fit is repeated on what rounding leaves;
3. what the patterns leave is packed best-fit on the histogram, each step
   repeating one filling pattern as often as the counts allow.

The plan is a list of rank intervals per length, so it never grows beyond the
number of distinct lengths. Each piece finds its place by its rank among the
pieces of its length; ranks come from a range partitioning, not from one task
per length.

Edge cases: null and empty texts have the end id alone; texts without tokens
too. Texts of any length are tokenised whole. Repeated rows are packed like any
other, and pieces of equal length, doc_id and number in any order. An empty
table gives no row; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import arrow_schema, batch_rows, global_rank, materialize, read, slices, texts, to_batch, trim

CAPACITY = 4096
END_ID = 1
#: Lengths of a pattern at most, shares of the room left that its middle lengths take, ways to close one with a pair, and fits in a row.
MOST, SHARES, PAIR_WAYS, FITS = 8, (0.3, 0.6), 2, 3
#: Words kept per worker between batches; beyond it the store starts anew.
WORDS_KEPT = 250_000

#: Marks that may follow a word.
MARKS = ",.;:!?$#%&*|"
#: The one character whose lower case has several code points, a letter and a mark; words with it are tokenised with what follows them.
DOTTED_I = "\u0130"
#: The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(PRINTABLE))}
SEPARATORS, PARTS = re.compile("[\x1c-\x1f]"), re.compile("[ \t\n\r]+")


class WordTokens(dict):
    """Token ids (little-endian unsigned 32-bit) by word; a word is tokenised when it is first asked for.

    The vocabulary's pre-tokeniser never joins characters across white space,
    so a text's ids are those of its parts in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize

    def __missing__(self, word: str) -> bytes:
        # a run of marks after a letter is a pre-token of its own, so `word,` is `word` and `,`
        stem = word.rstrip(MARKS)
        if len(stem) < len(word) and stem[-1:].isalpha() and "'" not in word and DOTTED_I not in word:
            found = self[stem] + self[word[len(stem):]]
        else:
            found = self._tokenise(word)
        self[word] = found
        return found

    def _tokenise(self, word: str) -> bytes:
        """Latin words of letters alone go to the byte-pair merges directly; all others through the whole tokeniser."""
        low = word.lower()
        if low.isalpha() and max(low) < "\u0250" and word.isalpha() and max(word) < "\u0250":
            if not low.isascii():
                low = low.encode().decode("latin-1").translate(BYTE_CHARS)
            ids = [t.id for t in self.merge(low)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if len(self) > WORDS_KEPT:
            self.clear()
        # the separators U+001C to U+001F are white space to split() alone
        words = PARTS.split(text) if SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, words))


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece; with_ids adds the token ids as little-endian bytes."""
    fields = PIECES + (", ids binary" if with_ids else "")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words, schema = WordTokens(vocabulary), arrow_schema(fields)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                columns: list[list] = [[] for _ in schema]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = words.ids(text or "") + end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[start:start + 4 * capacity]
                        for column, value in zip(columns, (doc_id, k, start // 4, len(own) // 4, zlib.crc32(own), own), strict=False):
                            column.append(value)
                yield to_batch(columns, schema)
        words.clear()
        trim()

    return texts(docs, "doc_id", "text").mapInArrow(tokenise, fields)


def pair_table(has: np.ndarray, capacity: int) -> np.ndarray:
    """Per sum up to the capacity, for each of PAIR_WAYS ways, the shorter of two present lengths that give it (0: none)."""
    present = np.flatnonzero(has)
    out = np.zeros((PAIR_WAYS, capacity + 1), dtype=np.int64)
    for total in range(2, capacity + 1):
        short = present[: np.searchsorted(present, total // 2, side="right")]
        short = short[has[total - short]]
        if len(short):
            out[:, total] = short[(np.arange(PAIR_WAYS) * (len(short) - 1)) // max(PAIR_WAYS - 1, 1)]
    return out


def patterns(counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of one to MOST present lengths that fill a sequence exactly, longest first.

    Every present length begins some: it is followed by up to MOST - 3 lengths
    that each take a share of the room left, and closed by a pair, or by one
    length, that fills the rest to the token. The number of patterns is bounded
    by the capacity, not by the input.
    """
    has = counts > 0
    has[0] = False
    present = np.flatnonzero(has)
    below = np.maximum.accumulate(np.where(has, np.arange(capacity + 1), 0))  # the longest present length up to each
    pairs, found = pair_table(has, capacity), set()
    for share in SHARES:
        taken, room = [present], capacity - present
        for _ in range(MOST - 2):
            one = has[room] & (room > 0)
            ends = [(one, [room]), *((short[room] > 0, [room - short[room], short[room]]) for short in pairs), (room == 0, [])]
            for ok, last in ends:
                columns = np.stack([x[ok] for x in (*taken, *last)], axis=1)
                found.update(map(tuple, -np.sort(-columns, axis=1)))
            step = below[np.minimum((room * share).astype(np.int64), room)]
            taken, room = [x[step > 0] for x in (*taken, step)], (room - step)[step > 0]
            if not len(room):
                break
    return sorted((tuple(int(x) for x in p) for p in found if all(p.count(x) <= counts[x] for x in set(p))), reverse=True)


def nnls(found: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|, A holding each pattern's lengths (accelerated projected gradient)."""
    column = np.repeat(np.arange(len(found)), [len(p) for p in found])
    row = np.concatenate([np.array(p) for p in found])
    target = counts.astype(float)
    weight = np.maximum(np.bincount(row, minlength=len(counts)), 1)  # scaled rows: short lengths occur in many patterns
    x = y = np.zeros(len(found))
    step, t = 1.0 / max(map(len, found)), 1.0
    for _ in range(rounds):
        residual = (np.bincount(row, y[column], len(counts)) - target) / weight
        gradient = np.bincount(column, residual[row], len(found))
        new = np.maximum(0.0, y - step * gradient)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def rounded(x: np.ndarray) -> np.ndarray:
    """Whole numbers whose running sums follow those of x: what rounding takes from a pattern goes to the next ones, which are alike."""
    return np.diff(np.floor(np.concatenate([[0.0], np.cumsum(x)]) + 0.5)).astype(np.int64)


def fitted(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) by least squares, taken from the histogram `left`; fits again to what rounding left, while that places more."""
    out: list[tuple[tuple[int, ...], int]] = []
    for _ in range(FITS):
        found = patterns(left, capacity)
        placed = 0
        for pattern, times in zip(found, rounded(nnls(found, left)).tolist() if found else [], strict=True):
            if times:
                lengths, need = np.unique(pattern, return_counts=True)
                n = int(min(times, (left[lengths] // need).min()))
                if n:
                    left[lengths] -= n * need
                    out.append((pattern, n))
                    placed += n
        if not placed:
            break
    return out


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats), using every piece of the histogram exactly once."""
    left = counts.astype(np.int64).copy()
    out = fitted(left, capacity)
    while left.any():  # residual: longest first, each gap filled with the longest that fits
        pattern, room, used, top = [], capacity, {}, capacity
        while room:
            fit = np.flatnonzero(left[: min(room, top) + 1])
            if not len(fit):
                break
            length = int(fit[-1])
            times = min(room // length, int(left[length]))
            pattern += [length] * times
            used[length] = times
            room -= times * length
            top = length - 1
        n = min(int(left[length]) // times for length, times in used.items())
        for length, times in used.items():
            left[length] -= n * times
        out.append((tuple(pattern), n))
    return out


def intervals(packed: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """Per length, from which rank on pieces go to which sequences: sorted by (length, first rank)."""
    taken = np.zeros(capacity + 1, dtype=np.int64)
    rows, base = [], 0
    for pattern, n in packed:
        at = 0
        for length, times in sorted({p: pattern.count(p) for p in pattern}.items(), reverse=True):
            rows.append((length, int(taken[length]), base, times, at))
            taken[length] += n * times
            at += length * times
        base += n
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "base", "times", "offset"), columns, strict=True))


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...)."""
    spark = parts.sparkSession
    parts = materialize(parts, "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    table = spark.sparkContext.broadcast(intervals(plan(counts, capacity), capacity))
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, t = arrow_schema(fields), table.value
        width = np.int64(1) << 42
        keys = t["length"] * width + t["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            own = batch.column("rank").to_numpy() - before[length]
            k = np.searchsorted(keys, length * width + own, side="right") - 1
            nth, j = np.divmod(own - t["first"][k], t["times"][k])
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(t["base"][k] + nth), pa.array(t["offset"][k] + j * length)], schema=schema)

    ranked = global_rank(parts, ["length", "doc_id", "piece", "start"], "ranked")
    batch_rows(spark, 10_000)
    return ranked.mapInArrow(place, fields)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, vocabulary or default_vocabulary(), capacity), capacity)


def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
