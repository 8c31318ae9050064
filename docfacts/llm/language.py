"""Language identification by sparse multinomial regression (operator 3).

Features are character n-grams (one to three letters, words bounded by a
blank) hashed into a fixed number of buckets, weighted by TF-IDF. Document
frequencies are counted over all training documents; the regression is fitted
on a sample bounded by `PER_LANGUAGE` documents a language, with
follow-the-regularised-leader and L1 and L2 penalties, and its scores are
calibrated by one temperature on a part of the sample that it did not see.

Edge cases: null texts and texts without a letter are `und` with score 0; if
nothing can be learned (no labelled text, or an empty table) every row is
`und`; a single learned language gets score 1. Texts of any length are read
whole. Of equal scores the language first in order wins. Repeated rows get
equal predictions. lang, source and doc_id never enter a prediction, other
columns are not looked at, and `kept` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import Shipped, arrow_schema, filter_rows, fold, read, texts, to_batch

BUCKETS = 1 << 15
#: Bound of the training sample: expected documents per language.
PER_LANGUAGE = 800
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.05, 0.01

_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Per code point: whether it is a letter. Made once per worker."""
    if not _LETTER:
        table = np.zeros(0x110000, dtype=bool)
        for start in range(0, 0x110000, 0x1000):
            if start not in range(0xD000, 0xE000):
                table[start:start + 0x1000] = [chr(c).isalpha() for c in range(start, start + 0x1000)]
            else:
                table[start:start + 0x800] = [chr(c).isalpha() for c in range(start, start + 0x800)]
        _LETTER.append(table)
    return _LETTER[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, counts) of a text's n-grams; None if it has no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = letter_table()[codes]
    if not letters.any():
        return None
    codes = np.where(letters, codes, 32)
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # one blank after each word
    codes = np.concatenate([[32], codes[keep]]).astype(np.uint64)
    with np.errstate(over="ignore"):
        grams = [codes * np.uint64(0x9E3779B97F4A7C15)]
        for n in (2, 3):
            if len(codes) >= n:
                grams.append((grams[-1][:-1] ^ codes[n - 1:] << np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F))
    at = (np.concatenate(grams) >> np.uint64(64 - 15)).astype(np.int64)
    counts = np.bincount(at, minlength=BUCKETS)
    own = np.flatnonzero(counts)
    return own, counts[own]


def weights(own: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit-length TF-IDF values."""
    x = np.log1p(counts) * idf[own]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents with letters and, per bucket, how many of them have it; fixed-size parts from each task are added up."""
    chunk = 1024

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0):
                got = ngram_counts(t.as_py())
                if got is not None:
                    df[got[0]] += 1
                    df[BUCKETS] += 1
        starts = range(0, BUCKETS + 1, chunk)
        yield to_batch([[s // chunk for s in starts], [df[s:s + chunk].tobytes() for s in starts]], arrow_schema("part int, df binary"))

    def add(pdf):
        total = sum(np.frombuffer(b, dtype=np.int64) for b in pdf["df"])
        return pdf.head(1).assign(df=[total.tobytes()])

    parts = texts(docs, "text").mapInArrow(count, "part int, df binary").groupBy("part").applyInPandas(add, "part int, df binary").collect()
    df = np.concatenate([np.frombuffer(r["df"], dtype=np.int64) for r in sorted(parts)]) if parts else np.zeros(BUCKETS + 1, dtype=np.int64)
    return int(df[BUCKETS]), df[:BUCKETS]


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> np.ndarray:
    """FTRL-proximal over (class, buckets, values); the weights, buckets x classes."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def solve(own: np.ndarray) -> np.ndarray:
        zo = z[own]
        return np.where(np.abs(zo) <= L1, 0.0, -(zo - np.sign(zo) * L1) / ((BETA + np.sqrt(n[own])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for label, own, x in rows:
            w = solve(own)
            p = softmax(x @ w)
            p[label] -= 1.0
            g = np.outer(x, p)
            sigma = (np.sqrt(n[own] + g * g) - np.sqrt(n[own])) / ALPHA
            z[own] += g - sigma * w
            n[own] += g * g
    return solve(np.arange(BUCKETS))


def softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max())
    return e / e.sum()


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of logits with the least negative log-likelihood, on a geometric grid."""

    def loss(t: float) -> float:
        a = logits / t
        a = a - a.max(1, keepdims=True)
        return float((np.log(np.exp(a).sum(1)) - a[np.arange(len(a)), labels]).mean())

    return min((2.0 ** (k / 8) for k in range(-40, 25)), key=loss) if len(logits) else 1.0


class LanguageModel:
    def __init__(self, languages: list[str], idf: np.ndarray, matrix: np.ndarray, heat: float):
        self.languages, self.idf, self.matrix, self.heat = languages, idf, matrix, heat

    def predict(self, text: str | None) -> tuple[str, float]:
        got = ngram_counts(text)
        if got is None or not self.languages:
            return "und", 0.0
        p = softmax(weights(*got, self.idf) @ self.matrix[got[0]] / self.heat)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def fit(docs: DataFrame, keep: Column, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from text and lang of the rows that `keep` admits."""
    learn = docs.filter(keep & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    total, df = document_frequencies(learn)
    idf = np.log((1 + total) / (1 + df)) + 1.0
    if not languages:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), 1.0)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    rate = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))])
    sample = learn.filter(draw < rate[F.col("lang")]).select(F.array_position(F.lit(languages), F.col("lang")).cast("int").alias("label"), F.xxhash64("doc_id").alias("turn"), "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("label int, turn long, own binary, x binary")
        for batch in batches:
            rows = []
            for label, turn, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = ngram_counts(t)
                if got is not None:
                    rows.append((label - 1, turn, got[0].astype(np.int32).tobytes(), weights(*got, idf).astype(np.float32).tobytes()))
            yield to_batch(list(zip(*rows, strict=True)) if rows else [[]] * 4, schema)

    def learn_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((turn, label, own, x) for batch in batches for label, turn, own, x in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        rows = [(label, np.frombuffer(own, dtype=np.int32), np.frombuffer(x, dtype=np.float32).astype(float)) for _, label, own, x in rows]
        seen, unseen = [r for k, r in enumerate(rows) if k % 5], rows[::5]
        matrix = train(seen or rows, len(languages)).astype(np.float32)
        heat = temperature(np.array([x @ matrix[own] for _, own, x in unseen]), np.array([r[0] for r in unseen]))
        yield to_batch([[matrix.tobytes()], [heat]], arrow_schema("matrix binary, heat double"))

    # at most len(languages) * per_language rows: the documented bound of the sample
    got = sample.mapInArrow(vectors, "label int, turn long, own binary, x binary").repartition(1).mapInArrow(learn_all, "matrix binary, heat double").first()
    return LanguageModel(languages, idf, np.frombuffer(got["matrix"], dtype=np.float32).reshape(BUCKETS, -1).astype(float), got["heat"])


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every document."""
    shared = Shipped(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, own = arrow_schema("doc_id long, lang_pred string, score double"), shared.value
        for batch in batches:
            got = [own.predict(t.as_py()) for t in batch.column(1)]
            yield to_batch([batch.column(0), [g[0] for g in got], [g[1] for g in got]], schema)

    return texts(docs, "doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def kept(docs: DataFrame, model: LanguageModel, least: float = 0.3) -> DataFrame:
    """The rows of a known language, in one pass and with all their columns; short texts with numbers and addresses in them score low and stay."""
    shared = Shipped(docs.sparkSession, model)

    def keep(batch: pa.RecordBatch) -> list[bool]:
        got = [shared.value.predict(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
        return [lang != "und" and score >= least for lang, score in got]

    return filter_rows(docs, keep)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    return predict(docs, fit(docs, ~held_out)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
