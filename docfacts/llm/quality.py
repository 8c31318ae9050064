"""Regularised quadratic discriminant over document statistics (operator 2).

Every text becomes one vector of transformed statistics. Class counts, sums and
products of all labelled training rows are added up by Spark (fixed size, no
sample); the driver makes class means and covariances of them, shrinks each
covariance towards the pooled one and towards its diagonal, and factorises it
once. Scores are logistic functions of the difference of Mahalanobis
log-densities plus log priors, solved with the cached Cholesky factors.

Edge cases: null and empty texts have the statistics of the empty text and get
a score like any other; texts of any length are read whole. Labels without a
document, documents without a label and null labels teach nothing; a label that
is repeated counts once, and a doc_id with contradicting labels teaches
nothing. Repeated rows are scored, and taught, one by one. A class with fewer
than two training rows, an empty table among them, gives score 0.5 to every
row. Columns other than doc_id and text are not looked at; `kept` returns them
as they are. Labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import arrow_schema, filter_rows, fold, materialize, read, texts, to_batch

THRESHOLD = 0.3
#: Shares of the class's own covariance, of the pooled one and of the pooled diagonal.
SHRINKAGE = (0.75, 0.15, 0.10)

STATISTICS = [
    "log_bytes", "log_words", "word_length", "distinct_words", "adjacent_repeats", "distinct_lines", "upper", "digits",
    "symbols", "bars", "exclamation", "full_stops", "other_marks", "white_space", "short_words", "capital_words", "distinct_pairs",
]


def _classes() -> np.ndarray:
    """256 x 7: which bytes are upper case, digits, symbols, bars, exclamation marks, full stops and commas, other marks."""
    out = np.zeros((256, 8))
    for k, chars in enumerate(["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#$%&*@^~+=<>\\_`{}", "|", "!", ".,", "-:;?'\"()[]/", " \t\n\r\x0b\x0c"]):
        out[list(chars.encode()), k] = 1
    return out


CLASSES = _classes()


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of STATISTICS."""
    n = len(text)
    upper, digits, symbols, bars, marks, stops, other, white = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ CLASSES / max(n, 1)
    words = text.split()
    k = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = lambda part, whole: part / whole if whole else 0.0
    ratios = [
        share(len(set(words)), k) ** 0.5, share(sum(map(eq, words, words[1:])), k - 1), share(len(set(lines)), len(lines)),
        upper, digits, symbols, bars, marks, stops, other, white,
        share(sum(map(3 .__gt__, map(len, words))), k), share(sum(map(bytes.isupper, words)), k),
        share(len(set(zip(words, words[1:], strict=False))), k - 1) if k > 1 else 1.0,
    ]
    ratios = np.arcsin(np.sqrt(np.clip(ratios, 0.0, 1.0))).tolist()
    return [float(np.log1p(n)), float(np.log1p(k)), float(np.log1p(share(n, k))), *ratios]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every document, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, x array<double>")
        for batch in batches:
            yield to_batch([batch.column(0), [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)]], schema)

    return texts(docs, "doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


def moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products per class of (label, x), added up by Spark."""
    d = len(STATISTICS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, total = arrow_schema("label int, cell int, v double"), {0: np.zeros((d, d)), 1: np.zeros((d, d))}
        for batch in batches:
            labels = batch.column(0).to_numpy()
            x = np.ones((len(labels), d))
            x[:, 1:] = batch.column(1).flatten().to_numpy().reshape(len(labels), d - 1)
            for c in total:
                own = x[labels == c]
                total[c] += own.T @ own
        cells = np.arange(d * d)
        for c, m in total.items():
            yield to_batch([np.full(d * d, c), cells, m.ravel()], schema)

    rows = labelled.select(F.col("label").cast("int"), "x").mapInArrow(run, "label int, cell int, v double").groupBy("label", "cell").agg(F.sum("v").alias("v")).collect()
    out = {c: np.zeros((d, d)) for c in (0, 1)}
    for r in rows:  # 2 d^2 rows
        out[r["label"]].flat[r["cell"]] = r["v"]
    return {c: (m[0, 0], m[0, 1:], m[1:, 1:]) for c, m in out.items()}


def solved(factor: np.ndarray, right: np.ndarray) -> np.ndarray:
    """z with factor @ z = right for a lower triangular factor, by forward substitution over all columns at a time."""
    z = np.empty_like(right)
    for i in range(len(factor)):
        z[i] = (right[i] - factor[i, :i] @ z[:i]) / factor[i, i]
    return z


class Discriminant:
    """Means, Cholesky factors and constants of both classes."""

    def __init__(self, found: dict, shrinkage=SHRINKAGE):
        own, pooled, diagonal = shrinkage
        n = {c: found[c][0] for c in found}
        self.ready = min(n.values()) >= 2
        if not self.ready:
            return
        mean = {c: found[c][1] / n[c] for c in n}
        cov = {c: found[c][2] / n[c] - np.outer(mean[c], mean[c]) for c in n}
        both = sum(cov[c] * n[c] for c in n) / sum(n.values())
        spread = np.diag(np.diag(both) + 1e-4)
        self.parts = []
        for c in (0, 1):
            factor = np.linalg.cholesky(own * cov[c] + pooled * both + diagonal * spread)
            constant = -np.log(np.diag(factor)).sum() + np.log(n[c] / sum(n.values()))
            self.parts.append((mean[c], factor, constant))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(x), 0.5)
        density = [constant - 0.5 * (solved(factor, (x - mean).T) ** 2).sum(0) for mean, factor, constant in self.parts]
        return 1.0 / (1.0 + np.exp(-np.clip(density[1] - density[0], -700, 700)))


def fit(vectors: DataFrame, labels: DataFrame, train: Column) -> Discriminant:
    marked = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
    marked = marked.filter("label = other").select("doc_id", "label")
    return Discriminant(moments(vectors.filter(train).join(marked, "doc_id")))


def score(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) for (doc_id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, score double")
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], schema=schema)

    return vectors.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def kept(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores at least the threshold, in one pass and with all their columns."""

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        texts = batch.column(batch.schema.get_field_index("text"))
        return model.score(np.array([statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts])) >= threshold

    return filter_rows(docs, keep)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(features(read(spark, sf_dir, "documents")), "statistics")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = fit(vectors, read(spark, sf_dir, "labels"), ~held_out)
    return score(vectors, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
