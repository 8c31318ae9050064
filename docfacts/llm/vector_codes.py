"""Compression of vectors to codes of product codebooks by exact integer arithmetic (operator 11).

A vector's components become integers, floor(4096 * x), and the vector is cut
into equal parts, each with a codebook of its own. An assignment is a matrix
product: the nearest entry is the one with the least |c|**2 - 2 x.c. Integers
are broken into limbs, so that every product of two limb matrices is a float64
BLAS call whose sums stay below 2**53 and so are exact; the products are
shifted and added in int64, where the whole distance fits, and the first least
entry wins. Where a batch holds components too large for int64 distances, the
limbs are added as Python integers instead: the same limbs, the same result.

A round is one pass over the vectors: tasks assign their batches and emit one
row of sums an entry; sums travel in limbs too, so they never overflow. Only
codebooks (parts x entries) reach the driver and go out with the next round's
tasks. Nothing depends on the order of rows, a lost task is simply run again.

Edge cases: vectors that are null, empty or hold null or non-finite components
are dropped, as are those whose length differs from that of the kept vector with
the least vec_id (rows without one come last) or is no multiple of the number
of parts. Rows that repeat a vec_id each count and each get their row; of equal
vec_ids the least vector comes first among the initial entries. With fewer
vectors than entries the codebooks have fewer, and an empty table gives no row.
Ties go to the lower entry. Errors beyond a long are given as the greatest
long. Columns other than vec_id, embedding and label are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import arrow_schema, batch_rows, materialize, read, to_batch

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Limbs of 2**LIMB carry sums from tasks to the driver.
LIMB = 30
#: Labels up to this number are broadcast with their sums; more are joined.
MOST = 500_000
GREATEST = (1 << 63) - 1


def limbs(x: np.ndarray, width: int, count: int) -> list[np.ndarray]:
    """x as float64 arrays l[0] + l[1] * 2**width + ...: all but the last lie in 0 .. 2**width - 1, the last has the sign."""
    out = []
    for _ in range(count - 1):
        out.append((x & ((1 << width) - 1)).astype(np.float64))
        x = x >> width
    return [*out, x.astype(np.float64)]


def limb_plan(largest: int, terms: int) -> tuple[int, int]:
    """(width, count) of limbs, two at least, for integers up to `largest` so that sums of `terms` products stay below 2**53."""
    bits = max(int(largest).bit_length(), 1)
    most = (53 - max(terms, 1).bit_length()) // 2
    count = max(2, -(-bits // most))
    return -(-bits // count), count


def exact_dot(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of integer matrices, exact: int64 where that holds every sum, Python integers where it does not."""
    largest = max((int(abs(v).max()) for v in (x, c) if v.size), default=0)
    width, count = limb_plan(largest, x.shape[1])
    kind = np.int64 if 2 * x.shape[1] * (largest + 1) ** 2 < 1 << 62 else object
    out = np.zeros((len(x), len(c)), dtype=kind)
    right = limbs(c, width, count)
    for i, a in enumerate(limbs(x, width, count)):
        for j, b in enumerate(right):
            product = (a @ b.T).astype(np.int64)  # below 2**53
            out += product.astype(kind) << (width * (i + j))
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first nearest entry, its squared distance) of every row of x among the rows of c."""
    dot = exact_dot(x, c)
    squares = lambda v: (v.astype(dot.dtype) ** 2).sum(1)
    rest = squares(c) - 2 * dot
    at = rest.argmin(1)
    return at, rest[np.arange(len(x)), at] + squares(x)


def integers(embedding: pa.Array, dims: int | None, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, matrix of floor(SCALE * x)): rows of finite vectors of `dims` components (None: of the first such row's)."""
    sizes = embedding.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = embedding.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    bad = np.r_[0, np.cumsum(~np.isfinite(values))]
    kept = (sizes > 0) & (sizes % parts == 0) & (bad[ends] == bad[ends - sizes])
    if dims is None:
        dims = int(sizes[kept][0]) if kept.any() else 0
    kept &= sizes == dims
    scaled = np.floor(values[np.repeat(kept, sizes)] * SCALE)
    if scaled.size and np.abs(scaled).max() >= 1 << 62:
        scaled = np.array([int(v) for v in scaled], dtype=object)
    else:
        scaled = scaled.astype(np.int64)
    return kept, scaled.reshape(-1, max(dims, 1))


def least_vectors(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The integer vectors with the least vec_ids, one a row; the first one sets the number of components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = F.size("embedding")
    good = vectors.filter((size > 0) & (size % parts == 0) & F.coalesce(finite, F.lit(False))).select("vec_id", "embedding")
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    first = good.orderBy(*order).limit(1).select(F.size("embedding").alias("n")).collect()
    if not first:
        return np.zeros((0, parts), dtype=np.int64)
    some = good.filter(F.size("embedding") == first[0]["n"]).orderBy(*order).limit(entries).toArrow()
    return integers(some.column("embedding").combine_chunks(), first[0]["n"], parts)[1]


def assigned(x: np.ndarray, codebooks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(entries, distances) of the rows of x, part by part."""
    width = x.shape[1] // len(codebooks)
    return [nearest(x[:, p * width:(p + 1) * width], c) for p, c in enumerate(codebooks)]


SUMS = "part int, entry int, n long, sums array<long>"


def to_limbs(value: int) -> list[int]:
    """Five limbs hold any sum of float32 components; the last has the sign."""
    value = int(value)
    return [value >> LIMB * k & ((1 << LIMB) - 1) for k in range(4)] + [value >> LIMB * 4]


def improved(vectors: DataFrame, codebooks: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """One round: every entry becomes the floored mean of its parts; unused ones stay."""
    parts, width = len(codebooks), dims // len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            _, x = integers(batch.column(0), dims, parts)
            for p, (at, _) in enumerate(assigned(x, codebooks)):
                own = x[:, p * width:(p + 1) * width]
                for e in np.unique(at):
                    some = own[at == e]
                    wide = some if some.dtype == object or int(abs(some).max()) < 1 << 31 else some.astype(object)  # else sums of a batch fit int64
                    have = totals.setdefault((p, int(e)), [0, [0] * width])
                    have[0] += len(some)
                    have[1] = [a + int(b) for a, b in zip(have[1], wide.sum(0), strict=True)]
        rows = [(p, e, n, [v for s in sums for v in to_limbs(s)]) for (p, e), (n, sums) in totals.items()]
        if rows:
            yield to_batch(list(zip(*rows, strict=True)), arrow_schema(SUMS))

    each = [F.sum(F.element_at("sums", k + 1)).alias(f"s{k}") for k in range(5 * width)]
    found = vectors.select("embedding").mapInArrow(run, SUMS).groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect()
    out = [c.astype(object) for c in codebooks]
    for r in found:
        sums = [sum(r[f"s{5 * d + k}"] << LIMB * k for k in range(5)) for d in range(width)]
        out[r["part"]][r["entry"]] = [s // r["n"] for s in sums]
    return [_narrow(c) for c in out]


def _narrow(c: np.ndarray) -> np.ndarray:
    return c.astype(np.int64) if all(abs(v) < 1 << 62 for v in c.ravel()) else c


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[np.ndarray], int]:
    """(codebooks by part, number of components)."""
    first = least_vectors(vectors, parts, entries)
    dims = first.shape[1] if len(first) else 0
    codebooks = [_narrow(c) for c in np.split(first, parts, axis=1)] if dims else []
    for _ in range(rounds if dims else 0):
        codebooks = improved(vectors, codebooks, dims)
    return codebooks, dims


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    return sha256(",".join(str(int(v)) for c in codebooks for v in c.ravel()).encode()).hexdigest()


CODES = "vec_id long, label int, code string, error long"


def encode(vectors: DataFrame, codebooks: list[np.ndarray], dims: int) -> DataFrame:
    """(vec_id, label, code, error) of every kept vector."""
    if not dims:
        return vectors.sparkSession.createDataFrame([], CODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = integers(batch.column("embedding"), dims, len(codebooks))
            found = assigned(x, codebooks)
            codes = np.stack([at for at, _ in found], 1).astype(np.uint8) if len(x) else np.zeros((0, 1), np.uint8)
            errors = np.sum([d.astype(object) for _, d in found], axis=0)
            chosen = batch.select(["vec_id", "label"]).filter(pa.array(kept))
            yield to_batch([*chosen.columns, [c.tobytes().hex() for c in codes], [min(int(e), GREATEST) for e in errors]], arrow_schema(CODES))

    return vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "embedding").mapInArrow(run, CODES)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector."""
    batch_rows(vectors.sparkSession, 10_000)
    codebooks, dims = fit(vectors, parts, entries, rounds)
    coded = materialize(encode(vectors, codebooks, dims), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(GREATEST).cast("decimal(38,0)")).cast("long")
    sums = materialize(coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error")), "labels")
    sums = F.broadcast(sums) if sums.count() <= MOST else sums
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The six rounds written out: a table of part vectors, and codebooks and assignments in turn."""
    dot = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, label, p.part, v[p.part * len(v) // {PARTS} + 1:(p.part + 1) * len(v) // {PARTS}] AS v FROM kept, (SELECT unnest(range({PARTS})) AS part) p)",
        f"b0 AS MATERIALIZED (SELECT part, entry, v AS c FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM parts) WHERE entry < {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"a{k} AS MATERIALIZED (SELECT vec_id, label, part, entry, v, d FROM (SELECT vec_id, label, part, entry, v, {dot} AS d FROM parts JOIN b{k} USING (part))"
            " QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"
        )
        if k < ROUNDS:
            steps.append(
                f"b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (SELECT part, entry, list(s ORDER BY i) AS c FROM ("
                f"SELECT part, entry, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS s FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}) GROUP BY part, entry, i"
                ") GROUP BY part, entry) m USING (part, entry))"
            )
    last = f"a{ROUNDS}"
    return f"""WITH {", ".join(steps)},
coded AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM {last} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded"""


ORACLE = _oracle()
