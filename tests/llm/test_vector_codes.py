"""Codes against plain Python integers, exactness of the limb products, and odd vectors."""

import math
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from docfacts.llm import vector_codes as V


@pytest.mark.parametrize("largest", [0, 1, 5000, 2**20, 2**28 - 1, 2**40, 2**61])
def test_dot_is_exact(largest):
    rng = np.random.default_rng(largest % 97)
    x, c = (rng.integers(-largest, largest + 1, (n, 8)) for n in (50, 16))
    got = V.exact_dot(x, c)
    assert got.tolist() == (x.astype(object) @ c.astype(object).T).tolist()
    assert (got.dtype == object) == (largest >= 2**28)
    width, count = V.limb_plan(largest, 8)
    assert count >= 2 and 8 * (2**width) ** 2 <= 2**53
    assert (sum(part.astype(object).astype(int) * 2 ** (width * k) for k, part in enumerate(V.limbs(x, width, count))) == x).all()


def test_first_of_equal_entries():
    c = np.array([[3, 0], [1, 0], [-1, 0], [1, 0]])
    assert V.nearest(np.array([[0, 0], [2, 0], [1, 0]]), c)[0].tolist() == [1, 0, 1]


def plain(rows, parts, entries, rounds):
    kept = [(v, [math.floor(4096 * x) for x in e], label) for v, e, label in rows if e and all(x is not None and math.isfinite(x) for x in e) and len(e) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // parts
    cut = lambda e, p: e[p * w:(p + 1) * w]
    books = [[cut(e, p) for _, e, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min((far(x, c), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            at = [near(cut(e, p), book)[1] for _, e, _ in kept]
            for k in set(at):
                own = [cut(e, p) for (_, e, _), a in zip(kept, at, strict=True) if a == k]
                book[k] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    out = []
    for v, e, label in kept:
        found = [near(cut(e, p), books[p]) for p in range(parts)]
        out.append((v, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    sums = {}
    for *_, d, label in out:
        sums[label] = sums.get(label, 0) + d
    name = sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    big = lambda d: min(d, 2**63 - 1)
    return sorted(((v, code, big(d), big(sum(big(x[2]) for x in out if x[3] == label)), name) for v, code, d, label in out), key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, entry int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2) for r in rows], SCHEMA)


def sample(scale, n=60, dims=16, seed=1):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dims)) * scale).astype(np.float32)
    x[10:20] = x[10]
    return [(int(i * 7 % n), [float(v) for v in row], int(i % 4) if i % 5 else None) for i, row in enumerate(x)]


@pytest.mark.parametrize("scale", [0.2, 3e4, 1e7, 1e30])
def test_against_plain_integers(spark, scale):
    rows = sample(scale)
    odd = [(100, None, 1), (101, [], 1), (102, [1.0] * 15 + [None], 1), (103, [1.0] * 15 + [float("nan")], None), (104, [float("inf")] * 16, 2),
           (105, [1.0] * 8, 2), (106, [0.5] * 13, 2), rows[3], rows[3], (rows[5][0], [0.0] * 16, 3), (None, [0.25] * 16, 9)]
    want = plain(rows + odd, 4, 5, 3)
    got = V.compress(frame(spark, rows + odd).repartition(3), 4, 5, 3).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_few_and_no_rows(spark):
    rows = sample(0.3)[:3]
    assert sorted(map(tuple, V.compress(frame(spark, rows)).collect()), key=repr) == plain(rows, 8, 16, 6)
    assert V.compress(frame(spark, rows).limit(0)).count() == 0
    assert V.compress(frame(spark, [(1, None, 1)])).count() == 0


def test_sql(spark, sf):
    want = duckdb.sql(V.ORACLE.replace("FROM embeddings", f"FROM '{sf}/embeddings.parquet'"))
    got = V.op11_vector_codes(spark, sf).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
