"""The manifest against a plain tree, with runs so short that the exchange takes several rounds, and against its SQL."""

import zlib
from hashlib import sha256

import duckdb
import pytest

from docfacts.llm import merkle


def digest(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def plain_leaf(*values) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves: list[str]):
    """(root, siblings left and right of each leaf by level)."""
    level, at, steps = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, a in enumerate(at):
            first = a - a % 3
            steps[i].append((level[first:a], level[a + 1:first + 3]))
        level, at = [digest("".join(level[i:i + 3])) for i in range(0, len(level), 3)], [a // 3 for a in at]
    return level[0], steps


def plain_manifest(rows):
    """Sorted results of (doc_id, source, lang, n_chars, text) rows."""
    key = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (key(r[0]), plain_leaf(*r)))
        trees.append((own, *plain_tree([plain_leaf(*r) for r in own])))
    root, above = plain_tree([t[1] for t in trees])
    out = []
    for (own, subroot, steps), high in zip(trees, above, strict=True):
        for r, low in zip(own, steps, strict=True):
            path = low + high
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            end = plain_leaf(*r[:4], text)
            for left, right in path:
                end = digest("".join([*left, end, *right]))
            proof = digest("".join(x for left, right in path for x in [*left, *right]))
            out.append((r[0], plain_leaf(*r), subroot, root, proof, end, end == root, len(path)))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, node string, rank int, run int, leaf string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("height", [0, 1, 2, 7])
def test_against_a_plain_tree(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "RUN", 3**height)
    rows = [(i, f"s{min(i % 40, 9)}" if i % 40 else None, "en" if i % 3 else None, i % 7, f"text {i}\nline\n" if i % 5 else None) for i in range(130)]
    rows += [(7, "é", None, None, "x\n"), (7, "é", None, None, "y"), (7, "é", None, None, "y"), (None, "é", "en", 1, "a\nb"), (1, "z", "", 0, ""), (2, "Z", "en", 5, "long " * 30_000 + "\n")]
    got = sorted(map(tuple, merkle.manifest(frame(spark, rows)).collect()), key=repr)
    assert got == plain_manifest(rows)
    assert any(not r[6] for r in got) and any(r[6] for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 27, 28, 82])
def test_sizes(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "RUN", 3)
    rows = [(i, "a", None, i, f"{i}\n") for i in range(n)]
    assert sorted(map(tuple, merkle.manifest(frame(spark, rows)).collect()), key=repr) == plain_manifest(rows)


def test_empty(spark):
    assert merkle.manifest(frame(spark, []).limit(0)).count() == 0


def test_sql(spark, sf):
    want = duckdb.sql(merkle.ORACLE.replace("FROM documents)", f"FROM '{sf}/documents.parquet')"))
    got = merkle.op12_merkle_manifest(spark, sf).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
