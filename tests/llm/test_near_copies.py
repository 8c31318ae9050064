"""Near copies of whole rows: repeats, shared doc_ids, nulls, and the filters of the candidate search."""

import numpy as np

from docfacts.llm import jaccard, simhash


def test_repeated_rows_and_shared_ids(spark):
    a, b, c = ("the first text of some length here", "another text about other things", "a third one that stands alone")
    rows = [(5, a, "r1"), (5, a, "r1"), (6, a, "r3"), (6, b, "r4"), (7, c, "r5"), (7, c, "r0")]
    got = simhash.kept(spark.createDataFrame(rows, "doc_id long, text string, key string")).collect()
    assert sorted(map(tuple, got)) == [(5, a, "r1"), (6, b, "r4"), (7, c, "r0")]


def test_nulls_and_empty_tables(spark):
    rows = [(None, "a b c"), (None, "A B c"), (3, None), (4, ""), (4, None), (2, " \n"), (None, "x"), (9, "x"), (1, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, simhash.kept(docs).collect()), key=repr)
    assert [r for r in got if r[0] is not None] == [(2, " \n")]  # texts without words are one group, and a null doc_id comes first
    assert len(got) == 3 and {(r[1] or "").lower() for r in got} == {"a b c", "x", " \n"}
    assert simhash.kept(docs.limit(0)).count() == 0


def test_fingerprints_propose_the_first_links(spark, monkeypatch):
    """Without the search over prefixes the copies that operator 6 links still go, and texts of one fingerprint and different sets stay."""
    words = [f"w{k}" for k in range(2000)]
    near = [*words[:1000], "changed", *words[1001:]]
    spam = ["spam " * 400 + " ".join(f"{name}{k}" for k in range(60)) for name in "ab"]
    docs = spark.createDataFrame(list(enumerate([" ".join(words), " ".join(near), " ".join(words).upper() + "\n", *spam])), "doc_id long, text string")
    fps = {r["doc_id"]: bytes(r["fp"]) for r in simhash.fingerprints(docs).collect()}
    assert fps[3] == fps[4] and fps[0] == fps[2]
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3}
    assert {r["doc_id"] for r in simhash.kept(docs).collect()} == {0, 3, 4}
    prefix_lists = jaccard.prefix_lists
    monkeypatch.setattr(jaccard, "prefix_lists", lambda *args: prefix_lists(*args).limit(0))
    assert {r["doc_id"] for r in simhash.kept(docs).collect()} == {0, 3, 4}


def test_parity_never_refuses_a_pair():
    rng = np.random.default_rng(3)
    for n in (4, 40, 700, 5000):
        for _ in range(40):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = a.copy()
            change = rng.choice(n, int(rng.integers(0, n // 5 + 1)), replace=False)
            b[change] = rng.integers(0, 1 << 63, len(change)).astype(np.uint64)
            x, y = (np.frombuffer(jaccard.parity(np.unique(s)), np.uint64) for s in (a, b))
            assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_stars_and_open_pairs():
    """Stars join what may match in each list; open pairs are all pairs of different roots that may match."""
    rng = np.random.default_rng(8)
    n = 300
    k = np.sort(rng.integers(0, 40, n))
    node = rng.integers(0, 60, n)
    size, at = 20 + node % 5, rng.integers(0, 3, n)
    bits = np.zeros((n, 8), dtype=np.uint64)
    whole = jaccard.Lists(k, node, size, at, k, jaccard.Threshold(4, 5), node % 7, bits)
    got = set(map(tuple, whole.between_roots().T.tolist()))
    want = set()
    for i in range(n):
        for j in range(n):
            if k[i] == k[j] and node[i] < node[j] and node[i] % 7 != node[j] % 7:
                need = np.ceil(0.8 / 1.8 * (size[i] + size[j]) - 1e-9)
                if min(size[i], size[j]) >= 0.8 * max(size[i], size[j]) - 1e-9 and min(size[i] - at[i], size[j] - at[j]) >= need:
                    want.add((int(node[i]), int(node[j])))
    assert got == want
    stars = jaccard.Lists(k, node, size, at, k, jaccard.Threshold(4, 5)).stars()
    assert 0 < stars.shape[1] < n and (stars[0] < stars[1]).all()
