"""The join against all pairs, its filters against what they may never refuse, and odd rows."""

import numpy as np
import pytest

from docfacts.llm import jaccard
from docfacts.llm.jaccard import Threshold


def plain_sets(text, words):
    own = (text or "").encode()
    own = bytes(b + 32 if 65 <= b <= 90 else b for b in own).split()
    return {tuple(own[i:i + words]) for i in range(max(len(own) - words + 1, 1))} if own else set()


def plain_join(rows, words=4, num=85, den=100):
    """Sorted (doc_id, size, component) of (doc_id, text) rows: all pairs."""
    sets = [plain_sets(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * shared >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = lambda d: (d is not None, d or 0)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d, key=low)
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def corpus(seed=5, groups=25):
    """Groups of near copies around the threshold, a passage in many texts, and a group that shares nearly all tokens."""
    rng = np.random.default_rng(seed)
    word = lambda n: [f"W{x}" for x in rng.integers(0, 400, n)]
    passage, rows = word(40), []
    for _ in range(groups):
        base = word(int(rng.integers(8, 160))) + (passage if rng.random() < 0.6 else [])
        for _ in range(int(rng.integers(1, 7))):
            text = list(base)
            for at in rng.integers(0, len(text), int(rng.integers(0, 2 + len(text) // 35))):
                text[at] = f"x{rng.integers(0, 10**6)}"
            rows.append(" ".join(text))
    rows += [" ".join([*passage, *word(int(k))]) for k in rng.integers(0, 9, 60)]
    rng.shuffle(rows)
    return [(int(i), t) for i, t in zip(rng.permutation(len(rows)) * 3, rows, strict=True)]


def joined(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "k", 1, "s", 2) for r in rows], "doc_id long, text string, key string, node long, sign string, size int")
    return sorted(map(tuple, jaccard.ngram_join(docs.repartition(5), **kw).collect()), key=repr)


@pytest.mark.parametrize("settings", [{}, {"BLOCK": 7, "SHORT": 5}, {"GATHERED": 4, "SHARE": 0.0, "BLOCK": 9}, {"COUNTED": 300}])
def test_against_all_pairs(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus()
    got = joined(spark, rows)
    assert got == plain_join(rows)
    assert len({r[2] for r in got}) < len(rows) * 0.8


def test_five_words_at_four_fifths(spark):
    rows = corpus(9)
    assert joined(spark, rows, words=5, least=(4, 5)) == plain_join(rows, 5, 4, 5)


def test_given_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, jaccard.op13_ngram_jaccard(spark, sf).collect()), key=repr) == plain_join(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977} v{i % 31}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one\x0btwo"), (6, "two one"), (7, long), (8, long + " more"), (7, long), (9, "a b c d e"), (9, "p q r s t"), (None, "p q r s t"), (10, "é É")]
    got = joined(spark, rows)
    assert got == plain_join(rows)
    assert (1, 0, 1) in got and (5, 1, 4) in got and (6, 1, 6) in got
    assert jaccard.ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_filter_refuses_a_similar_pair():
    rng = np.random.default_rng(3)
    for at_least in (Threshold(85, 100), Threshold(4, 5)):
        similar = 0
        for n in (1, 2, 7, 40, 700, 5000):
            for _ in range(60):
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                b = a.copy()
                change = rng.choice(len(b), int(rng.integers(0, n // 5 + 1)), replace=False)
                b[change] = rng.integers(0, 1 << 63, len(change)).astype(np.uint64)
                b = np.unique(b)
                if at_least.reached(len(np.intersect1d(a, b)), len(a), len(b)):
                    similar += 1
                    x, y = (jaccard.signature(s, at_least, 3) for s in (a, b))
                    assert jaccard.may_link(x, y, len(a), len(b), at_least, 3)
                    common = jaccard.CommonTokens(a[::3], rng.integers(3, 99, len(a[::3])))
                    assert set(common.prefix(a, at_least.prefix(len(a)))) & set(common.prefix(b, at_least.prefix(len(b))))
        assert similar > 200


def test_filters_refuse_unlike_sets():
    rng = np.random.default_rng(4)
    pool, t = rng.integers(0, 1 << 63, 200).astype(np.uint64), Threshold(85, 100)
    sets = [np.unique(np.concatenate([rng.choice(pool, 30, replace=False), rng.integers(0, 1 << 63, 270).astype(np.uint64)])) for _ in range(30)]  # about five in common
    signs = [jaccard.signature(s, t, 3) for s in sets]
    blind = [bytes(64) + s[64:] for s in signs]  # without parity bits
    assert not any(jaccard.may_link(signs[i], signs[j], 300, 300, t, 3) for i in range(30) for j in range(i))
    one, two, three = (sum(jaccard.may_link(blind[i], blind[j], len(sets[i]), len(sets[j]), t, k) for i in range(30) for j in range(i)) for k in (1, 2, 3))
    assert one == 435 and three < two < one


def test_counts_of_common_tokens(monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTED", 50)
    rng, tally, true = np.random.default_rng(2), jaccard.Tally(), {}
    for _ in range(200):
        own = np.unique(np.r_[rng.integers(0, 5, 3), rng.integers(100, 10**6, 7)]).astype(np.uint64)
        for t in own.tolist():
            true[t] = true.get(t, 0) + 1
        tally.add(own)
    tally.merge(2)
    got = dict(zip(tally.tokens.tolist(), tally.counts.tolist(), strict=True))
    assert set(range(5)) <= set(got) and len(got) < 50
    assert all(true[t] - tally.rounds <= n <= true[t] for t, n in got.items())
