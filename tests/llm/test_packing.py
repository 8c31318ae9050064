"""Patterns fill sequences exactly, least squares places most pieces, rounding keeps sums."""

import numpy as np
import pytest

from docfacts.llm import packing


def histogram(n, seed=7):
    rng = np.random.default_rng(seed)
    return np.bincount(np.minimum(4096, rng.gamma(1.2, 700, n).astype(int) + 1), minlength=4097)


def test_patterns_fill_sequences():
    counts = histogram(400)
    found = packing.patterns(counts, 4096)
    assert len(found) == len(set(found)) > 400
    assert all(sum(p) == 4096 and len(p) <= packing.MOST and all(p.count(x) <= counts[x] for x in p) for p in found)
    assert {len(p) for p in found} >= {2, 3, 4, 5, 6}
    assert packing.patterns(np.zeros(4097, dtype=np.int64), 4096) == []


def test_least_squares_has_no_better_neighbour():
    """At the fit, no pattern's count can be changed for a smaller error (small instance, many rounds)."""
    rng = np.random.default_rng(1)
    found = [tuple(sorted(rng.integers(1, 12, int(rng.integers(1, 5))).tolist(), reverse=True)) for _ in range(40)]
    counts = rng.integers(0, 30, 13).astype(np.int64)
    counts[0] = 0
    x = packing.nnls(found, counts, rounds=20_000)
    matrix = np.array([[p.count(row) for p in found] for row in range(13)], dtype=float)
    scale = np.maximum(matrix.sum(1), 1)
    gradient = matrix.T @ ((matrix @ x - counts) / scale)
    assert (x >= 0).all() and np.abs(gradient[x > 1e-6]).max() < 1e-3 and gradient.min() > -1e-3


def test_rounding_keeps_running_sums():
    x = np.random.default_rng(2).random(1000) * 0.4
    n = packing.rounded(x)
    assert (n >= 0).all() and np.abs(np.cumsum(n) - np.cumsum(x)).max() <= 0.5 + 1e-9


@pytest.mark.parametrize("n, share", [(150, 0.5), (1000, 0.7), (20_000, 0.85)])
def test_fit_places_most_pieces(n, share):
    counts = histogram(n)
    left = counts.copy()
    out = packing.fitted(left, 4096)
    placed = sum(len(p) * times for p, times in out)
    assert placed == (counts - left).sum() >= share * n and (left >= 0).all()
    sequences = sum(times for _, times in packing.plan(counts))
    assert sequences <= -(-int((counts * np.arange(4097)).sum()) // 4096) + 1


def test_ids_are_those_of_the_tokeniser():
    """Random strings of letters whose case, marks or width are odd, punctuation and white space, against the whole tokeniser."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, words = Tokenizer.from_file(path), packing.WordTokens(path)
    rng = np.random.default_rng(11)
    letters = list("abzAZéÉßſİıÏöŸΣςﬁ한글中ñŽđĲ̇́") + list("09٣½²") + list(",.;:!?$#%&*|'\"-_()/\\@") + list(" \t\n  　\x1c\x0b") + ["😀", "‍", "İ;", "İ%."]
    for text in ["İ;", "한&İ%.", "İ", "İstanbul, İzmir; DİYARBAKIR!", "", *("".join(rng.choice(letters, int(rng.integers(1, 14)))) for _ in range(20_000))]:
        ids = np.frombuffer(words.ids(text), "<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_very_long_texts(spark):
    text = "İki satır, bir söz. " * 400_000  # 10 MB in one row
    got = packing.pack_documents(spark.createDataFrame([(1, text), (2, "a b"), (3, None)], "doc_id long, text string")).orderBy("doc_id", "piece").collect()
    own = [r for r in got if r["doc_id"] == 1]
    assert [r["start"] for r in own] == [k * 4096 for k in range(len(own))] and {r["length"] for r in own[:-1]} == {4096} and len(own) > 500
