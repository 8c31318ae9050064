"""Grouping of items, block-max bounds against cursors, and recall by brute force."""

import numpy as np

from docfacts.llm import decontaminate as D


def by_cursors(index, terms, threshold):
    """Block-max WAND for one passage: cursors in item order, a pivot by the terms' largest scores, a jump where the blocks' largest scores rule it out."""
    lists = []
    for t in terms:
        own = slice(index.ptr[t], index.ptr[t + 1])
        if index.ptr[t + 1] > index.ptr[t]:
            block = slice(index.block_ptr[t], index.block_ptr[t + 1])
            blocks = dict(zip(index.block[block].tolist(), index.block_max[block].tolist(), strict=True))
            lists.append([0, index.item[own].tolist(), index.score[own].tolist(), float(index.term_max[t]), blocks])
    found = {}
    while lists:
        lists.sort(key=lambda c: c[1][c[0]])
        total, pivot = 0.0, None
        for k, c in enumerate(lists):
            total += c[3]
            if total >= threshold - 1e-9:
                pivot = k
                break
        if pivot is None:
            break
        item = lists[pivot][1][lists[pivot][0]]
        while pivot + 1 < len(lists) and lists[pivot + 1][1][lists[pivot + 1][0]] == item:
            pivot += 1
        block = item // D.BLOCK
        if sum(c[4].get(block, 0.0) for c in lists[:pivot + 1]) >= threshold - 1e-9:
            if lists[0][1][lists[0][0]] == item:
                score = sum(c[2][c[0]] for c in lists[:pivot + 1])
                if score >= threshold - 1e-9:
                    found[item] = score
                goal = item + 1
            else:
                goal = item
        else:  # nothing in this block up to the next cursor can reach the threshold
            goal = (block + 1) * D.BLOCK
            if pivot + 1 < len(lists):
                goal = min(goal, lists[pivot + 1][1][lists[pivot + 1][0]])
            goal = max(goal, item + 1) if lists[0][1][lists[0][0]] == item else max(goal, item)
        moved = False
        for c in lists[:pivot + 1]:
            while c[0] < len(c[1]) and c[1][c[0]] < goal:
                c[0] += 1
                moved = True
        assert moved
        lists = [c for c in lists if c[0] < len(c[1])]
    return found


def test_bounds_by_block_find_what_cursors_find():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(90)]
    index = D.Index([(i, " ".join(rng.choice(words, int(rng.integers(5, 30))))) for i in range(70)])
    stream = rng.choice([*words, "zz", "yy"], 6000)
    ids = np.array([index.terms.get(w.encode(), -1) for w in stream])
    starts = np.arange(0, 5900, 48)
    p, item, score = D.search(index, ids, starts, starts + 96, 0.6)
    got = {(a, b): c for a, b, c in zip(p.tolist(), item.tolist(), score.tolist(), strict=True)}
    want = {(k, m): s for k, at in enumerate(starts) for m, s in by_cursors(index, sorted({int(i) for i in ids[at:at + 96] if i >= 0}), 0.6).items()}
    assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def brute(docs, items):
    """All (document, item) pairs with an item's words in a row, or with enough of its shingles, in some passage: no index, no bounds."""
    parsed = [(i, D.words_of(t), D.question_and_answer(t)) for i, t in items if D.words_of(t)]
    n, mean = len(parsed), sum(len(w) for _, w, _ in parsed) / len(parsed)
    df = {}
    for _, w, _ in parsed:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    score = lambda w, t: np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * (D.K1 + 1) / (w.count(t) + D.K1 * (1 - D.B + D.B * len(w) / mean))
    out = set()
    for d, text in docs:
        words = D.words_of(text)
        for i, w, parts in parsed:
            window = D.window_of(len(w))
            own = sum(score(w, t) for t in set(w))
            for s in range(0, max(1, len(words) - window // 2), window // 2):
                passage = words[s:s + window]
                if sum(score(w, t) for t in set(w) & set(passage)) >= D.THRESHOLD * own - 1e-9:
                    if D.overlap(parts[0], passage) >= D.QUESTION and D.overlap(parts[1], passage) >= D.ANSWER:
                        out.add((d, i))
    return out


def corpus(rng):
    items = [(k, " ".join(f"{'common' if j % 5 == 0 else f'i{k}w'}{j % 37}{'.' if j == n * 3 // 4 else ''}" for j in range(n))) for k, n in enumerate((8, 20, 47, 60, 96, 130, 180, 260, 500))]
    docs = []
    for d in range(60):
        k = int(rng.integers(0, len(items)))
        words = items[k][1].split()
        for at in rng.choice(len(words), int(rng.integers(0, len(words) // 2 + 1)), replace=False):
            words[at] = f"x{at}"
        docs.append((d, " ".join([*(f"a{j}" for j in range(int(rng.integers(0, 200))))] + words + [*(f"b{j}" for j in range(int(rng.integers(0, 200))))])))
    return docs, items


def test_whole_query_against_brute_force(spark):
    docs, items = corpus(np.random.default_rng(9))
    want = brute(docs, items)
    assert 15 < len(want) < 60
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for group in (20_000, 3):
        assert {(r["doc_id"], r["item_id"]) for r in D.matches(*tables, group=group).collect()} == want
        assert {r["doc_id"] for r in D.kept(*tables, group=group).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_scores_do_not_depend_on_groups(spark):
    docs, items = corpus(np.random.default_rng(4))
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, many = ({(r["doc_id"], r["item_id"]): round(r["bm25"], 9) for r in D.matches(*tables, group=g).collect()} for g in (20_000, 2))
    assert one == many


def test_rows_of_one_doc_id_are_told_apart(spark):
    item = "the quick brown fox jumps over the lazy dog. it barks at the moon all night long"
    rows = [(1, item, "a"), (1, "something else entirely", "b"), (None, item, "c"), (None, None, "d"), (2, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "other words that nobody wrote down here")], "item_id long, text string")
    for group in (20_000, 1):
        assert sorted(r["key"] for r in D.kept(docs, bench, group).collect()) == ["b", "d", "e"]
        assert D.kept(docs.limit(0), bench, group).count() == 0 and D.kept(docs, bench.limit(0), group).count() == 5
