"""Each operator against a brute-force version, an exact round trip or held-out labels, and its edge cases."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docfacts.llm import audio, decontaminate, html_template, language, language_model, packing, quality, sharding, simhash, url_filter

MORE = "/root/testdata/sf0.01"
WORDS = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, train string, rank int, key int, fp string, x int, score int"


def table(name, sf):
    return duckdb.sql(f"SELECT * FROM '{sf}/{name}.parquet'").df()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def ids_of(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, unusual characters, and columns whose names operators use themselves."""
    long = " ".join(f"word{i % 977} next{i % 31}" for i in range(30_000))
    texts = [None, "", " \n\t", "a", "A a", long, long, "é" * 5000, "|| !! $$", "the cat sat. " * 40, "x\x0by\x0cz\x1cw", "𝔘𝔫𝔦 ﬁ Σ İ <|endoftext|> it's don't,"]
    rows = [(i, t, "en" if i % 2 else None, None, None, "t", 1, 2, "f", 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[9], (None, "no id", None, None, None, None, None, None, None, None, None)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# 1 -----------------------------------------------------------------------


def test_html_articles(spark, sf):
    got = {r["page_id"]: r["text"] for r in html_template.op1_html_template(spark, sf).collect()}
    for page_id, page in table("pages", sf)[["page_id", "html"]].itertuples(index=False):
        article = re.search("<article>(.*?)</article>", page, re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:b|i|a|em|strong)\b[^>]*>", "", article))
        assert got[page_id] == " ".join(html.unescape(plain).split())


def test_html_structure_and_edges(spark):
    pages = [(i, f"http://h.example/{i}", f"<body><div class='menu'>Home News</div><div id=content><p>Story {i} of <b>bold</b>ness &amp; more, told at length.</p><p>Second {i * 7} part &lt;here&gt;.</p></div><div class=sidebar>side {i}</div><p>Always the same last line</p><div class='comments'>nice {i}</div><form>mail</form></body>") for i in range(6)]
    pages += [(90, None, None), (91, "u", ""), (92, "x://y", "<p>open <i>and"), (93, "http://h.example/0", pages[0][2])]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, host int")
    got = {r["page_id"]: (r["text"], r["n_chars"], r["template_tokens"]) for r in html_template.extract(df).collect()}
    assert got[3][0] == "Story 3 of boldness & more, told at length. Second 21 part <here>." and got[3][1] == len(got[3][0]) and got[3][2] > 5
    assert got[93][0] == got[0][0] and got[90][:2] == got[91][:2] == ("", 0) and got[92][0] == "open and"
    assert html_template.extract(df.limit(0)).count() == 0


# 2, 3 --------------------------------------------------------------------


def test_quality_held_out(spark):
    got, labels = ids_of(quality.op2_quality(spark, MORE)), table("labels", MORE)
    held = [(r.quality, got[r.doc_id]) for r in labels.itertuples() if got[r.doc_id]["held_out"]]
    assert len(held) > 40 and sum(q == g["predicted"] for q, g in held) / len(held) > 0.95
    assert all(g["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and (g["score"] >= 0.3) == g["predicted"] for d, g in got.items())


def test_quality_edges(spark, odd, none):
    model = quality.fit(quality.features(odd), spark.createDataFrame([(1, None), (99, 1)], "doc_id long, quality int"), F.lit(True))
    assert {r["score"] for r in quality.score(quality.features(odd), model).collect()} == {0.5}
    assert quality.score(quality.features(none), model).count() == 0 and quality.kept(odd, model).columns == odd.columns


def test_language_held_out(spark):
    got, docs = ids_of(language.op3_language(spark, MORE)), table("documents", MORE)
    held = [(r.lang, got[r.doc_id]["lang_pred"]) for r in docs.itertuples() if got[r.doc_id]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_language_edges(spark, odd, none):
    got = ids_of(language.predict(odd, language.fit(odd, F.lit(True))))
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 8)] == ["und"] * 4 and got[0]["score"] == 0.0 and got[3]["lang_pred"] == "en"
    empty = language.fit(none, F.lit(True))
    assert {r["lang_pred"] for r in language.predict(odd, empty).collect()} == {"und"}
    assert language.kept(odd, empty).count() == 0


# 4 -----------------------------------------------------------------------


def test_hilbert_is_a_curve():
    side = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1)
    at = np.argsort(sharding.hilbert(side, 3))
    assert sorted(sharding.hilbert(side, 3)) == list(range(512))
    assert (np.abs(np.diff(side[:, at], axis=1)).sum(0) == 1).all()


def test_shards(spark, sf, odd, none):
    for docs, texts in ((spark.read.parquet(f"{sf}/documents.parquet"), table("documents", sf).text.tolist()), (odd, None)):
        rows = sharding.hilbert_shards(docs).collect()
        assert len(rows) == docs.count()
        sizes = Counter(r["shard"] for r in rows)
        assert max(sizes[s] for s in range(16)) - min(sizes[s] for s in range(16)) <= 1
        for s in sizes:
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
        if texts:
            by = {r["doc_id"]: r for r in rows}
            assert all(by[i]["size"] == len(t.encode()) + 1 and by[i]["text_crc32"] == zlib.crc32(t.encode()) for i, t in enumerate(texts))
    assert sharding.hilbert_shards(none).count() == 0


# 5 -----------------------------------------------------------------------


@pytest.mark.parametrize("part_pairs, part_words, block", [(3_000_000, 2_000_000, 8 << 20), (2_000, 1_500, 30_000)])
def test_language_model(spark, sf, monkeypatch, part_pairs, part_words, block):
    monkeypatch.setattr(language_model, "PART_PAIRS", part_pairs)
    monkeypatch.setattr(language_model, "PART_WORDS", part_words)
    monkeypatch.setattr(language_model, "BLOCK_BYTES", block)
    monkeypatch.setattr(language_model, "SLICE_BYTES", min(block, 20_000))
    got = ids_of(language_model.op5_language_model(spark, sf))
    texts = dict(table("documents", sf)[["doc_id", "text"]].itertuples(index=False))
    tokens = {d: [*re.findall(WORDS, lower(t)), 0] for d, t in texts.items()}
    train = [w for d, w in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    one, two, ctx, three, ctx2 = (Counter() for _ in range(5))
    pairs_of = lambda ws: list(zip([None, *ws[:-1]], ws, strict=True))
    for ws in train:
        one.update(ws)
        pairs = pairs_of(ws)
        two.update(pairs)
        ctx.update(p[0] for p in pairs)
        three.update(zip(pairs[:-1], ws[1:], strict=True))
        ctx2.update(pairs[:-1])
    n, v, mu = sum(one.values()), len(one), language_model.MU
    p1 = lambda w: (one[w] + 1) / (n + v + 1)
    read_back = lambda p: 10.0 ** language_model.BOOK[language_model.quantise(np.array([math.log10(p)]))[0]]
    p2 = lambda a, w: (two[a, w] + mu * p1(w)) / (ctx[a] + mu)

    def is_context(a, w):
        """The count that the quantised probability gives back."""
        prior = read_back(p1(w))
        stored = read_back((two[a, w] + mu * prior) / (ctx[a] + mu))
        return two[a, w] > 0 and np.rint(stored * (ctx[a] + mu) - mu * prior) >= language_model.LEAST

    def score(ws):
        total, used, each = 0.0, 0, pairs_of(ws)
        for k, (a, w) in enumerate(each):
            p = p2(a, w)
            if k and one[w] and is_context(*each[k - 1]):
                before = each[k - 1]
                p, used = (three[before, w] + mu * p) / (ctx2[before] + mu), used + 1
            total += math.log10(p)
        return total, used

    assert set(got) == set(tokens)
    third = 0
    for d, ws in tokens.items():
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(one[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10(p1(w)) for w in ws), rel_tol=1e-9)
        want, used = score(ws)
        third += used
        assert abs(r["score"] - want) <= 0.03 * len(ws) + 0.06
    assert third > 1000


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, universe in ((1, 1), (5, 1000), (4000, 9000), (4000, 1 << 40)):
        values = np.sort(rng.integers(0, universe, n))
        ef = language_model.EliasFano(n, universe, *language_model.EliasFano.encode(values, universe))
        assert (ef.at(np.arange(n)) == values.astype(np.uint64)).all()
        asked = rng.integers(0, universe, 3000)
        assert (ef.find(asked) == np.searchsorted(values, asked)).all()


def test_language_model_edges(spark, odd, none):
    for train in (True, False):
        out, total = language_model.score_documents(odd.withColumn("train", F.lit(train)))
        got = {r["doc_id"]: r for r in out.collect()}
        assert out.count() == odd.count() and got[0]["n_tokens"] == got[1]["n_tokens"] == 1 and got[5]["score"] == got[6]["score"] and got[10]["n_tokens"] == 4
        assert (total > 0) is train and None in got
    assert language_model.score_documents(none.withColumn("train", F.lit(True)))[0].count() == 0


# 6 -----------------------------------------------------------------------


def brute_components(fps):
    parent = {d: d for d in fps}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash(spark, sf):
    import xxhash

    fps = {}
    for d, text in table("documents", sf)[["doc_id", "text"]].itertuples(index=False):
        w = re.findall(WORDS, lower(text))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        fps[d] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    got = ids_of(simhash.op6_simhash(spark, sf))
    assert {d: int(r["fingerprint"], 16) for d, r in got.items()} == fps
    assert {d: r["component_id"] for d, r in got.items()} == brute_components(fps)


@pytest.mark.parametrize("block", [1500, 20])
def test_links_of_crowded_lists(spark, block):
    """Clusters of near fingerprints, in lists longer than a block: components are those of all pairs."""
    rng = np.random.default_rng(5)
    fps = []
    for _ in range(6):
        x = int(rng.integers(0, 1 << 62))
        for _ in range(90):
            fps.append(x)
            x ^= 1 << int(rng.integers(0, 64))
            if rng.random() < 0.2:
                x ^= (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64)))
    fps = sorted(set(fps))
    nodes = spark.createDataFrame([(bytearray(f.to_bytes(8, "big")),) for f in fps], "fp binary")
    edges = simhash.links(simhash.postings(nodes, simhash.cover(8, 5, 3)), 5, 3, block)
    roots = {int.from_bytes(r["node"], "big"): bytes(r["root"]) for r in simhash.components(edges).collect()}
    want = brute_components({f: f for f in fps})
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(roots.get(f, f))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_cover_is_complete():
    from itertools import combinations

    keys = [set(k) for k in simhash.cover(8, 5, 3)]
    assert all(any(k <= set(five) for k in keys) for five in combinations(range(8), 5))


def test_simhash_edges(spark, odd, none):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(odd).collect()}
    assert bytes(got[0]["fp"]) == bytes(8) and got[0]["component_id"] == got[1]["component_id"] == got[2]["component_id"] == 0 and got[6]["component_id"] == 5
    assert simhash.near_duplicates(odd).count() == odd.count() and simhash.near_duplicates(none).count() == 0


# 7 -----------------------------------------------------------------------


def test_decontamination(spark):
    docs, items = table("documents", MORE), table("benchmark", MORE)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.op7_decontaminate(spark, MORE).collect()}
    planted = {(d.doc_id, i.item_id) for i in items.itertuples() for d in docs.itertuples() if i.text in d.text}
    assert planted and planted <= got
    words = {d.doc_id: set(decontaminate.words_of(d.text)) for d in docs.itertuples()}
    by = {i.item_id: decontaminate.words_of(i.text) for i in items.itertuples()}
    assert all(sum(w in words[d] for w in by[i]) / len(by[i]) > 0.6 for d, i in got)


def test_bounds_lose_nothing():
    """Block-max search gives what exact scoring of every passage and item gives."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(40)]
    index = decontaminate.Index(items)
    stream = rng.choice([*words, "zz"], 3000)
    ids = np.array([index.terms.get(w.encode(), -1) for w in stream])
    starts = np.arange(0, 2950, 15)
    p, item, score = decontaminate.search(index, ids, starts, starts + 40, 0.6)
    dense = np.zeros((len(index.terms), len(items)))
    dense[np.repeat(np.arange(len(index.terms)), np.diff(index.ptr)), index.item] = index.score
    want = {}
    for k, s in enumerate(starts):
        total = dense[sorted({i for i in ids[s:s + 40] if i >= 0})].sum(0)
        want |= {(k, m): total[m] for m in np.flatnonzero(total >= 0.6)}
    got = dict(zip(zip(p.tolist(), item.tolist(), strict=True), score, strict=True))
    assert want and got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in got)


def test_decontamination_edges(spark, odd, none, monkeypatch):
    items = spark.createDataFrame([(1, "the cat sat. the cat sat. the cat sat."), (2, None), (3, ""), (None, "no id"), (1, "word5 next5 word6")], "item_id long, text string")
    first = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(odd, items).collect()}
    assert (9, 1) in first and (None, None) in first
    assert decontaminate.kept(odd, items).count() == odd.count() - len({d for d, _ in first}) - 1  # row 9 is there twice
    assert decontaminate.matches(none, items).count() == 0 and decontaminate.matches(odd, items.limit(0)).count() == 0


# 8 -----------------------------------------------------------------------


def test_audio_round_trip(spark, sf, odd, none):
    for docs, texts in ((spark.read.parquet(f"{sf}/documents.parquet"), None), (odd, 1)):
        source = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        for r in audio.media_columns(docs).collect():
            raw = source[r["doc_id"]].encode()
            padded = raw + bytes(-len(raw) % 64 or 64 * (not raw))
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
            assert r["media_bytes"] == len(r["media"]) and r["media_sha256"] == hashlib.sha256(r["media"]).hexdigest()
            assert r["duration_us"] == r["frames"] * 24_000 and all(r["media"][o] == 0xFF for o in r["seek_offsets"])
    assert audio.media_columns(none).count() == 0


def test_audio_damage():
    payload = bytes(range(256)) * 40
    media = audio.encode(payload)
    whole = audio.parse(media)
    assert whole["payload"] == payload and whole["bad_crc"] == whole["skipped"] == 0 and whole["table"]["frames"] == len(whole["offsets"]) and whole["tags"] == {"TXXX:payload": str(len(payload))}
    cut = audio.parse(media[: whole["offsets"][2]] + b"\x00\xffjunk" + media[whole["offsets"][2]:])
    assert cut["payload"] == payload and cut["skipped"] == 6
    torn = bytearray(media)
    torn[whole["offsets"][1] + 10] ^= 1
    assert audio.parse(bytes(torn))["bad_crc"] == 1 and audio.parse(b"no stream")["payload"] == b"" == audio.parse(b"")["payload"]


# 9 -----------------------------------------------------------------------


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    tokenizer, used, by = Tokenizer.from_file(packing.default_vocabulary()), {}, {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by.setdefault(r["doc_id"], []).append(r)
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    for d, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by[d], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 4096))
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4")
            assert r["length"] == min(4096, len(ids) - r["start"]) and r["ids_crc32"] == zlib.crc32(part.tobytes())
    return len(used), -(-sum(r["length"] for r in rows) // 4096)


def test_packing(spark, sf, odd, none):
    texts = dict(table("documents", sf)[["doc_id", "text"]].itertuples(index=False))
    found, least = check_packing(packing.op9_pattern_packing(spark, sf).collect(), texts)
    assert found <= least + 1
    once = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check_packing(packing.pack_documents(once).collect(), {r["doc_id"]: r["text"] for r in once.collect()})
    assert packing.pack_documents(none).count() == 0 and packing.pack_documents(odd).select("doc_id").distinct().count() == 13


def test_plan_uses_every_piece():
    rng = np.random.default_rng(7)
    for scale in (30, 3000):
        counts = np.bincount(np.minimum(4096, rng.gamma(1.2, 700, scale).astype(int) + 1), minlength=4097)
        left = counts.copy()
        for pattern, n in packing.plan(counts):
            assert sum(pattern) <= 4096
            np.subtract.at(left, list(pattern), n)
        assert not left.any()


# 10 ----------------------------------------------------------------------


def test_urls_against_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{MORE}/pages.parquet'")
    want = sorted(map(tuple, duckdb.sql(url_filter.ORACLE).fetchall()))
    got = url_filter.op10_url_filter(spark, MORE).select("page_id", "host", "path", "rule", "verdict").collect()
    order = duckdb.sql(url_filter.ORACLE).columns
    assert sorted(tuple(r[c] for c in order) for r in got) == want


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), (F.xxhash64("id") % 7 == 0).alias("listed"))
    cascade = url_filter.Cascade.build(keys)
    assert len(cascade.levels) > 2
    assert cascade.member(keys, "key", "m").filter("m <> listed").count() == 0
    asked = keys.select("key", F.col("listed").alias("want"))
    for most in (1_000, 128 << 20):  # in several cascades, or in one
        assert url_filter.members(asked, "key", keys, "m", most).filter("m = want").count() == 20_000


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://A.Example.ORG/es/x?y"), (4, "x://com/fr/"), (5, "http://notcom/de/"), (6, "http://b.com/de/1#f"), (7, "http://org"), (8, "http://example.org/en/12")]
    df = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df).collect()}
    assert got[1] == got[2] == ("", "", None, "allow") and got[3] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[4][2:] == ("com/fr/", "allow")
    assert got[5][2] is None and got[6][2:] == ("com/de/", "block") and got[7] == ("org", "", None, "allow") and got[8][2:] == ("example.org/en/1", "block")
    assert url_filter.judge(df.limit(0)).count() == 0


# pipeline ------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline as P
    from docfacts.llm.shared import materialize

    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    labels, sizes = {r.doc_id: r.quality for r in table("labels", MORE).itertuples()}, []
    kept = docs
    for name, stage in P.STAGES[:-1]:
        kept = materialize(stage(spark, kept, MORE), name)
        assert kept.columns == docs.columns
        sizes.append({r["doc_id"] for r in kept.select("doc_id").collect()})
    quality_kept, language_kept, unique, clean = sizes
    marked = [(labels[d], d in quality_kept) for d in labels]
    assert sum(bool(q) == k for q, k in marked) / len(marked) > 0.95 and language_kept == quality_kept
    texts = {r.doc_id: r.text for r in table("documents", MORE).itertuples()}
    assert len({texts[d] for d in unique}) == len(unique)
    items = [i.text for i in table("benchmark", MORE).itertuples()]
    assert not [d for d in clean if any(i in texts[d] for i in items)]
    assert {d for d in unique if any(i in texts[d] for i in items)} == unique - clean
    # near duplicates: brute force over five-word shingles of what the stage before kept
    sets = {d: (lambda w: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})(re.findall(WORDS, lower(texts[d]))) for d in language_kept}
    ids, parent = sorted(sets), {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert unique == {d for d in ids if find(d) == d}
    packed = P.STAGES[-1][1](spark, kept, MORE).collect()
    found, least = check_packing(packed, {d: texts[d] for d in clean})
    assert found <= least + 1


def test_wide_fingerprints_find_near_copies():
    """Five-word shingles: copies with a similarity of 0.8 or more lie within the pipeline's distance, unrelated texts don't."""
    rng = np.random.default_rng(11)
    limit, keys, missed = simhash.WIDE["distance"], simhash.wide_keys(), 0
    for _ in range(60):
        words = [f"w{x}" for x in rng.integers(0, 5000, 400)]
        other = list(words)
        for i in rng.choice(400, 7, replace=False):
            other[i] = "changed"
        a, b, c = (simhash.fingerprint(simhash.shingle_hashes(" ".join(w), 5), 256) for w in (words, other, words[::-1]))
        far = lambda x, y: int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum())
        met = any(all(a[p] == b[p] for p in key) for key in keys)
        missed += far(a, b) > limit or not met
        assert far(a, c) > limit
    assert missed <= 3



def brute_copies(texts):
    """Least doc_id of each group over five-word shingles, by all pairs."""
    sets = {d: (lambda w: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})(t.split()) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if b < a and shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}



def test_near_copies_around_the_threshold(spark):
    """Copies with about 6 % of shingles changed each: links that fail must not take others with them."""
    rng, texts = np.random.default_rng(3), {}
    for group in range(12):
        words = [f"g{group}w{k}" for k in range(304)]
        for copy in range(12):
            own = list(words)
            for at in rng.choice(300, 4, replace=False):
                own[at] = f"c{copy}x{at}"
            texts[len(texts)] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_copies(texts)
    assert 24 < len(set(want.values())) < 140
    assert {r["doc_id"] for r in simhash.kept(docs).collect()} == {d for d, c in want.items() if d == c}



def test_near_copies_misses_no_pair(spark):
    """Isolated pairs with a similarity of 0.8 or little more, and little less, among texts of common phrases."""
    rng, texts = np.random.default_rng(7), {}
    for pair in range(300):
        size = int(rng.integers(60, 300))
        words = [f"p{pair}w{k}" if k % 40 > 6 else f"common{k % 40}" for k in range(size)]
        n = max(1, round((size - 4) * 0.111 / 5 + rng.integers(-1, 2)))
        other = list(words)
        for at in rng.choice(size, n, replace=False):
            other[at] = f"z{pair}x{at}"
        texts[2 * pair], texts[2 * pair + 1] = " ".join(words), " ".join(other)
    want = brute_copies(texts)
    assert 100 < sum(d != c for d, c in want.items()) < 300
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.kept(docs).collect()} == {d for d, c in want.items() if d == c}



def test_near_copies_compare_distinct_shingles(spark):
    """Repeated words neither join different texts nor part near copies."""
    tail = lambda name: " ".join(f"{name}{k}" for k in range(60))
    line = " ".join(f"l{k}" for k in range(8))
    texts = {0: "spam " * 300 + tail("a"), 1: "spam " * 300 + tail("b"), 2: tail("c") + " " + line, 3: tail("c") + (" " + line) * 200, 4: "spam " * 400, 5: "spam " * 90}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_copies(texts)
    assert want == {0: 0, 1: 1, 2: 2, 3: 2, 4: 4, 5: 4}
    assert {r["doc_id"] for r in simhash.kept(docs).collect()} == {0, 1, 2, 4}



def test_template_decides_inside_the_region(spark):
    """Constant texts of a host go from its articles too; without a region short slots stay."""
    inside = [(i, f"http://a.example/{i}", f"<body><article><p>Story {i} at length.</p><div>Always this notice</div><p>End {i * 7}.</p></article></body>") for i in range(6)]
    without = [(10 + i, f"http://b.example/{i}", f"<body><div id=x><p>{f'Long part {i} ' * 40}</p></div><div id=y><section>Short {i}</section></div><p>Same</p></body>") for i in range(6)]
    got = {r["page_id"]: r["text"] for r in html_template.extract(spark.createDataFrame(inside + without, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story 3 at length. End 21."
    assert got[12].endswith("Short 2") and "Same" not in got[12]



def test_long_items_are_found_wherever_they_stand(spark):
    """Items of 20 to 700 words, verbatim in a document at every alignment of the shortest passages."""
    items = {k: " ".join(f"i{k}w{j}{'.' if j == n * 3 // 4 else ''}" for j in range(n)) for k, n in enumerate((20, 48, 49, 100, 120, 150, 170, 300, 700))}
    docs = [(k * 100 + at, " ".join([*(f"x{j}" for j in range(at)), text, *(f"y{j}" for j in range(60))])) for k, text in items.items() for at in range(0, 48, 5)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench).collect()} == {(k * 100 + at, k) for k in items for at in range(0, 48, 5)}
    assert decontaminate.kept(docs, bench).count() == 0
