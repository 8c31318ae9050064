"""Every stage and every filter on odd and empty tables: nulls, empty and long texts, repeated rows, clashing columns."""

import pytest

from docfacts.llm import decontaminate, language, quality, simhash
from docfacts.llm.shared import materialize

MORE = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, node long, rank int, score double, fp string"


def odd_rows():
    long = " ".join(f"word{i % 977} next{i % 31}" for i in range(20_000))
    texts = [None, "", " \n\t", "a", "A a", long, long, "é" * 3000, "|| !! $$", "the cat sat on the mat and looked at the moon. " * 12, "12 34", "x\x0by\x0cz"]
    rows = [(i, t, "en" if i % 2 else None, None, None, "k", 1, 2, 0.5, "f") for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, texts[9], "en", "s", 1, None, None, None, None, None), (9, "another text under the same number", "en", "s", 1, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


def test_pipeline_on_odd_and_empty_tables(spark, odd):
    import corpus_pipeline as P

    for docs in (odd, odd.limit(0)):
        kept = docs
        for name, stage in P.STAGES[:-1]:
            kept = materialize(stage(spark, kept, MORE), name)
            assert kept.columns == docs.columns and kept.count() <= docs.count()
        assert P.STAGES[-1][1](spark, kept, MORE).count() >= kept.count()


def test_filters_on_empty_tables(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = quality.fit(quality.features(none), labels, quality.F.lit(True))
    assert quality.kept(none, model).count() == 0 and quality.kept(odd, model).count() == odd.count()  # 0.5 each
    speech = language.fit(none, language.F.lit(True))
    assert language.predict(none, speech).count() == 0 and language.kept(none, speech).count() == 0
    bench = spark.createDataFrame([(1, "the cat sat on the mat and looked at the moon.")], "item_id long, text string")
    assert decontaminate.kept(none, bench).count() == 0 and decontaminate.matches(odd, bench.limit(0)).count() == 0
    assert simhash.kept(none).count() == 0 and simhash.near_duplicates(none).count() == 0


def test_near_duplicates_of_odd_rows(spark, odd):
    got = simhash.kept(odd).collect()
    texts = [r["text"] for r in got]
    # texts without words, the long text and the repeated one leave one row each
    assert len(got) == len(set(texts)) == 10 and sum(not (t or "").split() for t in texts) == 1
    assert [r["doc_id"] for r in got if r["text"] and r["text"].startswith("the cat")] == [None]  # a null doc_id is the least
    assert any(r["doc_id"] == 9 and r["text"].startswith("another") for r in got)
