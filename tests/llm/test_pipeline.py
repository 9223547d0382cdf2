from __future__ import annotations

import pytest

import corpus_pipeline
from farewind.scratch import new_folder
from tests.llm.tables import benchmark_df, docs_df, documents, prose
from tests.llm.test_near_dups import brute


@pytest.fixture(scope="module")
def folder(spark):
    base = prose(900, 70)
    rows = documents()
    rows += [(1000 + i, prose(1000 + i, 60, "en" if i % 2 else "fr"), "en" if i % 2 else "fr", "s", 0) for i in range(80)]
    rows += [(2000, prose(2000, 30) + " " + base + ". " + prose(2001, 30), "en", "s", 0)]
    rows += [(2100, prose(1001, 60) + " more.", "en", "s", 0), (2101, "Menu\nHome\nShare\n" * 30, "en", "s", 0)]
    root = new_folder(spark, "pipeline-input")
    docs_df(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{root}/documents.parquet")
    benchmark_df(spark, [(1, base), (2, None)]).write.parquet(f"{root}/benchmark.parquet")
    labels = [(1000 + i, int(i % 3 > 0), 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What each stage was given and what it kept."""
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = new_folder(spark, name)
        stage(spark, docs, folder).write.parquet(out)
        kept = spark.read.parquet(out)
        seen[name] = (docs, kept)
        docs = kept
    return seen


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=repr)


def test_all_but_the_last_return_documents(stages):
    for name, (docs, kept) in stages.items():
        if name != "mixing":
            assert kept.columns == docs.columns, name
        assert kept.count() <= docs.count(), name


def test_language_drops_texts_without_letters(stages):
    docs, kept = stages["language"]
    gone = {r["doc_id"] for r in docs.collect()} - set(ids(kept))
    assert {4, 5, 6, 7} <= gone
    assert not gone & set(range(1000, 1080)), "clean documents stay"


def test_quality_keeps_prose(stages):
    _, kept = stages["quality"]
    left = set(ids(kept))
    assert set(range(1000, 1080)) <= left and 2101 not in left and 8 not in left


def test_near_dups_match_brute_force(stages):
    docs, kept = stages["near_dups"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = {d for d, _, _, stays in brute(rows, 5) if stays and d is not None}
    assert {d for d in ids(kept) if d is not None} == expected
    assert 1001 in expected and 2100 not in expected


def test_decontamination_drops_the_passage_only(stages):
    docs, kept = stages["decontamination"]
    assert set(ids(docs)) - set(ids(kept)) == {2000}


def test_mixing_keeps_what_is_drawn(stages):
    docs, kept = stages["mixing"]
    assert set(kept.columns) == {*docs.columns, "rate", "copies"}
    assert set(ids(kept)) <= set(ids(docs)) and kept.filter("copies < 1").count() == 0


def test_run_is_the_stages(spark, folder, stages):
    assert ids(corpus_pipeline.run(spark, folder)) == ids(stages["mixing"][1])


def test_empty(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name
