from __future__ import annotations

import zlib

from farewind.llm import language
from tests.llm.tables import docs_df, documents, prose


def test_awkward_rows(spark):
    rows = language.identify(docs_df(spark)).collect()
    assert len(rows) == len(documents())
    for row in rows:
        crc = zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1 if row["doc_id"] is not None else False
        assert row["held_out"] == crc
        assert 0 <= row["score"] <= 1
    told = {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] is not None}
    assert told[4] == told[5] == told[6] == told[7] == "und"
    assert {told[11], told[8]} <= {"en", "fr", "de"}


def test_held_out_accuracy(spark):
    rows = [(i, prose(i, 5 + i % 60, "en" if i % 2 else "fr"), "en" if i % 2 else "fr", "s", 0) for i in range(400)]
    truth = {r[0]: r[2] for r in rows}
    found = [r for r in language.identify(docs_df(spark, rows)).collect() if r["held_out"]]
    assert len(found) > 50
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in found) >= 0.97 * len(found)


def test_predictions_do_not_use_labels(spark):
    rows = [(i, prose(i, 30, "en" if i % 2 else "fr"), "en" if i % 2 else "fr", "s", 0) for i in range(60)]
    network = language.fit(docs_df(spark, rows).select("text", "lang"))
    texts = spark.createDataFrame([(1, rows[0][1]), (2, rows[1][1])], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.predict(texts, network).orderBy("doc_id").collect()] == ["fr", "en"]


def test_whole_texts_count(spark):
    """A text of another language behind a beginning of 1000 words decides."""
    rows = [(i, prose(i, 60, "en" if i % 2 else "fr"), "en" if i % 2 else "fr", "s", 0) for i in range(200)]
    network = language.fit(docs_df(spark, rows).select("text", "lang"))
    text = prose(1, 300, "en") + " " + prose(2, 5000, "fr")
    row = language.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), network).first()
    assert row["lang_pred"] == "fr"


def test_empty_and_unlabelled(spark):
    assert language.identify(docs_df(spark, [])).collect() == []
    unlabelled = docs_df(spark, [(1, "abc", None, "s", 3), (2, "77", None, "s", 2)])
    assert [r["lang_pred"] for r in language.identify(unlabelled).collect()] == ["und", "und"]
    assert [r["doc_id"] for r in language.keep_identified(unlabelled).collect()] == [1]


def test_keep_identified_keeps_columns(spark):
    docs = docs_df(spark)
    kept = language.keep_identified(docs)
    assert kept.dtypes == docs.dtypes
    ids = {r["doc_id"] for r in kept.collect()}
    assert {1, 2, 3, 11} <= ids and not ids & {4, 5, 6, 7}
