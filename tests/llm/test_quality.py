from __future__ import annotations

import random
import re
import time

from farewind.llm import quality
from tests.llm.tables import docs_df, documents, prose


def brute(text):
    body = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", body)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [line for line in body.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in body),
        len(lines) - len(set(lines)), len(hit),
        len(words) < 20 or 100 * len(hit) > 30 * len(words),
    )


def rows():
    extra = [
        (900, "A line of words that ends well here.\nA line of words that ends well here.\nother | menu | bar | x", "en", "s", 0),
        (901, "\n".join(["Home", "Menu", "a | b | c | d", "All rights reserved.", prose(1, 30)]), "en", "s", 0),
        (902, "no end of the line\n" * 9, "en", "s", 0),
        (903, "one two three four five six seven eight nine. " * 3 + prose(2, 60), "en", "s", 0),
        (904, "# * $ % & | < >", "en", "s", 0),
        (905, "We use cookies. " + prose(3, 100), "en", "s", 0),
    ]
    return documents() + extra


def test_measures_match_brute_force(spark):
    df = quality.judge_documents(docs_df(spark, rows()))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = sorted(((r["doc_id"], *[r[n] for n in names]) for r in df.collect()), key=repr)
    assert found == sorted(((r[0], *brute(r[1])) for r in rows()), key=repr)
    assert df.columns.count("n_words") == 1


def test_lines(spark):
    found = {r["doc_id"]: r for r in quality.judge_documents(docs_df(spark, rows())).collect() if r["doc_id"] and r["doc_id"] >= 900}
    assert found[900]["clean_text"] == "A line of words that ends well here.\nA line of words that ends well here."
    assert found[901]["clean_text"] == prose(1, 30) and found[901]["kept"]
    assert found[902]["clean_text"] == "" and not found[902]["kept"]
    assert found[905]["clean_text"] == rows()[-1][1]  # a long line is prose


def test_no_python_on_rows(spark):
    plan = quality.judge_documents(docs_df(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_keep_good(spark):
    docs = docs_df(spark, rows())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and dict(kept.dtypes) == dict(docs.dtypes)
    for row in kept.collect():
        assert row["n_chars"] == len(row["text"])
    assert {1, 2, 3, 10, 11, 901} <= {r["doc_id"] for r in kept.collect()}
    assert quality.keep_good(docs_df(spark, [])).collect() == []


def test_separated_lines_as_by_the_repeated_group(spark):
    """The rule is three links of a chain; the pattern in use has no repeated group."""
    rng = random.Random(4)
    lines = ["".join(rng.choice("a|> ·") for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    found = spark.createDataFrame([(line,) for line in lines], "line string").selectExpr("line", f"line rlike r'{quality.SEPARATED}' as hit")
    for line, hit in found.collect():
        assert hit == bool(re.search(r"(?:\S*\s*[|»›→•·>]\s*\S+){3,}", line)), line


def test_very_long_lines(spark):
    long = [" | ".join(["word"] * 100_000), "x" * 400_000 + "|||" + "y" * 600_000, "|" * 200_000, "z" * 1_000_000 + "| | |"]
    docs = docs_df(spark, [(i, prose(1, 60) + "\n" + line, "en", "s", 0) for i, line in enumerate(long)])
    begun = time.time()
    kept = {r["doc_id"]: r["clean_text"] for r in quality.judge_documents(docs).select("doc_id", "clean_text").collect()}
    assert time.time() - begun < 60
    assert kept[0] == kept[2] == prose(1, 60)
