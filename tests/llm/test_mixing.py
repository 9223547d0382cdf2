from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from farewind.llm import mixing
from tests.llm.tables import docs_df, documents, prose

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=300):
    """Good, poor and toxic documents, told apart by words that come with them."""
    marks = {0: "splendid account", 1: "meh filler", 2: "stupid trash"}
    rows = [(i, f"{prose(i, 30 + i % 40)} {marks[i % 3]}", "en", "s", 0) for i in range(n)]
    labels = [(i, int(i % 3 == 0), int(i % 3 == 2)) for i in range(0, n, 2)]
    return docs_df(spark, rows), spark.createDataFrame(labels, LABELS)


def totals(mixed):
    rows = mixed.select("n_tokens", "posterior", "rate").collect()
    p = np.array([r["posterior"] for r in rows])
    tokens = np.array([r["n_tokens"] for r in rows], float)
    rates = np.array([r["rate"] for r in rows])
    return p, tokens, rates


@pytest.mark.parametrize("targets", [{"good": 0.8, "poor": 0.17, "toxic": 0.03}, {"good": 0.2, "poor": 0.5, "toxic": 0.3}, {"good": 1.0}])
def test_expected_tokens_meet_the_targets(spark, targets):
    docs, labels = corpus(spark)
    p, tokens, rates = totals(mixing.mix(docs, labels, targets))
    assert rates.min() >= 0 and np.allclose(p.sum(axis=1), 1)
    expected = (rates * tokens) @ p
    for i, name in enumerate(["good", "poor", "toxic"]):
        if name in targets:
            assert expected[i] / tokens.sum() == pytest.approx(targets[name], rel=2e-3)


def test_posteriors_know_the_domains(spark):
    docs, labels = corpus(spark)
    rows = mixing.mix(docs, labels).collect()
    best = sum(int(np.argmax(r["posterior"])) == r["doc_id"] % 3 for r in rows)
    assert best >= 0.98 * len(rows)


def test_domains_of_many_words_are_known_on_rows_held_out(spark):
    """A hundred words tell each domain and a document holds four of them: no few words will do."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(2400):
        marks = " ".join(f"mark{i % 3}x{k}" for k in rng.choice(100, 4, replace=False))
        rows.append((i, f"{prose(i, 10)} {marks}", "en", "s", 0))
    labels = [(i, int(i % 3 == 0), int(i % 3 == 2)) for i in range(2400) if i % 4]
    found = mixing.mix(docs_df(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    for domain in range(3):
        held = [r for r in found if r["doc_id"] % 4 == 0 and r["doc_id"] % 3 == domain]
        assert sum(int(np.argmax(r["posterior"])) == domain for r in held) >= 0.97 * len(held)


def test_scores_are_sums_of_log_odds(spark):
    docs, labels = corpus(spark)
    named = labels.select("doc_id", mixing.label_domain(F.col("quality"), F.col("toxic")).alias("domain"))
    model = mixing.fit_classifier(docs.join(named, "doc_id").select("text", "domain"))
    words = {r["word"]: [r[f"w{i}"] / mixing.SCALE for i in range(3)] for r in model["words"].collect()}
    assert {"splendid", "meh", "trash"} <= set(words)
    by_key = {(r["_k1"], r["_k2"]): r for r in mixing.text_posteriors(docs, model).collect()}
    for row in docs.select("text", *mixing._keyed(F.col("text"))).limit(50).collect():
        own = row["text"].lower().split()
        scores = np.array(model["prior"]) + np.sum([words[w] for w in set(own) if w in words], axis=0)
        expected = np.exp(scores - scores.max())
        found = by_key[row["_k1"], row["_k2"]]
        assert np.allclose(found["posterior"], expected / expected.sum())
        assert (found["n_tokens"], found["n_rows"]) == (len(own), 1)


def test_copies_of_a_text_are_one_text(spark):
    docs, labels = corpus(spark, 60)
    once = {r["doc_id"]: r for r in mixing.mix(docs, labels).collect()}
    extra = docs.filter("doc_id = 1").withColumn("doc_id", F.explode(F.sequence(F.lit(1000), F.lit(1050))))
    again = mixing.mix(docs.unionByName(extra.select(docs.columns)), labels).collect()
    assert len(again) == 111
    for r in again:
        assert np.allclose(r["posterior"], once[r["doc_id"] if r["doc_id"] < 1000 else 1]["posterior"])


def test_plan_does_not_grow_with_the_vocabulary(spark):
    rows = [(i, " ".join(f"w{i % 3}x{k}" for k in range(3000)), "en", "s", 0) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 == 2)) for i in range(90)], LABELS)
    plan = mixing.mix(docs_df(spark, rows), labels)._jdf.queryExecution().toString()
    assert len(plan) < 100_000


def test_missed_targets_are_told(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 0)
    docs, labels = corpus(spark)
    with pytest.warns(UserWarning, match="not met"):
        mixing.mix(docs, labels)


def test_fit_matches_plain_numpy(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.4, 0.4], 200)
    tokens = rng.integers(0, 500, 200)
    rows = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "n_tokens long, posterior array<double>").withColumn("n_rows", F.lit(1))
    names, targets = ["a", "b", "c"], {"a": 0.7, "b": 0.25, "c": 0.05}
    steps, pace = mixing.fit_rates(rows, names, targets)
    found = np.array([r[0] for r in rows.select(mixing.rate_of(F.col("posterior"), steps, pace)).collect()])
    size = tokens @ p
    goal = tokens.sum() * np.array([0.7, 0.25, 0.05])
    gram = (p * tokens[:, None]).T @ p / np.sqrt(np.outer(size, size))
    rate, ahead, step = np.ones(200), np.ones(200), 1 / gram.sum(axis=1).max()
    for t in range(len(steps)):
        new = np.maximum(0, ahead - step * (p @ (((tokens * ahead) @ p - goal) / size)))
        rate, ahead = new, new + t / (t + 3) * (new - rate)
    assert np.allclose(found, rate)
    assert np.allclose((tokens * found) @ p, goal, rtol=2e-3)


def test_copies_follow_rates(spark):
    docs, labels = corpus(spark, 600)
    rows = mixing.mix(docs, labels).collect()
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in rows)
    assert sum(r["copies"] for r in rows) == pytest.approx(sum(r["rate"] for r in rows), rel=0.1)


def test_draw(spark):
    docs, labels = corpus(spark)
    drawn = mixing.draw(docs, labels)
    assert drawn.columns == [c for c in docs.columns if c not in ("n_tokens", "posterior", "rate", "copies")] + ["rate", "copies"]
    expected = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, labels).collect() if r["copies"] > 0}
    assert {r["doc_id"]: r["copies"] for r in drawn.collect()} == expected


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (4, 1, None), (None, 1, 1), (1, 0, 0), (10, 1, 0)], LABELS)
    rows = mixing.mix(docs_df(spark), labels.selectExpr("*", "'t' as text")).collect()
    assert len(rows) == len(documents())
    assert all(r["rate"] >= 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5, 6)} == {0}


def test_without_labels_all_is_one_domain(spark):
    none = spark.createDataFrame([], LABELS)
    rows = mixing.mix(docs_df(spark), none).collect()
    assert {(r["rate"], r["copies"]) for r in rows} == {(1.0, 1)}
    assert mixing.mix(docs_df(spark, []), none).collect() == []


def test_no_python_on_rows(spark):
    docs, labels = corpus(spark)
    plan = mixing.mix(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
