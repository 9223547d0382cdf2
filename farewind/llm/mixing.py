"""Mixing documents to target weights by soft membership in domains, as DataFrame operations.

A labelled table gives domains. A naive Bayes classifier on the presence of telling words
predicts every document's posterior over them. Rates (how often a document is to be drawn) are
then fitted so that the expected tokens of each domain, the sum of rate * tokens * posterior,
come to its target. The fit is projected gradient descent on the squared relative errors: each
step is one sum over all documents and moves every rate against its own gradient, with negative
rates set to zero.
"""

from __future__ import annotations

import functools
import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farewind.scratch import stored

#: Parts of the tokens that each domain is to have.
TARGETS = {"good": 0.8, "poor": 0.17, "toxic": 0.03}
#: Labelled rows that the classifier learns from at most (expected number).
SAMPLE_ROWS = 20_000
#: Labelled documents that must hold a word, and the likelihood ratio statistic (G squared, one
#: degree of freedom: 20 comes by chance once in 130,000 words) that its tie to a domain must reach.
MIN_DOCUMENTS, MIN_EVIDENCE = 5, 20.0
MAX_STEPS, TOLERANCE = 200, 1e-4
#: Steps after which the rates are stored, and rows that one file of them holds.
STORED_STEPS, STATE_ROWS = 10, 100_000
#: Log-odds are whole numbers of this part, so that their sums do not depend on the order.
SCALE = 1 << 32

_KEY = ("_k1", "_k2")
_BLANK = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BLANK), "")


def label_domain(quality: Column, toxic: Column) -> Column:
    """The domain of a labelled row; null if a label is."""
    return F.when(toxic == 1, F.lit("toxic")).when((toxic == 0) & (quality == 1), F.lit("good")).when(
        (toxic == 0) & (quality == 0), F.lit("poor")
    )


def fit_classifier(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Domains, their priors, and a stored table of the telling words.

    ``labelled`` has text and domain. Rows with a null in either are not used. A hash of the
    text chooses ``sample_rows`` rows on average if there are more. The words are all that
    MIN_DOCUMENTS rows hold and whose tie to a domain is evident (MIN_EVIDENCE), however many:
    the others have no ascertained odds, and their chance odds add up over a long text. The table
    has, by word, the log-odds of its presence in each domain (w0, w1, ... in SCALE parts).
    """
    usable = labelled.filter(F.col("text").isNotNull() & F.col("domain").isNotNull()).select("text", "domain")
    n = usable.count()
    if n > sample_rows:
        share = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1_000_000)) / 1_000_000.0
        usable = usable.filter(share < sample_rows / n)
    rows = stored(usable.select("domain", F.array_distinct(words_of(F.col("text"))).alias("words")), "labelled")
    sizes = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    if not sizes:
        return {"domains": ["all"], "prior": [0.0], "words": None}
    domains = sorted(sizes)
    counted = rows.select("domain", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)]
    ).filter(F.col("n") >= MIN_DOCUMENTS)
    total = sum(sizes.values())
    evidence = [_evidence(F.col(f"n{i}"), F.col("n"), sizes[d], total) for i, d in enumerate(domains)]
    told = counted.filter(functools.reduce(lambda x, y: x | y, [e >= MIN_EVIDENCE for e in evidence]))
    chance = [(F.col(f"n{i}") + 0.5) / (sizes[d] + 1.0) for i, d in enumerate(domains)]
    words = stored(
        told.select(
            "word", *[F.round((F.log(p) - F.log(1 - p)) * SCALE).cast("long").alias(f"w{i}") for i, p in enumerate(chance)],
            *[F.log(1 - p).alias(f"absent{i}") for i, p in enumerate(chance)],
        ),
        "words",
    )
    absent = words.agg(*[F.coalesce(F.sum(f"absent{i}"), F.lit(0.0)) for i in range(len(domains))]).first()
    prior = [math.log(sizes[d] / total) + absent[i] for i, d in enumerate(domains)]
    return {"domains": domains, "prior": prior, "words": words.drop(*[f"absent{i}" for i in range(len(domains))])}


def _evidence(inside: Column, n: Column, size: int, total: int) -> Column:
    """G squared of a word that ``inside`` of a domain's ``size`` rows and ``n`` of all ``total`` hold."""
    cells = [
        (inside, n * (size / total)), (n - inside, n * (1 - size / total)),
        (size - inside, (total - n) * (size / total)), (total - size - (n - inside), (total - n) * (1 - size / total)),
    ]
    parts = [F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells]
    return 2 * functools.reduce(lambda x, y: x + y, parts)


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _keyed(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text."""
    body = F.coalesce(text, F.lit(""))
    return [F.xxhash64(F.lit(k), body).alias(name) for k, name in enumerate(_KEY)]


def text_posteriors(docs: DataFrame, model: dict) -> DataFrame:
    """Of each distinct text of ``docs`` (text): its key, n_rows, n_tokens and posterior; stored.

    The distinct words of a row meet the model's words in a join, and their log-odds are summed by
    text: before the shuffle there is one row a text, however many words. Every row also has the
    empty word, which no text has, to be counted by. Sums are of whole numbers, hence the same in
    any order. posterior has one double per domain of the model, summing to 1.
    """
    k = range(len(model["domains"]))
    found = words_of(F.col("text"))
    rows = docs.select(*_keyed(F.col("text")), found.alias("found"))
    rows = rows.select(
        *_KEY, F.size("found").cast("long").alias("n_tokens"),
        F.explode(F.array_append(F.array_distinct("found"), F.lit(""))).alias("word"),
    )
    marked = docs.sparkSession.range(1).select(F.lit("").alias("word"), *[F.lit(0).cast("long").alias(f"w{i}") for i in k])
    words = marked if model["words"] is None else stored(model["words"].unionByName(marked), "words")
    summed = rows.join(words, "word").groupBy(*_KEY).agg(
        F.count_if(F.col("word") == "").alias("n_rows"), F.max("n_tokens").alias("n_tokens"),
        *[F.sum(f"w{i}").alias(f"w{i}") for i in k],
    )
    scores = F.array(*[F.lit(float(p)) + F.col(f"w{i}") / F.col("n_rows") / float(SCALE) for i, p in zip(k, model["prior"])])
    parts = F.transform("_scores", lambda x: F.exp(x - F.array_max("_scores")))
    told = summed.withColumn("_scores", scores).withColumn("_parts", parts)
    whole = functools.reduce(lambda x, y: x + y, [F.col("_parts")[i] for i in k])
    posterior = F.array(*[F.col("_parts")[i] / whole for i in k])
    return stored(told.select(*_KEY, "n_rows", "n_tokens", posterior.alias("posterior")), "posteriors")


def fit_rates(rows: DataFrame, domains: list[str], targets: dict[str, float]) -> tuple[list[list[float]], float]:
    """The steps of the fit and the step size, from which ``rate_of`` makes every row's rate.

    ``rows`` has n_tokens, posterior and n_rows (how many alike it stands for). ``targets`` are weights; their sum need not be 1.
    A step holds, per domain, the error at that time divided by the domain's tokens at rate 1,
    and its momentum: the next slope is taken ahead of the rates, along the way they came. The
    budget of tokens is that of rate 1 for all. A domain without tokens, or
    without a target, is left out of the errors. Rates are stored every STORED_STEPS steps, so that
    a pass replays a few steps only. Warns if the targets are not met after MAX_STEPS.
    """
    k = range(len(domains))
    tokens = [F.col("n_tokens") * F.col("n_rows") * F.col("posterior")[i] for i in k]
    sums = rows.agg(
        *[F.coalesce(F.sum(t), F.lit(0.0)).alias(f"s{i}") for i, t in enumerate(tokens)],
        *[F.coalesce(F.sum(tokens[i] * F.col("posterior")[j]), F.lit(0.0)).alias(f"g{i}_{j}") for i in k for j in k],
    ).first()
    size = [sums[f"s{i}"] for i in k]
    weight = sum(targets.get(domains[i], 0.0) for i in k if size[i] > 0)
    goal = [sum(size) * targets.get(domains[i], 0.0) / weight if weight and size[i] > 0 else 0.0 for i in k]
    active = [i for i in k if goal[i] > 0]
    # the largest row sum bounds the largest eigenvalue of the scaled Gram matrix
    bound = max((sum(sums[f"g{i}_{j}"] / math.sqrt(size[i] * size[j]) for j in active) for i in active), default=1.0)
    pace = 1.0 / bound
    steps: list[list[float]] = []
    state, done = rows.select("n_tokens", "n_rows", "posterior", F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead")), 0
    n_files = max(1, math.ceil(rows.count() / STATE_ROWS))
    for number in range(MAX_STEPS + 1):
        rate, ahead = _rate_and_ahead(F.col("posterior"), steps[done:], pace, ("rate", "ahead"))
        at = state.select("n_tokens", "n_rows", "posterior", rate.alias("rate"), ahead.alias("ahead"))
        if number % STORED_STEPS == 0:
            state, done = stored(at.coalesce(n_files), "rates"), number
            at = state
        now = at.agg(*[
            F.coalesce(F.sum(tokens[i] * F.col(c)), F.lit(0.0)).alias(f"{c}{i}") for c in ("rate", "ahead") for i in k
        ]).first()
        if all(abs(now[f"rate{i}"] - goal[i]) <= TOLERANCE * goal[i] for i in active):
            return steps, pace
        if number < MAX_STEPS:
            errors = [(now[f"ahead{i}"] - goal[i]) / size[i] if i in active else 0.0 for i in k]
            steps.append([*errors, number / (number + 3)])
    missed = {domains[i]: round(now[f"rate{i}"] / goal[i], 4) for i in active}
    warnings.warn(f"targets not met after {MAX_STEPS} steps; tokens as a part of the target: {missed}", stacklevel=2)
    return steps, pace


def _rate_and_ahead(
    posterior: Column, steps: list[list[float]], pace: float, start: tuple[str, str] | None = None
) -> tuple[Column, Column]:
    """The rate after all steps, and the place ahead of it where the next slope is taken.

    ``start`` names the columns that hold both beforehand; without it, both are 1.
    """
    before = [F.col(c) for c in start] if start else [F.lit(1.0), F.lit(1.0)]
    if not steps:
        return tuple(before)
    start = F.struct(before[0].alias("rate"), before[1].alias("ahead"))
    moves = F.array(*[_doubles(step) for step in steps])

    def move(state, step):
        errors = F.slice(step, 1, len(steps[0]) - 1)
        slope = F.aggregate(F.zip_with(posterior, errors, lambda p, e: p * e), F.lit(0.0), lambda a, x: a + x)
        rate = F.greatest(F.lit(0.0), state["ahead"] - F.lit(pace) * slope)
        return F.struct(
            rate.alias("rate"), (rate + F.element_at(step, -1) * (rate - state["rate"])).alias("ahead")
        )

    state = F.aggregate(moves, start, move)
    return state["rate"], state["ahead"]


def rate_of(posterior: Column, steps: list[list[float]], pace: float) -> Column:
    """The rate after all steps, begun at 1 and kept from falling below 0."""
    return _rate_and_ahead(posterior, steps, pace)[0]


def text_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """Of each distinct text of ``docs``: its key, n_tokens, posterior and rate. Runs jobs when called."""
    named = labels.select("doc_id", label_domain(F.col("quality"), F.col("toxic")).alias("domain"))
    model = fit_classifier(docs.select("doc_id", "text").join(named, "doc_id").select("text", "domain"))
    texts = text_posteriors(docs, model)
    steps, pace = fit_rates(texts, model["domains"], targets or TARGETS)
    return stored(texts.select(*_KEY, "n_tokens", "posterior", rate_of(F.col("posterior"), steps, pace).alias("rate")), "rates")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) with n_tokens, posterior, rate and copies.

    ``labels`` (doc_id, quality, toxic) names the domain of some rows. A document's posterior
    is an array in the order of the domains' names. copies is the rate rounded up or down by a
    hash of the document, so that its mean is the rate. A null text has no tokens. Without
    usable labels every document is in the one domain ``all``. Repeated rows get equal rates;
    labels that repeat a doc_id count once each. Columns of ``docs`` with the names of added
    ones are replaced. Runs jobs when called.

    Words are looked up once: the rates come to the documents by a join on two hashes of the
    text. Both sides are tables, so Spark can split a text that very many rows hold; the text
    itself only moves if it is asked for.
    """
    added = ("n_tokens", "posterior", "rate", "copies")
    rates = text_rates(docs.select("doc_id", "text"), labels, targets)
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    keyed = docs.select(*kept, *_keyed(F.col("text")), unit.alias("_unit"))
    told = keyed.join(rates, list(_KEY)).withColumn("copies", F.floor(F.col("rate") + F.col("_unit")).cast("long"))
    return told.drop(*_KEY, "_unit")


def draw(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` that are drawn, with rate and copies (how often each is drawn)."""
    added = ("n_tokens", "posterior", "rate", "copies")
    names = [c for c in docs.columns if c not in added]
    drawn = mix(docs, labels, targets).filter("copies > 0")
    return drawn.select(*[F.col(f"`{c}`") for c in names], "rate", "copies")
