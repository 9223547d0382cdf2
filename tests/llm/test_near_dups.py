from __future__ import annotations

import random
import re

import pytest

from farewind.llm import near_dups
from farewind.llm.components import connected_components
from tests.llm.tables import docs_df, documents, prose


def brute(rows, size, pct=80):
    """doc index -> (n_shingles, component id) by comparing all pairs."""
    sets = []
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = None if doc_id is None else least[root(i)]
        out.append((doc_id, len(sets[i]), component, doc_id is None or doc_id == component))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [2, 5])
def test_awkward_rows_match_brute_force(spark, size):
    rows = [(r[0], r[1]) for r in documents()]
    assert collected(near_dups.deduplicate(docs_df(spark), size=size)) == brute(rows, size)


def family(n, seed=0):
    """Texts around one original: near enough to it, not always to each other."""
    rng = random.Random(seed)
    base = prose(seed, 300).split()
    rows = [(500, " ".join(base))]
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice([3, 8, 14])):
            words[rng.randrange(300)] = f"w{rng.randrange(10**6)}"
        rows.append((501 + i, " ".join(words)))
    return rows


def test_a_large_family_keeps_all_links(spark):
    rows = family(60) + family(20, seed=9)
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(near_dups.deduplicate(df, size=2)) == brute(rows, 2)


def test_the_rest_of_a_bucket_is_compared_whole(spark):
    """Without a pivot round every pair in a bucket is compared; the result is the same."""
    rows = [(i, text) for i, (_, text) in enumerate(family(25))]
    df = spark.createDataFrame(rows, "id long, text string")
    schema = "id bigint, node bigint, n_shingles bigint, bands array<bigint>, s0 bigint, s1 bigint, s2 bigint, s3 bigint"
    features = df.mapInArrow(near_dups._per_text(2, False), schema)

    def sets_of(_):
        return df.mapInArrow(near_dups._per_text(2, True), "id bigint, node bigint, shingles array<bigint>").select("node", "shingles")

    whole = near_dups.link_classes(features, sets_of, 80, rounds=0)
    pivots = near_dups.link_classes(features, sets_of, 80)
    groups = lambda df: sorted(r["count"] for r in df.groupBy("component").count().collect())
    assert groups(whole) == groups(pivots)


def test_keep_one(spark):
    docs = docs_df(spark)
    kept = near_dups.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    expected = {}
    for doc_id, _, _, stays in brute([(r[0], r[1]) for r in documents()], 5):
        if stays and doc_id is not None:
            expected[doc_id] = expected.get(doc_id, 0) + 1
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, n in expected.items() for _ in range(n))
    assert ids.count(None) == 2


def test_empty(spark):
    docs = docs_df(spark, [])
    assert near_dups.deduplicate(docs).collect() == []
    assert near_dups.keep_one(docs).collect() == []


def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(5, 5), (None, 3), (2000, 2001), (2000, 2001)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert found == {i: root(i) for i in parent}
    assert connected_components(df.filter("a > 9000")).count() == 0


def test_very_long_texts_barely_alike_are_linked_in_the_last_comparison(spark):
    """Hundreds of their shingles coincide in 31 bits; no pivot round comes before."""
    words = [f"w{i}" for i in range(200_001)]
    other = words[:]
    other[:21_800] = [f"v{i}" for i in range(21_800)]
    shared = 200_000 - 21_800
    assert 80 <= 100 * shared / (400_000 - shared) < 81
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "id long, text string")
    kind = f"id bigint, node bigint, n_shingles bigint, bands array<bigint>, {' bigint, '.join(near_dups.SKETCH)} bigint"
    classes = rows.mapInArrow(near_dups._per_text(2, False), kind).drop("id")
    sets = rows.mapInArrow(near_dups._per_text(2, True), "id bigint, node bigint, shingles array<bigint>").drop("id")
    found = near_dups.link_classes(classes, lambda involved: sets, 80, rounds=-1)
    assert found is not None and found.count() == 2
