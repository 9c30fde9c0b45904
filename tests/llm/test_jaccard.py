import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costbook.llm import common, jaccard


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w[i:i + n]) for i in range(len(w) - n + 1)] or ([tuple(w)] if w else []))


def components(rows, n, percent):
    """Brute force over all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets))


def near_copies(seed, groups=12, copies=9, words=120, edits=6):
    rng = random.Random(seed)
    vocab = [f"v{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.randrange(3, words))]
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.randrange(0, edits)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("small", [2, 16])
def test_components_equal_brute_force(docs, monkeypatch, words, percent, small):
    monkeypatch.setattr(jaccard, "SMALL", small)  # 2: most buckets go by stars and what they leave
    rows = near_copies(words + small) + [(1000 + k, f"shared passage of many words in every text number {k}") for k in range(30)]
    out = jaccard.near_duplicates(docs(rows), words=words, percent=percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == components(rows, words, percent)


@pytest.mark.parametrize("least", [1, 32])
def test_large_group_of_varied_copies(docs, monkeypatch, least):
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "LEAST", least)  # 1: most pairs are offered more than once
    rows = near_copies(5, groups=2, copies=70, words=90, edits=9)
    out = jaccard.near_duplicates(docs(rows), words=3, percent=90).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == components(rows, 3, 90)


def test_signatures_never_differ_in_more_bits_than_the_sets_in_ngrams(spark):
    rng = np.random.default_rng(3)
    rows, most = [], []
    for n in (1, 60, 500, 512, 513, 1020, 3000):  # 512 to 513: one is twice as long
        for odd in (0, 1, 7, 40):
            a = np.unique(rng.integers(-2**63, 2**63 - 1, n))
            b = np.unique(np.concatenate([a[odd:], rng.integers(-2**63, 2**63 - 1, odd)]))
            rows.append((jaccard.signature(a).tolist(), jaccard.signature(b).tolist()))
            most.append(len(np.setxor1d(a, b)))
    rows += [(b, a) for a, b in rows]
    small, large = jaccard.signature(a[:512]), jaccard.signature(a[:513])
    rows += [(small.tolist(), large.tolist()), (large.tolist(), small.tolist())]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<long>, b array<long>")
    found = [r[1] for r in df.select("i", jaccard._differing(F.col("a"), F.col("b"))).orderBy("i").collect()]
    assert all(0.7 * m <= f <= m for f, m in zip(found, most + most + [1, 1]))


def test_only_likely_pairs_of_a_large_group_are_compared_in_full(docs, monkeypatch):
    # copies of one text, most too far from each other to link, that share many early n-grams
    rng, compared = random.Random(8), []
    base = [f"v{k}" for k in range(150)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rng.sample(range(100), rng.randrange(2, 6)):
            w[k] = f"x{i}-{k}"
        rows.append((i, " ".join(w)))
    verified = jaccard._verified

    def counted(read, found, pairs, *more):
        compared.append(pairs.count())
        return verified(read, found, pairs, *more)

    monkeypatch.setattr(jaccard, "_verified", counted)
    out = jaccard.near_duplicates(docs(rows), words=3, percent=90).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == components(rows, 3, 90)
    sets = [shingles(t, 3) for _, t in rows]
    linked = sum(100 * len(a & b) >= 90 * len(a | b) for k, a in enumerate(sets) for b in sets[:k])
    assert sum(compared) <= 1.2 * linked + 10, (compared, linked)


def test_rows_that_share_an_id_give_a_class_once(docs):
    rows = [(r, t) for r, t in near_copies(11, groups=3, copies=30, words=90)]
    twice = docs([(i % 5, t) for i, t in rows]).repartition(6)
    out = jaccard.near_duplicates(twice.unionByName(twice), words=3, percent=90)
    alone = [(i, t) for i, t in rows]
    sets = {i: c for i, _, c in components(alone, 3, 90)}
    least = {}
    for i, c in sets.items():
        least[c] = min(least.get(c, 5), i % 5)
    want = sorted((i % 5, least[c]) for i, c in sets.items() if rows[i][1])
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == sorted(want + want)


def test_odd_rows_and_empty_table(odd, docs):
    out = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.near_duplicates(odd).collect()}
    assert out[1, 0] == 1 and out[2, 0] == 2 and out[3, 0] == 3 and out[5, 1] == 4 and out[None, 1] is None
    assert jaccard.near_duplicates(docs([])).count() == 0


def test_connected_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    out = {r["node"]: r["component"] for r in common.connected_components(edges).collect()}
    assert out == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert common.connected_components(edges.filter(F.lit(False))).count() == 0


def test_components_of_stars_need_one_round(spark, monkeypatch):
    staged, names = common.staged, []
    monkeypatch.setattr(common, "staged", lambda df, name: names.append(name) or staged(df, name))
    edges = spark.createDataFrame([(i % 3, i) for i in range(3, 60)] + [(7, 7), (40, 1), (1, 40)], "a long, b long")
    out = {r["node"]: r["component"] for r in common.connected_components(edges).collect()}
    assert out == {i: i % 3 for i in range(60)} and len(names) == 1
    names.clear()
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (8, 4), (20, 21)], "a long, b long")
    out = {r["node"]: r["component"] for r in common.connected_components(chain).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 1, 8: 1, 9: 1, 20: 20, 21: 20}


def test_components_are_computed_again_only_after_more_links(docs, monkeypatch):
    # one group of near copies that all link with the bucket's first member: no later round finds a link
    rows = [(i, " ".join(f"v{k}" for k in range(100)) + f" end{i}") for i in range(12)] + [(50, "a b c d")]
    components_, calls = common.connected_components, []
    monkeypatch.setattr(common, "connected_components", lambda edges: calls.append(1) or components_(edges))
    out = jaccard.near_duplicates(docs(rows), words=3, percent=90).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == components(rows, 3, 90)
    assert len(calls) == 1
