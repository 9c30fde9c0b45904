import random

import numpy as np
from pyspark.sql import functions as F

from costbook.llm import toxicity


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = toxicity.Network(["bad", "evil"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = net.inputs(["good", "bad", "evil", "day", "x"])
    ids = rng.integers(0, 5, (7, 6))
    ids[5:, 0] = ids[2:, 1] = -1
    y = np.array([0, 1, 0, 1, 1, 0], float)

    def loss():
        x = net.scores(ids, net._embed(*words))
        return float((np.log1p(np.exp(-x)) * y + np.log1p(np.exp(x)) * (1 - y)).sum())

    grad, _ = net.gradients(ids, words, y, np.ones(6))
    for k, v in net.p.items():
        flat, g = v.reshape(-1), grad[k].reshape(-1)
        for i in np.argsort(-np.abs(g))[:4]:
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-4 - g[i]) < 1e-3 * max(1, abs(g[i])), k


def test_windows_cover_and_overlap():
    for n in (0, 1, 39, 40, 41, 70, 71, 400):
        starts = toxicity.window_starts(n, 40, 30)
        covered = {p for a in starts for p in range(a, min(a + 40, n))}
        assert covered == set(range(n))
        assert all(b - a <= 30 for a, b in zip(starts, starts[1:]))


def test_learns_and_scores(docs, spark):
    rng = random.Random(4)
    calm = ["river", "stone", "cloud", "table", "green", "paper", "light", "house", "music", "bread"]
    rude = ["grumbolt", "snarkel", "vexnog"]
    rows, labels = [], []
    for i in range(500):
        w = rng.choices(calm, k=rng.randrange(20, 200))
        if i % 3 == 0:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(rude)
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0)))
    df, y = docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    net = toxicity.learn(df, y, F.col("doc_id") < 350, rounds=2, steps=120)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(df, net).collect()}
    right = np.mean([(out[i] >= 0.7) == bool(i % 3 == 0) for i in range(350, 500)])
    assert right > 0.95
    late = docs([(1, " ".join(calm * 80) + " grumbolt snarkel " + " ".join(calm * 3)), (2, " ".join(calm * 80))])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(late, net).collect()}
    assert got[1] > 0.7 > got[2]


def test_odd_rows_and_no_labels(odd, docs, spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.learn(odd, none, F.lit(True)) is None
    out = toxicity.score(odd, None).collect()
    assert len(out) == odd.count() and {r["score"] for r in out} == {0.0}
    net = toxicity.Network(["a"])
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(odd, net).collect())
    assert toxicity.score(docs([]), net).count() == 0
