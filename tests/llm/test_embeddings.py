import numpy as np
import pytest

from costbook.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    n, up = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x, a in rows:
        for j, y, b in rows:
            if i != j and a == b and a is not None and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                n[i] += 1
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return n, {i: root(i) for i in up}


def vectors(seed, groups=25, copies=8, noise=0.02, size=32):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(groups):
        base = rng.standard_normal(size)
        for c in range(rng.integers(1, copies)):
            x = base if c % 3 == 2 else base + noise * rng.standard_normal(size)
            rows.append((k, [float(v) for v in np.float32(x)], int(g % 4)))
            k += 1
    return rows


@pytest.mark.parametrize("chunk", [3, 512])
def test_links_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)  # 3: buckets in many blocks
    rows = vectors(1)
    n, least = brute(rows)
    out = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(out[i]["n_links"] <= n[i] for i in n)
    assert sum(r["n_links"] for r in out.values()) >= 0.9 * sum(n.values()) > 0
    assert np.mean([out[i]["component_id"] == least[i] for i in n]) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(300):  # pairs whose cosine is just over 0.98
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), k % 3), (2 * k + 1, (0.981 * a + np.sqrt(1 - 0.981 ** 2) * b).tolist(), k % 3)]
    out = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).filter("n_links > 0").count()
    assert out >= 0.9 * 600


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], 2), (None, [1.0, 0.0], 1),
            (11, [2.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1)]
    out = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in out)
    alone = [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)]
    assert got == sorted([(0, 4, 1), (1, 4, 1), (1, 4, 1), (2, 4, 1), (11, 4, 1), *alone])
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def chains(groups=40, length=7, step=10):
    """Per label a chain in the plane: only neighbours, ``step`` degrees apart, are linked."""
    angle = np.deg2rad(step * np.arange(length))
    return [(g * length + k, [float(np.cos(a + g)), float(np.sin(a + g))], g) for g in range(groups) for k, a in enumerate(angle)]


@pytest.mark.parametrize("chunk", [2, 512])
def test_components_are_the_closure_of_the_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rows = chains()
    n, least = brute(rows)
    # one projection and a wide cell: a label is one bucket, so that every link is found
    found = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), tables=1, hashes=1, width=1e9)
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()}
    assert out == {i: (n[i], least[i]) for i in n}


def test_block_joins_a_chain_whose_ends_have_the_small_nodes():
    import pyarrow as pa

    at = {1: 0, 3: 1, 4: 2, 2: 3}  # the links 1-3, 3-4, 4-2
    nodes = sorted(at)
    angle = [np.deg2rad(10 * at[i]) for i in nodes]
    batch = pa.RecordBatch.from_pydict({
        "block": [7] * 4, "table": [0] * 4, "side": [2] * 4, "keys": [[5]] * 4,
        "vector": [[float(np.cos(a)), float(np.sin(a))] for a in angle], "node": nodes, "copies": [1] * 4})
    found = [r for part in embeddings._compare(0.98)([batch]) for r in part.to_pylist()]
    assert {r["node"]: (r["other"], r["links"]) for r in found} == {1: (1, 1), 2: (1, 1), 3: (1, 2), 4: (1, 2)}
