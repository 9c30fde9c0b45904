"""Operator 8: near-duplicate embeddings by Euclidean p-stable hashing.

Vectors of one label are normalised and hashed in ``tables`` tables: a table's key is
``hashes`` Gaussian projections, shifted and quantised in steps of ``width``.  Vectors
that share a key in some table are compared by exact cosine in double precision.

With the defaults two vectors at cosine 0.98 (distance 0.2, a sixth of the width) share
a projection's cell with probability 0.867, a table's key with 0.24, and one of 12
tables with 0.96; closer ones more often.  Far pairs (distance 1.41) share a key with
probability 1e-5.

Equal vectors are one class.  A bucket is cut into chunks of ``CHUNK`` classes and
compared chunk by chunk; each block labels the components of its links and returns, per
linked vector, a count of links first seen in that table and one edge to the smallest
node of its component in the block.  These edges join what the block's links join, so
components are exactly the closure of the links found, output grows with the vectors and
not with their pairs, and no bucket is capped.

Edge cases: null labels, null, empty or zero vectors and vectors with null or non-finite
components link with nothing; vectors of different length are not compared; null ids
take part but name no component; repeated rows are copies of each other; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices

CHUNK = 512


def projections(size: int, tables: int, hashes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, size])
    return rng.standard_normal((size, tables * hashes)), rng.uniform(0, width, tables * hashes)


def keys_of(unit: np.ndarray, tables: int, hashes: int, width: float, seed: int) -> np.ndarray:
    """(rows, tables) 64-bit keys of unit vectors."""
    a, b = projections(unit.shape[1], tables, hashes, width, seed)
    cells = np.floor((unit @ a + b) / width).astype(np.int64).view(np.uint64).reshape(len(unit), tables, hashes)
    key = np.zeros((len(unit), tables), dtype=np.uint64)
    for i in range(hashes):
        key = (key ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _hash_rows(tables: int, hashes: int, width: float, seed: int):
    def run(batches):
        for part in slices(batches, 4096):
            nodes, vectors = part.column(0), part.column(1).to_pylist()
            out: list = [None] * len(vectors)
            sizes = np.array([len(v) for v in vectors])
            for n in np.unique(sizes):
                at = np.nonzero(sizes == n)[0]
                x = np.array([vectors[i] for i in at], dtype=np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for i, k in zip(at, keys_of(x, tables, hashes, width, seed)):
                    out[i] = k
            yield pa.RecordBatch.from_arrays([nodes, pa.array(out, pa.list_(pa.int64()))], names=["node", "keys"])

    return run


def _least_linked(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and per column of ``near``, the smallest node of its component (rows are the nodes
    ``left``, columns ``right``).  Every row and column is expanded once."""
    rows, columns = left.copy(), right.copy()
    row_open, column_open = near.any(axis=1), near.any(axis=0)
    for start in np.nonzero(row_open)[0]:
        if not row_open[start]:
            continue
        new, in_rows, in_columns = np.array([start]), [], []
        while len(new):
            row_open[new] = False
            in_rows.append(new)
            met = np.nonzero(near[new].any(axis=0) & column_open)[0]
            if not len(met):
                break
            column_open[met] = False
            in_columns.append(met)
            new = np.nonzero(near[:, met].any(axis=1) & row_open)[0]
        r, c = np.concatenate(in_rows), np.concatenate(in_columns)
        rows[r] = columns[c] = min(left[r].min(), right[c].min())
    return rows, columns


def _compare(threshold: float):
    """Rows sorted by block (table, bucket, chunk pair) to (node, other, links): a count or an edge."""

    def solve(rows):
        table, side_of = rows["table"][0], np.array(rows["side"])
        keys = np.array(rows["keys"], dtype=np.int64).reshape(len(side_of), -1)
        x = np.array(rows["vector"], dtype=np.float64)
        scale = np.abs(x).max(axis=1, keepdims=True)
        x = x / scale
        norm = np.linalg.norm(x, axis=1)
        node, copies = np.array(rows["node"], dtype=np.int64), np.array(rows["copies"], dtype=np.int64)
        diagonal = side_of[0] == 2
        left = np.nonzero(side_of != 1)[0]
        right = left if diagonal else np.nonzero(side_of == 1)[0]
        if not len(left) or not len(right):
            return
        near = (x[left] @ x[right].T) / (norm[left][:, None] * norm[right][None, :]) >= threshold
        for t in range(table):  # pairs that an earlier table has compared already
            near &= keys[left, t][:, None] != keys[right, t][None, :]
        if diagonal:
            near |= near.T  # the two products of a pair may differ in their last bit
            np.fill_diagonal(near, False)
            # a column stands for the same vector as its row: linked here, so that both are of one component
            lows = _least_linked(near | np.diag(near.any(axis=1)), node[left], node[left])
        else:
            lows = _least_linked(near, node[left], node[right])
        for side, other, hits, low in ((left, right, near, lows[0]), (right, left, near.T, lows[1]))[:1 if diagonal else 2]:
            some = hits.any(axis=1)
            if some.any():
                yield node[side[some]], low[some], (hits @ copies[other])[some]

    def run(batches):
        block, rows = None, {}
        names = ("table", "side", "keys", "vector", "node", "copies")

        def done():
            if rows and len(rows["node"]) > 1:
                for node, low, links in solve(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(low), pa.array(links)],
                                                     names=["node", "other", "links"])

        for part in slices(batches, 2048):
            marks = part.column("block").to_pylist()
            columns = {c: part.column(c).to_pylist() for c in names}
            at = 0
            while at < len(marks):
                if marks[at] != block:
                    yield from done()
                    block, rows = marks[at], {c: [] for c in names}
                end = at
                while end < len(marks) and marks[end] == block:
                    end += 1
                for c in names:
                    rows[c] += columns[c][at:end]
                at = end
        yield from done()

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", tables: int = 12, hashes: int = 10, width: float = 1.2, seed: int = 1) -> DataFrame:
    """Per row: the id, n_links, component_id (smallest id reachable by links) and kept."""
    v = F.col("vector")
    sound = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("node", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("label", "vector")))
    rows = common.staged(rows, "vectors")
    classes = common.staged(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"),
        F.min("id").alias("least")), "vector-classes")
    keyed = common.staged(classes.select("node", "vector").mapInArrow(
        _hash_rows(tables, hashes, width, seed), "node long, keys array<long>"), "vector-keys")
    buckets = keyed.join(classes.select("node", "label", F.size("vector").alias("size")), "node").select(
        "node", "label", "size", F.posexplode("keys").alias("table", "key"))
    bucket = ["label", "size", "table", "key"]
    counts = buckets.groupBy(*bucket).agg(F.count("*").alias("members")).filter("members > 1")
    # a bucket's members are dealt to chunks by hash; every pair of chunks is one block
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    dealt = buckets.join(counts, bucket).withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("node", "table"), F.col("chunks").cast("long")).cast("int"))
    blocks = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("chunk", "with"), F.greatest("chunk", "with")
    blocks = blocks.select("node", "table", F.xxhash64(*bucket, low, high).alias("block"),
                           F.when(F.col("chunk") == F.col("with"), 2).when(F.col("chunk") < F.col("with"), 0).otherwise(1).alias("side"))
    full = blocks.join(keyed, "node").join(classes.select("node", "vector", "copies"), "node")
    full = full.repartition("block").sortWithinPartitions("block", "node")
    found = common.staged(full.select("block", "table", "side", "keys", "vector", "node", "copies").mapInArrow(
        _compare(threshold), "node long, other long, links long"), "vector-links")
    label = common.connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = classes.select("node", "copies", "least").join(linked, "node", "left").join(label, "node", "left")
    of = of.withColumn("component", F.coalesce("component", "node"))
    names = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(names, "component").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.join(of, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).cast("long").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
