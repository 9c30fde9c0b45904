from pyspark.sql import functions as F

from costbook.llm import common, mixing
from costbook.llm.queries import ORACLE, QUERIES


def fill(sizes, weights, cap):
    """Targets by resharing the excess until none is above."""
    total, target, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w >= cap * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / w
            break
        for i in over:
            target[i] = cap * sizes[i]
            left -= target[i]
            free.discard(i)
    return target


def test_targets_equal_resharing(spark):
    sizes = [5, 100, 1000, 40, 7, 3000, 0, 12]
    rows = [(f"s{i}", s) for i, s in enumerate(sizes[:-1])] + [(None, sizes[-1])]
    got = mixing.source_targets(spark.createDataFrame(rows, "source string, size long"), (5, 2, 1), 3).orderBy("rank").collect()
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3)
    assert got[-1]["source"] is None
    assert all(abs(r["target"] - w) < 1e-6 for r, w in zip(got, want))


def test_mix_follows_targets_and_reruns_agree(docs):
    rows = [(i, "w " * (1 + i * 7 % 40), "en", f"s{i % 5}" if i % 3 else "s0") for i in range(2000)]
    out = [mixing.mix(docs(rows), common.word_count(F.col("text"))).toPandas().sort_values("doc_id") for _ in range(2)]
    assert out[0].equals(out[1]) or (out[0].reset_index(drop=True).equals(out[1].reset_index(drop=True)))
    by = out[0].groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((by.target - by.taken).abs() <= 3 * 40).all()
    assert (out[0].taken <= 3 * out[0]["size"]).all()
    assert out[0].taken.sum() <= out[0]["size"].sum()


def test_odd_rows_and_empty_table(odd, docs):
    out = mixing.mix(odd, common.word_count(F.col("text"))).toPandas()
    assert len(out) == odd.count()
    assert out[out["size"] == 0].taken.sum() == 0
    assert out.source.isna().sum() == 1
    assert mixing.mix(docs([]), common.word_count(F.col("text"))).count() == 0


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = {tuple(r) for r in QUERIES["op1_mix_sources"](spark, sf).collect()}
    assert got == set(con.execute(ORACLE["op1_mix_sources"]).fetchall())


def test_null_ids_are_separate_documents(docs):
    rows = [(None if i % 2 else i, f"d{i} " + "w " * (1 + i * 7 % 40), "en", f"s{i % 3}") for i in range(900)]
    out = mixing.mix(docs(rows), common.word_count(F.col("text"))).toPandas()
    by = out.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((by.target - by.taken).abs() <= 3 * 42).all()
