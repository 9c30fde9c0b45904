"""The pipeline's rows against a brute-force run over sf0.001."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from .test_jaccard import components
from .test_lines import brute
from .test_quality import base
from tokenizers import Tokenizer

import corpus_pipeline
from costbook.llm import mixing, quality

SF = "/root/testdata/sf0.001"


def _holds(rule, q):
    return all((q[n] > at) if above else (q[n] <= at) for n, above, at in rule)


def _cut(rows):
    gone = brute([(r["doc_id"], r["text"]) for r in rows], 20)
    out = []
    for r in rows:
        lines, kept, k = r["text"].split("\n"), [], 0
        for x in lines:
            if not x.split():
                kept.append(x)
            else:
                if k not in gone[r["doc_id"]]:
                    kept.append(x)
                k += 1
        if not gone[r["doc_id"]] or len(gone[r["doc_id"]]) < k:
            out.append({**r, "text": "\n".join(kept), "n_chars": len("\n".join(kept)) if gone[r["doc_id"]] else r["n_chars"]})
    return out


def _mix(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r["doc_id"], r["text"], r["source"]) for r in rows])
    copies = {r[0]: r[5] for r in con.execute(mixing.oracle_sql()).fetchall()}
    return [r for r in rows for _ in range(copies[r["doc_id"]])]


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [r.asDict() for r in docs.collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "ngram jaccard", "mix sources", "pack"]

    # 1: the learned list, applied row by row
    rules = quality.learn(docs, labels).rules
    q = {r["doc_id"]: r["q"] for r in docs.select("doc_id", quality.measure(F.col("text")).alias("q")).collect()}
    want = []
    for r in rows:
        b = base(r["text"])
        if b[0] >= 50 and 100 * b[4] <= 50 * b[0] and not any(_holds(x, q[r["doc_id"]]) for x in rules):
            want.append(r)
    steps = [want]
    steps.append(_cut(steps[-1]))
    stay = {i for i, _, least in components([(r["doc_id"], r["text"]) for r in steps[-1]], 5, 80) if i == least}
    steps.append([r for r in steps[-1] if r["doc_id"] in stay])
    steps.append(_mix(steps[-1]))

    got = docs
    key = lambda r: (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
    for (name, stage), want in zip(corpus_pipeline.STAGES, steps):
        got = stage(spark, got, SF)
        assert got.columns == docs.columns, name
        assert sorted(map(key, got.collect())) == sorted(map(key, want)), name
        assert want, name

    # 5: every id of every copy in exactly one piece, in gapless sequences
    pieces = corpus_pipeline.run(spark, SF).toPandas()
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: np.array(own.encode(r["text"], add_special_tokens=False).ids + [1], "<u4") for r in steps[-1]}
    taken = {}
    for r in steps[-1]:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
    assert set(pieces.doc_id) == set(ids)
    for doc, some in pieces.groupby("doc_id"):
        assert some.length.sum() == taken[doc] * len(ids[doc])
        for p in some.itertuples():
            assert zlib.crc32(ids[doc][p.start:p.start + p.length].tobytes()) == p.ids_crc32
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 2048


def test_odd_rows_pass_every_stage(spark, odd, tmp_path):
    spark.createDataFrame([(1, 1), (None, 0), (9, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, str(tmp_path)).columns == rows.columns, name
            if name != "quality rules":
                assert stage(spark, rows, str(tmp_path)).count() <= 3 * rows.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path)).count() >= rows.count()
    # exact repeats stay once after the near-duplicate stage; null ids are not lost
    out = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, odd, str(tmp_path)).collect()]
    assert out.count(5) == 0 and out.count(4) == 1 and out.count(None) == 1


def test_near_duplicates_keep_rows_not_ids(spark, docs, tmp_path):
    """Null and repeated ids: of each class one row stays, whatever ids the others bear."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(4, a, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (None, a, "en", "s"), (None, c, "en", "s"), (5, b, "de", "r"), (5, b, "de", None)]
    runs = [sorted(map(str, corpus_pipeline.near_duplicates(spark, docs(rows).repartition(n), str(tmp_path)).collect())) for n in (1, 3)]
    assert runs[0] == runs[1]
    out = corpus_pipeline.near_duplicates(spark, docs(rows), str(tmp_path)).collect()
    assert sorted((r["doc_id"] or -1, r["text"], r["lang"]) for r in out) == sorted([(4, a, "en"), (5, b, "de"), (-1, c, "en")])
