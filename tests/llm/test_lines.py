import random

import pytest

from costbook.llm import lines
from costbook.llm.queries import ORACLE, QUERIES


def brute(rows, min_words):
    """Deleted line numbers by document, from windows of every length."""
    seqs = {i: [x for x in t.split("\n") if x.split()] for i, t in rows if t is not None}
    gone = {i: set() for i, _ in rows}
    for n in range(1, max(map(len, seqs.values()), default=0) + 1):
        first = set()
        for i in sorted(seqs):
            for p in range(len(seqs[i]) - n + 1):
                w = tuple(seqs[i][p:p + n])
                if w in first and sum(len(x.split()) for x in w) >= min_words:
                    gone[i] |= set(range(p, p + n))
                first.add(w)
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_deleted_lines_equal_brute_force(docs, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"p{k}w{j}" for j in range(rng.randrange(1, 9))) for k in range(25)]
    rows = []
    for i in range(40):
        text = [rng.choice(pool) if rng.random() < 0.5 else f"own line {i} {k}" for k in range(rng.randrange(1, 14))]
        rows.append((i, "\n".join(x if rng.random() < 0.9 else x + "\n \n" for x in text)))
    rows += [(100 + k, rows[k][1]) for k in range(5)]
    want = brute(rows, 6)
    for r in lines.dedup(docs(rows), min_words=6).collect():
        text = dict(rows)[r["doc_id"]]
        assert set(r["line_dedup"]["deleted"]) == want[r["doc_id"]]
        kept, k = [], 0
        for x in text.split("\n"):
            if not x.split():
                kept.append(x)
            else:
                if k not in want[r["doc_id"]]:
                    kept.append(x)
                k += 1
        assert r["text"] == "\n".join(kept)


def test_passage_of_fifty_words_goes_from_later_documents(docs):
    passage = "\n".join(" ".join(f"q{k}x{j}" for j in range(9)) for k in range(6))
    rows = [(i, f"start {i} a\n{passage}\nend {i} b") for i in range(8)]
    out = {r["doc_id"]: r["text"] for r in lines.dedup(docs(rows)).collect()}
    assert out[0] == rows[0][1] and all(out[i] == f"start {i} a\nend {i} b" for i in range(1, 8))


def test_odd_rows_and_empty_table(odd, docs):
    out = lines.dedup(odd)
    assert out.columns == [*odd.columns, "line_dedup"] and out.count() == odd.count()
    assert sorted(r["text"] or "" for r in out.collect()) == sorted(r["text"] or "" for r in odd.collect())
    assert lines.dedup(docs([])).count() == 0


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = QUERIES["op9_line_runs"](spark, sf)
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(ORACLE["op9_line_runs"]).fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("min_words", [1, 6, 20])
def test_runs_of_every_length_equal_brute_force(docs, min_words):
    rng = random.Random(min_words)
    pool = [" ".join(f"p{k}w{j}" for j in range(rng.randrange(1, 9))) for k in range(60)]
    rows = []
    for i in range(60):
        text = []
        while len(text) < 12:
            at, n = rng.randrange(60), rng.randrange(1, 9)
            text += pool[at:at + n] if rng.random() < 0.7 else [f"own line {i} {len(text)}"]
        rows.append((i, "\n".join(text)))
    rows += [(100, "\n".join(["a"] * 30)), (101, "\n".join(["a"] * 19)), (102, "x\n" + "\n".join(["a"] * 25))]
    want = brute(rows, min_words)
    assert {r["doc_id"]: set(r["line_dedup"]["deleted"]) for r in lines.dedup(docs(rows), min_words=min_words).collect()} == want


@pytest.mark.parametrize("words", [(9, 9, 9), (40, 5, 6), (5, 6, 40), (1,) * 21])
def test_run_whose_windows_of_two_powers_are_short(docs, words):
    run = "\n".join(" ".join(f"r{k}y{j}" for j in range(n)) for k, n in enumerate(words))
    rows = [(i, f"start {i} a\n{run}\nend {i} b") for i in range(3)]
    out = {r["doc_id"]: r["text"] for r in lines.dedup(docs(rows)).collect()}
    assert out == {0: rows[0][1], 1: "start 1 a\nend 1 b", 2: "start 2 a\nend 2 b"}
