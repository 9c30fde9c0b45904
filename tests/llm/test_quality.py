import re
from collections import Counter

from pyspark.sql import functions as F

from costbook.llm import quality

W = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = W.findall(t)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(g)
    covered = {i + k for i, x in enumerate(g) if n[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if W.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def measured(df):
    q = F.col("q")
    return df.select("text", quality.measure(F.col("text")).alias("q")).select(
        "text", *[q[c].alias(c) for c in quality.BASE], quality.base_failed(q).alias("failed")).collect()


def test_base_measures(odd, docs):
    texts = ["a b c a b c a b c", "x y z x y", "l1 a\nl1 a\n\n l1 a\nz", "# $a% |&|", "漢字 éé \U0001f600", "a b " * 500, "one\x0btwo\x0cthree\x0dfour"]
    for r in measured(odd) + measured(docs(texts)):
        want = base(r["text"])
        assert tuple(r[c] for c in quality.BASE) == want
        assert r["failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def _labelled(docs, spark, n=300):
    good = [(i, " ".join(f"w{i}x{k}" for k in range(60)) + ".") for i in range(n)]
    bad = [(n + i, " ".join(f"w{i}y{k}###" for k in range(60))) for i in range(n // 3)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    return docs(good + bad), labels, n


def test_learned_list_rejects_bad_and_keeps_good(docs, spark):
    df, labels, n = _labelled(docs, spark)
    rules = quality.learn(df, labels)
    assert rules.rules  # several measures tell these apart: the verdict counts, not which one was taken
    out = df.select("doc_id", quality.measure(F.col("text")).alias("q")).select("doc_id", rules.verdict(F.col("q")).alias("ok"))
    assert {r["doc_id"] for r in out.collect() if r["ok"]} == set(range(n))


def test_no_labels_learns_nothing(docs, spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learn(odd, none).rules == []
    odd_labels = spark.createDataFrame([(None, 1), (9, None), (9, 1)], "doc_id long, quality int")
    assert quality.learn(odd, odd_labels).rules == []
    assert quality.learn(docs([]), odd_labels).rules == []


def test_plan_is_native(docs):
    plan = docs(["a"]).select(quality.measure(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
