from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from costbook.llm import langid
from costbook.llm.queries import QUERIES


def plain(text):
    """1- to 3-grams of the words, with word edges, as strings."""
    out = Counter()
    word = []
    for c in [*text.lower(), " "]:
        if c.isalpha():
            word.append(c)
        elif word:
            w = ["_", *word, "_"]
            out.update(word)
            out.update(a + b for a, b in zip(w, w[1:]))
            out.update(a + b + c for a, b, c in zip(w, w[1:], w[2:]))
            word = []
    return out


def test_grams_equal_plain_counts():
    for text in ("Ab, abc a", "é漢 naïve 123 x", "", "12 !", "a b", "\U0001f600a\U0001f600"):
        codes, counts = langid.grams(text)
        assert sorted(counts) == sorted(plain(text).values())
        assert len(set(codes)) == len(codes)


def test_nearest_profile_and_unknown(docs):
    rows = [(i, "the cat and the dog went there with them " * 3, "en", "s") for i in range(20)]
    rows += [(20 + i, "der hund und die katze gingen nicht dorthin " * 3, "de", "s") for i in range(20)]
    df = docs(rows)
    profiles = langid.learn(df, F.lit(True))
    test = docs([(1, "and the other cat was there"), (2, "und die andere katze nicht"), (3, None), (4, "123 !?"), (5, "")])
    out = {r["doc_id"]: r for r in langid.predict(test, profiles).collect()}
    assert [out[i]["lang_pred"] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[3]["score"] == 0
    # the distance itself, plainly
    own = [g for g, _ in sorted(plain("und die").items(), key=lambda x: -x[1])]
    assert len(langid.ranked(*langid.grams("und die"), 400)) == len(own)


def test_odd_rows_and_no_training(odd, docs):
    profiles = langid.learn(odd, F.lit(True))
    assert langid.predict(odd, profiles).count() == odd.count()
    out = langid.predict(odd, langid.learn(docs([]), F.lit(True))).collect()
    assert {r["lang_pred"] for r in out} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op6_rank_language"](spark, sf).filter("held_out")
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").filter("lang IS NOT NULL")
    right = np.mean([r["lang"] == r["lang_pred"] for r in out.join(truth, "doc_id").collect()])
    assert right > 0.97
