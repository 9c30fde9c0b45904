import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from tools.check_oracle import duck

from costbook.llm import collocations
from costbook.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, longest=3, least=10, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        kept = []
        for p, a in found.items():
            if 100 * inside[p] >= 50 * a:
                continue
            score, _, left, right = min((Fraction(1000000 * a * a, c[p[:k]] * c[p[k:]]).__floor__(), k, c[p[:k]], c[p[k:]])
                                        for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for k, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, k, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("longest,least,shards,bits,held", [(3, 10, 2, 1 << 24, 1 << 22), (3, 3, 3, 64, 500), (4, 4, 1, 1 << 10, 1 << 22)])
def test_equals_brute_force(spark, longest, least, shards, bits, held):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r["text"], r["lang"]) for r in df.select("text", "lang").collect()]
    out = collocations.collocations(df.repartition(5), longest, least, shards=shards, bits=bits, held_words=held)
    assert rows_of(out) == brute(texts, longest, least)


def test_query_equals_sql(spark):
    sql = duck(SF).sql(ORACLE["op11_phrase_collocations"])
    at = [sql.columns.index(c) for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    assert rows_of(QUERIES["op11_phrase_collocations"](spark, SF)) == sorted(tuple(r[i] for i in at) for r in sql.fetchall())


def test_pieces_overlaps_ties_and_cut(docs):
    rows = [(i, "Aa aa aa\taa! x\x0by Ä ä", "en", "s") for i in range(10)] + [(90 + i, "k m, k. m k m", None, None) for i in range(10)]
    df = docs(rows)
    out = rows_of(collocations.collocations(df, least=10))
    assert out == brute([(r[1], r[2]) for r in rows], least=10)
    by = {(r[0], r[2]): r for r in out}
    assert by["en", "aa aa aa"][3] == 20 and ("en", "x y") not in by and ("und", "m k m") in by
    assert ("en", "y Ä ä") in by  # only A to Z are lower-cased


def test_a_phrase_that_starts_late_gets_its_whole_cycle(docs):
    # the words pass the threshold in the last shard only; the phrase is also in the first one
    rows = [(i, "p q" if i % 2 == 0 else "p q p q") for i in range(12)]
    for shards in (1, 2, 3, 4):
        out = rows_of(collocations.collocations(docs(rows).coalesce(1), least=15, shards=shards))
        assert [r[2:6] for r in out] == [("p q", 18, 18, 18)]


def test_phrases_travel_and_are_kept_in_blocks(docs, monkeypatch):
    # 3000 rare phrases in few rows: a row a phrase took most of the time
    staged, merged, sizes = collocations.common.staged, collocations._merged, []

    def seen(df, name):
        out = staged(df, name)
        sizes.append(out.count())
        return out

    def counted(state, found, *rest):
        sizes.append(found.count())
        return merged(state, found, *rest)

    monkeypatch.setattr(collocations.common, "staged", seen)
    monkeypatch.setattr(collocations, "_merged", counted)
    monkeypatch.setattr(collocations, "BUCKETS", 4)
    rows = [(i, f"r{i} s{i} t{i} a b c a b") for i in range(1000)]
    df = docs(rows).coalesce(1)
    assert rows_of(collocations.collocations(df)) == brute([(r[1], "en") for r in rows])
    assert sizes and max(sizes) <= 60


@pytest.mark.parametrize("buckets,block,merged", [(1, 1, 1), (3, 2, 1), (3, 256, 7), (1000, 5, 40), (1, 256, 1)])
def test_blocks_add_up_whatever_their_sizes(monkeypatch, buckets, block, merged):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "MERGED", merged)
    rng = np.random.default_rng(buckets + block)
    kinds = [("en", 1), ("en", 2), ("de", 2), ("", 2), ("de", 0)]
    parts, expected = [], {}

    def put(kind, names, values):
        bucket = np.array([zlib.crc32(n.encode()) % buckets for n in names], np.int32)
        by = np.argsort(bucket, kind="stable")
        fixed = {"bucket": pa.array(bucket[by]), "lang": pa.repeat(kind[0], len(by)), "words": pa.repeat(pa.scalar(kind[1], pa.int32()), len(by))}
        parts.extend(collocations._blocks(bucket[by], fixed, {"phrase": pa.array(names).take(pa.array(by)),
                                                              **{k: v.take(pa.array(by)) for k, v in values.items()}}))

    for kind in kinds:
        names = [f"p{i}" for i in range(40)] if kind[1] else [""]
        for _ in range(3):  # found in three tasks, in scan 1 of shard 1
            n = rng.integers(1, 4, len(names))
            put(kind, names, {"n": pa.array(n), "until": pa.repeat(pa.scalar(2, pa.int32()), len(names))})
            for name, k in zip(names, n):
                expected.setdefault((*kind, name), [0, 0, None, 2])[1] += int(k)
        for name, k in zip(names[::2], rng.integers(0, 9, len(names))):  # kept: c0, perhaps c1 of an earlier count, reach
            e, early = expected[*kind, name], int(k) > 6
            e[0], e[2] = int(k), 0 if early else None
            put(kind, [name], {"c0": pa.array([int(k)]), "c1": pa.array([e[1] if early else None], pa.int64()),
                               "reach": pa.array([e[2]], pa.int32()), "until": pa.array([1], pa.int32())})
    put(("en", 2), ["gone", "stays"], {"c0": pa.array([3, 11]), "c1": pa.array([2, None], pa.int64()),
                                       "reach": pa.array([None, 0], pa.int32()), "until": pa.array([1, 1], pa.int32())})
    expected["en", 2, "stays"] = [11, None, 0, 1]
    types = {"bucket": pa.int32(), "lang": pa.string(), "words": pa.int32(), "phrase": pa.list_(pa.string()), "n": pa.list_(pa.int64()),
             "c0": pa.list_(pa.int64()), "c1": pa.list_(pa.int64()), "reach": pa.list_(pa.int32()), "until": pa.list_(pa.int32())}
    rows = pa.Table.from_pylist([r for b in parts for r in b.to_pylist()], pa.schema(types)).sort_by("bucket")
    got = {}
    for out in collocations._add_up(1, ["c0", "c1"], 8)(rows.to_batches(max_chunksize=3)):
        for r in out.to_pylist():
            assert 0 < len(r["phrase"]) <= block
            for name, c0, c1, reach, until in zip(*(r[k] for k in ("phrase", "c0", "c1", "reach", "until"))):
                assert r["bucket"] == zlib.crc32(name.encode()) % buckets and r["over"] == (reach is not None)
                assert (r["lang"], r["words"], name) not in got
                got[r["lang"], r["words"], name] = [c0 or 0, c1, reach, until]
    for e in expected.values():
        e[2] = 1 if e[2] is None and e[0] + (e[1] or 0) >= 8 else e[2]
    assert got == expected


def test_many_languages(docs):
    rows = [(i, "a b a b. c d", f"l{i % 40}", "s") for i in range(400)]
    assert rows_of(collocations.collocations(docs(rows))) == brute([(r[1], r[2]) for r in rows])


def test_large_counts_stay_exact(spark):
    n = 3_000_000_019
    part = spark.createDataFrame([("en", "a b", 2, n), ("en", "a", 1, n + 7), ("en", "b", 1, n + 5), ("en", "", 0, 9 * n)],
                                 "lang string, phrase string, words int, n long")
    keep = collocations.counts
    try:
        collocations.counts = lambda *a, **k: part
        (row,) = rows_of(collocations.collocations(part))
    finally:
        collocations.counts = keep
    assert row == ("en", 1, "a b", n, n + 7, n + 5, 9 * n, 1000000 * n * n // ((n + 7) * (n + 5)))


def test_odd_rows_and_empty_table(odd, docs):
    texts = [(r["text"], r["lang"]) for r in odd.select("text", "lang").collect()]
    assert rows_of(collocations.collocations(odd)) == brute(texts)
    assert collocations.collocations(docs([])).count() == 0
