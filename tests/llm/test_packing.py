import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from costbook.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def padding(n, window):
    return 0 if n & (n - 1) == 0 else window - n


def cheapest(ends, sentences, window, sentence_cost):
    """All ways to cut, for small streams."""
    inner = sorted({*ends[:-1], *sentences} - {ends[-1]})
    best = None
    for k in range(len(inner) + 1):
        for cut in itertools.combinations(inner, k):
            at = [0, *cut, ends[-1]]
            parts = [b - a for a, b in zip(at, at[1:])]
            if max(parts) <= window:
                cost = sum(padding(p, window) for p in parts) + sum(sentence_cost * (c not in ends) for c in cut)
                best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_optimal(seed):
    rng = np.random.default_rng(seed)
    window = 16
    marks = np.cumsum(rng.integers(1, 12, 12))
    ends = np.array(sorted({*rng.choice(marks, 4, replace=False), marks[-1]}))
    sentences = np.array([m for m in marks if m not in ends])
    got = packing.cuts(ends, sentences, window, 3.0, 9.0)
    parts = np.diff([0, *got])
    cost = sum(padding(p, window) for p in parts) + sum(3 * (c not in ends) for c in got)
    assert max(parts) <= window and got[-1] == ends[-1]
    assert cost == cheapest(list(ends), list(sentences), window, 3)


def test_round_trip_and_digest(spark, docs):
    import random

    rng = random.Random(1)
    rows = [" ".join(rng.choice(["alpha", "beta.", "gamma", "naïve", "漢字", "x\n"]) for _ in range(rng.randrange(0, 3000))) for _ in range(60)]
    rows += ["", None, "a <|endoftext|> b", "no sentence end " * 4000]
    out = packing.pack(docs(rows).coalesce(2), PATH, with_ids=True).toPandas()
    own = Tokenizer.from_file(PATH)
    for i, text in enumerate(rows):
        want = own.encode(text or "", add_special_tokens=False).ids + [1]
        mine = out[out.doc_id == i].sort_values("start")
        assert [x for ids in mine.ids for x in ids] == want
        assert list(mine.start) == [0, *np.cumsum(mine.length)[:-1]] and set(mine.doc_tokens) == {len(want)}
        for r in mine.itertuples():
            assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 2048
    pad = sum(padding(n, 2048) for n in out.groupby("sequence_id").length.sum())
    assert pad < 0.03 * out.length.sum()


def test_odd_rows_and_empty_table(odd, docs):
    out = packing.pack(odd, PATH).toPandas()
    assert len(out[out.doc_id == 5]) == 2 and set(out[out.doc_id == 1].doc_tokens) == {1}
    assert packing.pack(docs([]), PATH).count() == 0


def test_every_sentence_end_is_offered():
    class Encode:
        sentence_end = np.array([False, False, True, False])

        def __call__(self, text):
            return np.array([int(c) for c in text], dtype=np.uint32)

    # sentence ends after 10 and 40 ids of one cell of 48: only a cut at 40 fills the window
    stream = packing._Stream(Encode(), 40, 1, 4.0, 64.0)
    stream.add(1, "3" * 9 + "2" + "3" * 29 + "2" + "3" * 39)
    assert [sum(len(ids) for _, _, ids, _ in w) for w in stream.windows(last=True)] == [40, 40]
