"""Operator 6: language identification by rank-order n-gram profiles.

A language's profile is its ``top`` most frequent character n-grams (one to three
letters, with word edges) in rank order, counted over all training rows.  A text is
compared by the out-of-place distance: the sum over its own ``top`` n-grams of the
difference between their ranks in text and profile, ``top`` for an n-gram that the
profile lacks.  The nearest language wins, ties by name.

Edge cases: null texts and texts without a letter are ``und`` with score 0, and so is
everything when there is no training row; whole texts are profiled; training rows
with a null language or without letters teach nothing; repeated rows count each;
other columns are ignored.  Driver and tasks hold ``top`` n-grams per language: their
size depends on the number of languages, not of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import slices

UNKNOWN = "und"
_BITS = 21  # a code point fits
_letters = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the 1- to 3-grams of the lower-cased words; 0 is a word's edge.

    A code holds the n-gram's code points, 21 bits each, so equal codes are equal n-grams.
    """
    x = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    letter = _is_letter()[x]
    x = np.where(letter, x, 0)
    x = x[letter | np.concatenate([[False], letter[:-1]])] if len(x) else x  # one edge per gap
    if not len(x):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x = np.concatenate([[0], x, [0]])
    two = (x[:-1] << _BITS) | x[1:]
    three = (two[:-1] << _BITS) | x[2:]
    one = x[x > 0]
    two = two[(x[:-1] > 0) | (x[1:] > 0)]
    three = three[x[1:-1] > 0]
    # of equal length or not, two n-grams never share a code: one is a code point, two is
    # negative, three has its middle letter above bit 21 and a mark that the others lack
    codes = np.concatenate([one, -two - 1, three ^ np.int64(-1 << 63)])
    return np.unique(codes, return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` codes by count, then code."""
    if len(codes) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:top]


def _counts(batches):
    """(lang, code, n) summed over slices."""
    for part in slices(batches, 2048):
        by: dict[str, list] = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            by.setdefault(lang, []).append(grams(text or ""))
        langs, codes, ns = [], [], []
        for lang, found in by.items():
            c, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            langs += [lang] * len(c)
            codes.append(c)
            ns.append(np.bincount(at, weights=np.concatenate([f[1] for f in found]), minlength=len(c)).astype(np.int64))
        if langs:
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(codes)),
                                              pa.array(np.concatenate(ns))], names=["lang", "code", "n"])


def learn(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", top: int = 400) -> dict[str, np.ndarray]:
    """Profiles of the languages in the rows where ``train`` holds."""
    rows = docs.filter(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    total = rows.mapInArrow(_counts, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    best = total.withColumn("place", place).filter(F.col("place") <= top).orderBy("lang", "place").collect()
    out: dict[str, list] = {}
    for r in best:
        out.setdefault(r["lang"], []).append(r["code"])
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
            top: int = 400) -> DataFrame:
    """Per row: the id, lang_pred and score (the nearest language's share of inverse distances, 0 to 1)."""
    names = sorted(profiles)

    def run(batches):
        known = np.unique(np.concatenate([profiles[k] for k in names])) if names else np.empty(0, np.int64)
        place = np.full((len(names), len(known) + 1), -1, dtype=np.int64)  # the last column: n-grams in no profile
        for i, k in enumerate(names):
            place[i, np.searchsorted(known, profiles[k])] = np.arange(len(profiles[k]))

        def judge(text):
            if not text or not names:
                return UNKNOWN, 0.0
            own = ranked(*grams(text), top)
            if not len(own):
                return UNKNOWN, 0.0
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            at = np.where(known[at] == own, at, len(known))
            ranks = place[:, at]
            distance = np.where(ranks >= 0, np.abs(ranks - np.arange(len(own))), top).sum(axis=1) / (len(own) * top)
            best = int(np.argmin(distance))
            near = (1 - distance) ** 8
            return names[best], float(near[best] / near.sum()) if near.sum() > 0 else 0.0

        for part in slices(batches):
            found = [judge(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], names=["id", "lang_pred", "score"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
