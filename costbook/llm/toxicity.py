"""Operator 10: toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as a trained vector (for the words that tell the classes apart best; all
others share one) beside character evidence (the mean of trained vectors of its hashed
character trigrams).  A window of ``window`` words runs through a GRU in both directions,
attention pools its states, and a logistic output scores it; windows overlap by
``window - stride`` words and cover the whole text.  A document's score is that of its
highest window.

Training (numpy, on the driver) sees a bounded sample: at most ``fit_rows`` labelled
documents (smallest hash).  Labels of documents become labels of windows in ``rounds``:
first the windows that telling words point at, then, with the network so far, each
document's worst window.  Word statistics cover all training rows.  A quarter of the
sample is kept back to shift the output so that 0.7 is the best threshold.

Edge cases: null texts and texts without words score 0; null labels are ignored and
contradicting labels count as toxic; without labelled rows of both classes all scores
are 0; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices

_WORD = re.compile(r"[^\W\d_]+")
#: Labels that are broadcast at most (a few bytes each).
BROADCAST_LABELS = 500_000
#: Words whose vectors a task keeps at once.
_KNOWN_WORDS = 200_000
_HIDDEN, _WORD_DIM, _CHAR_DIM, _CHAR_ROWS = 6, 6, 6, 512


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _trigrams(word: str) -> list[int]:
    w = f"<{word}>"
    return [zlib.crc32(w[i:i + 3].encode("utf-8", "replace")) % _CHAR_ROWS for i in range(len(w) - 2)]


def window_starts(n: int, window: int, stride: int) -> list[int]:
    """Starts of overlapping windows that cover n words; the last one ends with the text."""
    if n <= window:
        return [0] if n else []
    return [*range(0, n - window, stride), n - window]


class Network:
    """Forward and backward passes over batches of windows of word numbers (-1: no word)."""

    def __init__(self, vocabulary: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = _WORD_DIM + _CHAR_DIM, _HIDDEN
        self.number = {w: i + 1 for i, w in enumerate(vocabulary)}
        small = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        self.p = {"word": small(len(vocabulary) + 1, _WORD_DIM), "char": small(_CHAR_ROWS, _CHAR_DIM),
                  "att": small(2 * h), "out": small(2 * h), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"W{side}": small(d, 3 * h), f"U{side}": small(h, 3 * h), f"c{side}": np.zeros(3 * h, np.float32)}
        self.shift = 0.0

    def inputs(self, vocab: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words: word rows, trigram rows one word after the other, trigrams a word."""
        rows = np.array([self.number.get(w, 0) for w in vocab], dtype=np.int64)
        grams = [_trigrams(w) for w in vocab]
        return rows, np.array([t for g in grams for t in g], dtype=np.int64), np.array([len(g) for g in grams])

    def vectors(self, vocab: list[str]) -> np.ndarray:
        return self._embed(*self.inputs(vocab))

    def _embed(self, rows: np.ndarray, grams: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        char = np.add.reduceat(self.p["char"][grams], first) / lengths[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][rows], char.astype(np.float32)], axis=1)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None):
        """States (T, N, h) of projected inputs x (T, N, 3h); time runs backwards for side b."""
        h = _HIDDEN
        u = self.p[f"U{side}"]
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((x.shape[0], x.shape[1], h), np.float32)
        for t in (range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)):
            rz = x[t, :, :2 * h] + state @ u[:, :2 * h]
            np.negative(rz, out=rz)
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            r, z = rz[:, :h], rz[:, h:] * mask[t, :, None]
            c = np.tanh(x[t, :, 2 * h:] + (r * state) @ u[:, 2 * h:])
            new = state + z * (c - state)
            if keep is not None:
                keep.append((t, state, r, z, c))
            out[t] = state = new
        return out

    def scores(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Logits of windows ``ids`` (T, N) over the words of ``vectors``; -1 is padding."""
        mask = (ids >= 0).astype(np.float32)
        at = np.maximum(ids, 0)
        out = []
        for side in "fb":
            projected = vectors @ self.p[f"W{side}"] + self.p[f"c{side}"]
            out.append(self._run(projected[at], mask, side, None))
        s = np.concatenate(out, axis=2)
        e = s @ self.p["att"]
        a = np.exp(e - e.max(axis=0)) * mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        return np.einsum("tn,tnh,h->n", a, s, self.p["out"], optimize=True) + self.p["bias"][0]

    def gradients(self, ids: np.ndarray, words: tuple[np.ndarray, ...], y: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted logistic loss, and the logits; ``words`` as ``inputs`` gives them."""
        rows, grams, lengths = words
        p, h = self.p, _HIDDEN
        g = {k: np.zeros_like(v) for k, v in p.items()}
        vec = self._embed(*words)
        mask, at = (ids >= 0).astype(np.float32), np.maximum(ids, 0)
        x = vec[at]
        kept: dict[str, list] = {"f": [], "b": []}
        s = np.concatenate([self._run(x @ p[f"W{d}"] + p[f"c{d}"], mask, d, kept[d]) for d in "fb"], axis=2)
        e = s @ p["att"]
        a = np.exp(e - e.max(axis=0)) * mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", a, s)
        logit = pooled @ p["out"] + p["bias"][0]
        dl = ((1 / (1 + np.exp(-logit)) - y) * weight).astype(np.float32)
        g["out"], g["bias"][0] = pooled.T @ dl, dl.sum()
        dpool = dl[:, None] * p["out"]
        ds = a[:, :, None] * dpool
        da = np.einsum("tnh,nh->tn", s, dpool)
        de = a * (da - (a * da).sum(axis=0))
        g["att"] = np.einsum("tn,tnh->h", de, s)
        ds = ds + de[:, :, None] * p["att"]
        dx = np.zeros_like(x)
        for side, part in (("f", ds[:, :, :h]), ("b", ds[:, :, h:])):
            u, back = p[f"U{side}"], np.zeros((x.shape[1], h), np.float32)
            for t, state, r, z, c in reversed(kept[side]):
                d = back + part[t]
                dc = d * z * (1 - c * c)
                dz = d * (c - state) * z * (1 - z)
                drs = dc @ u[:, 2 * h:].T
                dr = drs * state * r * (1 - r)
                gate = np.concatenate([dr, dz], axis=1)
                g[f"U{side}"][:, :2 * h] += state.T @ gate
                g[f"U{side}"][:, 2 * h:] += (r * state).T @ dc
                full = np.concatenate([gate, dc], axis=1)
                g[f"W{side}"] += x[t].T @ full
                g[f"c{side}"] += full.sum(axis=0)
                dx[t] += full @ p[f"W{side}"].T
                back = d * (1 - z) + drs * r + gate @ u[:, :2 * h].T
        flat, of = dx[mask > 0], at[mask > 0]
        total = lambda where, what, n: np.stack(
            [np.bincount(where, weights=what[:, k], minlength=n) for k in range(what.shape[1])], axis=1)
        per_word = total(of, flat, len(rows))
        g["word"] = total(rows, per_word[:, :_WORD_DIM], len(p["word"])).astype(np.float32)
        per_gram = np.repeat(per_word[:, _WORD_DIM:] / lengths[:, None], lengths, axis=0)
        g["char"] = total(grams, per_gram, _CHAR_ROWS).astype(np.float32)
        return g, logit


def _word_counts(batches):
    """(word, toxic, n): documents of each class that hold the word."""
    for part in slices(batches, 1024):
        n: dict[tuple[str, bool], int] = {}
        for text, bad in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            for w in set(words_of(text or "")):
                n[w, bad] = n.get((w, bad), 0) + 1
        if n:
            yield pa.RecordBatch.from_pydict({"word": [k[0] for k in n], "toxic": [k[1] for k in n], "n": list(n.values())},
                                             schema=pa.schema([("word", pa.string()), ("toxic", pa.bool_()), ("n", pa.int64())]))


def learn(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", window: int = 40, stride: int = 30, fit_rows: int = 6000, vocabulary: int = 2000,
          rounds: int = 3, steps: int = 200) -> Network | None:
    """Fit on the labelled rows where ``train`` holds; None without both classes."""
    y = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).alias("toxic"))
    rows = docs.filter(train & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    # few labels are broadcast, so that the texts stay where they are
    known = F.broadcast(y) if y.count() <= BROADCAST_LABELS else y
    rows = common.staged(rows.join(known, "_id").select("_id", "text", "toxic"), "toxic-train")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return None
    counts = rows.select("text", "toxic").mapInArrow(_word_counts, "word string, toxic boolean, n long")
    counts = counts.groupBy("word").agg(F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("a"),
                                        F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (totals[True] + 1)) - F.log((F.col("b") + 0.5) / (totals[False] + 1))
    # how sure the odds are: in units of their standard error
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    ranked = counts.filter("a + b >= 3").withColumn("z", z).orderBy(F.desc(F.abs("z")), "word").limit(vocabulary).collect()
    strength = {r["word"]: r["z"] for r in ranked}
    each = fit_rows // 2  # of either class
    ids = [rows.filter(F.col("toxic") == c).select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(each)
           for c in (True, False)]
    # at most fit_rows ids are broadcast; the sample is spread so that all cores score it
    sample = rows.join(F.broadcast(ids[0].unionByName(ids[1])), "_id", "left_semi").select(
        F.xxhash64("_id").alias("id"), "text", "toxic")
    sample = common.staged(sample.repartition(48, "id"), "toxic-sample")
    net = Network(sorted(strength))
    # the words that stand for toxicity most surely start apart from the rest
    for w, i in net.number.items():
        net.p["word"][i, 0] = np.float32(np.clip(strength[w] / 8, -2, 2))
    net.p["word"][0] = 0
    found: dict[tuple, bool] = {}
    for r in range(rounds):
        # first the windows that the words point at, then those that the network takes for the worst
        best = sample.mapInArrow(_worst_windows(strength if r == 0 else None, net, window, stride),
                                 "id long, toxic boolean, words array<string>, logit double")
        for row in best.orderBy("id", "words").collect():  # a few windows of each of fit_rows documents
            found[row["id"], tuple(row["words"])] = row["toxic"]
        keys = sorted(found)
        _fit(net, [k[1] for k in keys], np.array([found[k] for k in keys], np.float32),
             np.array([_held(k[0]) for k in keys]), window, steps)
    best = sample.mapInArrow(_worst_windows(None, net, window, stride),
                             "id long, toxic boolean, words array<string>, logit double").select("id", "toxic", "logit").collect()
    held = [r for r in best if _held(r["id"])]
    _set_threshold(net, held if len({r["toxic"] for r in held}) == 2 else best)
    return net


def _held(doc: int) -> bool:
    """A quarter of the sample: it sets the threshold and is not trained on."""
    return zlib.crc32(str(doc).encode()) % 4 == 0


def _worst_windows(strength: dict[str, float] | None, net: Network, window: int, stride: int):
    """Per document its windows of most word strength (clean ones: also one in the middle),
    or without ``strength`` its window of highest logit."""

    def run(batches):
        scorer = _Scorer(net, window, stride)
        for part in slices(batches, 256):
            ids, ys, parts, logits = [], [], [], []
            texts = [words_of(t) for t in part.column(1).to_pylist()]
            best, where = scorer.highest(texts) if strength is None else (None, None)
            for k, (i, words, bad) in enumerate(zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist())):
                starts = window_starts(len(words), window, stride)
                if not starts:
                    continue
                if strength is None:
                    some = [(float(best[k]), int(where[k]))]
                else:
                    s = np.array([max(0.0, strength.get(w, 0.0)) for w in words])
                    sums = sorted(((float(s[a:a + window].sum()), a) for a in starts), reverse=True)
                    some = sums[:1] if bad else sums[:2] + sums[len(sums) // 2:][:1]
                for x, a in some:
                    ids.append(i)
                    ys.append(bad)
                    parts.append(words[a:a + window])
                    logits.append(x)
            yield pa.RecordBatch.from_pydict({"id": ids, "toxic": ys, "words": parts, "logit": logits}, schema=pa.schema(
                [("id", pa.int64()), ("toxic", pa.bool_()), ("words", pa.list_(pa.string())), ("logit", pa.float64())]))

    return run


def _fit(net: Network, windows: list[list[str]], y: np.ndarray, held: np.ndarray, width: int, steps: int, batch: int = 128) -> None:
    """Adam over the windows that are not held out, both classes weighing the same."""
    vocab = sorted({w for x in windows for w in x})
    number = {w: i for i, w in enumerate(vocab)}
    ids = np.full((width, len(windows)), -1, dtype=np.int64)
    for k, x in enumerate(windows):
        ids[:len(x), k] = [number[w] for w in x]
    rows, grams, lengths = net.inputs(vocab)
    first = np.concatenate([[0], np.cumsum(lengths)])
    rng = np.random.default_rng(11)
    use = np.nonzero(~held)[0] if 0 < y[~held].sum() < (~held).sum() else np.arange(len(y))
    weight = np.where(y > 0, 0.5 / max(1, y[use].sum()), 0.5 / max(1, (1 - y[use]).sum())).astype(np.float32)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    order = np.empty(0, dtype=np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(use)):
            order = rng.permutation(use)
        some, order = order[:batch], order[batch:]
        own, local = np.unique(ids[:, some], return_inverse=True)
        local = local.reshape(width, len(some)) - (1 if own[0] < 0 else 0)
        own = own[own >= 0]
        some_grams = np.concatenate([grams[first[w]:first[w + 1]] for w in own])
        g, _ = net.gradients(local, (rows[own], some_grams, lengths[own]), y[some], weight[some] * len(use) / len(some))
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k in net.p:
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.01 * (g[k] * g[k] - v[k])
            net.p[k] -= rate * ((m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
                                + (1e-3 if k in ("word", "char") else 0) * net.p[k])


def _set_threshold(net: Network, rows) -> None:
    """Shift the output so that 0.7 is the best cut (F1) between the documents' logits."""
    rows = sorted(rows, key=lambda r: (r["logit"], r["id"]))
    logit = np.array([r["logit"] for r in rows])
    toxic = np.array([r["toxic"] for r in rows], dtype=np.int64)
    right = np.concatenate([[toxic.sum()], toxic.sum() - np.cumsum(toxic)])  # toxic at or above each cut
    f1 = 2 * right / np.maximum(np.arange(len(rows), -1, -1) + toxic.sum(), 1)
    best = np.nonzero(f1 >= f1.max() - 1e-9)[0]
    k = int(best[len(best) // 2])
    low = logit[k - 1] if k else logit[0] - 2
    high = logit[k] if k < len(rows) else logit[-1] + 2
    net.shift = float((low + high) / 2 - math.log(0.7 / 0.3))


class _Scorer:
    """The highest window of many documents at once; words' vectors are kept between calls."""

    def __init__(self, net: Network, window: int, stride: int):
        self.net, self.window, self.stride = net, window, stride
        self.number: dict[str, int] = {}
        self.vectors = np.empty((0, _WORD_DIM + _CHAR_DIM), np.float32)

    def highest(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Per list of words the highest logit (-inf without words) and its window's first word."""
        best, where = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        if len(self.number) > _KNOWN_WORDS:
            self.number, self.vectors = {}, self.vectors[:0]
        number = self.number
        ids, owners, starts = [], [], []
        for k, words in enumerate(texts):
            if words:
                own = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32)
                first = np.array(window_starts(len(own), self.window, self.stride))
                at = first[:, None] + np.arange(self.window)
                ids.append(np.where(at < len(own), own[np.minimum(at, len(own) - 1)], -1))
                owners.append(np.full(len(first), k))
                starts.append(first)
        if not ids:
            return best, where
        if len(number) > len(self.vectors):
            new = self.net.vectors(list(islice(number, len(self.vectors), None)))
            self.vectors = np.concatenate([self.vectors, new])
        ids, owners, starts = np.concatenate(ids).T, np.concatenate(owners), np.concatenate(starts)
        for a in range(0, ids.shape[1], 2048):
            some = ids[:, a:a + 2048]
            own, local = np.unique(some, return_inverse=True)
            pad = int(own[0] < 0)
            logit = self.net.scores(local.reshape(some.shape) - pad, self.vectors[own[pad:]])
            for k, s, x in zip(owners[a:a + 2048], starts[a:a + 2048], logit):
                if x > best[k]:
                    best[k], where[k] = x, s
        return best, where


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", window: int = 40,
          stride: int = 30) -> DataFrame:
    """Per row: the id, score (0 to 1) and the first word of the highest window."""

    def run(batches):
        scorer = _Scorer(net, window, stride) if net else None
        for part in slices(batches, 256):
            texts = [words_of(t) if t else [] for t in part.column(1).to_pylist()]
            best, where = scorer.highest(texts) if net else (np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64))
            value = np.where(np.isfinite(best), 1 / (1 + np.exp(-(np.clip(best, -60, 60) - (net.shift if net else 0)))), 0.0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value, pa.float64()), pa.array(where)],
                                             names=["id", "score", "at_word"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, at_word long")
