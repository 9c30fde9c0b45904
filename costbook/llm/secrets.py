"""Operator 7: secret scans with formats learned by grammar inference.

Fixed patterns find credentials of known shape (``base_spans``).  Their values
are the labelled sample: per kind, a prefix tree over character classes is built
and states whose futures agree within Hoeffding bounds are merged (``infer``; ``learn``
does it from counts over all values), which leaves a small probabilistic automaton.  Every token of the corpus that has at
least the shortest learned value's length and is not inside a base span is scored,
whatever its characters, also one that extends beyond a base span, by its likelihood
per character under each automaton against an automaton of ordinary long tokens; a token that fits a format as well as that format's own
members do becomes a span of kind ``format``.

Edge cases: a null text is empty and has no spans; whole texts are searched,
whatever their length (all patterns are linear); overlapping kinds are all kept;
repeated rows give repeated results; without any labelled value nothing is added;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices

#: Kinds in order; the last is the learned one.
KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed patterns, by start, then kind."""
    out = []
    low = text.encode("utf-8", "replace").lower()
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    out.sort(key=lambda s: s[:2])
    return out


def _classes() -> dict[int, str]:
    table = {}
    for chars, name in (("0123456789", "0"), ("abcdef", "a"), ("ghijklmnopqrstuvwxyz", "g"), ("ABCDEF", "A"),
                        ("GHIJKLMNOPQRSTUVWXYZ", "G"), ("+/_.=-", "-")):
        table.update({ord(c): name for c in chars})
    return table


_CLASS = _classes()
#: Characters of a class: a class's probability is shared evenly among them.
_WIDTH = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20, "-": 6}
_END = ""
_STEPS = ("0", "a", "g", "A", "G", "-", _END)


def shape(value: str) -> str:
    return value.translate(_CLASS)


class Automaton:
    """Transition counts by state; ``log_likelihood`` is per character, in nats."""

    def __init__(self, states: list[dict[str, tuple[int, int]]]):
        self.states = []
        for moves in states:
            total = sum(n for n, _ in moves.values()) or 1
            self.states.append({c: (math.log(n / total), to) for c, (n, to) in moves.items()})
        self.least = -1e9
        self.shortest = 1  # characters of the shortest value learned from

    def log_likelihood(self, value: str) -> float:
        at, total = 0, 0.0
        for c in shape(value):
            p, to = self.states[at].get(c, (None, None)) if at is not None else (None, None)
            total += (math.log(1e-4) if p is None else p) - math.log(_WIDTH[c])
            at = to
        return total / max(1, len(value))


def _step(node: int, c: str) -> int:
    """The prefix tree's node that class ``c`` leads to from another one (a 63-bit hash)."""
    h = ((node ^ (ord(c) * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1)
    return (h ^ (h >> 29)) & ((1 << 63) - 1)


def _passes(value: str, move: dict[int, dict[str, int]]):
    """(node, class) of every step of a value's shape: through the states while ``move`` leads on,
    then down the prefix tree of what is not decided."""
    at = 0
    for c in value:
        yield at, c
        to = move.get(at, {}).get(c)
        at = _step(at, c) if to is None else to
    yield at, _END


def _merge(count: dict[int, dict[str, float]], red: list[int], move: dict[int, dict[str, int]], alpha: float = 0.01) -> dict[int, dict[str, float]]:
    """Merge compatible states (red and blue states, in order of discovery): ``red`` and ``move`` gain what
    is decided.  Returns the counts with those of merged states.  A node without counts is one that too few
    values pass to tell it from any state: it merges with the first."""
    count = {x: dict(n) for x, n in count.items()}
    go = {x: {c: move.get(x, {}).get(c, _step(x, c)) for c in n if c != _END} for x, n in count.items()}
    done, none = set(red), {}
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            x, y = count.get(a, none), count.get(b, none)
            n, m = sum(x.values()), sum(y.values())
            if not n or not m:
                continue
            gap = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for c in x.keys() | y.keys():
                if abs(x.get(c, 0) / n - y.get(c, 0) / m) > gap:
                    return False
            todo += [(go[a][c], go[b][c]) for c in go[a].keys() & go[b].keys()]
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if y not in count:
                continue
            into, on = count.setdefault(x, {}), go.setdefault(x, {})
            for c, n in count[y].items():
                into[c] = into.get(c, 0) + n
            for c, to in go[y].items():
                if c in on:
                    if on[c] != to:
                        todo.append((on[c], to))
                else:
                    on[c] = to

    while True:
        blue = next(((r, c, to) for r in red for c, to in sorted(go.get(r, none).items()) if to not in done), None)
        if blue is None:
            break
        parent, c, state = blue
        for r in red:
            if compatible(r, state):
                go[parent][c] = r
                fold(r, state)
                break
        else:
            red.append(state)
            done.add(state)
    for r in red:
        move[r] = {**move.get(r, {}), **go.get(r, {})}
    return count


def _automaton(count: dict[int, dict[str, float]], red: list[int], move: dict[int, dict[str, int]]) -> Automaton:
    number = {r: i for i, r in enumerate(red)}
    return Automaton([{c: (n, number[move[r][c]] if c != _END else 0) for c, n in sorted(count.get(r, {}).items())} for r in red])


def infer(values: list[str], alpha: float = 0.01, weights: list[float] | None = None) -> Automaton:
    """The automaton of a list of values: their prefix tree with compatible states merged.

    A value counts as often as its weight says, once without weights."""
    count: dict[int, dict[str, float]] = {}
    for v, w in zip(values, weights or [1] * len(values)):
        for node, c in _passes(shape(v), {}):
            into = count.setdefault(node, {})
            into[c] = into.get(c, 0) + w
    red, move = [0], {}
    return _automaton(_merge(count, red, move, alpha), red, move)


def candidates(text: str, least: int) -> list[tuple[int, int]]:
    """Tokens of at least ``least`` characters: what the automata score."""
    return [m.span() for m in _TOKEN.finditer(text) if m.end() - m.start() >= least]


def _beyond(spans: list[tuple[int, int]], base) -> list[tuple[int, int]]:
    """The spans that lie inside no single base span (both come by start)."""
    out, k, reach = [], 0, -1
    for s, e in spans:
        while k < len(base) and base[k][0] <= s:
            reach = max(reach, base[k][2])
            k += 1
        if reach < e:
            out.append((s, e))
    return out


def _values(batches):
    """(kind, value) of the labelled values; as kind -1 the other words."""
    for part in slices(batches):
        found = set()
        for text in part.column(0).to_pylist():
            if text:
                base = base_spans(text)
                found.update((k, v) for _, k, _, v in base)
                found.update((-1, w) for w in set(text.split()) if 6 <= len(w) <= 256 and w.isascii() and w.isalnum()
                             and not any(v in w for *_, v in base))
        yield pa.RecordBatch.from_pydict({"kind": [k for k, _ in found], "value": [v for _, v in found]},
                                         schema=pa.schema([("kind", pa.int32()), ("value", pa.string())]))


def _stepped(moves: dict[int, dict[int, dict[str, int]]]):
    """(kind, node, c, n): how many values take a step, of rows (kind, shape, n)."""

    def run(batches):
        for part in slices(batches):
            seen: dict[tuple, int] = {}
            for kind, value, n in zip(*(part.column(k).to_pylist() for k in range(3))):
                for step in _passes(value, moves[kind]):
                    seen[kind, *step] = seen.get((kind, *step), 0) + n
            kinds, nodes, cs = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(nodes, pa.int64()), pa.array(cs, pa.string()), pa.array(seen.values(), pa.int64())],
                names=["kind", "node", "c", "n"])

    return run


def _fit(shapes: DataFrame, totals: dict[int, int], weights: dict[int, float], fit_shapes: int) -> dict[int, Automaton]:
    """The automata of (kind, shape, n), from all shapes.

    A run of all shapes through what is decided so far counts each state's steps and, from
    where they leave it, those of the prefix tree.  Only the tree's nodes that at least a
    ``fit_shapes``-th of a kind's values pass are looked at one by one, at most ``fit_shapes``
    a level; the values at the others go on from the state these merge with, and the next run
    counts them there, until every step of every value is one of the automaton.
    """
    red, move, out = {k: [0] for k in totals}, {k: {} for k in totals}, {}
    while len(out) < len(totals):
        todo = [k for k in totals if k not in out]
        steps = shapes.filter(F.col("kind").isin(todo)).mapInArrow(_stepped(move), "kind int, node long, c string, n long")
        nodes = steps.groupBy("kind", "node").agg(
            F.sum("n").alias("passed"), *[F.sum(F.when(F.col("c") == c, F.col("n"))).alias(f"c{i}") for i, c in enumerate(_STEPS)])
        many = [(F.col("kind") == k) & ((F.col("passed") * fit_shapes >= totals[k]) | F.col("node").isin(red[k])) for k in todo]
        count: dict[int, dict] = {k: {} for k in todo}
        for r in nodes.filter(reduce(lambda a, b: a | b, many)).collect():
            count[r["kind"]][r["node"]] = {c: r[f"c{i}"] for i, c in enumerate(_STEPS) if r[f"c{i}"]}
        for k in todo:
            if all(c in move[k].get(r, {}) for r in red[k] for c in count[k].get(r, {}) if c != _END):
                out[k] = _automaton(count[k], red[k], move[k])
            else:
                _merge({x: {c: weights[k] * n for c, n in of.items()} for x, of in count[k].items()}, red[k], move[k])
    return out


def _scores(models: dict[int, Automaton]):
    """(kind, score, n) of rows (kind, shape, n)."""

    def run(batches):
        for part in slices(batches):
            kinds, values = part.column(0).to_pylist(), part.column(1).to_pylist()
            scores = [models[k].log_likelihood(v) for k, v in zip(kinds, values)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), part.column(2)], names=["kind", "score", "n"])

    return run


def _at_rank(scores: DataFrame, rank: int, bins: int = 1000) -> float:
    """The score of that rank (from 0, lowest first), by counts in ever narrower bins."""
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    while low < high:
        at = F.least(F.floor((F.col("score") - low) / ((high - low) / bins)), F.lit(bins - 1))
        rows = scores.filter(F.col("score").between(low, high)).groupBy(at.alias("at")).agg(
            F.sum("n").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for r in sorted(rows.collect(), key=lambda r: r["at"]):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return low


def learn(docs: DataFrame, text_col: str = "text", fit_rows: int = 400, fit_least: int = 20,
          fit_shapes: int = 4096) -> dict[str, Automaton]:
    """Automata of the three kinds and of ordinary words.

    A kind's is learned from the shapes of all its distinct labelled values, the words' from
    those of all distinct words; a kind with fewer than ``fit_least`` values has none.  More than
    ``fit_rows`` values (and the words always) count by their shares, ``fit_rows`` in all, so that
    an automaton merges alike whatever the corpus's size.  What is rarer than a
    ``fit_shapes``-th is told from no other state, but counts (see ``_fit``).
    """
    found = docs.select(F.col(text_col)).mapInArrow(_values, "kind int, value string").distinct()
    like = F.translate("value", "".join(map(chr, _CLASS)), "".join(_CLASS.values()))
    shapes = common.staged(found.groupBy("kind", like.alias("shape")).agg(F.count("*").alias("n")), "secret-shapes")
    sizes = {r["kind"]: r for r in shapes.groupBy("kind").agg(F.sum("n").alias("n"), F.min(F.length("shape")).alias("least")).collect()}
    totals = {k: r["n"] for k, r in sizes.items() if k < 0 or r["n"] >= fit_least}
    models = _fit(shapes, totals, {k: fit_rows / n if k < 0 else min(1, fit_rows / n) for k, n in totals.items()}, fit_shapes)
    kinds = [k for k in sorted(models) if k >= 0]
    if kinds:
        scores = common.staged(shapes.filter(F.col("kind").isin(kinds)).mapInArrow(_scores(models), "kind int, score double, n long"), "secret-scores")
        for k in kinds:
            models[k].least = _at_rank(scores.filter(F.col("kind") == k), totals[k] // 50)
            models[k].shortest = sizes[k]["least"]
    return {"words" if k < 0 else KINDS[k]: models[k] for k in [*kinds, *(k for k in models if k < 0)]}


def scan(docs: DataFrame, models: dict[str, Automaton], id_col: str = "doc_id", text_col: str = "text",
         margin: float = 0.5) -> DataFrame:
    """Per row: the id, counts by kind, and all spans as arrays of (kind, start, end).

    A candidate is a ``format`` span if under some kind's automaton it is as likely as
    that kind's own values (all but their lowest fiftieth) and likelier than under the
    ordinary words by ``margin`` nats a character.
    """
    ordinary = models.get("words")
    formats = [m for k, m in models.items() if k != "words"]
    shortest = min((m.shortest for m in formats), default=1)

    def fits(value: str) -> bool:
        usual = ordinary.log_likelihood(value) if ordinary else -math.log(64)
        return any(x >= m.least and x - usual >= margin for m in formats for x in (m.log_likelihood(value),))

    def find(batches):
        for part in slices(batches):
            ids, texts = part.column(0), part.column(1).to_pylist()
            kinds, starts, ends = [], [], []
            for text in texts:
                base = base_spans(text) if text else []
                spans = [(s, k, e) for s, k, e, _ in base]
                if text and formats:
                    spans += [(s, 3, e) for s, e in _beyond(candidates(text, shortest), base) if fits(text[s:e])]
                    spans.sort()
                kinds.append([k for _, k, _ in spans])
                starts.append([s for s, _, _ in spans])
                ends.append([e for _, _, e in spans])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(kinds, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64())),
                 pa.array(ends, pa.list_(pa.int64()))], names=["id", "kinds", "starts", "ends"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        find, f"id {kind}, kinds array<int>, starts array<long>, ends array<long>")
    spans = F.zip_with(F.arrays_zip("starts", "ends"), F.col("kinds"), lambda s, k: F.struct(
        F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1).alias("kind"),
        s["starts"].alias("start"), s["ends"].alias("end")))
    return rows.select(F.col("id").alias(id_col), spans.alias("spans"))


def digest(spans: list[tuple[int, str, int]]) -> str:
    """What base_sha256 holds for (start, kind, end) in order; used by tests."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
