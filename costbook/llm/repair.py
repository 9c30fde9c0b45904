"""Operator 13: repair of conversation structure by weighted CYK interval parsing.

The role initials of a conversation should spell ``(s?(ua)+)?``.  The repair grammar is
in Chomsky normal form: a nonterminal stands for a pair of states (p, q) of that
language's automaton and derives the spans of rows whose edited initials lead from p to
q, by (p, q) -> (p, r) (r, q).  A span's cell holds per nonterminal the least
(cost, audit), audit being the edits' initials.  A row's own cell comes from keeping,
reroling or deleting it, closed under insertions before and after it.  Spans are
combined bottom-up, equal lengths first: since the nonterminals are all state pairs,
every way to cut a span gives the same cell, so one cut a span is enough and a
conversation of n rows takes n - 1 combinations.  Equal costs mean equal numbers of
insertions at every common place, so the order of audits is kept by concatenation.

On Spark the rows are range-sorted by conversation and turn; a task combines the spans
of its own rows while they stream by, and only spans of conversations that cross a range
border meet in a shuffle, at most ``JOINED`` neighbours at a time.  A row is a duplicate
by a grouped minimum over (conversation, role, text), so no conversation is gathered for
it.  Repaired messages stream through one task a conversation, sorted, one row at a time
(a digest of a whole text can only be taken in order).

Rows are ordered by turn (nulls first), then role, then text.  Each row's first fault
counts: blank (nothing but U+0020 and U+0009 to U+000D), duplicate (its role and text
stand earlier), truncated (the last other character is not ``.``, ``!`` or ``?``).

Edge cases: null role and text are one space; a null conversation id is a conversation;
an empty role has no initial that fits and is never kept; repeated rows are duplicates;
a conversation that keeps no row has an empty audit; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices

#: The automaton of (s?(ua)+)?: moves, and where it may end.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS = 4, (0, 3)
#: What edits cost (fixed values); a truncated row that stays costs as much as an insertion.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Roles that rows may be given, by initial, and pairs of initials that may stand side by side.
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Spans of one conversation that are combined in one task of a round.
JOINED = 64
_FAULTS = ("", "blank", "duplicate", "truncated")
_SPACE = " \t\n\x0b\x0c\r"


# --- cells ------------------------------------------------------------------------
def _insertions() -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest insertions that lead from p to q."""
    best = {(p, p): (0, "") for p in range(STATES)}
    for _ in range(STATES):
        for (p, r), (cost, audit) in list(best.items()):
            for letter in ROLES:
                q = MOVES.get((r, letter))
                if q is not None and (p, q) not in best:
                    best[p, q] = (cost + INSERT, audit + "I")
    return best


class Grammar:
    """Nonterminals, rules and row cells."""

    def __init__(self):
        inserted = _insertions()
        steps = set(inserted) | {(p, q) for (p, _), q in MOVES.items()}
        pairs = set(steps)
        while True:  # all pairs that any row sequence can join
            more = {(p, s) for p, q in pairs for r, s in pairs if q == r} - pairs
            if not more:
                break
            pairs |= more
        self.pairs = sorted(pairs)
        place = {pair: k for k, pair in enumerate(self.pairs)}
        self.rules = [(place[p, s], place[p, q], place[r, s]) for p, q in self.pairs for r, s in self.pairs if q == r]
        self.empty = [inserted.get(pair) for pair in self.pairs]
        self.goals = [place[0, q] for q in ENDS if (0, q) in place]
        self.cells = {(i, fault): self._row(place, i, fault) for i in (*"sua", "") for fault in _FAULTS}

    def _row(self, place, initial: str, fault: str) -> list:
        edits = {pair: [] for pair in place}
        for p in range(STATES):
            edits[p, p].append((DELETE, "D"))
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                if (p, initial) in MOVES:
                    edits[p, MOVES[p, initial]].append((KEEP + extra, "K"))
                for letter in ROLES:
                    if (p, letter) in MOVES:
                        edits[p, MOVES[p, letter]].append((REROLE + extra, "R"))
        row = [min(edits[pair], default=None) for pair in self.pairs]
        return self.combine(self.combine(self.empty, row), self.empty)

    def cell(self, initial: str, fault: str) -> list:
        return self.cells[initial if initial in ("s", "u", "a") else "", fault]

    def combine(self, left: list, right: list) -> list:
        out: list = [None] * len(self.pairs)
        for to, a, b in self.rules:
            x, y = left[a], right[b]
            if x is not None and y is not None:
                both = (x[0] + y[0], x[1] + y[1])
                if out[to] is None or both < out[to]:
                    out[to] = both
        return out

    def best(self, cell: list) -> tuple[int, str]:
        return min(cell[g] for g in self.goals if cell[g] is not None)


GRAMMAR = Grammar()


@dataclass
class Span:
    """What is known of some neighbouring rows of a conversation."""

    rows: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    turns: int  # distinct, nulls aside
    low: int | None  # least and greatest turn; rows are sorted, so these are the first and last turns too
    high: int | None
    first: str  # initials
    last: str
    cell: list

    @classmethod
    def of(cls, turn, role: str, fault: str) -> "Span":
        i = role[:1]
        return cls(1, fault == "blank", fault == "duplicate", fault == "truncated", 0, turn is not None, turn, turn, i, i,
                   GRAMMAR.cell(i, fault))

    def then(self, o: "Span") -> "Span":
        same = self.high is not None and self.high == o.low
        return Span(self.rows + o.rows, self.blank + o.blank, self.duplicate + o.duplicate, self.truncated + o.truncated,
                    self.illegal + o.illegal + (self.last + o.first not in LEGAL), self.turns + o.turns - same,
                    o.low if self.low is None else self.low, self.high if o.high is None else o.high,
                    self.first, o.last, GRAMMAR.combine(self.cell, o.cell))


class Stack:
    """Spans of the rows so far, combined when they are as long as their left neighbour."""

    def __init__(self):
        self.spans: list[Span] = []

    def add(self, span: Span) -> None:
        self.spans.append(span)
        while len(self.spans) > 1 and self.spans[-2].rows <= self.spans[-1].rows:
            right = self.spans.pop()
            self.spans[-1] = self.spans[-1].then(right)

    def whole(self) -> Span:
        while len(self.spans) > 1:
            right = self.spans.pop()
            self.spans[-1] = self.spans[-1].then(right)
        return self.spans[0]


# --- spans as rows ------------------------------------------------------------------
_NUMBERS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
_SPAN = ", ".join(f"{c} long" for c in _NUMBERS) + ", first string, last string, costs array<long>, audits array<string>"


def _span_arrays(spans: list[Span]) -> list[pa.Array]:
    return [*[pa.array([None if getattr(s, c) is None else int(getattr(s, c)) for s in spans], pa.int64()) for c in _NUMBERS],
            pa.array([s.first for s in spans], pa.string()), pa.array([s.last for s in spans], pa.string()),
            pa.array([[c and c[0] for c in s.cell] for s in spans], pa.list_(pa.int64())),
            pa.array([[c and c[1] for c in s.cell] for s in spans], pa.list_(pa.string()))]


_SPAN_NAMES = [*_NUMBERS, "first", "last", "costs", "audits"]


def _span(row: dict) -> Span:
    cell = [None if a is None else (c, a) for c, a in zip(row["costs"], row["audits"])]
    return Span(*[row[c] for c in _NUMBERS], row["first"], row["last"], cell)


def _first_spans(kind):
    """Sorted rows (conv, part, pos, turn, role, text, later) to the same rows with their
    fault (kind 'row') and one span per conversation of the task (kind 'span')."""

    def run(batches):
        stack, now, before, part_id = Stack(), None, None, 0
        done: list = []

        def flush():
            nonlocal done
            convs, parts, spans = [d[0] for d in done], [d[1] for d in done], [d[2] for d in done]
            done = []
            none = lambda t: pa.nulls(len(spans), t)
            return pa.RecordBatch.from_arrays(
                [pa.array(convs, kind), pa.array(parts, pa.int64()), none(pa.int64()), none(pa.string()), none(pa.string()), none(pa.string()),
                 *_span_arrays(spans)], names=["conv", "part", "pos", "role", "text", "fault", *_SPAN_NAMES])

        for part in slices(batches, 1024):
            faults = []
            rows = zip(*[part.column(k).to_pylist() for k in range(7)])
            for conv, part_id, _, turn, role, text, later in rows:
                if before is None or conv != now:
                    if before is not None:
                        done.append((now, before[3], stack.whole()))
                    stack, now, before = Stack(), conv, None
                plain = text.rstrip(_SPACE)
                if not plain:
                    fault = "blank"
                elif later or before is not None and before[:3] == (turn, role, text):
                    fault = "duplicate"
                else:
                    fault = "" if plain[-1] in ".!?" else "truncated"
                stack.add(Span.of(turn, role, fault))
                faults.append(fault)
                before = (turn, role, text, part_id)
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), part.column(4), part.column(5), pa.array(faults, pa.string()),
                 *[pa.nulls(n, pa.int64()) for _ in _NUMBERS], pa.nulls(n, pa.string()), pa.nulls(n, pa.string()),
                 pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.string()))],
                names=["conv", "part", "pos", "role", "text", "fault", *_SPAN_NAMES])
            if len(done) >= 1024:
                yield flush()
        if before is not None:
            done.append((now, before[3], stack.whole()))
        if done:
            yield flush()

    return run


def _join_spans(batches):
    """Groups of neighbouring spans (conv, part, spans) to one span each."""
    for part in slices(batches, 256):
        spans = []
        for group in part.column(2).to_pylist():
            stack = Stack()
            for s in sorted(group, key=lambda s: s["part"]):
                stack.add(_span(s))
            spans.append(stack.whole())
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *_span_arrays(spans)], names=["conv", "part", *_SPAN_NAMES])


def _final(kind):
    def run(batches):
        for part in slices(batches, 1024):
            rows = part.to_pylist()
            spans = [_span(r) for r in rows]
            best = [GRAMMAR.best(s.cell) for s in spans]
            gaps = [0 if s.low is None else s.high - s.low + 1 - s.turns for s in spans]
            longs = [gaps, *[[getattr(s, c) for s in spans] for c in ("blank", "duplicate", "truncated", "illegal")], [b[0] for b in best]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["conv"] for r in rows], kind), *[pa.array(v, pa.int64()) for v in longs], pa.array([b[1] for b in best], pa.string())],
                names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return run


# --- edits --------------------------------------------------------------------------
class Edits:
    """Applies an audit to the rows of a conversation, one after the other."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def _placed(self, role: str) -> str:
        self.state = MOVES[self.state, role[:1]]
        return role

    def _next_role(self) -> str:
        return next(r for letter, r in ROLES.items() if (self.state, letter) in MOVES)

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._placed(self._next_role()), "", "I"

    def row(self, role: str, text: str):
        """(role, text, edit) of what comes before the row and of the row itself."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._placed(role), text, edit
        elif edit == "R":
            yield self._placed(self._next_role()), text, edit


def _replayed(batches):
    """(conv, messages) of sorted rows, a conversation's audit first; messages is a generator of row slices."""
    edits = None
    for part in slices(batches, 256):
        for conv, pos, role, text, audit in zip(*[part.column(k).to_pylist() for k in range(5)]):
            if pos < 0:
                if edits is not None:
                    yield last, edits.inserted(), True
                edits, last = Edits(audit), conv
                yield conv, (), False
            else:
                yield conv, edits.row(role, text), False
    if edits is not None:
        yield last, edits.inserted(), True


def _digests(kind):
    def run(batches):
        convs, hashes, digest, some = [], [], hashlib.sha256(), False
        for conv, messages, end in _replayed(batches):
            for role, text, _ in messages:
                digest.update(f"\n{role}:{text}".encode() if some else f"{role}:{text}".encode())
                some = True
            if end:
                convs.append(conv)
                hashes.append(digest.hexdigest())
                digest, some = hashlib.sha256(), False
            if len(convs) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(hashes, pa.string())], names=["conv", "repaired_sha256"])
                convs, hashes = [], []
        yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(hashes, pa.string())], names=["conv", "repaired_sha256"])

    return run


def _messages(kind):
    def run(batches):
        out, place = [], 0

        def flush():
            nonlocal out
            cols, out = list(zip(*out)) or [[]] * 5, []
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), pa.array(cols[1], pa.int64()), *[pa.array(c, pa.string()) for c in cols[2:]]],
                names=["conv", "place", "role", "text", "edit"])

        for conv, messages, end in _replayed(batches):
            for message in messages:
                place += 1
                out.append((conv, place, *message))
            place = 0 if end else place
            if len(out) >= 1024:
                yield flush()
        yield flush()

    return run


class Repaired:
    """A repair: ``report`` (per conversation gaps, blank, duplicate, truncated, illegal,
    cost, audit), ``messages()`` and ``digests()``."""

    def __init__(self, report: DataFrame, rows: DataFrame, id_col: str):
        self.report, self._rows, self._id = report, rows, id_col

    def _replay(self, run, columns: str) -> DataFrame:
        heads = self.report.select(F.col(self._id).alias("conv"), F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"),
                                   F.lit("").alias("text"), "audit")
        rows = self._rows.select("conv", "pos", "role", "text", F.lit("").alias("audit"))
        kind = self.report.schema[self._id].dataType
        sent = heads.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "pos")
        out = sent.mapInArrow(run(_arrow(kind)), f"conv {kind.simpleString()}, {columns}")
        return out.withColumnRenamed("conv", self._id)

    def messages(self) -> DataFrame:
        """The repaired messages: the id, place (from 1), role, text, edit (K, R or I)."""
        return self._replay(_messages, "place long, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """Per conversation the SHA-256 of its repaired ``role:text`` lines."""
        return self._replay(_digests, "repaired_sha256 string")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repaired:
    """The repair of every conversation that has rows."""
    kind = rows.schema[id_col].dataType
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    said = rows.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"),
                       text(text_col).alias("text"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    mark = F.struct("conv", "role", F.md5("text").alias("md5"))  # a struct, so that a null id equals itself
    said = said.withColumn("at", turn).withColumn("mark", mark)
    # messages that stand at several turns: later ones are duplicates; those of one turn are neighbours once sorted
    often = said.groupBy("mark").agg(F.min("at").alias("since"), F.max("at").alias("until")).filter("since != until").drop("until")
    said = said.join(often, "mark", "left").withColumn("later", F.coalesce(F.col("at") > F.col("since"), F.lit(False)))
    order = ["conv", F.col("turn").asc_nulls_first(), "role"]
    dealt = said.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    dealt = dealt.select("conv", F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("pos"),
                         "turn", "role", "text", "later")
    schema = f"conv {kind.simpleString()}, part long, pos long, role string, text string, fault string, {_SPAN}"
    first = common.staged(dealt.mapInArrow(_first_spans(_arrow(kind)), schema), "chat-rows")
    spans = first.filter("rows IS NOT NULL").select("conv", "part", *_SPAN_NAMES)
    # spans of one conversation from several ranges: neighbours are combined, round by round
    whole, group = [], F.struct("conv")
    while True:
        several = spans.groupBy(group.alias("mark")).agg(F.count("*").alias("n")).filter("n > 1")
        several = common.staged(several, "chat-several")
        if several.isEmpty():
            whole.append(spans)
            break
        spans = spans.withColumn("mark", group)
        whole.append(spans.join(several, "mark", "left_anti").drop("mark"))
        near = spans.join(several, "mark", "left_semi").groupBy(
            "mark", F.expr(f"CAST(part DIV {JOINED} AS LONG)").alias("near")).agg(F.collect_list(F.struct("part", *_SPAN_NAMES)).alias("spans"))
        near = near.select("mark.conv", F.col("near").alias("part"), "spans")
        spans = common.staged(near.mapInArrow(_join_spans, f"conv {kind.simpleString()}, part long, {_SPAN}"), "chat-spans")
    cells = whole[0]
    for more in whole[1:]:
        cells = cells.unionByName(more)
    report = cells.select("conv", *_SPAN_NAMES).mapInArrow(_final(_arrow(kind)), (
        f"conv {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"))
    report = common.staged(report.withColumnRenamed("conv", id_col), "chat-report")
    return Repaired(report, first.filter("rows IS NULL"), id_col)


# --- the damage that the registered query repairs -------------------------------------
def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults by crc32(conv_id:turn) % 20: 0 drops the row, 1 empties its text,
    2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes its role user; nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    by = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), by.alias("by")).filter("by != 0")
    return out.select(
        "conv_id", "turn", F.when(F.col("by") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("by") == 1, "").when(F.col("by") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("by") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """Every conversation of ``rows`` (conv_id, turn, role, text) after damage and repair."""
    done = repair(damaged(rows))
    found = done.report.join(done.digests().withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    out = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
