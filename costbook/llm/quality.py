"""Operator 2: quality rules as a learned decision list (DataFrame functions only).

``measure`` looks at whole texts; ``learn`` fits an ordered list of threshold
conjunctions by sequential covering: a rule is grown condition by condition by
information gain on one part of the labelled rows and pruned back on the other,
the rows it covers are set aside, and the next rule is learned from the rest.
Every step is one grouped count over (feature, bin).  ``DecisionList.verdict``
is the list as a Spark conditional expression.

Edge cases: a null or empty text has no words and measures 0 everywhere (it fails
the base rules); labels that are null are ignored, contradicting labels of one id
count as the lower one; without labelled rows of both classes the list is empty
and only the base rules decide; repeated rows are judged alike; other columns of
``docs`` are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the rules may test; each is a ratio or a count of the whole text.
FEATURES = ("n_words", "mean_word", "symbol_share", "upper_share", "digit_share", "stop_share", "mark_share",
            "dup_line_share", "repeat_share", "distinct_share", "line_words")
_POSITION_BITS = 24


def _repeat_words(words: Column, n: Column, packed: Column) -> Column:
    """Words in 3-word windows found twice or more; ``packed`` holds the sorted windows.

    A window is its hash's upper 40 bits and its position; equal neighbours are
    compared word by word, so a shared hash alone does not count.
    """
    mask = (1 << _POSITION_BITS) - 1

    def same(x: Column, y: Column) -> Column:
        i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
        alike = F.shiftright(x, _POSITION_BITS) == F.shiftright(y, _POSITION_BITS)
        for k in range(3):
            alike = alike & (F.get(words, i + k) == F.get(words, j + k))
        return F.coalesce(alike, F.lit(False))

    twice = F.filter(packed, lambda x, at: same(x, F.get(packed, at - 1)) | same(x, F.get(packed, at + 1)))
    starts = F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(mask)))
    covered = common.let(starts, lambda s: F.aggregate(
        F.transform(s, lambda x, at: F.least(F.lit(3), F.coalesce(F.get(s, at + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, b: a + b))
    return F.when(n >= 3, covered).otherwise(0).cast("long")


def _kept_length(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in the class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def measure(text: Column) -> Column:
    """The struct of BASE and FEATURES of a text.

    One nested expression: each intermediate (words, windows, lines, counts) is a
    lambda variable, so no rule of the optimizer can copy and re-evaluate it.
    """
    text = F.coalesce(text, F.lit(""))

    def windows(w: Column) -> Column:
        spans = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
        return F.sort_array(F.transform(spans, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
                                        .bitwiseAND(~((1 << _POSITION_BITS) - 1)).bitwiseOR(i.cast("long"))))

    def counts(w: Column, packed: Column, lines: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, common.GAP, "")).cast("long").alias("word_chars"),
            _kept_length(text, "#*$%&|<>").cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(w, F.size(w), packed).alias("n_repeat_words"),
            F.size(lines).alias("n_lines"), F.size(F.array_distinct(w)).alias("n_distinct"),
            _kept_length(text, "A-Z").alias("n_upper"), _kept_length(text, "0-9").alias("n_digit"),
            _kept_length(text, ".,;:").alias("n_stop"), _kept_length(text, "!?").alias("n_mark"))

    def shares(c: Column) -> Column:
        def share(a: str, b: str) -> Column:
            return F.when(c[b] > 0, c[a] / c[b]).otherwise(0.0)

        pairs = {"mean_word": ("word_chars", "n_words"), "symbol_share": ("n_symbols", "word_chars"),
                 "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digit", "word_chars"),
                 "stop_share": ("n_stop", "word_chars"), "mark_share": ("n_mark", "word_chars"),
                 "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
                 "distinct_share": ("n_distinct", "n_words"), "line_words": ("n_words", "n_lines")}
        return F.struct(*[c[k].alias(k) for k in BASE], *[share(*v).alias(k) for k, v in pairs.items()])

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(common.WORD))
    return common.let(F.regexp_extract_all(text, F.lit(common.WORD), F.lit(0)), lambda w: common.let(
        windows(w), lambda packed: common.let(lines, lambda ls: common.let(counts(w, packed, ls), shares))))


def base_failed(q: Column) -> Column:
    """Under 50 words, or over half of them in repeated windows."""
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


@dataclass
class DecisionList:
    """Rules in order; a rule is a list of (feature, above, threshold); the first that holds rejects."""

    rules: list[list[tuple[str, bool, float]]] = field(default_factory=list)

    @staticmethod
    def holds(rule, q: Column) -> Column:
        out = F.lit(True)
        for name, above, at in rule:
            x = q[name].cast("double")
            out = out & ((x > at) if above else (x <= at))
        return out

    def rule_number(self, q: Column) -> Column:
        """1 for the first rule, ...; 0 where none holds."""
        out = F.lit(0)
        for k in range(len(self.rules), 0, -1):
            out = F.when(self.holds(self.rules[k - 1], q), k).otherwise(out)
        return out

    def verdict(self, q: Column) -> Column:
        return self.rule_number(q) == 0


def learn(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          label_col: str = "quality", fit_rows: int = 20_000, bins: int = 24, max_rules: int = 8,
          max_conditions: int = 3, precision: float = 0.95, support: int = 4) -> DecisionList:
    """Fit on at most ``fit_rows`` labelled ids (those of smallest hash).

    A rule stays if at least ``precision`` of the held-out labelled rows that it
    covers are bad (label 0), and at least ``support`` of them are.
    """
    ids = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    # at most fit_rows rows of two numbers: a proven bound for the broadcast
    some = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(ids), "_id")
    x = common.staged(some.select(measure(F.col("_text")).alias("q"), (F.col("_label") == 0).alias("bad"),
                                  (F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(3)) == 0).alias("held")), "quality-fit")
    q = F.col("q")
    x = x.filter(~base_failed(q))
    cuts = x.agg(*[F.percentile_approx(F.col(f"q.{c}").cast("double"), [k / bins for k in range(1, bins)], 5000).alias(c)
                   for c in FEATURES]).first()
    cuts = {c: sorted(set(cuts[c] or ())) for c in FEATURES}
    bin_of = [F.struct(F.lit(c).alias("f"), _bin(q[c], cuts[c]).alias("b")) for c in FEATURES if cuts[c]]
    out = DecisionList()
    while bin_of and len(out.rules) < max_rules:
        rest = x.filter(out.verdict(q))
        rule: list = []
        while len(rule) < max_conditions:
            found = _grow(rest.filter(~F.col("held") & out.holds(rule, q)), bin_of, cuts)
            if found is None or found in rule:
                break
            rule.append(found)
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        counts = rest.filter("held").agg(*[F.count_if(out.holds(p, q) & (F.col("bad") == b)).alias(f"n{i}_{b}")
                                          for i, p in enumerate(prefixes) for b in (True, False)]).first()
        bad = lambda i: counts[f"n{i}_True"]
        good = lambda i: counts[f"n{i}_False"]
        best = max(range(len(prefixes)), key=lambda i: ((bad(i) - good(i)) / max(1, bad(i) + good(i)), -i))
        if bad(best) < support or bad(best) < precision * (bad(best) + good(best)):
            break
        out.rules.append(_centred(rest.filter(F.col("bad") & out.holds(prefixes[best], q)), prefixes[best], q))
    return out


def _centred(caught: DataFrame, rule: list, q: Column) -> list:
    """The rule with every threshold halfway to the nearest bad row that it covers,
    so that good rows a little beyond those seen stay."""
    edges = caught.agg(*[(F.min if above else F.max)(q[name].cast("double")).alias(f"e{i}")
                         for i, (name, above, _) in enumerate(rule)]).first()
    return [(name, above, (at + edges[f"e{i}"]) / 2) for i, (name, above, at) in enumerate(rule)]


def _bin(x: Column, at: list[float]) -> Column:
    """How many of the thresholds ``at`` are below ``x``."""
    return F.size(F.filter(F.array(*[F.lit(float(t)) for t in at]), lambda t: t < x.cast("double")))


def _grow(rows: DataFrame, bin_of: list, cuts: dict[str, list[float]]) -> tuple[str, bool, float] | None:
    """The condition of highest gain over ``rows``, or None when none helps."""
    cells = rows.select("bad", F.explode(F.array(*bin_of)).alias("c")).groupBy("c.f", "c.b").agg(
        F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()  # features x bins rows
    table = {c: [[0, 0] for _ in range(len(t) + 1)] for c, t in cuts.items()}
    for r in cells:
        table[r["f"]][r["b"]] = [r["p"], r["n"]]
    first = next(iter(r["f"] for r in cells), None)
    if first is None:
        return None
    p0, n0 = (sum(v[k] for v in table[first]) for k in (0, 1))
    if not p0 or not n0:
        return None
    best = None
    for c in sorted(cuts):
        p = n = 0
        for k, at in enumerate(cuts[c]):
            p, n = p + table[c][k][0], n + table[c][k][1]
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                if pp:
                    gain = pp * (math.log2(pp / (pp + nn)) - math.log2(p0 / (p0 + n0)))
                    if gain > 1e-9 and (best is None or gain > best[0]):
                        best = (gain, (c, above, at))
    return best and best[1]
