"""Operator 3: personal data, with information-theoretic sanitisation of what reveals it.

Fixed patterns find protected entities (``base_spans``).  Then the corpus tells how
strongly a term near an entity discloses it: with n(t, e) documents in which the term
stands near the entity, n(t) documents that hold the term anywhere, n(e) documents
that hold the entity and N documents,

    disclosure(t, e) = log(n(t, e) N / (n(t) n(e))) / log(N / n(e)),

pointwise mutual information as a share of the entity's own information; 1 means
that the term alone gives the entity away.  Terms over ``threshold`` that stand near
the entity in at least ``support`` different contexts become spans of kind ``term``
wherever they stand, in every text and at any distance; ``reach`` only serves the
estimate.  Occurrences inside an entity belong to that entity.
``sanitise`` replaces entities by their kind and generalises terms to what they are
(a number, a name), or removes them.

Edge cases: a null text is empty; whole texts are searched by linear scans; copies of
one context count once in the support; repeated rows get equal spans each; without
entities nothing is added; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: A term: a run without white space, quotes, brackets, end marks or symbols.
TERM = r"[^\x20\x09-\x0D.,;:!?\"'()<>\[\]{}|#*$%&]+"
_TERM = re.compile(TERM)


def _emails(text: str) -> list[tuple[int, int]]:
    """What the pattern matches, found from each @ outwards so that long runs cost one pass."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        free = m.end() if m else at + 1
        if m:
            out.append((start, m.end()))
        at = text.find("@", free)
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    out = []
    for run in _NUMBERS.finditer(text):
        if run[0].count(".") >= 3:
            parts = list(_PART.finditer(text, run.start(), run.end()))
            for k in range(0, len(parts) - 3, 4):
                if all(len(v) <= 3 and int(v or 0) <= 255 for v in (p[0].lstrip("0") for p in parts[k:k + 4])):
                    out.append((parts[k].start(), parts[k + 3].end()))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [(1, s, e) for s, e in _ips(text)]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def entity_key(kind: int, value: str) -> str:
    """What two mentions of one entity share."""
    return f"{KINDS[kind]}:" + (value.lower() if kind == 0 else re.sub(r"[^0-9.]" if kind == 1 else r"[^0-9]", "", value))


def _terms(text: str, spans) -> list[tuple[int, int, str]]:
    """(start, end, term) of the terms that overlap no entity."""
    masked = sorted((s, e) for _, s, e in spans)
    merged: list[list[int]] = []
    for s, e in masked:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    terms, k = [], 0
    for m in _TERM.finditer(text):
        while k < len(merged) and merged[k][1] <= m.start():
            k += 1
        if k == len(merged) or merged[k][0] >= m.end():
            terms.append((m.start(), m.end(), m[0]))
    return terms


def _near(text: str, spans, reach: int):
    """(entity, term, start, end, context) of the ``reach`` terms before and after each entity."""
    if not spans:
        return
    terms = _terms(text, spans)
    starts = [t[0] for t in terms]
    for kind, s, e in spans:
        i = bisect_left(starts, s)
        near = terms[max(0, i - reach):i + reach]
        context = zlib.crc32(" ".join(t[2] for t in near).encode("utf-8", "replace"))
        entity = entity_key(kind, text[s:e])
        for a, b, t in near:
            yield entity, t, a, b, context


def _places(batches):
    """(uid, terms): every occurrence of every term that overlaps no entity."""
    place = pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for part in slices(batches, 64):
        offsets, names, starts, ends = [0], [], [], []
        for text, base in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            for a, b, t in _terms(text or "", [(s["kind"], s["start"], s["end"]) for s in base]):
                names.append(t)
                starts.append(a)
                ends.append(b)
            offsets.append(len(names))
        places = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(starts, pa.int64()),
                                             pa.array(ends, pa.int64())], fields=list(place))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), places)],
                                         names=["uid", "places"])


def _schema(kind: pa.DataType) -> pa.Schema:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    fields = [("uid", pa.string()), ("id", kind), ("base", pa.list_(span)), ("entity", pa.string()),
              ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("context", pa.int64())]
    return pa.schema(fields + [("text", pa.string())])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 6, support: int = 3,
             threshold: float = 0.8, keep_text: bool = False) -> DataFrame:
    """Per row: the id, ``base`` and ``terms`` (arrays of kind, start, end) and, if ``keep_text``, ``clean_text``."""
    kind = docs.schema[id_col].dataType

    def find(batches):
        n, task = 0, TaskContext.get().partitionId()
        for part in slices(batches):
            ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            rows = []
            for doc, text in zip(ids, texts):
                uid, n = f"{task}-{n}", n + 1
                spans = base_spans(text) if text else []
                rows.append({"uid": uid, "id": doc, "text": text, "base": [
                    {"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]})
                rows += [{"uid": uid, "entity": e, "term": t, "start": a, "end": b, "context": c}
                         for e, t, a, b, c in _near(text or "", spans, reach)]
            yield pa.RecordBatch.from_pylist(rows, schema=_schema(part.column(0).type))

    span = "struct<kind:string,start:long,end:long>"
    out = (f"uid string, id {kind.simpleString()}, base array<{span}>, entity string, term string, start long, end long, "
           "context long, text string")
    # one pass over the texts gives both kinds of rows: documents (with base) and near terms (with entity)
    rows = common.staged(docs.select(id_col, text_col).mapInArrow(find, out), "pii")
    found = rows.filter("base IS NOT NULL")
    terms = disclosing(docs.select(F.col(text_col).alias("text")), rows.filter("entity IS NOT NULL"), found.count(),
                       support, threshold)
    if terms is None:
        done = found.withColumn("terms", F.array().cast(f"array<{span}>"))
    else:
        # every occurrence in every text, not only those near the entity
        marked = common.staged(terms.select("term").distinct(), "pii-terms")
        places = found.select("uid", "text", "base").mapInArrow(
            _places, "uid string, places array<struct<term:string,start:long,end:long>>").select("uid", F.inline("places"))
        held = places.join(marked, "term").select("uid", F.struct(
            F.lit("term").alias("kind"), "start", "end").alias("s"))
        held = held.groupBy("uid").agg(F.array_sort(F.collect_set("s")).alias("terms"))
        done = found.join(held, "uid", "left").withColumn("terms", F.coalesce("terms", F.array().cast(f"array<{span}>")))
    return done.select(F.col("id").alias(id_col), "base", "terms",
                       *([clean(F.col("text"), F.concat("base", "terms")).alias("clean_text")] if keep_text else []))


def disclosing(texts: DataFrame, near: DataFrame, n_docs: int, support: int, threshold: float) -> DataFrame | None:
    """(entity, term) pairs over the threshold; None where no pair has the support."""
    pairs = near.groupBy("entity", "term").agg(F.count_distinct("uid").alias("n_te"),
                                               F.count_distinct("context").alias("contexts"))
    pairs = common.staged(pairs.filter(F.col("contexts") >= support), "pii-pairs")
    if pairs.isEmpty():
        return None
    # document frequencies of the pairs' terms, over all texts: counted first, so that a frequent term meets the pairs once
    held = texts.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))).alias("term"))
    n_t = held.groupBy("term").agg(F.count("*").alias("n_t"))
    n_e = near.join(pairs.select("entity").distinct(), "entity", "left_semi").groupBy("entity").agg(
        F.count_distinct("uid").alias("n_e"))
    gain = F.log(F.col("n_te") * F.lit(float(n_docs)) / (F.col("n_t") * F.col("n_e")))
    own = F.log(F.lit(float(n_docs)) / F.col("n_e"))
    scored = pairs.join(n_t, "term").join(n_e, "entity").withColumn("disclosure", F.when(own > 0, gain / own))
    return scored.filter(F.col("disclosure") >= threshold).select("entity", "term", "disclosure")


def _clean(text: pd.Series, spans: pd.Series) -> pd.Series:
    def one(t, found):
        if t is None:
            return None
        out, at = [], 0
        for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= at:
                word = t[s["start"]:s["end"]]
                label = (s["kind"].upper() if s["kind"] != "term" else "NUMBER" if word[:1].isdigit()
                         else "NAME" if word[:1].isupper() else "TERM")
                out += [t[at:s["start"]], f"[{label}]"]
                at = s["end"]
        return "".join(out) + t[at:]

    return pd.Series([one(t, f) for t, f in zip(text, spans)])


def clean(text: Column, spans: Column) -> Column:
    """The text with every span replaced by what it is."""
    return F.pandas_udf(_clean, "string")(text, spans)
