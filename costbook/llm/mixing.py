"""Operator 1: mixing sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents, repeated up to ``max_repeats``
times.  A copy's virtual finish time is the source's cumulative size up to and
including it, divided by the source's target.  All copies are range-sorted by
finish time and the order is truncated at the total budget (the sum of sizes).

Running totals are never one task's window over a source: documents are dealt
into key ranges of about ``ROWS`` rows, ranges into groups of ranges, and the
totals of the coarser level are added to those of the finer one.

Edge cases: a null source is a source of its own, last in order; null or empty
texts have size 0 and take 0; rows with a null id are told apart by their texts;
rows repeated exactly share one finish time and one decision; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Rows of one range: what one window group holds.
ROWS = 2048
_KEY_BITS = 28


def _before(totals: DataFrame, group: list[str], at: str, value: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over smaller ``at`` in the group, by two levels."""
    totals = totals.withColumn("_hi", F.shiftright(at, 11))
    inner = Window.partitionBy(*group, "_hi").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_hi").rowsBetween(Window.unboundedPreceding, -1)
    tops = totals.groupBy(*group, "_hi").agg(F.sum(value).alias("_t"))
    tops = tops.withColumn("_o", F.coalesce(F.sum("_t").over(outer), F.lit(0))).drop("_t")
    return (totals.withColumn("_i", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(tops, [*group, "_hi"]).withColumn("before", F.col("_i") + F.col("_o"))
            .drop("_i", "_o", "_hi"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """(source, rank, source_size, target): one row per source of ``sizes`` (source, size).

    Sources by code point, null last, weigh ``weights`` in turn.  A target stops at
    ``max_repeats`` times the source's size; the excess is reshared by weight until no
    target is above: the water level is that of the first source, by rising
    cap / weight, that the level of the rest does not fill.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = total.withColumn("rank", F.row_number().over(order) - 1).withColumn("w", w)
    s = s.withColumn("cap", F.lit(max_repeats) * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("w"))
    earlier = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0))
    s = s.withColumn("level", left / weight)
    level = F.min(F.when(F.col("level") < F.col("fill"), F.struct("fill", "rank", "level"))).over(everything)["level"]
    s = s.withColumn("water", level)
    # after the first source that is not filled, all later ones have a higher fill than the water
    target = F.when(F.col("water").isNotNull() & (F.col("fill") > F.col("water")), F.col("w") * F.col("water")).otherwise(
        F.col("cap"))
    return s.select("source", "rank", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
        weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3, keep: tuple[str, ...] = (), text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, ``keep``, size, source_size, target, copies and taken.

    A document's place in the shuffle follows from its id, or from its text where the id is null.
    """
    taken = [F.col(c) for c in keep if c not in (id_col, source_col)]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), size.cast("long").alias("size"),
                       F.md5(F.coalesce(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit(""))).alias("key"),
                       *[c.alias(f"_k{i}") for i, c in enumerate(taken)])
    rows = common.staged(rows, "mix")
    n = rows.count()
    shift = _KEY_BITS - min(_KEY_BITS, max(0, (n // ROWS).bit_length()))
    rows = rows.withColumn("range", F.shiftright(F.conv(F.substring("key", 1, 7), 16, 10).cast("long"), shift))
    sources = common.staged(source_targets(rows, weights, max_repeats), "mix-sources")
    # one row per source: joined by rank so that the null source joins too
    ranked = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(rows["*"], "rank", "source_size", "target")
    before = _before(ranked.groupBy("rank", "range").agg(F.sum("size").alias("size")), ["rank"], "range", "size")
    within = Window.partitionBy("rank", "range").orderBy("key", F.col("_id")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    timed = ranked.withColumn("run", F.sum("size").over(within)).join(
        before.select("rank", "range", "before"), ["rank", "range"])
    done = F.col("run") + F.col("before")
    times = F.array(*[
        F.when(F.col("size") > 0, (F.lit(e) * F.col("source_size") + done) / F.col("target")) for e in range(max_repeats)])
    timed = common.staged(timed.withColumn("finish", times).drop("run", "before", "range"), "mix-times")
    cut = _cut(timed, n * max_repeats)
    copies = F.lit(0)
    if cut is not None:
        for e in range(max_repeats):
            place = F.struct(F.get("finish", F.lit(e)).alias("f"), F.col("rank").alias("r"), F.col("key").alias("k"),
                             F.lit(e).alias("e"))
            edge = F.struct(F.lit(cut[0]).alias("f"), F.lit(cut[1]).alias("r"), F.lit(cut[2]).alias("k"),
                            F.lit(cut[3]).alias("e"))
            copies = copies + F.when(F.get("finish", F.lit(e)).isNotNull() & (place <= edge), 1).otherwise(0)
    out = timed.withColumn("copies", copies.cast("long"))
    return out.select(F.col("_id").alias(id_col), F.col("source").alias(source_col),
                      *[F.col(f"_k{i}").alias(c) for i, c in enumerate(x for x in keep if x not in (id_col, source_col))],
                      "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))


def _cut(timed: DataFrame, copies: int) -> tuple | None:
    """The last place (finish, rank, key, repeat) of the global order within the budget.

    The order is dealt into ranges of finish time; their running totals say which
    range holds the cut, and only that range is sorted.
    """
    ranges = max(1, copies // ROWS)
    at = F.least(F.floor(F.col("f") * ranges), F.lit(64 * ranges)).cast("long").alias("range")
    places = timed.select("rank", "key", "size", F.posexplode("finish").alias("e", "f")).filter("f IS NOT NULL")
    places = places.withColumn("range", at)
    totals = _before(places.groupBy("range").agg(F.sum("size").alias("size")), [], "range", "size")
    budget = timed.agg(F.sum("size")).first()[0] or 0
    held = totals.filter(F.col("before") <= F.lit(budget)).agg(F.max(F.struct("range", "before"))).first()[0]
    if held is None:
        return None
    order = ["f", "rank", "key", "e"]
    upto = Window.partitionBy("range").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = places.filter(F.col("range") == held["range"]).withColumn("run", F.sum("size").over(upto) + F.lit(held["before"]))
    last = edge.filter(F.col("run") <= budget).agg(F.max(F.struct(*order))).first()[0]
    if last is None:  # the range's first copy is already over: the range before ends the mix
        last = places.filter(F.col("range") < held["range"]).agg(F.max(F.struct(*order))).first()[0]
    return None if last is None else tuple(last)


def oracle_sql() -> str:
    """DuckDB SQL of op1_mix_sources."""
    return r"""WITH rows AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, text, '')) AS key,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sources),
capped AS (SELECT *, 3 * source_size AS cap, [5.0::DOUBLE, 2.0, 1.0][rank % 3 + 1] AS w FROM weighed),
filled AS (SELECT *, cap / w AS fill FROM capped),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER e, 0))::DOUBLE
    / (sum(w) OVER () - coalesce(sum(w) OVER e, 0)) AS level FROM filled
  WINDOW e AS (ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT level FROM levels WHERE level < fill ORDER BY fill, rank LIMIT 1),
targets AS (SELECT *, CASE WHEN fill > (SELECT level FROM water) THEN w * (SELECT level FROM water) ELSE cap END::DOUBLE AS target
  FROM levels),
run AS (SELECT r.*, t.rank, t.source_size, t.target, sum(r.size) OVER (PARTITION BY t.rank ORDER BY key, doc_id) AS done
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
places AS (SELECT *, (e * source_size + done)::DOUBLE / target AS f FROM run, range(3) AS x(e) WHERE size > 0),
ordered AS (SELECT *, sum(size) OVER (ORDER BY f, rank, key, e) AS upto FROM places),
counted AS (SELECT rank, key, doc_id, size, count(*) / count(DISTINCT e) AS same, count(DISTINCT e) AS copies FROM ordered
  WHERE upto <= (SELECT sum(size) FROM rows) GROUP BY rank, key, doc_id, size)
SELECT r.doc_id, r.source, r.size, r.source_size, r.target, coalesce(c.copies, 0) AS copies,
  r.size * coalesce(c.copies, 0) AS taken
FROM run r LEFT JOIN counted c ON r.rank = c.rank AND r.key = c.key AND r.doc_id IS NOT DISTINCT FROM c.doc_id AND r.size = c.size"""
