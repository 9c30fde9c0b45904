"""Operator 4: n-gram Jaccard join by vertical partitioning.

A document's set of word n-grams is put in one global order (rare before frequent
n-grams; the frequent ones are known from counts over all documents) and the order is
cut into fragments.  A pair's overlap is counted per fragment and the partial counts
are summed per pair.

Only pairs that share an n-gram of their first ``p = n - ceil(s n) + 1`` can reach the
similarity s, and only pairs that share 1 + e n-grams of their first ``p + e`` can.  So
documents show half as many n-grams again as p; how many classes show each is counted
exactly, by a shuffle; and a document leaves out the e that most others show.  Of the
shared ones the rarest stays on both sides, so no pair is missed, and n-grams that the
order wrongly takes for rare offer no pairs.  A document that shares fewer than 1 + e of
its early n-grams with any other leaves altogether.  The pairs left must also agree in
their signatures: the parities of a set's n-grams in each of as many cells as it has
n-grams, so that two sets differ in at least as many n-grams as their signatures in bits.

Copies are one class and take part once.  A bucket (the classes that share an early
n-gram) of up to ``SMALL`` members offers all its pairs; a larger one offers a star around one member, then, where the links
found leave it in several components, a star around a second one, then the likeliest
partners, and then every pair across components that could still link: no
link between components is missed,
and no group of near copies is expanded into all its pairs.

Edge cases: A-Z is lower-cased, nothing else; fewer words than n form one n-gram; null,
empty and blank texts have no n-grams and are alone; null ids take part, their class is
named by its other ids or null; repeated rows are copies; other columns are ignored.
N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import slices

#: Fragments of the global order; the last holds the frequent n-grams.
FRAGMENTS = 8
#: Buckets of more classes than this are joined by stars first.
SMALL = 4
#: Partners that a class of a large bucket is compared with before the rest.
LIKELIEST = 3
#: So many n-grams of a class are looked up to offer a pair once; pairs that share only others are offered more often.
LEAST = 32
#: At most so many n-grams are known to be frequent: one megabyte for each task.
FREQUENT = 1 << 17
#: Ids of candidates are broadcast up to so many bytes.
BROADCAST_BYTES = 16 << 20
#: Bits of a signature at least; sets of more n-grams have longer ones, by powers of two.
SIGNATURE_BITS = 512
_FLUSH = 1 << 22


def ngram_hashes(data: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of UTF-8 text."""
    words = data.lower().split() if data else []
    if not words:
        return np.empty(0, np.int64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h = (h ^ w[i:len(w) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h.view(np.int64))


def least_overlap(size: int, percent: int) -> int:
    """The n-grams that a set of ``size`` shares at least with any that it links with."""
    return -(-percent * size // 100)


def spare(size: int, percent: int) -> int:
    """e: the early n-grams that a set shows beyond its prefix (it grows with the size)."""
    return max(0, min((100 - percent) * size // 200, least_overlap(size, percent) - 1))


def _least_overlap(size: Column, percent: int) -> Column:
    return F.ceil(F.lit(percent) * size / F.lit(100))


def _spare(size: Column, percent: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.floor(F.lit(100 - percent) * size / F.lit(200)), _least_overlap(size, percent) - 1))


def _class(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The parity of the hashes in each cell, 64 cells a number."""
    bits = max(SIGNATURE_BITS, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount(hashes & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _scan(n: int):
    """Rows of documents (id, size, class), the first of a class in a task with its signature, and
    of n-grams counted in several documents of a slice."""

    def run(batches):
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def counted():
            token, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.int64),) * 2
            held.clear()
            keep = times >= 3
            return pa.RecordBatch.from_arrays(
                [pa.nulls(int(keep.sum()), kind), pa.array(times[keep]), pa.nulls(int(keep.sum()), pa.int64()),
                 pa.array(token[keep]), pa.nulls(int(keep.sum()), pa.list_(pa.int64()))], names=["id", "size", "node", "token", "sign"])

        kind = None
        for part in slices(batches):
            kind, sizes, nodes, signs = part.column(0).type, [], [], []
            for data in part.column(1).to_pylist():
                h = ngram_hashes(data, n)
                sizes.append(len(h))
                nodes.append(_class(h) if len(h) else None)
                signs.append(None)
                if len(h) and nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    held.append(h)
                    signs[-1] = signature(h)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(len(sizes), pa.int64()),
                 pa.array(signs, pa.list_(pa.int64()))], names=["id", "size", "node", "token", "sign"])
            if sum(map(len, held)) > _FLUSH:
                yield counted()
        if kind is not None:
            yield counted()

    return run


class Order:
    """The global order: n-grams not known as frequent by hash, then the frequent ones, rarest first."""

    def __init__(self, frequent: list[int]):
        f = np.array(frequent, dtype=np.int64)
        by = np.argsort(f)
        self.known, self.place = f[by], by  # place 0 is the most frequent

    def split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.known):
            return hashes, hashes[:0]
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        often = self.known[at] == hashes
        return hashes[~often], hashes[often][np.argsort(-self.place[at[often]], kind="stable")]

    def prefix(self, hashes: np.ndarray, length: int) -> np.ndarray:
        rare, often = self.split(hashes)
        return rare[:length] if len(rare) >= length else np.concatenate([rare, often[:length - len(rare)]])

    def fragments(self, hashes: np.ndarray):
        """(fragment, hashes) of the non-empty fragments; cuts stand at fixed places of the order."""
        rare, often = self.split(hashes)
        edges = [int(-(1 << 63) + k * (1 << 64) / (FRAGMENTS - 1)) for k in range(1, FRAGMENTS - 1)]
        for k, part in enumerate(np.split(rare, np.searchsorted(rare, np.array(edges, dtype=np.int64)))):
            if len(part):
                yield k, part
        if len(often):
            yield FRAGMENTS - 1, np.sort(often)


def _prefixes(n: int, percent: int, order: Order):
    """(token, node, size, place) of the first n-grams of every class of a task."""

    def run(batches):
        seen: set[int] = set()
        for part in slices(batches):
            tokens, nodes, sizes, places = [], [], [], []
            for data in part.column(0).to_pylist():
                h = ngram_hashes(data, n)
                node = _class(h) if len(h) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                first = order.prefix(h, len(h) - least_overlap(len(h), percent) + 1 + spare(len(h), percent))
                tokens.append(first)
                nodes.append(np.full(len(first), node))
                sizes.append(np.full(len(first), len(h)))
                places.append(np.arange(len(first)))
            if tokens:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tokens)), pa.array(np.concatenate(nodes)),
                    pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(places).astype(np.int32))],
                    names=["token", "node", "size", "place"])

    return run


def _segments(n: int, order: Order):
    """(node, fragment, grams) of the classes of the documents given, once a task."""

    def run(batches):
        seen: set[int] = set()
        for part in slices(batches, 128):
            nodes, numbers, grams = [], [], []
            for data in part.column(0).to_pylist():
                h = ngram_hashes(data, n)
                node = _class(h)
                if node in seen:
                    continue
                seen.add(node)
                for k, some in order.fragments(h):
                    nodes.append(node)
                    numbers.append(k)
                    grams.append(some)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(numbers, pa.int32()),
                                              pa.array(grams, pa.list_(pa.int64()))], names=["node", "fragment", "grams"])

    return run


def _could_link(percent: int) -> Column:
    """Whether two bucket rows (a and b) can reach the similarity, by sizes and places."""
    need = F.ceil(F.lit(percent) * (F.col("size_a") + F.col("size_b")) / F.lit(100 + percent))
    most = F.least("place_a", "place_b") + 1 + F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) - 1
    return (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")) & (most >= need)


def _sided(rows: DataFrame, side: str, *more: str) -> DataFrame:
    return rows.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "size", "place", *more)])


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b, size_a, size_b), a < b, of joined bucket rows that could link."""
    return rows.filter(_could_link(percent)).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"),
        F.when(F.col("node_a") < F.col("node_b"), F.col("size_a")).otherwise(F.col("size_b")).alias("size_a"),
        F.when(F.col("node_a") < F.col("node_b"), F.col("size_b")).otherwise(F.col("size_a")).alias("size_b")).distinct()


def _differing(a: Column, b: Column) -> Column:
    """The bits in which two signatures differ; one twice as long is folded, other lengths count as equal."""
    def xor(x, y):
        return x.bitwiseXOR(y)

    def bits(x, y):
        return F.aggregate(F.zip_with(x, y, xor), F.lit(0), lambda n, v: n + F.bit_count(v))

    def folded(x):
        half = F.shiftright(F.size(x), 1)
        return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), xor)

    return F.when(F.size(a) == F.size(b), bits(a, b)).when(F.size(a) == 2 * F.size(b), bits(folded(a), b)).when(
        F.size(b) == 2 * F.size(a), bits(folded(b), a)).otherwise(F.lit(0))


def _alike(percent: int) -> Column:
    """Whether two classes (a and b) can reach the similarity, by their signatures."""
    need = F.ceil(F.lit(percent) * (F.col("size_a") + F.col("size_b")) / F.lit(100 + percent))
    return F.col("size_a") + F.col("size_b") - _differing(F.col("sign_a"), F.col("sign_b")) >= 2 * need


def _shared_enough(pairs: DataFrame, early: DataFrame, percent: int) -> DataFrame:
    """The pairs whose early n-grams and signatures agree in enough places.

    All common ones of the n-grams that two documents show are in ``early``.  Where the
    list that ends first in the order ends, all before it is known, and at most the rest
    of that document can still agree: the overlap is at most common + size - list length.
    It is also at most half of what the sizes sum to beyond the signatures' different bits.
    """
    rest = lambda size: _least_overlap(F.col(size), percent) - 1 - _spare(F.col(size), percent)
    need = F.ceil(F.lit(percent) * (F.col("size_a") + F.col("size_b")) / F.lit(100 + percent))
    both = pairs.join(early.select(F.col("node").alias("a"), F.col("early").alias("early_a"), F.col("sign").alias("sign_a")), "a").join(
        early.select(F.col("node").alias("b"), F.col("early").alias("early_b"), F.col("sign").alias("sign_b")), "b")
    both = both.filter(_alike(percent))
    both = both.withColumn("shared", F.size(F.array_intersect("early_a", "early_b")))
    return both.filter(F.col("shared") + F.greatest(rest("size_a"), rest("size_b")) >= need).select(
        "a", "b", "size_a", "size_b", "shared")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per row of ``docs``: the id, n_shingles and component_id (the smallest id reachable by links)."""
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("data"))
    rows = common.staged(read.mapInArrow(_scan(words), f"id {kind}, size long, node long, token long, sign array<long>"), "ngram-scan")
    found = rows.filter("token IS NULL")
    often = rows.filter("token IS NOT NULL").groupBy("token").agg(F.sum("size").alias("n")).filter("n >= 8")
    order = Order([r["token"] for r in often.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()])
    early = _early(read, found, words, percent, order)
    label = _labels(read, found, early, _buckets(early, percent), words, percent, order)
    classes = found.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    labelled = classes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    of = labelled.join(names, "component").select("node", "component_id")
    return found.join(of, "node", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _early(read: DataFrame, found: DataFrame, words: int, percent: int, order: Order) -> DataFrame:
    """(node, size, shown, early, sign) of the classes that share enough of the n-grams they show: these
    as (members, token, place), those that most classes show first, their tokens, and the class's signature."""
    rows = read.select("data").mapInArrow(_prefixes(words, percent, order), "token long, node long, size int, place int")
    token = Window.partitionBy("token")
    shared = rows.withColumn("lead", F.min("node").over(token)).withColumn("last", F.max("node").over(token))
    shared = shared.filter("lead != last").drop("lead", "last").dropDuplicates(["token", "node"])
    shared = shared.withColumn("members", F.count("*").over(token))
    # a class's list is never longer than the list of one of its documents
    lists = shared.groupBy("node").agg(F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("members", "token", "place")), asc=False).alias("shown"))
    enough = lists.filter(F.size("shown") > _spare(_least_overlap(F.col("size"), percent), percent))
    sign = found.filter("sign IS NOT NULL").groupBy("node").agg(F.first("sign").alias("sign"))
    return common.staged(enough.withColumn("early", F.col("shown.token")).join(sign, "node"), "ngram-early")


def _buckets(early: DataFrame, percent: int) -> DataFrame:
    """(token, node, size, place, members, lead, other): the early n-grams that offer pairs and who shares them.

    A class leaves out as many of its most shown n-grams as the smallest class that it can
    link with shows beyond its prefix: any two that link share at least one more than that.
    """
    spare_ = _spare(_least_overlap(F.col("size"), percent), percent).cast("int")
    kept = early.select("node", "size", F.inline(F.slice("shown", spare_ + 1, F.size("shown")))).drop("members")
    token = Window.partitionBy("token")
    kept = kept.withColumn("members", F.count("*").over(token)).filter("members > 1")
    # a second centre that differs from bucket to bucket
    some = F.min(F.struct(F.xxhash64("node", "token").alias("h"), F.col("node").alias("node"))).over(token)["node"]
    return common.staged(kept.withColumn("lead", F.min("node").over(token)).withColumn("other", some).select(
        "token", "node", "size", "place", "members", "lead", "other"), "ngram-buckets")


def _labels(read: DataFrame, found: DataFrame, early: DataFrame, buckets: DataFrame, words: int, percent: int, order: Order) -> DataFrame:
    """(node, component) of the linked classes, from links that suffice for the components."""
    small, large = buckets.filter(F.col("members") <= SMALL), buckets.filter(F.col("members") > SMALL)
    both = _sided(small, "a").join(_sided(small, "b"), "token").filter("node_a < node_b")
    stars = _sided(large, "a").join(_sided(large.filter("node = lead"), "b"), "token").filter("node_a != node_b")
    pairs = common.staged(_pairs(both.unionByName(stars), percent), "ngram-pairs")
    near = common.staged(_shared_enough(pairs, early, percent), "ngram-near")
    label = common.connected_components(_verified(read, found, near, words, percent, order))
    if large.isEmpty():
        return label
    # a second centre meets only what the first star left in other components
    placed = _placed(large, label)
    second = _sided(placed.filter("node = other"), "b", "component")
    stars = _sided(placed, "a", "component").join(second, "token").filter("component_a != component_b")
    more = common.staged(_pairs(stars, percent).join(pairs, ["a", "b"], "left_anti"), "ngram-second")
    near = common.staged(_shared_enough(more, early, percent), "ngram-near")
    pairs = pairs.unionByName(more)
    label = _joined(label, _verified(read, found, near, words, percent, order))
    placed = _placed(large, label).drop("members", "lead", "other")
    # the bucket's largest component needs no pairs within itself: the others meet it and each other
    sizes = placed.groupBy("token", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("token").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("parts"))
    apart = common.staged(placed.join(main.filter("parts > 1"), "token").withColumn(
        "inner", F.col("component") == F.col("main")).drop("main", "parts"), "ngram-apart")
    # a pair that shares several n-grams is offered by the first of them that both show among their LEAST
    least = apart.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("token")), 1, LEAST).alias("least"))
    # (the signatures are looked at inside the join: of a large group of copies too far apart, no pairs are made)
    apart = common.staged(apart.join(least, "node").join(early.select("node", "sign"), "node"), "ngram-offers")
    across = _sided(apart.filter("NOT inner"), "a", "component", "least", "sign").join(
        _sided(apart, "b", "component", "least", "inner", "sign"), "token").filter(
        "component_a != component_b AND (inner_b OR node_a < node_b)").filter(_could_link(percent)).filter(
        F.coalesce(F.array_min(F.array_intersect("least_a", "least_b")) >= F.col("token"), F.lit(True))).filter(_alike(percent))
    rest = _pairs(across, percent).join(pairs, ["a", "b"], "left_anti")
    rest = common.staged(_shared_enough(rest, early, percent), "ngram-rest")
    if rest.isEmpty():
        return label
    # the likeliest partners of each class first: what they join needs no other pair
    ends = rest.select("a", "b", "shared", F.explode(F.array("a", "b")).alias("node"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("shared"), "a", "b"))
    likely = ends.withColumn("place", place).filter(F.col("place") <= LIKELIEST).select("a", "b").distinct()
    first = common.staged(rest.join(likely, ["a", "b"], "left_semi"), "ngram-likely")
    label = common.staged(_joined(label, _verified(read, found, first, words, percent, order)), "ngram-labels")
    left = rest.join(likely, ["a", "b"], "left_anti")
    for side in "ab":
        left = left.join(label.select(F.col("node").alias(side), F.col("component").alias(f"in_{side}")), side, "left")
    apart = F.coalesce("in_a", "a") != F.coalesce("in_b", "b")
    left = common.staged(left.filter(apart).select("a", "b", "size_a", "size_b"), "ngram-left")
    if left.isEmpty():
        return label
    return _joined(label, _verified(read, found, left, words, percent, order))


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (node, component) after more links: those between two components join these."""
    if links.isEmpty():
        return label
    known = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return common.connected_components(known.unionByName(links))


def _placed(large: DataFrame, label: DataFrame) -> DataFrame:
    """The bucket rows with the component that the links found give their class."""
    return common.staged(large.join(label, "node", "left").withColumn("component", F.coalesce("component", "node")), "ngram-placed")


def _verified(read: DataFrame, found: DataFrame, pairs: DataFrame, words: int, percent: int, order: Order) -> DataFrame:
    """The pairs whose partial overlaps sum to the similarity."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    classes = found.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"))
    ids = common.staged(classes.join(nodes, "node", "left_semi").select(F.col("id").alias("want")).distinct(), "ngram-ids")
    # few ids are broadcast, so that the texts stay where they are; many meet the texts in a shuffle
    size = ids.agg(F.sum(F.length(F.col("want").cast("string")) + 16)).first()[0] or 0
    few = F.broadcast(ids) if size <= BROADCAST_BYTES else ids
    texts = read.join(few, F.col("id").eqNullSafe(F.col("want")), "left_semi").select("data")
    segments = texts.mapInArrow(_segments(words, order), "node long, fragment int, grams array<long>")
    segments = common.staged(segments, "ngram-segments")
    # rows that share an id can give a class in several tasks
    if not segments.groupBy("node", "fragment").count().filter("count > 1").isEmpty():
        several, segments = segments, common.staged(segments.dropDuplicates(["node", "fragment"]), "ngram-segments")
        common.discard(several)
    # both sides read the same segments by the same keys, so that these are dealt out once
    cells = pairs.select("a", "b", "size_a", "size_b", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("part"))
    one = cells.join(segments.alias("x"), (F.col("a") == F.col("x.node")) & (F.col("part") == F.col("x.fragment"))).select(
        "a", "b", "size_a", "size_b", "part", F.col("x.grams").alias("grams_a"))
    two = one.join(segments.alias("y"), (F.col("b") == F.col("y.node")) & (F.col("part") == F.col("y.fragment")))
    overlap = two.select("a", "b", "size_a", "size_b", F.size(F.array_intersect("grams_a", "y.grams")).alias("n")).groupBy(
        "a", "b", "size_a", "size_b").agg(F.sum("n").alias("n"))
    linked = overlap.filter(100 * F.col("n") >= percent * (F.col("size_a") + F.col("size_b") - F.col("n"))).select("a", "b")
    linked = common.staged(linked, "ngram-linked")
    common.discard(segments)
    return linked
