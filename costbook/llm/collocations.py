"""Operator 11: phrase collocations by dynamic itemset counting.

The documents are dealt into shards, and the shards are scanned in a cycle.  Single
words are counted from the first scan on.  A longer phrase is counted as soon as both
phrases that it holds (without its last and without its first word) have reached the
threshold, in the scan after that, so lengths interleave; its count is complete after
one full cycle from there.  The scans end when no phrase has shards left.

A scan is one job: a task counts its words and the active phrases in it (integer codes
of its own words, so nothing is compared by a hash), and the counts meet the counts so
far in one shuffle.  Phrases travel and are kept in blocks, a row for up to ``BLOCK``
phrases of one language, length and bucket: with a row a phrase most of the time went there.
A bucket is a share of the phrases by hash; there are as many as the texts need
(``BUCKET_BYTES``, at least ``BUCKETS``).  A partition's blocks come sorted by bucket, and
the phrases of a few buckets at a time are added up by their text.  Which phrases have reached the threshold is sent to
the tasks as bit maps of ``FILTER_BITS`` bits a length: phrases over the threshold, and
those that passed it since each scan of the last cycle.  Their size is fixed.  A false hit only
counts a phrase too early.  Counts are kept per shard and counting a shard again gives
the same number, so early counts change nothing; and a phrase with a word below the
threshold stays below it.

Counts are by language.  A candidate is cut into two parts where floor(scale * a * a /
(l * r)) is lowest (a, l, r: occurrences of the phrase and of its parts).  Candidates
whose words lie in a longer candidate with at least half their occurrences are dropped.

Edge cases: null languages are ``und``; null, empty and blank texts and pieces without a
word count nothing; repeated rows count each; ties go to the smaller cut, and in the
ranking to more occurrences, then to the phrase in byte order; an empty table gives no
rows; other columns are ignored.  Products are decimals of 38 digits: exact up to 10^15
occurrences of a phrase, an error beyond.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import slices

UNKNOWN = "und"
#: Characters that end a piece (fixed values): ``.,;:!?`` and U+000A to U+000D.
ENDS = b".,;:!?\n\x0b\x0c\r"
#: Bits of each map of phrases over the threshold: half a megabyte.
FILTER_BITS = 1 << 22
#: Words that a task holds before it passes on its counts.
HELD_WORDS = 1 << 22
#: Buckets of phrases: one for so many bytes of text, and no fewer than ``BUCKETS``.
BUCKET_BYTES = 1 << 22
BUCKETS = 1 << 12
#: Phrases in a row, and about how many are added up at a time (but always whole buckets).
BLOCK = 64
MERGED = 1 << 16
_SEED = 42


# --- bit maps ---------------------------------------------------------------------
def _turned(h: Column) -> Column:
    return F.shiftleft(h, 7).bitwiseOR(F.shiftrightunsigned(h, 57))


def _phrase_hash(lang: Column, phrase: Column) -> Column:
    """The words' hashes (seeded with the language), folded from the left."""
    words = F.transform(F.split(phrase, " "), lambda w: F.xxhash64(lang, w))
    return F.aggregate(F.slice(words, 2, 64), F.get(words, F.lit(0)), lambda h, w: _turned(h).bitwiseXOR(w))


def _folded(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return ((h << np.uint64(7)) | (h >> np.uint64(57))) ^ w


def _maps(state: DataFrame, scan: int, shards: int, longest: int, bits: int) -> dict[int, tuple[np.ndarray, dict[int, np.ndarray]]]:
    """Per length below the longest: bits of the phrases over the threshold, and per scan of
    the last cycle the bits of those that reached it in that scan or later."""
    over = state.filter("over").filter(F.col("words").between(1, longest - 1)).select(
        "lang", "words", F.explode(F.arrays_zip("phrase", "reach")).alias("p")).select("lang", "words", "p.phrase", "p.reach")
    at = over.select("words", "reach", _phrase_hash(F.col("lang"), F.col("phrase")).bitwiseAND(F.lit(bits - 1)).alias("at"))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    since = [k for k in range(scan - shards, scan) if k >= 0]
    rows = at.groupBy("words", F.shiftrightunsigned("at", 6).alias("word")).agg(
        F.bit_or(bit).alias("over"), *[F.bit_or(F.when(F.col("reach") >= k, bit).otherwise(F.lit(0))).alias(f"s{k}") for k in since])
    none = lambda: np.zeros(max(bits // 64, 1), np.uint64)
    maps = {n: (none(), {k: none() for k in since}) for n in range(1, longest)}
    for r in rows.collect():  # at most bits / 64 rows a length
        over, late = maps[r["words"]]
        over[r["word"]] = np.int64(r["over"]).astype(np.uint64)
        for k in since:
            late[k][r["word"]] = np.int64(r[f"s{k}"]).astype(np.uint64)
    return maps


def _recent(maps, hashes: np.ndarray) -> np.ndarray:
    """The scan of the last cycle in which a phrase reached the threshold at the latest, -1 for an earlier one, -2 if it has not."""
    over, late = maps
    out = np.where(_has(over, hashes), -1, -2).astype(np.int32)
    for k in sorted(late):
        out[_has(late[k], hashes)] = k
    return out


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


# --- blocks -----------------------------------------------------------------------
def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _blocks(key: np.ndarray, fixed: dict[str, pa.Array], lists: dict[str, pa.Array]):
    """Batches of blocks of rows in the order of their keys: rows of one key agree in ``fixed``, and
    each block has the ``lists`` of up to ``BLOCK`` of them."""
    if not len(key):
        return
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    place = np.arange(len(key)) - np.repeat(begins, np.diff(np.append(begins, len(key))))
    cuts = np.append(np.flatnonzero(place % BLOCK == 0), len(key))
    for at in range(0, len(cuts) - 1, 2048):
        part = cuts[at:at + 2049]
        first, offsets = pa.array(part[:-1]), pa.array(part - part[0], pa.int32())
        columns = {k: v.take(first) for k, v in fixed.items()}
        columns |= {k: pa.ListArray.from_arrays(offsets, v[part[0]:part[-1]]) for k, v in lists.items()}
        yield pa.RecordBatch.from_pydict(columns)


def _parts(rows: np.ndarray):
    return (rows[at:at + MERGED] for at in range(0, len(rows), MERGED))


def _flat(blocks: pa.Table, names: list[str]) -> pa.Table:
    """A row for each phrase of the blocks."""
    size = pc.list_value_length(blocks["phrase"]).to_numpy()
    return pa.table({**{k: np.repeat(blocks[k].to_numpy(), size) for k in ("kind", "bucket")}, **{k: pc.list_flatten(blocks[k]) for k in names}})


# --- one scan ---------------------------------------------------------------------
def _spaced() -> bytes:
    table = bytearray(range(256))
    for c in ENDS:
        table[c] = ord(".")
    table[9] = 32
    return bytes(table)


class _Counter:
    """Counts of one language's words and active phrases in the texts of a task."""

    def __init__(self, lang: str):
        self.seed = xxhash.xxh64_intdigest(lang.encode(), seed=_SEED)
        self.lang = lang
        self.code: dict[bytes, int] = defaultdict()
        self.code.default_factory = self.code.__len__
        self.code[b"."]  # the end of a piece is 0
        self.held: list[np.ndarray] = []

    def add(self, data: bytes, table: bytes) -> int:
        words = data.lower().translate(table).replace(b".", b" . ").split()  # lower() of bytes: A-Z only
        if words:
            self.held += [np.fromiter(map(self.code.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        return len(words)

    def rows(self, words_too: bool, maps: dict, longest: int, shards: int, buckets: int):
        """(words, buckets, phrases, counts, untils) of the held texts in the order of their buckets, up
        to ``MERGED`` phrases at a time; words 0 is the number of all words, until the last scan in
        which a phrase is counted."""
        if not self.held:
            return
        text, self.held = np.concatenate(self.held), []
        names = pa.array(list(self.code), pa.binary())
        size = len(names)
        own = np.fromiter((xxhash.xxh64_intdigest(w, seed=self.seed) for w in self.code), np.uint64, size)
        if words_too:
            n = np.bincount(text, minlength=size)
            yield 0, np.zeros(1, np.int32), pa.array([b""], pa.binary()), np.array([n[1:].sum()]), np.array([shards - 1])
            if size > 1:
                bucket = _buckets(own[1:], buckets)
                order = np.argsort(bucket, kind="stable")
                for by in _parts(order):
                    yield 1, bucket[by], names.take(pa.array(by + 1)), n[by + 1], np.full(len(by), shards - 1)
        if not maps:
            return
        recent = _recent(maps[1], own)
        recent[0] = -2
        recent = recent[text]  # of the phrase of length - 1 that starts at each word
        for length in range(2, longest + 1):
            latest = np.maximum(recent[:-1], recent[1:])
            both = np.nonzero((recent[:-1] > -2) & (recent[1:] > -2))[0]
            active = both[latest[both] > -1]
            if len(active):
                code, bound = text[active].astype(np.int64), size
                for k in range(1, length):
                    if bound * size > 1 << 62:  # renumbered, so that codes never pass 64 bits
                        code, bound = np.unique(code, return_inverse=True)[1].astype(np.int64), len(active)
                    code, bound = code * size + text[active + k], bound * size
                by = np.argsort(code)
                code = code[by]
                first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                n, starts = np.diff(np.append(first, len(code))), active[by[first]]
                del code, by, first, active
                bucket = _buckets(self.hashes(own, text, starts, length), buckets)
                order = np.argsort(bucket, kind="stable")
                for by in _parts(order):
                    at = starts[by]
                    phrases = pc.binary_join_element_wise(*[names.take(pa.array(text[at + k])) for k in range(length)], b" ")
                    yield length, bucket[by], phrases, n[by], latest[at] + shards
            if length < longest:
                recent = np.full(len(latest), -2, np.int32)
                recent[both] = _recent(maps[length], self.hashes(own, text, both, length))

    @staticmethod
    def hashes(own: np.ndarray, text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the phrases that start at the words ``at``."""
        out = own[text[at]]
        for k in range(1, length):
            out = _folded(out, own[text[at + k]])
        return out


def _scan(words_too: bool, maps, longest: int, shards: int, held_words: int, buckets: int):
    """Blocks (bucket, lang, words, [phrase], [n], [until]) of a task's texts; ``maps`` is a broadcast."""

    def run(batches):
        table, counters, held = _spaced(), {}, 0

        def passed_on():
            for c in counters.values():
                for length, bucket, phrases, n, until in c.rows(words_too, maps.value, longest, shards, buckets):
                    fixed = {"bucket": pa.array(bucket), "lang": pa.repeat(c.lang, len(n)), "words": pa.repeat(pa.scalar(length, pa.int32()), len(n))}
                    yield from _blocks(bucket, fixed, {"phrase": phrases.cast(pa.string()), "n": pa.array(n, pa.int64()), "until": pa.array(until, pa.int32())})

        for part in slices(batches, 256):
            for lang, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if data:
                    if lang not in counters:
                        counters[lang] = _Counter(lang)
                    held += counters[lang].add(data, table)
                    if held >= held_words:
                        yield from passed_on()
                        counters, held = {}, 0
        yield from passed_on()

    return run


# --- the cycle --------------------------------------------------------------------
def _add_up(scan: int, kept: list[str], least: int):
    """Blocks in the order of their buckets, found ones and kept ones, to the blocks kept next."""
    now = kept[scan % len(kept)]

    def summed(blocks: pa.Table):
        langs, words = blocks["lang"].combine_chunks().dictionary_encode(), blocks["words"].to_numpy()
        lengths = int(words.max()) + 1
        blocks = blocks.append_column("kind", pa.array(langs.indices.to_numpy().astype(np.int64) * lengths + words))
        is_found = pc.is_valid(blocks["n"])
        rows = pa.concat_tables([_flat(blocks.filter(is_found), ["phrase", "n", "until"]),
                                 _flat(blocks.filter(pc.invert(is_found)), ["phrase", *kept, "reach", "until"])], promote_options="default")
        sums = rows.group_by(["kind", "phrase"], use_threads=False).aggregate(
            [("bucket", "min"), ("n", "sum"), *((c, "max") for c in (*kept, "reach", "until"))]).combine_chunks()
        counted = {c: sums[f"{c}_max"] for c in kept}
        counted[now] = pc.coalesce(sums["n_sum"], counted[now])
        enough = pc.greater_equal(reduce(pc.add, [c.fill_null(0) for c in counted.values()]), least)
        reach = pc.coalesce(sums["reach_max"], pc.if_else(enough, pa.scalar(scan, pa.int32()), pa.scalar(None, pa.int32())))
        kind, until = sums["kind"].to_numpy(), sums["until_max"]
        stays = pc.or_(pc.or_(enough, pc.greater(until, scan)), pa.array(kind % lengths == 0))
        key = (kind * 2 + pc.is_valid(reach).to_numpy()) << 32 | sums["bucket_min"].to_numpy()
        at = np.flatnonzero(stays.to_numpy())
        at = at[np.argsort(key[at], kind="stable")]
        key, by = key[at], pa.array(at)
        kind, over = np.divmod(key >> 32, 2)
        fixed = {"bucket": pa.array(key & 0xFFFFFFFF, pa.int32()), "lang": langs.dictionary.take(pa.array(kind // lengths)),
                 "words": pa.array(kind % lengths, pa.int32()), "over": pa.array(over == 1)}
        lists = {"phrase": sums["phrase"], **counted, "reach": reach, "until": until}
        yield from _blocks(key, fixed, {k: v.take(by).combine_chunks() for k, v in lists.items()})

    def run(batches):
        held, size = [], 0
        for part in slices(batches):
            held.append(part)
            size += pc.sum(pc.list_value_length(part["phrase"])).as_py()
            if size >= MERGED and part["bucket"][-1] != held[0]["bucket"][0]:  # all but the last bucket are whole
                blocks = pa.Table.from_batches(held).combine_chunks()
                cut = int(np.searchsorted(blocks["bucket"].to_numpy(), part["bucket"][-1].as_py()))
                yield from summed(blocks[:cut])
                held = blocks[cut:].to_batches()
                size = sum(pc.sum(pc.list_value_length(b["phrase"])).as_py() for b in held)
        if held:
            yield from summed(pa.Table.from_batches(held).combine_chunks())

    return run


def _merged(state: DataFrame | None, found: DataFrame, scan: int, shards: int, least: int) -> DataFrame:
    """The counts so far with a scan's, in blocks: per phrase one count a shard, the scan in
    which it reached ``least``, and the last scan that counts it.  ``over`` blocks hold the phrases
    that reached it.  A phrase whose cycle has ended below the threshold goes.  (One that a
    false hit counted too early may go, too: its own cycle counts all shards again.)"""
    kept = [f"c{j}" for j in range(shards)]
    longs = F.lit(None).cast("array<long>")
    columns = ["bucket", "lang", "words", "phrase", "n", *kept, "reach", "until"]
    rows = found.select("*", *[longs.alias(c) for c in kept], F.lit(None).cast("array<int>").alias("reach")).select(columns)
    if state is not None:
        rows = rows.unionByName(state.withColumn("n", longs).select(columns))
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _add_up(scan, kept, least), "bucket int, lang string, words int, over boolean, phrase array<string>, "
        + ", ".join(f"{c} array<long>" for c in kept) + ", reach array<int>, until array<int>")


def counts(docs: DataFrame, longest: int = 3, least: int = 10, shards: int = 2, lang_col: str = "lang", text_col: str = "text",
           bits: int = FILTER_BITS, held_words: int = HELD_WORDS) -> DataFrame:
    """(lang, phrase, words, n) of every phrase of up to ``longest`` words with ``least`` occurrences;
    ``words`` 0 (an empty phrase) holds the number of all words of the language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("binary").alias("data"))
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(shards))  # no shuffle: each task deals its own rows
    path = f"{common.shared_dir(spark)}/llm-phrase-shards-{common.uuid.uuid4().hex}"
    texts.filter("octet_length(data) > 0").withColumn("shard", deal.cast("int")).write.partitionBy("shard").parquet(path)
    shard = spark.read.schema("lang string, data binary, shard int").parquet(path)
    shard.staged_at = path
    buckets = max(BUCKETS, (shard.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // BUCKET_BYTES)
    state, scan, reached = None, 0, {}
    while True:
        active = [n for n in range(2, longest + 1) if reached.get(n - 1, -1) >= max(scan - shards, 0)]
        if scan >= shards and not active:
            break
        maps = _maps(state, scan, shards, longest, bits) if active else {}
        sent = spark.sparkContext.broadcast(maps)
        rows = shard.filter(F.col("shard") == scan % shards).select("lang", "data")
        found = rows.mapInArrow(_scan(scan < shards, sent, longest, shards, held_words, buckets),
                                "bucket int, lang string, words int, phrase array<string>, n array<long>, until array<int>")
        new = common.staged(_merged(state, found, scan, shards, least), "phrase-counts")
        common.discard(state)
        sent.destroy()
        state = new
        reached = {r["words"]: r["reach"] for r in state.filter("over").groupBy("words").agg(F.max(F.array_max("reach")).alias("reach")).collect()}
        scan += 1
    common.discard(shard)
    kept = [f"c{j}" for j in range(shards)]
    each = state.filter("over OR words = 0").select("lang", "words", F.explode(F.arrays_zip("phrase", *kept)).alias("p"))
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"p.{c}"), F.lit(0)) for c in kept])
    return each.select("lang", "p.phrase", "words", total.alias("n"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, scale: int = 1_000_000, inside_percent: int = 50,
                 **options) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    seen = counts(docs, longest, least, **options)
    part = seen.filter("words > 0").select("lang", "phrase", "n")
    found = seen.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    # every cut of a candidate meets the counts of its two parts
    words = F.split("phrase", " ")
    cut = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select("*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
                     F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    cut = cut.join(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(
        part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    exact = "CAST({} AS DECIMAL(38,0))".format
    score = F.expr(f"CAST({scale} * {exact('a')} * {exact('a')} div ({exact('l')} * {exact('r')}) AS LONG)")
    low = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    scored = cut.groupBy("lang", "phrase", "words", "a").agg(low.alias("cut"))
    # the most occurrences of a longer candidate around each shorter phrase
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    around = found.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", place.cast("long")).filter(F.col("rank") <= top)
    n = seen.filter("words = 0").select("lang", "n")
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = 10, top: int = 2000) -> str:
    """The contract's result in DuckDB SQL (phrases of two and three words)."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         regexp_extract_all(unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
f AS (
  SELECT lang, m AS words, phrase, count(*) AS n FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)
  GROUP BY ALL),
c AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND n >= {least}),
cuts AS (
  SELECT c.lang, c.words, c.phrase, c.a, k, x.n AS l, y.n AS r,
         CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM c) AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE words = 3)
  GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, (SELECT CAST(sum(n) AS BIGINT) FROM f WHERE f.lang = ranked.lang AND words = 1) AS n, score
FROM ranked WHERE rank <= {top}
"""
