"""Operator 9: line dedup over the suffixes of line-id sequences (DataFrame functions only).

Every document is a sequence of line ids (lines without a word are skipped and always
stay).  Prefix doubling sorts all suffixes into the groups of the suffix array: level k
groups the suffixes that agree in their first 2^k lines, and level k + 1 follows by
pairing a suffix's group with that of the suffix 2^k lines on.  A group of two or more
suffixes is an interval whose longest common prefix is at least 2^k lines: a repeated
run.  A group is named by its first suffix (by document id, then line), so a suffix that
is not its group's name begins a later copy.  Suffixes that are alone in their group
drop out, and the doubling ends when none is left.  The order among groups says nothing about repeats and is not computed.

A line is deleted if a run of any number of lines that holds it has at least
``min_words`` words and an earlier copy.  Two windows per line decide that: the shortest
with ``min_words`` words that ends there and the shortest that begins there.  In such a
run, a line up to which the run has ``min_words`` words lies in the window that ends at
it, and the lines before that in the window that begins where the run does; both windows
are inside the run, so they have its earlier copy.  Every line has a word: the windows
have at most ``min_words`` lines, and the doubling goes no further.  A window of n lines
is named by the groups of its first and of its last 2^k lines, 2^k <= n < 2^(k + 1).

Only suffixes that begin with a repeated line are ever shuffled after the first count,
and a group is met as one grouped minimum and maximum, not as a list.

A copy may overlap the one before it in the same text: of thirty equal lines of one word
the first stays.

Edge cases: null texts stay null and have no lines; empty and blank texts keep their
lines; rows repeated exactly (id and text) are one document and get one result each; a
null id is the first id; ties do not arise, since (id, text, line) is unique; other
columns pass through.  Lines are compared by 96 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common


def _numbered(text: Column) -> Column:
    """The lines with a word as structs (line, at); ``at`` is the place among all lines."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("at"))),
                    lambda s: s["line"].rlike(common.WORD))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20) -> DataFrame:
    """(doc, line, length): windows of at least ``min_words`` words that have an earlier copy;
    ``doc`` is the struct (id, hash of the text), ``line`` counts the lines with a word."""
    text = F.col(text_col)
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text"))
    rows = docs.filter(text.isNotNull()).select(doc.alias("doc"), F.posexplode(_numbered(text)).alias("line", "x"))
    line = F.col("x.line")
    rows = rows.select("doc", "line", F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b")).alias("key"),
                       common.word_count(line).alias("words"))
    active = _grouped(common.staged(rows, "lines"), "lines-0")
    windows = common.staged(_windows(active, max(1, min_words)), "lines-windows")
    found, span = None, 1
    while True:
        of = windows.filter((F.col("length") >= span) & (F.col("length") < 2 * span)).join(
            active.select("doc", "line", "name"), ["doc", "line"])
        last = active.select("doc", F.col("line").alias("tail"), F.col("name").alias("next"))
        of = of.withColumn("tail", F.col("line") + F.col("length") - span).join(last, ["doc", "tail"])
        key = ["length", "name", "next"]
        firsts = of.groupBy(*key).agg(F.min(F.struct("doc", "line")).alias("first"))
        new = of.join(firsts, key).filter(F.struct("doc", "line") != F.col("first")).select("doc", "line", "length")
        new = common.staged(new, f"copies-{span}")
        found = new if found is None else found.unionByName(new)
        if 2 * span > max(1, min_words):
            return found
        ahead = active.select("doc", (F.col("line") - span).alias("line"), F.col("name").alias("next"))
        pairs = active.join(ahead, ["doc", "line"]).select("doc", "line", F.struct("name", "next").alias("key"), "words")
        span *= 2
        active = _grouped(common.staged(pairs, f"pairs-{span}"), f"lines-{span}")
        if active.isEmpty():
            return found


def _windows(active: DataFrame, min_words: int) -> DataFrame:
    """(doc, line, length): per line the shortest windows of repeated lines with at least
    ``min_words`` words that begin and that end there."""
    stretch = F.col("line") - F.row_number().over(Window.partitionBy("doc").orderBy("line"))
    rows = active.select("doc", "line", "words", stretch.alias("stretch"))
    by = Window.partitionBy("doc", "stretch")
    rows = rows.withColumn("upto", F.sum("words").over(by.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("before", F.col("upto") - F.col("words"))
    # lines that begin less than min_words words on, and lines that end less than that many words back
    on, back = by.orderBy("before").rangeBetween(0, min_words - 1), by.orderBy("upto").rangeBetween(1 - min_words, 0)
    rows = rows.select("doc", "line", "upto", "before", F.max("line").over(on).alias("end"), F.max("upto").over(on).alias("end_upto"),
                       F.min("line").over(back).alias("start"), F.min("before").over(back).alias("start_before"))
    ahead = F.when(F.col("end_upto") - F.col("before") >= min_words, F.struct(
        F.col("line").alias("line"), (F.col("end") - F.col("line") + 1).alias("length")))
    behind = F.when((F.col("upto") - F.col("start_before") >= min_words) & (F.col("start") < F.col("line")), F.struct(
        F.col("start").alias("line"), (F.col("line") - F.col("start") + 1).alias("length")))
    return rows.select("doc", F.explode(F.array_compact(F.array(ahead, behind))).alias("w")).select("doc", "w.line", "w.length")


def _grouped(rows: DataFrame, name: str) -> DataFrame:
    """The suffixes whose key another suffix shares, with their group's first suffix as ``name``."""
    at = F.struct("doc", "line")
    groups = rows.groupBy("key").agg(F.min(at).alias("name"), F.max(at).alias("last")).filter("name != last").drop("last")
    return common.staged(rows.join(groups, "key").select("doc", "line", "name", "words").dropDuplicates(["doc", "line"]), name)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20,
          out_col: str = "line_dedup") -> DataFrame:
    """``docs`` with later copies deleted from the text, and the struct ``out_col`` of
    ``n_lines`` (lines with a word, before) and ``deleted`` (their numbers among these)."""
    windows = repeated_windows(docs, id_col, text_col, min_words)
    gone = windows.groupBy(F.col("doc").alias("_line_dedup_doc")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(
        F.sequence("line", F.col("line") + F.col("length") - 1))))).alias("_line_dedup_gone"))
    text = F.col(text_col)
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text"))
    rows = docs.join(gone, doc == F.col("_line_dedup_doc"), "left").drop("_line_dedup_doc")
    deleted = F.coalesce("_line_dedup_gone", F.array().cast("array<int>"))

    def without(gone_: Column) -> Column:
        lines = F.split(text, "\n")
        places = common.let(_numbered(text), lambda n: F.transform(gone_, lambda g: F.get(n, g)["at"]))
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return common.let(lines, lambda x: F.array_join(F.transform(kept, lambda i: F.get(x, i)), "\n"))

    n_lines = F.when(text.isNull(), 0).otherwise(F.size(_numbered(text))).cast("long")
    rows = rows.withColumn("_line_dedup", F.struct(n_lines.alias("n_lines"), deleted.alias("deleted"))).drop("_line_dedup_gone")
    cut = F.when(F.size("_line_dedup.deleted") > 0, without(F.col("_line_dedup.deleted"))).otherwise(text)
    return rows.withColumn(text_col, cut).withColumnRenamed("_line_dedup", out_col)


def oracle_sql(min_words: int = 20) -> str:
    """DuckDB SQL of op9_line_runs: windows of every length up to ``min_words`` lines.  (Every
    line has a word, so a line of a longer run with ``min_words`` words lies in such a window.)"""
    parts = ["""docs AS (SELECT doc_id, text, dense_rank() OVER (ORDER BY doc_id NULLS FIRST, text) AS doc FROM documents)""",
             """all_lines AS (SELECT DISTINCT doc, unnest(string_split(text, chr(10))) AS line,
  unnest(range(len(string_split(text, chr(10))))) AS place FROM docs WHERE text IS NOT NULL)""",
             r"""l0 AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY place) - 1 AS line, md5(line) AS key,
  len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM all_lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))""",
             r"""places AS (SELECT doc, place, line AS body, CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN
  count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) OVER (PARTITION BY doc ORDER BY place) - 1 END AS line FROM all_lines)"""]
    found = []
    for n in range(1, min_words + 1):
        found.append(f"""SELECT doc, line, {n} AS length FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc, line) AS copy
  FROM (SELECT doc, line, string_agg(key, '') OVER w AS run, sum(words) OVER w AS n_words, count(*) OVER w AS n FROM l0
    WINDOW w AS (PARTITION BY doc ORDER BY line ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING))
  WHERE n = {n} AND n_words >= {min_words}) WHERE copy > 1""")
    parts.append("found AS (" + "\nUNION ALL ".join(found) + ")")
    parts.append("gone AS (SELECT DISTINCT doc, unnest(range(line, line + length)) AS line FROM found)")
    parts.append("""kept AS (SELECT p.doc, string_agg(p.body, chr(10) ORDER BY p.place) AS body FROM places p
  LEFT JOIN gone g ON p.doc = g.doc AND p.line = g.line WHERE g.line IS NULL GROUP BY p.doc)""")
    parts.append("deleted AS (SELECT doc, count(*) AS n, string_agg(line, ',' ORDER BY line) AS lines FROM gone GROUP BY doc)")
    parts.append("counted AS (SELECT doc, count(*) AS n FROM l0 GROUP BY doc)")
    return "WITH " + ",\n".join(parts) + """
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(x.n, 0) AS n_deleted, coalesce(x.lines, '') AS deleted,
  CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.body, '')) END AS clean_md5
FROM docs d LEFT JOIN counted c USING (doc) LEFT JOIN deleted x USING (doc) LEFT JOIN kept k USING (doc)"""
