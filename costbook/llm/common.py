"""Helpers shared by the operators: staging, components, row slicing, expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local master without the setting gets a folder of this machine.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later uses
    neither recompute it nor depend on the executors that made it."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the folder of a staged table that nothing reads any more."""
    if df is not None:
        spark, path = df.sparkSession, df.staged_at
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, body) -> Column:
    """``body`` of a column evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches, rows: int = 512):
    """Arrow batches cut to ``rows`` rows, so that few long texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); component is the
    smallest node reached.  Alternating large-star and small-star steps: each
    halves long paths and only sends grouped minima and edges, so no component is
    ever gathered in one place.  The rounds end as soon as all edges form stars."""

    def star(pairs: DataFrame, both: bool) -> DataFrame:
        if both:
            pairs = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = pairs.join(mins, "u")
        if both:
            moved = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                mins.select("u", F.col("m").alias("v")))
        return moved.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def stars_only(pairs: DataFrame) -> bool:
        """Whether every larger end has one edge and is no smaller end: then the smaller ends are the components."""
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            pairs.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").isEmpty()

    pairs = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        pairs = staged(star(star(pairs, True), False), "stars")
        if stars_only(pairs):
            break
    roots = pairs.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
