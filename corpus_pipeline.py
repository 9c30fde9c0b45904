"""The corpus pipeline: quality rules, line dedup, near duplicates, mixing, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but
the last return the columns of ``documents``.

Empty tables pass through every stage; null texts fail the quality rules and go; rows
repeated exactly (id and text) are one document from the near-duplicate stage on; extra
columns stay as they are until packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costbook.llm import common, jaccard, lines, mixing, packing, quality

#: The learned rules can't be written as SQL: the run is tested against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a learned rule go."""
    rules = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keep = common.let(quality.measure(F.col("text")), lambda q: ~quality.base_failed(q) & rules.verdict(q))
    return docs.filter(keep)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; a text that loses all its lines goes."""
    out = lines.dedup(docs, out_col="_pipeline_lines")
    n, gone = F.col("_pipeline_lines.n_lines"), F.size("_pipeline_lines.deleted")
    out = out.filter(~((gone > 0) & (gone == n)))
    chars = F.when(gone > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a Jaccard similarity of 0.8 over 5-word n-grams, one stays: that of
    the smallest id (null last).  A document is a row, told by id and text; of rows equal in
    both, the first by language, source and size stays."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("text"))
    docs_ = docs.withColumn("_pipeline_row", row)
    found = jaccard.near_duplicates(docs_, id_col="_pipeline_row", words=5, percent=80)
    stay = found.filter(F.col("_pipeline_row").eqNullSafe(F.col("component_id"))).select(F.col("_pipeline_row").alias("_pipeline_stay")).distinct()
    rows = docs_.join(stay, F.col("_pipeline_row").eqNullSafe(F.col("_pipeline_stay")), "left_semi")
    once = F.row_number().over(Window.partitionBy("_pipeline_row").orderBy("lang", "source", "n_chars"))
    return rows.withColumn("_pipeline_once", once).filter("_pipeline_once = 1").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    size = common.word_count(F.col("text"))
    docs_ = docs.withColumn("_pipeline_text", F.xxhash64("text"))
    taken = mixing.mix(docs_, size, keep=("_pipeline_text",)).filter("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("_pipeline_text").alias("_text"),
        F.col("copies").alias("_pipeline_copies")).distinct()
    rows = docs_.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
                      & (F.col("_pipeline_text") == F.col("_text")))
    return rows.withColumn("_pipeline_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_pipeline_copies"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("ngram jaccard", near_duplicates),
          ("mix sources", mix_sources), ("pack", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
