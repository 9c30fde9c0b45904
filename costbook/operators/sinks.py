"""Mart sinks: create-if-absent, append, and upsert (MERGE without a table format).

A mart is a Parquet dataset partitioned by one date column.  Plain Parquet
has no MERGE, so :func:`upsert` rewrites only the partitions the source
touches:

1. read the target rows of those partitions (partition pruning keeps the
   rest unread);
2. full outer join target and source on the merge keys with plain equality
   (a NULL key never matches, so it is inserted again on every run);
3. a matched target row takes the update columns from the source and keeps
   the rest; unmatched source rows are inserted; other target rows stay;
   a target row matching two source rows fails the merge before anything
   is written, as MERGE does (checked with a grouped count, not a window);
4. the result is staged below the scratch root (cutting the lineage back to
   the files about to be replaced), then written with dynamic partition
   overwrite.

The source is staged too, and its partition values name the folders that
step 1 reads: the target's other partitions are neither listed nor read,
however many partitions there are.

Each merge key fixes its partition (every key includes the date, or a month
that determines it), so rows of untouched partitions can never match.

Replacing several partitions is not atomic, but it is recoverable: a journal
(one file in the mart's folder) names the staged rows and the partitions before
the first one is replaced, and goes after the last.  A run that finds a journal
first replaces those partitions again from the staged rows, which outlive the
run that stopped.  Until then a reader may see partitions of both states.  One
writer per mart is assumed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from costbook import schemas
from costbook.session import Staging, remove_path


@dataclass(frozen=True)
class Mart:
    name: str
    schema: StructType
    partition_col: str
    keys: tuple[str, ...] = ()
    update_cols: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# The seven marts: schema, partition column, and merge keys / updated columns.
DAILY_EDITIONS_COMPUTE_PRICING = Mart(
    "daily_editions_compute_pricing", schemas.DAILY_EDITIONS_COMPUTE_PRICING, "date",
    ("reservation_id", "date"), ("cost", "baseline_cost"))
DAILY_ONDEMAND_COMPUTE_PRICING = Mart(
    "daily_ondemand_compute_pricing", schemas.DAILY_ONDEMAND_COMPUTE_PRICING, "date",
    ("project_id", "date"), ("cost",))
DAILY_STORAGE_USAGE = Mart("daily_storage_usage", schemas.DAILY_STORAGE_USAGE, "date")
MONTHLY_STORAGE_PRICING = Mart(
    "monthly_storage_pricing", schemas.MONTHLY_STORAGE_PRICING, "year_month_beginning",
    ("project_id", "year_month"),
    ("logic_active_price", "logic_long_term_price", "comp_active_price", "comp_long_term_price",
     "logic_total_price", "comp_total_price", "active_total_price", "long_term_total_price", "total_price"))
QUERY_ANALYSIS = Mart("query_analysis", schemas.QUERY_ANALYSIS, "date")
SLOT_ANALYSIS = Mart("slot_analysis", schemas.SLOT_ANALYSIS, "date")
STORAGE_ANALYSIS = Mart("storage_analysis", schemas.STORAGE_ANALYSIS, "date")

MARTS = {m.name: m for m in (
    DAILY_EDITIONS_COMPUTE_PRICING, DAILY_ONDEMAND_COMPUTE_PRICING, DAILY_STORAGE_USAGE,
    MONTHLY_STORAGE_PRICING, QUERY_ANALYSIS, SLOT_ANALYSIS, STORAGE_ANALYSIS)}


class MergeError(RuntimeError):
    pass


class MartSchemaError(ValueError):
    pass


class RecoveryError(RuntimeError):
    pass


# A mart folder keeps its schema in this file, and the replacement that is under
# way in the other (Spark skips names that begin with an underscore).
SCHEMA_FILE = "_mart_schema.json"
JOURNAL_FILE = "_replacing.json"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _filesystem(spark, path)
    return bool(fs.exists(jpath))


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, jpath = _filesystem(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: a reader finds the old text, none, or the whole new one."""
    fs, new = _filesystem(spark, f"{path}.new")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    remove(spark, path)
    if not fs.rename(new, _filesystem(spark, path)[1]):
        raise OSError(f"{path} could not be replaced")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of a mart, if it is there."""
    fs, jpath = _filesystem(spark, path)
    fs.delete(jpath, True)


def kept_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that a mart folder keeps."""
    text = read_small(spark, f"{path}/{SCHEMA_FILE}")
    return None if text is None else StructType.fromJson(json.loads(text))


def ensure(spark: SparkSession, mart: Mart, path: str) -> None:
    """``CREATE TABLE IF NOT EXISTS``: a folder that keeps the mart's schema.

    A folder that is there must keep the same schema; one from before schemas
    were kept gets it now.  A replacement that an earlier run began is ended.
    """
    fs, jpath = _filesystem(spark, path)
    kept = kept_schema(spark, path) if fs.exists(jpath) else None
    if kept is None:
        fs.mkdirs(jpath)
        write_small(spark, f"{path}/{SCHEMA_FILE}", mart.schema.json())
    elif _types(kept) != _types(mart.schema):
        raise MartSchemaError(f"{path} keeps another schema than {mart.name}: {_types(kept)}")
    recover(spark, mart, path)


def _types(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def checked(df: DataFrame, mart: Mart) -> DataFrame:
    """``df`` with the mart's columns, if all are there and of the mart's types."""
    have = dict(_types(df.schema))
    wrong = [f"{n}: {have.get(n, 'missing')}, not {t}" for n, t in _types(mart.schema) if have.get(n) != t]
    if wrong:
        raise MartSchemaError(f"rows for {mart.name} don't fit: " + "; ".join(wrong))
    return df.select(*mart.columns)


def read(spark: SparkSession, mart: Mart, path: str, values: list | None = None) -> DataFrame:
    """The mart's rows; with ``values`` only those partitions' folders are listed."""
    reader = spark.read.schema(mart.schema).option("basePath", path)
    if values is None:
        return reader.parquet(path).select(*mart.columns)
    return read_partitions(spark, reader, path, mart.partition_col, values, mart.schema).select(*mart.columns)


def read_partitions(spark: SparkSession, reader, path: str, column: str, values: list, schema: StructType) -> DataFrame:
    """The folders of these date partition values that exist, and no others."""
    fs, _ = _filesystem(spark, path)
    folders = [f"{path}/{column}={_NULL_PARTITION if v is None else v.isoformat()}" for v in values]
    there = [f for f in folders if fs.exists(_filesystem(spark, f)[1])]
    return reader.parquet(*there) if there else spark.createDataFrame([], schema)


def append(df: DataFrame, mart: Mart, path: str, replace_partition: bool = False) -> None:
    """``INSERT INTO`` the mart.  A rerun appends the same rows again; with
    ``replace_partition=True`` the partitions written are replaced instead."""
    spark = df.sparkSession
    rows = checked(df, mart)
    ensure(spark, mart, path)
    writer = rows.write.partitionBy(mart.partition_col)
    if replace_partition:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def repeated_matches(target: DataFrame, source: DataFrame, mart: Mart) -> DataFrame:
    """Target rows whose merge key appears on two or more source rows.

    The source keys are counted with a grouped (map-side partial) count, so a
    key repeated many times is never gathered into one task; plain equality
    means a NULL key never matches.
    """
    keys = list(mart.keys)
    repeated = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1).drop("_n"))
    return target.join(repeated, on=keys, how="left_semi")


def merged_rows(target: DataFrame, source: DataFrame, mart: Mart) -> DataFrame:
    """The rows of the touched partitions after MERGE (lazy, no write).

    Assumes :func:`repeated_matches` is empty (MERGE fails otherwise).
    """
    keys, updates, p = list(mart.keys), set(mart.update_cols), mart.partition_col
    touched_parts = source.select(p).distinct()
    t = target.join(touched_parts, on=p, how="left_semi").withColumn("_in_target", F.lit(True))
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in mart.columns], F.lit(True).alias("_in_source"))
    cond = None
    for k in keys:
        c = t[k] == s[f"_s_{k}"]
        cond = c if cond is None else cond & c
    j = t.join(s, on=cond, how="full_outer")
    in_t, in_s = F.col("_in_target").isNotNull(), F.col("_in_source").isNotNull()
    out = []
    for c in mart.columns:
        if c in updates:
            v = F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(c))
        else:
            v = F.when(in_t, F.col(c)).otherwise(F.col(f"_s_{c}"))
        out.append(v.alias(c))
    return j.select(*out)


def upsert(source: DataFrame, mart: Mart, path: str) -> None:
    """MERGE ``source`` into the mart at ``path`` (see the module notes).

    The source (a daily or monthly roll-up) is staged once: the merge reads it
    twice, and its partition values (dates) name the folders of the target that
    are read.  The merged rows are staged too, which cuts the lineage back to the
    files about to be replaced; both folders are removed at the end, the merged rows
    only after all partitions have been replaced.
    """
    spark = source.sparkSession
    rows = checked(source, mart)
    ensure(spark, mart, path)
    p = mart.partition_col
    with Staging(spark) as staging:
        src = staging.table(rows, f"merge-source-{mart.name}")
        parts = sorted((r[0] for r in src.select(p).distinct().collect()), key=str)  # one value a day
        target = read(spark, mart, path, parts)
        if not repeated_matches(target, src, mart).isEmpty():
            raise MergeError(f"MERGE into {mart.name}: a target row matches more than one source row")
        staging.table(merged_rows(target, src, mart), f"merged-{mart.name}")
        replace_partitions(spark, mart, path, staging.release(), parts)


def replace_partitions(spark: SparkSession, mart: Mart, path: str, staged: str, parts: list) -> None:
    """Replace the partitions ``parts`` by the rows staged at ``staged``, then delete these.

    The journal stands from before the first partition until after the last, so a run
    that stops in between is ended by :func:`recover`.
    """
    journal = {"staged": staged, "partitions": [None if v is None else v.isoformat() for v in parts]}
    write_small(spark, f"{path}/{JOURNAL_FILE}", json.dumps(journal))
    _swap(spark, mart, path, staged)
    remove(spark, f"{path}/{JOURNAL_FILE}")
    remove_path(spark, staged)


def _swap(spark: SparkSession, mart: Mart, path: str, staged: str) -> None:
    rows = spark.read.schema(mart.schema).parquet(staged)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(mart.partition_col).parquet(path)


def recover(spark: SparkSession, mart: Mart, path: str) -> list[str]:
    """End the replacement that a stopped run began; returns its partitions (none: nothing to do).

    All of them are replaced again: which ones the stopped run had reached does not
    matter, since their rows are those staged, not what the mart holds now.
    """
    text = read_small(spark, f"{path}/{JOURNAL_FILE}")
    if text is None:
        return []
    journal = json.loads(text)
    if not exists(spark, journal["staged"]):
        raise RecoveryError(f"{path}: a replacement of {journal['partitions']} was not ended, and its rows at "
                            f"{journal['staged']} are gone; restore these partitions and delete {JOURNAL_FILE}")
    _swap(spark, mart, path, journal["staged"])
    remove(spark, f"{path}/{JOURNAL_FILE}")
    remove_path(spark, journal["staged"])
    return journal["partitions"]
