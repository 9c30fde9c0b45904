"""Kept partial sums per UTC day, so that a month-to-date run reads changed days only.

The scheduled scripts scan one or two whole months every day.  All of their sums are
integers that can be added up from days, and a day's input hardly ever changes once the
day is over.  :class:`KeptDays` is a Parquet dataset of partial rows laid out by UTC day
with one print per day: a digest of the day's input files (name, length, modification
time) and of everything else that its rows depend on.  A run compares prints, recomputes
the days whose print differs, and adds up all days.

Order of writes: the prints of the days to recompute are dropped first, then their rows
are replaced, then their new prints are kept.  A run that stops in between leaves days
without a print, and the next run computes them again.  One writer per dataset.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from costbook.operators.sinks import read_small, read_partitions, remove, write_small
from costbook.sources.telemetry import TABLES, day_folders, read_days

#: The prints, by day (Spark skips names that begin with an underscore).
PRINTS_FILE = "_days.json"
DAY = "day"


class KeptDays:
    """Partial rows by UTC day at ``path``; ``schema`` holds the column ``day``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def prints(self) -> dict[str, str]:
        text = read_small(self.spark, f"{self.path}/{PRINTS_FILE}")
        return json.loads(text) if text else {}

    def refresh(self, prints: dict[date, str], build: Callable[[list[date]], DataFrame]) -> list[date]:
        """Bring the days of ``prints`` up to date; returns those that were recomputed.

        ``build`` gives the rows of a list of days.  Days outside ``prints`` are left
        as they are (another month's run may want them).
        """
        kept = self.prints()
        changed = sorted(d for d, p in prints.items() if kept.get(d.isoformat()) != p)
        if not changed:
            return []
        for d in changed:
            kept.pop(d.isoformat(), None)
        write_small(self.spark, f"{self.path}/{PRINTS_FILE}", json.dumps(kept))
        for d in changed:  # a day may have no rows any more, so replacing partitions is not enough
            remove(self.spark, f"{self.path}/{DAY}={d.isoformat()}")
        rows = build(changed).select(*[f.name for f in self.schema.fields])
        rows.write.partitionBy(DAY).mode("append").parquet(self.path)
        kept.update({d.isoformat(): prints[d] for d in changed})
        write_small(self.spark, f"{self.path}/{PRINTS_FILE}", json.dumps(kept))
        return changed

    def read(self, days: list[date]) -> DataFrame:
        """The rows of these days; no other day's folder is listed."""
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        return read_partitions(self.spark, reader, self.path, DAY, days, self.schema)


class DayExport:
    """Day-partitioned datasets of one export: their folders, prints and rows by UTC day."""

    def __init__(self, spark: SparkSession, root: str, names: dict[str, str], window: tuple[datetime, datetime]):
        """``names`` maps a dataset to the column by whose UTC day it is laid out."""
        self.spark, self.root, self.names = spark, root, names
        self.folders = {name: day_folders(spark, root, name, column, *window) for name, column in names.items()}

    @property
    def days(self) -> list[date]:
        return sorted({d for by_day in self.folders.values() for d in by_day})

    def prints(self, depends_on: str) -> dict[date, str]:
        """One digest a day of its files in all datasets and of ``depends_on``."""
        out = {}
        for d in self.days:
            parts = [depends_on]
            for name in sorted(self.names):
                folder = self.folders[name].get(d)
                parts += [name, *(_files(self.spark, folder) if folder else ())]
            out[d] = hashlib.sha256("\n".join(parts).encode()).hexdigest()
        return out

    def read(self, name: str, days: list[date]) -> DataFrame:
        """The dataset's rows of these days, from their folders only."""
        folders = [f for d, f in sorted(self.folders[name].items()) if d in set(days)]
        if not folders:
            return self.spark.createDataFrame([], TABLES[name])
        return read_days(self.spark, self.root, name, folders)


def _files(spark: SparkSession, folder: str) -> list[str]:
    """``name length modification-time`` of a folder's files, sorted."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(jpath)]
    return [" ".join(map(str, f)) for f in sorted(found) if not f[0].startswith(("_", "."))]


def rows_digest(df: DataFrame) -> str:
    """A digest of a table's rows whatever their order or files (for lookups that are exported whole)."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    n, total, mixed = df.select(h.alias("h")).agg(
        F.count("*"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor(F.shiftright("h", 1))).first()
    return f"{sorted(df.columns)} {n} {total} {mixed}"
