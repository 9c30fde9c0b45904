"""Fan-in of sources that exist once per key (project, admin project).

The scheduled scripts loop over keys and run one statement per key; one
variant stops at the first unreadable source, the other skips it.  Here each
source is a path; all readable ones are read by a single scan over the list
of paths (one plan node however many projects there are, and one Spark job
later reads them all in parallel).

Lazy evaluation hides some failures: a missing path fails at once, but a
corrupt file would fail only when the union runs.  Each source is therefore
opened first: a distributed Spark job reads the footer of every file of it and
merges their schemas, so one corrupt file, or one file of other types, makes
the source unreadable.  Skipped sources are reported, not dropped silently.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class FanInError(RuntimeError):
    pass


@dataclass
class FanInResult:
    frame: DataFrame
    read: list[str] = field(default_factory=list)
    skipped: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class PerProject:
    """A source that exists once per project, at ``template.format(key=project)``."""

    spark: SparkSession
    template: str
    schema: StructType

    def path(self, key: str) -> str:
        return self.template.format(key=key)


def gather(source: DataFrame | PerProject, keys: DataFrame, column: str, on_error: str) -> tuple[DataFrame, dict[str, str]]:
    """A source's rows for the projects that ``keys`` names, and what was skipped and why.

    A single dataset is returned as it is (a later join picks its rows).  For
    sources per project the distinct keys come to the driver: an organisation's
    projects, a list that names one folder each.
    """
    if isinstance(source, DataFrame):
        return source, {}
    names = [r[0] for r in keys.select(column).distinct().collect() if r[0] is not None]
    result = fan_in(source.spark, {k: source.path(k) for k in names}, source.schema, on_error)
    return result.frame, result.skipped


def _check(spark: SparkSession, path: str, schema: StructType) -> None:
    # With schema merging Spark reads the footers of all files in a job.
    probe = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "false").parquet(path)
    have = {f.name: f.dataType.simpleString() for f in probe.schema.fields}
    wrong = [f"{f.name}: {have.get(f.name, 'missing')}" for f in schema.fields
             if have.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise FanInError(f"{path}: columns missing or of another type: {wrong}")


def fan_in(
    spark: SparkSession,
    sources: dict[str, str],
    schema: StructType,
    on_error: str = "raise",
    parallelism: int = 16,
) -> FanInResult:
    """Union the sources ``{key: path}``.

    ``on_error="raise"`` stops at the first unreadable source (in key order,
    the strict loop); ``"skip"`` leaves it out and records it in ``skipped``.
    The checks read footers only, in Spark jobs of which ``parallelism`` run at
    once, so thousands of projects do not mean thousands of sequential
    round trips.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(on_error)
    keys = sorted(sources)

    def check(key: str):
        try:
            _check(spark, sources[key], schema)
            return None
        except Exception as exc:  # noqa: BLE001 - reported, or re-raised below
            return exc

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        errors = dict(zip(keys, pool.map(check, keys)))
    result = FanInResult(frame=None)  # type: ignore[arg-type]
    paths = []
    for key in keys:
        exc = errors[key]
        if exc is None:
            paths.append(sources[key])
            result.read.append(key)
        elif on_error == "raise":
            raise FanInError(f"source {key!r} at {sources[key]} is unreadable: {exc}") from exc
        else:
            result.skipped[key] = type(exc).__name__
    if paths:
        df = spark.read.schema(schema).parquet(*paths)
        result.frame = df.select(*[F.col(f.name) for f in schema.fields])
    else:
        result.frame = spark.createDataFrame([], schema)
    return result
