"""On-demand compute cost: billed bytes per project and local day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costbook.asof import AsOf
from costbook.constants import SCRIPT_STATEMENT
from costbook.functions import TIB, date_lit, day_partition_bounds, in_range, local_date, month_labels
from costbook.operators.prices import ON_DEMAND_CLASS, compute_price


def filter_two_month_window(jobs: DataFrame, asof: AsOf) -> DataFrame:
    """Jobs created in the previous or the current local month (a UTC range)."""
    lo, hi = asof.month_window_utc(1)
    return jobs.filter(in_range("creation_time", lo, hi) & day_partition_bounds(jobs.columns, "creation_time", lo, hi))


def filter_ondemand_jobs(jobs: DataFrame) -> DataFrame:
    """No reservation, and not a script; a NULL statement type is dropped."""
    return jobs.filter(F.col("reservation_id").isNull() & (F.col("statement_type") != F.lit(SCRIPT_STATEMENT)))


def _priced(g: DataFrame, prices: DataFrame, asof: AsOf, latest_per_key: bool) -> DataFrame:
    """Bytes per project and local day to mart rows."""
    price = compute_price(prices, asof.region, ON_DEMAND_CLASS, latest_per_key)
    cost = F.col("bytes").cast("double") / F.lit(TIB) * price
    return g.select("project_id", cost.alias("cost"), "year", "year_month", "date")


def ondemand_day_cost(jobs: DataFrame, prices: DataFrame, asof: AsOf, latest_per_key: bool = False) -> DataFrame:
    """``SUM(bytes) / 1024^4 * price('on_demand')`` per project and local day."""
    d = local_date("creation_time", asof.zone)
    labels = month_labels(d)
    g = (
        filter_ondemand_jobs(filter_two_month_window(jobs, asof))
        .select("project_id", d.alias("date"), labels["year"].alias("year"),
                labels["year_month"].alias("year_month"), "total_bytes_billed")
        .groupBy("project_id", "date", "year", "year_month")
        .agg(F.sum("total_bytes_billed").alias("bytes"))
    )
    return _priced(g, prices, asof, latest_per_key)


def ondemand_day_partials(jobs: DataFrame, day_column: str, zone: str) -> DataFrame:
    """Billed bytes per UTC day folder, project and local date (a UTC day holds two of them)."""
    keyed = filter_ondemand_jobs(jobs).select(
        F.col(day_column).alias("day"), "project_id", local_date("creation_time", zone).alias("date"), "total_bytes_billed")
    return keyed.groupBy("day", "project_id", "date").agg(F.sum("total_bytes_billed").alias("bytes"))


def ondemand_cost_of_partials(partials: DataFrame, prices: DataFrame, asof: AsOf, latest_per_key: bool = False) -> DataFrame:
    """The rows of :func:`ondemand_day_cost`, from partial sums.

    The two-month window is a range of local dates, which the partial sums keep.
    """
    d = F.col("date")
    labels = month_labels(d)
    dates = partials.filter((d >= date_lit(asof.month_start(-1))) & (d < date_lit(asof.month_start(1))))
    g = dates.select("*", labels["year"].alias("year"), labels["year_month"].alias("year_month")).groupBy(
        "project_id", "date", "year", "year_month").agg(F.sum("bytes").alias("bytes"))
    return _priced(g, prices, asof, latest_per_key)
