"""Storage: usage per project and billing model, per dataset with day-over-day
differences, and the month-to-date price.

Table-level rows are summed per dataset before they meet the billing model
(one row per dataset).  The classification is linear in the byte counts, so
summing first gives the same totals while the join sees datasets, not
tables; a dataset holding a third of all tables is collapsed by the map-side
partial sum.  Byte sums stay integers and are divided by 1024^3 once (exact:
dividing by a power of two does not round).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costbook.asof import AsOf
from costbook.constants import BILLING_MODEL_OPTION, DEFAULT_MODEL, PHYSICAL_MODEL
from costbook.functions import GIB, date_lit
from costbook.operators.prices import storage_prices

DATASET_KEYS = ["project_id", "dataset_id"]
SIZE_COLUMNS = ["logic_active", "logic_long_term", "comp_active", "comp_long_term", "comp_time_travel",
                "comp_fail_safe"]


# --- billing model ---------------------------------------------------------------
def billing_model(schema_options: DataFrame) -> DataFrame:
    """``(project_id, dataset_id, storage_type)`` from the schema options."""
    return schema_options.filter(F.col("option_name") == F.lit(BILLING_MODEL_OPTION)).select(
        F.col("catalog_name").alias("project_id"),
        F.col("schema_name").alias("dataset_id"),
        F.col("option_value").alias("storage_type"),
    )


def _classify(storage_type: Column, explicit_logical: bool) -> dict[str, Column]:
    logical = storage_type.isNull()
    if explicit_logical:
        logical = logical | (storage_type == F.lit(DEFAULT_MODEL))
    physical = storage_type == F.lit(PHYSICAL_MODEL)
    zero = F.lit(0).cast("bigint")
    return {
        "active_logical_bytes": F.when(logical, F.col("active_logical_bytes")).otherwise(zero),
        "long_term_logical_bytes": F.when(logical, F.col("long_term_logical_bytes")).otherwise(zero),
        "active_physical_bytes": F.when(physical, F.col("active_physical_bytes")).otherwise(zero),
        "long_term_physical_bytes": F.when(physical, F.col("long_term_physical_bytes")).otherwise(zero),
    }


def storage_classified(table_storage: DataFrame, billing: DataFrame, explicit_logical: bool = False) -> DataFrame:
    """Per table: the four byte counts kept only for the dataset's billing model.

    No model (NULL) counts as logical; ``PHYSICAL`` as physical; an explicit
    ``LOGICAL`` zeroes all four unless ``explicit_logical=True``.
    """
    t = table_storage.select(
        "project_id", F.col("table_schema").alias("dataset_id"), F.col("table_name").alias("table_id"),
        "active_logical_bytes", "long_term_logical_bytes", "active_physical_bytes", "long_term_physical_bytes",
    )
    j = t.join(billing, on=DATASET_KEYS, how="left")
    cls = _classify(F.col("storage_type"), explicit_logical)
    return j.select("project_id", "dataset_id", "table_id", *[c.alias(n) for n, c in cls.items()])


def storage_project_usage(table_storage: DataFrame, billing: DataFrame, asof: AsOf,
                          explicit_logical: bool = False) -> DataFrame:
    """Rows appended to the daily storage mart: GiB per project and model."""
    per_dataset = table_storage.groupBy("project_id", F.col("table_schema").alias("dataset_id")).agg(
        *[F.sum(c).alias(c) for c in ("active_logical_bytes", "long_term_logical_bytes",
                                      "active_physical_bytes", "long_term_physical_bytes")]
    )
    j = per_dataset.join(billing, on=DATASET_KEYS, how="left")
    cls = _classify(F.col("storage_type"), explicit_logical)
    g = j.groupBy("project_id").agg(*[F.sum(c).alias(n) for n, c in cls.items()])

    def gib(c: str) -> Column:
        return F.col(c).cast("double") / F.lit(GIB)

    return g.select(
        "project_id",
        gib("active_logical_bytes").alias("logic_active"),
        gib("long_term_logical_bytes").alias("logic_long_term"),
        gib("active_physical_bytes").alias("comp_active"),
        gib("long_term_physical_bytes").alias("comp_long_term"),
        date_lit(asof.today).alias("date"),
    )


# --- per dataset, with yesterday ---------------------------------------------------
def storage_dataset(table_storage: DataFrame) -> DataFrame:
    """GiB per dataset; active physical is net of time travel and fail-safe."""
    net = F.col("active_physical_bytes") - (F.col("time_travel_physical_bytes") + F.col("fail_safe_physical_bytes"))
    sums = {
        "active_logical_gigabytes": F.sum("active_logical_bytes"),
        "long_term_logical_gigabytes": F.sum("long_term_logical_bytes"),
        "active_compressed_gigabytes": F.sum(net),
        "long_term_compressed_gigabytes": F.sum("long_term_physical_bytes"),
        "time_travel_compressed_gigabytes": F.sum("time_travel_physical_bytes"),
        "fail_safe_compressed_gigabytes": F.sum("fail_safe_physical_bytes"),
    }
    g = table_storage.groupBy("project_id", F.col("table_schema").alias("dataset_id")).agg(
        *[v.alias(k) for k, v in sums.items()]
    )
    return g.select(*DATASET_KEYS, *[(F.col(k).cast("double") / F.lit(GIB)).alias(k) for k in sums])


def storage_prev_day(mart_rows: DataFrame, asof: AsOf) -> DataFrame:
    """Yesterday's partition of the storage-analysis mart (keys and sizes)."""
    return mart_rows.filter(F.col("date") == date_lit(asof.yesterday)).select(*DATASET_KEYS, *SIZE_COLUMNS)


_CURRENT = {
    "logic_active": "active_logical_gigabytes",
    "logic_long_term": "long_term_logical_gigabytes",
    "comp_active": "active_compressed_gigabytes",
    "comp_long_term": "long_term_compressed_gigabytes",
    "comp_time_travel": "time_travel_compressed_gigabytes",
    "comp_fail_safe": "fail_safe_compressed_gigabytes",
}


def storage_day_diff(current: DataFrame, prev: DataFrame) -> DataFrame:
    """Today's sizes minus yesterday's; NULL for a dataset new today.

    A dataset stored twice yesterday fans out, as the script's join does.
    """
    p = prev.select(*DATASET_KEYS, *[F.col(c).alias(f"prev_{c}") for c in SIZE_COLUMNS])
    j = current.join(p, on=DATASET_KEYS, how="left")
    return j.select(
        *DATASET_KEYS,
        *[F.col(src).alias(dst) for dst, src in _CURRENT.items()],
        *[(F.col(src) - F.col(f"prev_{dst}")).alias(f"diff_{dst}") for dst, src in _CURRENT.items()],
    )


def storage_analysis_rows(table_storage: DataFrame, billing: DataFrame, prev: DataFrame, asof: AsOf) -> DataFrame:
    """Rows appended to the storage-analysis mart."""
    diff = storage_day_diff(storage_dataset(table_storage), prev)
    typed = diff.join(billing, on=DATASET_KEYS, how="left")
    return typed.select(
        *DATASET_KEYS,
        F.coalesce(F.col("storage_type"), F.lit(DEFAULT_MODEL)).alias("storage_type"),
        *SIZE_COLUMNS,
        *[f"diff_{c}" for c in SIZE_COLUMNS],
        date_lit(asof.today).alias("date"),
        F.lit(asof.year_month_label).alias("year_month"),
        F.lit(asof.year_label).alias("year"),
    )


# --- month to date -----------------------------------------------------------------
def storage_month_avg(daily_usage: DataFrame, asof: AsOf) -> DataFrame:
    """Mean of the four daily sizes over the stored rows of the current month.

    The month is a range on the ``date`` partition column, so only this
    month's partitions are listed and read.
    """
    m0, m1 = asof.month_start(0), asof.month_start(1)
    cur = daily_usage.filter((F.col("date") >= date_lit(m0)) & (F.col("date") < date_lit(m1)))
    return cur.groupBy(
        "project_id", F.date_format("date", "yyyy").alias("year"), F.date_format("date", "MM").alias("month")
    ).agg(
        F.avg("logic_active").alias("monthly_logic_active"),
        F.avg("logic_long_term").alias("monthly_logic_long_term"),
        F.avg("comp_active").alias("monthly_comp_active"),
        F.avg("comp_long_term").alias("monthly_comp_long_term"),
    )


def storage_month_price(month_avg: DataFrame, prices: DataFrame, asof: AsOf, latest_per_key: bool = False) -> DataFrame:
    """The nine month-to-date prices; any NULL part makes the totals NULL."""
    p = storage_prices(prices, asof.region, latest_per_key)
    la = F.col("monthly_logic_active") * p["logic_active"]
    ll = F.col("monthly_logic_long_term") * p["logic_long_term"]
    ca = F.col("monthly_comp_active") * p["comp_active"]
    cl = F.col("monthly_comp_long_term") * p["comp_long_term"]
    year_month = F.concat(F.col("year"), F.lit("-"), F.col("month"))
    return month_avg.select(
        "project_id",
        la.alias("logic_active_price"),
        ll.alias("logic_long_term_price"),
        ca.alias("comp_active_price"),
        cl.alias("comp_long_term_price"),
        (la + ll).alias("logic_total_price"),
        (ca + cl).alias("comp_total_price"),
        (la + ca).alias("active_total_price"),
        (ll + cl).alias("long_term_total_price"),
        (la + ll + ca + cl).alias("total_price"),
        "year",
        year_month.alias("year_month"),
        F.to_date(F.concat(year_month, F.lit("-01"))).alias("year_month_beginning"),
    )
