"""Schemas of the telemetry inputs, the price lists and the marts.

Telemetry columns are the ones the scheduled scripts use; timestamps are
``timestamp_ntz`` holding UTC.  Mart column order is the order of the
scripts' ``CREATE TABLE`` statements.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """``"a STRING, b BIGINT"`` -> StructType (flat columns only; no session needed)."""
    fields = []
    for item in columns.split(","):
        name, type_name = item.split()
        fields.append(T.StructField(name, _TYPES[type_name], True))
    return T.StructType(fields)

JOBS = _struct(
    "project_id STRING, job_id STRING, user_email STRING, reservation_id STRING, "
    "creation_time TIMESTAMP_NTZ, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, "
    "total_bytes_billed BIGINT, cache_hit BOOLEAN, statement_type STRING, state STRING"
)
JOBS_TIMELINE = _struct(
    "project_id STRING, job_id STRING, user_email STRING, reservation_id STRING, "
    "job_creation_time TIMESTAMP_NTZ, period_start TIMESTAMP_NTZ, period_slot_ms BIGINT, "
    "statement_type STRING, state STRING"
)
JOB_TEXT = _struct("project_id STRING, job_id STRING, user_email STRING, query STRING")
RESERVATION_TIMELINE = _struct(
    "project_id STRING, project_number BIGINT, reservation_id STRING, slots_assigned BIGINT, "
    "period_start TIMESTAMP_NTZ"
)
RESERVATIONS = _struct("project_id STRING, project_number BIGINT, edition STRING")
# Read when an export carries it; only the ``match_reservation`` option uses it.
RESERVATIONS_OPTIONAL = _struct("reservation_name STRING")
# Kept partial sums, by UTC day (see operators/partials.py).
ONDEMAND_DAY_PARTIAL = _struct("project_id STRING, date DATE, bytes BIGINT, day DATE")
EDITION_MINUTE_PARTIAL = _struct(
    "project_id STRING, reservation_id STRING, period_minute TIMESTAMP_NTZ, baseline BIGINT, edition STRING, "
    "slot_ms BIGINT, n_periods BIGINT, day DATE"
)
TABLE_STORAGE = _struct(
    "project_id STRING, table_schema STRING, table_name STRING, "
    "active_logical_bytes BIGINT, long_term_logical_bytes BIGINT, "
    "active_physical_bytes BIGINT, long_term_physical_bytes BIGINT, "
    "time_travel_physical_bytes BIGINT, fail_safe_physical_bytes BIGINT"
)
SCHEMA_OPTIONS = _struct(
    "catalog_name STRING, schema_name STRING, option_name STRING, option_value STRING"
)
PRICE_COMPUTE = _struct(
    "class STRING, pay_as_you_go_pricing DOUBLE, region STRING, application_start_date DATE"
)
PRICE_STORAGE = _struct(
    "active_logical_pricing DOUBLE, long_term_logical_pricing DOUBLE, "
    "active_compressed_pricing DOUBLE, long_term_compressed_pricing DOUBLE, "
    "region STRING, application_start_date DATE"
)

# --- marts -------------------------------------------------------------------
DAILY_EDITIONS_COMPUTE_PRICING = _struct(
    "reservation_id STRING, date DATE, year STRING, year_month STRING, edition STRING, "
    "baseline_cost DOUBLE, cost DOUBLE"
)
DAILY_ONDEMAND_COMPUTE_PRICING = _struct(
    "project_id STRING, cost DOUBLE, year STRING, year_month STRING, date DATE"
)
DAILY_STORAGE_USAGE = _struct(
    "project_id STRING, logic_active DOUBLE, logic_long_term DOUBLE, comp_active DOUBLE, "
    "comp_long_term DOUBLE, date DATE"
)
MONTHLY_STORAGE_PRICING = _struct(
    "project_id STRING, logic_active_price DOUBLE, logic_long_term_price DOUBLE, "
    "comp_active_price DOUBLE, comp_long_term_price DOUBLE, logic_total_price DOUBLE, "
    "comp_total_price DOUBLE, active_total_price DOUBLE, long_term_total_price DOUBLE, "
    "total_price DOUBLE, year STRING, year_month STRING, year_month_beginning DATE"
)
QUERY_ANALYSIS = _struct(
    "project_id STRING, job_id STRING, account STRING, query STRING, query_size DOUBLE, "
    "cache BOOLEAN, query_start TIMESTAMP_NTZ, query_end TIMESTAMP_NTZ, query_time DOUBLE, "
    "query_type STRING, date DATE, year_month STRING, year STRING"
)
SLOT_ANALYSIS = _struct(
    "project_id STRING, job_id STRING, account STRING, reservation_id STRING, cache BOOLEAN, "
    "slot_min DOUBLE, slot_max DOUBLE, job_start TIMESTAMP_NTZ, job_end TIMESTAMP_NTZ, "
    "job_time DOUBLE, query_type STRING, query STRING, date DATE, year_month STRING, year STRING"
)
STORAGE_ANALYSIS = _struct(
    "project_id STRING, dataset_id STRING, storage_type STRING, logic_active DOUBLE, "
    "logic_long_term DOUBLE, comp_active DOUBLE, comp_long_term DOUBLE, comp_time_travel DOUBLE, "
    "comp_fail_safe DOUBLE, diff_logic_active DOUBLE, diff_logic_long_term DOUBLE, "
    "diff_comp_active DOUBLE, diff_comp_long_term DOUBLE, diff_comp_time_travel DOUBLE, "
    "diff_comp_fail_safe DOUBLE, date DATE, year_month STRING, year STRING"
)
