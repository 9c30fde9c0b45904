"""Small builders for hand-written telemetry rows."""

from __future__ import annotations

from datetime import date, datetime

from costbook import schemas
from costbook.sources import fixtures
from costbook.sources.telemetry import Telemetry


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def job(project="p", job_id="j1", user="u@x", reservation=None, start=datetime(2024, 1, 29, 12), end=None,
        billed=1024**4, cache=False, statement="SELECT", state="DONE", created=None):
    return (project, job_id, user, reservation, created or start, start, end or start, billed, cache, statement, state)


def period(project="p", job_id="j1", user="u@x", reservation=None, created=datetime(2024, 1, 29, 12),
           start=datetime(2024, 1, 29, 12), ms=1000, statement="SELECT", state="DONE"):
    return (project, job_id, user, reservation, created, start, ms, statement, state)


def telemetry(spark, jobs=(), timeline=(), text=(), rt=(), res=(), storage=(), options=(), price_compute=None,
              price_storage=None) -> Telemetry:
    return Telemetry(
        jobs=frame(spark, schemas.JOBS, list(jobs)),
        jobs_timeline=frame(spark, schemas.JOBS_TIMELINE, list(timeline)),
        job_text=frame(spark, schemas.JOB_TEXT, list(text)),
        reservation_timeline=frame(spark, schemas.RESERVATION_TIMELINE, list(rt)),
        reservations=frame(spark, schemas.RESERVATIONS, list(res)),
        table_storage=frame(spark, schemas.TABLE_STORAGE, list(storage)),
        schema_options=frame(spark, schemas.SCHEMA_OPTIONS, list(options)),
        price_compute=frame(spark, schemas.PRICE_COMPUTE,
                            fixtures.PRICE_COMPUTE_ROWS if price_compute is None else list(price_compute)),
        price_storage=frame(spark, schemas.PRICE_STORAGE,
                            fixtures.PRICE_STORAGE_ROWS if price_storage is None else list(price_storage)),
    )


D = date
T = datetime
