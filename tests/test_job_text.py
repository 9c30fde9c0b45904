"""Job text laid out by the jobs' creation day: only the selected jobs' days are read."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from costbook.asof import DEFAULT_ASOF as A
from costbook.operators import jobs, slots
from costbook.sources import fixtures
from costbook.sources.telemetry import read_table


def test_only_the_selected_jobs_days_are_read(spark, tmp_path):
    t = fixtures.telemetry(spark, SF_SMALL)
    root = str(tmp_path)
    dated = t.job_text.join(t.jobs.select(*jobs.JOB_KEYS, F.to_date("creation_time").alias("creation_date")), jobs.JOB_KEYS)
    dated.write.partitionBy("creation_date").parquet(f"{root}/job_text")
    expected = {f: sorted(map(tuple, f(t.job_text).collect()), key=repr) for f in (
        lambda text: jobs.query_analysis_rows(t.jobs, text, A), lambda text: slots.slot_analysis_rows(t.jobs, t.jobs_timeline, text, A))}
    days = {r[0].isoformat() for r in jobs.recent_jobs(t.jobs, A).select(F.to_date("creation_time")).distinct().collect()}
    folders = [f for f in os.listdir(f"{root}/job_text") if f.startswith("creation_date=")]
    assert 0 < len(days) < len(folders) / 3
    text = read_table(spark, root, "job_text")
    assert "creation_date" in text.columns
    for folder in folders:  # the other days' files are spoilt: a run that opened one would fail
        if folder.split("=")[1] not in days:
            for f in os.listdir(f"{root}/job_text/{folder}"):
                with open(f"{root}/job_text/{folder}/{f}", "wb") as fh:
                    fh.write(b"no parquet")
    for rows, known in expected.items():
        assert sorted(map(tuple, rows(text).collect()), key=repr) == known
