"""Append and upsert on Parquet marts."""

from datetime import date

import pytest

from costbook import schemas
from costbook.operators import sinks
from helpers import frame

M = sinks.DAILY_ONDEMAND_COMPUTE_PRICING  # keys (project_id, date), updates cost


def rows(spark, path):
    return sorted(tuple(r) for r in sinks.read(spark, M, path).collect())


def src(spark, data):
    return frame(spark, schemas.DAILY_ONDEMAND_COMPUTE_PRICING, data)


def test_create_if_absent_is_empty_and_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    sinks.ensure(spark, M, path)
    sinks.ensure(spark, M, path)
    assert rows(spark, path) == []


def test_a_mart_keeps_its_schema(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    good = src(spark, [("a", 1.0, "2024", "2024-01", date(2024, 1, 1))])
    sinks.append(good, M, path)
    assert sinks.kept_schema(spark, path) == M.schema
    with pytest.raises(sinks.MartSchemaError, match="cost"):
        sinks.append(good.withColumn("cost", good["cost"].cast("string")), M, path)
    with pytest.raises(sinks.MartSchemaError, match="missing"):
        sinks.upsert(good.drop("cost"), M, path)
    with pytest.raises(sinks.MartSchemaError, match="another schema"):
        sinks.ensure(spark, sinks.QUERY_ANALYSIS, path)
    assert rows(spark, path) == [("a", 1.0, "2024", "2024-01", date(2024, 1, 1))]


def test_merge_over_many_partitions(spark, tmp_dir):
    """One path for any number of partitions."""
    from datetime import timedelta

    path = f"{tmp_dir}/m"
    days = [date(2020, 1, 1) + timedelta(days=k) for k in range(300)]
    sinks.upsert(src(spark, [("a", 1.0, "x", "x", d) for d in days]).coalesce(1), M, path)
    sinks.upsert(src(spark, [("a", 2.0, "y", "y", d) for d in days[:150]] + [("b", 3.0, "y", "y", days[-1])]).coalesce(1), M, path)
    got = rows(spark, path)
    assert len(got) == 301 and sum(r[1] for r in got) == 2 * 150 + 150 + 3 and {r[2] for r in got if r[0] == "a"} == {"x"}


def test_upsert_insert_update_keep(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    d1, d2, d3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    sinks.upsert(src(spark, [("a", 1.0, "2024", "2024-01", d1), ("b", 2.0, "2024", "2024-01", d2),
                             ("c", 3.0, "2024", "2024-01", d3)]), M, path)
    # update a (and try to change its labels: only cost follows), insert d, leave b and c alone
    sinks.upsert(src(spark, [("a", 10.0, "XXXX", "XXXX-XX", d1), ("d", 4.0, "2024", "2024-01", d2)]), M, path)
    assert rows(spark, path) == [
        ("a", 10.0, "2024", "2024-01", d1), ("b", 2.0, "2024", "2024-01", d2),
        ("c", 3.0, "2024", "2024-01", d3), ("d", 4.0, "2024", "2024-01", d2)]


def test_upsert_duplicate_source_rows(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    d1 = date(2024, 1, 1)
    dup = [("a", 1.0, "2024", "2024-01", d1), ("a", 2.0, "2024", "2024-01", d1)]
    sinks.upsert(src(spark, dup), M, path)  # no target row: both inserted
    assert len(rows(spark, path)) == 2
    with pytest.raises(Exception, match="more than one source row"):
        sinks.upsert(src(spark, dup), M, path)
    assert len(rows(spark, path)) == 2  # the failed merge changed nothing


def test_upsert_null_key_is_inserted_again(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    r = [(None, 1.0, "2024", "2024-01", date(2024, 1, 1))]
    sinks.upsert(src(spark, r), M, path)
    sinks.upsert(src(spark, r), M, path)
    assert len(rows(spark, path)) == 2


def test_append_duplicates_and_replace(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    r = [("a", 1.0, "2024", "2024-01", date(2024, 1, 1))]
    sinks.append(src(spark, r), M, path)
    sinks.append(src(spark, r), M, path)
    assert len(rows(spark, path)) == 2
    sinks.append(src(spark, [("a", 5.0, "2024", "2024-01", date(2024, 1, 1))]), M, path, replace_partition=True)
    assert rows(spark, path) == [("a", 5.0, "2024", "2024-01", date(2024, 1, 1))]


def test_monthly_mart_merges_on_year_month(spark, tmp_dir):
    mm = sinks.MONTHLY_STORAGE_PRICING
    path = f"{tmp_dir}/mm"
    row = ("p",) + (1.0,) * 9 + ("2024", "2024-01", date(2024, 1, 1))
    sinks.upsert(frame(spark, mm.schema, [row]), mm, path)
    sinks.upsert(frame(spark, mm.schema, [("p",) + (2.0,) * 9 + ("2024", "2024-01", date(2024, 1, 1))]), mm, path)
    got = [tuple(r) for r in sinks.read(spark, mm, path).collect()]
    assert got == [("p",) + (2.0,) * 9 + ("2024", "2024-01", date(2024, 1, 1))]


def test_upsert_reads_only_touched_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/m"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    sinks.upsert(src(spark, [("a", 1.0, "2024", "2024-01", d1), ("b", 2.0, "2024", "2024-01", d2)]), M, path)
    with open(f"{path}/date=2024-01-01/zz-corrupt.parquet", "wb") as fh:
        fh.write(b"garbage that is not parquet")
    # merging into 2024-01-02 must not open the files of 2024-01-01
    sinks.upsert(src(spark, [("b", 20.0, "2024", "2024-01", d2)]), M, path)
    from pyspark.sql import functions as F
    got = sinks.read(spark, M, path).filter(F.col("date") == d2).collect()
    assert [(r["project_id"], r["cost"]) for r in got] == [("b", 20.0)]


def test_editions_rerun_raises_on_repeated_keys(spark, tmp_dir):
    """Two editions per admin project and a baseline change within the day give
    several source rows per (reservation, date): the first merge inserts them
    all, the second fails like MERGE."""
    from conftest import SF_SMALL
    from costbook.asof import DEFAULT_ASOF
    from costbook.plans import pipelines
    from costbook.sources import fixtures

    path = f"{tmp_dir}/editions"
    t = fixtures.telemetry(spark, SF_SMALL)
    pipelines.run_editions_day_pricing(t, DEFAULT_ASOF, path)
    first = sinks.read(spark, sinks.DAILY_EDITIONS_COMPUTE_PRICING, path).count()
    assert first > 0
    with pytest.raises(Exception, match="more than one source row"):
        pipelines.run_editions_day_pricing(t, DEFAULT_ASOF, path)
    assert sinks.read(spark, sinks.DAILY_EDITIONS_COMPUTE_PRICING, path).count() == first


# --- property: upsert equals a plain model of MERGE -----------------------------------------
from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_row = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 9).map(float),
                 st.sampled_from([date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]))


def _merge_model(target, source):
    """Rows after MERGE on (project_id, date) updating cost; None if it must fail."""
    out, matched_sources = [], set()
    for t in target:
        hits = [i for i, s in enumerate(source) if t[0] is not None and s[0] == t[0] and s[2] == t[2]]
        if len(hits) > 1:
            return None
        if hits:
            matched_sources.add(hits[0])
            out.append((t[0], source[hits[0]][1], t[2]))
        else:
            out.append(t)
    out += [s for i, s in enumerate(source) if i not in matched_sources]
    return sorted(out, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(_row, max_size=6), source=st.lists(_row, min_size=1, max_size=5))
def test_upsert_equals_merge_model(spark, target, source):
    import tempfile

    path = tempfile.mkdtemp(prefix="costbook-merge-") + "/m"
    full = lambda rows: [(p, c, "2024", "2024-01", d) for p, c, d in rows]
    sinks.append(src(spark, full(target)), M, path)
    expected = _merge_model(target, source)
    if expected is None:
        with pytest.raises(sinks.MergeError):
            sinks.upsert(src(spark, full(source)), M, path)
        return
    sinks.upsert(src(spark, full(source)), M, path)
    got = sorted(((r[0], r[1], r[4]) for r in sinks.read(spark, M, path).collect()), key=repr)
    assert got == expected


def test_editions_merge_keeps_first_edition(spark, tmp_dir):
    em = sinks.DAILY_EDITIONS_COMPUTE_PRICING
    path = f"{tmp_dir}/e"
    d = date(2024, 1, 29)
    sinks.upsert(frame(spark, em.schema, [("r", d, "2024", "2024-01", "STANDARD", 1.0, 2.0)]), em, path)
    sinks.upsert(frame(spark, em.schema, [("r", d, "2024", "2024-01", "ENTERPRISE", 3.0, 4.0)]), em, path)
    got = [tuple(r) for r in sinks.read(spark, em, path).collect()]
    assert got == [("r", d, "2024", "2024-01", "STANDARD", 3.0, 4.0)]
