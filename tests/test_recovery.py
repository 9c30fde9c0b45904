"""A merge that stops between two partitions."""

from datetime import date

import pytest

from costbook.operators import sinks

M = sinks.DAILY_ONDEMAND_COMPUTE_PRICING


def row(project, day, cost):
    return (project, cost, "2024", "2024-01", date(2024, 1, day))


def frame(spark, rows):
    return spark.createDataFrame(rows, M.schema)


def held(spark, path):
    return sorted(map(tuple, sinks.read(spark, M, path).collect()))


class Stop(Exception):
    pass


@pytest.mark.parametrize("reached", [0, 1, 2])
def test_a_rerun_ends_what_a_stopped_merge_began(spark, tmp_dir, monkeypatch, reached):
    path = f"{tmp_dir}/mart"
    sinks.upsert(frame(spark, [row("a", 1, 1.0), row("a", 2, 1.0), row("b", 2, 1.0), row("c", 5, 1.0)]), M, path)
    source = frame(spark, [row("a", 1, 2.0), row("b", 2, 3.0), row("n", 3, 4.0)])
    swap = sinks._swap

    def stopping(spark, mart, path, staged):
        rows = spark.read.schema(mart.schema).parquet(staged)
        for day in range(1, reached + 1):  # some partitions are replaced, the next one is gone
            (rows.filter(f"date = DATE'2024-01-0{day}'").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("date").parquet(path))
        sinks.remove(spark, f"{path}/date=2024-01-0{reached + 1}")
        raise Stop

    monkeypatch.setattr(sinks, "_swap", stopping)
    with pytest.raises(Stop):
        sinks.upsert(source, M, path)
    monkeypatch.setattr(sinks, "_swap", swap)
    assert sinks.exists(spark, f"{path}/{sinks.JOURNAL_FILE}")
    merged = sorted([row("a", 1, 2.0), row("a", 2, 1.0), row("b", 2, 3.0), row("c", 5, 1.0), row("n", 3, 4.0)])
    sinks.upsert(frame(spark, [row("c", 5, 9.0)]), M, path)  # the next run, of other partitions
    assert held(spark, path) == sorted([r for r in merged if r[0] != "c"] + [row("c", 5, 9.0)])
    assert not sinks.exists(spark, f"{path}/{sinks.JOURNAL_FILE}")
    sinks.upsert(source, M, path)
    assert held(spark, path) == sorted([r for r in merged if r[0] != "c"] + [row("c", 5, 9.0)])


def test_recover_says_what_it_did_and_what_is_lost(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/mart"
    sinks.upsert(frame(spark, [row("a", 1, 1.0)]), M, path)
    assert sinks.recover(spark, M, path) == []
    monkeypatch.setattr(sinks, "_swap", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sinks.upsert(frame(spark, [row("a", 1, 2.0), row("a", 2, 2.0)]), M, path)
    monkeypatch.undo()
    assert sinks.recover(spark, M, path) == ["2024-01-01", "2024-01-02"]
    assert held(spark, path) == [row("a", 1, 2.0), row("a", 2, 2.0)]
    sinks.write_small(spark, f"{path}/{sinks.JOURNAL_FILE}", '{"staged": "%s/none", "partitions": ["2024-01-01"]}' % tmp_dir)
    with pytest.raises(sinks.RecoveryError, match="2024-01-01"):
        sinks.append(frame(spark, [row("z", 9, 1.0)]), M, path)


def test_no_staged_rows_are_left(spark, tmp_dir):
    import os

    from costbook.session import scratch_root
    root = scratch_root(spark).replace("file:", "")
    before = set(os.listdir(root))
    sinks.upsert(frame(spark, [row("a", 1, 1.0)]), M, f"{tmp_dir}/mart")
    assert set(os.listdir(root)) == before
