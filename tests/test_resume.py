"""A chain that stopped goes on where it did; unchanged input is not worked on again."""

import os

import pytest

from spanlake.plans import jobs
from spanlake.sources.versions import current

from test_jobs import inputs  # noqa: F401


def versions(spark, lake):
    return [current(spark, f"{lake}/{layer}").name for layer in ("bronze", "silver", "gold")]


def test_resume(spark, inputs, tmp_path, monkeypatch):  # noqa: F811
    lake = str(tmp_path / "lake")
    with monkeypatch.context() as m:
        m.setattr(jobs, "monthly_report", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.run_all(spark, inputs, lake, resume=True)
    first = versions(spark, lake)
    assert first[0] and first[1] and not first[2]
    resumed = jobs.run_all(spark, inputs, lake, resume=True)
    then = versions(spark, lake)
    assert then[:2] == first[:2] and then[2]
    again = jobs.run_all(spark, inputs, lake, resume=True)
    assert versions(spark, lake) == then
    assert [r.metrics for r in again] == [r.metrics for r in resumed]
    # Other options, or without resume: everything from there on is made anew.
    jobs.run_all(spark, inputs, lake, resume=True, keep_unknown=False)
    other = versions(spark, lake)
    assert other[0] == then[0] and other[1] != then[1] and other[2] != then[2]
    os.utime(f"{inputs}/periods.csv", (1, 1))
    jobs.run_all(spark, inputs, lake, resume=True, keep_unknown=False)
    assert all(a != b for a, b in zip(versions(spark, lake), other))


def test_plain_folders_are_never_taken_for_unchanged(spark, inputs, tmp_path):  # noqa: F811
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    jobs.ingest(spark, inputs, bronze)
    for table in ("snapshots", "periods"):
        current(spark, bronze).read(table).write.parquet(str(tmp_path / "bare" / table))
    jobs.conform(spark, str(tmp_path / "bare"), silver, resume=True)
    first = current(spark, silver).name
    jobs.conform(spark, str(tmp_path / "bare"), silver, resume=True)
    assert current(spark, silver).name != first
