"""Snapshot versions (S9) and the stage arguments that guard against silent loss."""

import os

import pytest

from ledgerlake import jobs
from ledgerlake.operators import targets as T
from ledgerlake.sources import sinks


def values(spark, table):
    return sorted(r[0] for r in sinks.read_table(spark, table).collect())


def test_versions_count_up_whatever_the_clock_says(spark, tmpdir_path, monkeypatch):
    import time
    table = os.path.join(tmpdir_path, "t")
    sinks.write_replace(spark.range(1), table)
    monkeypatch.setattr(time, "time_ns", lambda: 5)  # a host a long way behind
    monkeypatch.setattr(time, "time", lambda: 0.0)
    sinks.write_replace(spark.range(2), table)
    assert values(spark, table) == [0, 1] and sinks.versions(spark, table) == [1, 2]
    sinks.write_replace(spark.range(3), table)
    assert values(spark, table) == [0, 1, 2] and sinks.versions(spark, table) == [2, 3]
    assert len([f for f in os.listdir(table) if f.startswith("snap-")]) == 2


def test_a_version_is_published_once(spark, tmpdir_path):
    table = os.path.join(tmpdir_path, "t")
    first = sinks.write_replace(spark.range(1), table)
    assert not sinks._publish(spark, table, "snap-other", 1)  # taken: nothing is overwritten
    assert sinks.current_snapshot(spark, table) == first
    assert not [f for f in os.listdir(sinks.pointer_folder(table)) if f.startswith(".snap")]


def test_writers_from_one_snapshot_conflict(spark, tmpdir_path, monkeypatch):
    table = os.path.join(tmpdir_path, "t")
    base = sinks.write_replace(spark.range(1), table)
    sinks.write_replace(spark.range(2), table, expected=base)
    with pytest.raises(sinks.ConflictError):
        sinks.write_replace(spark.range(5), table, expected=base)
    assert values(spark, table) == [0, 1]
    # the other writer gets in between the look and the publication
    now, publish, calls = sinks.current_snapshot(spark, table), sinks._publish, []

    def late(spark_, table_, name, version):
        if not calls:
            calls.append(1)
            sinks.write_replace(spark.range(4), table)
        return publish(spark_, table_, name, version)

    monkeypatch.setattr(sinks, "_publish", late)
    with pytest.raises(sinks.ConflictError):
        sinks.write_replace(spark.range(9), table, expected=now)
    assert values(spark, table) == [0, 1, 2, 3]


def test_layout_is_one_row(spark, tmpdir_path):
    table = os.path.join(tmpdir_path, "t")
    for n in (4, 8):
        sinks.write_bucket_layout(spark, table, n)
        assert sinks.bucket_layout(spark, table) == n


@pytest.mark.parametrize("stage, given", [("deposits", ["--listings", "x"]), ("claim", []), ("apply", []), ("gold", []), ("bronze", []), ("deeds-stream", []), ("deposits", ["--listings", "x", "--per-company", "0"])])
def test_stages_refuse_missing_arguments(stage, given, tmpdir_path, capsys):
    with pytest.raises(SystemExit):
        jobs.main([stage, "--root", tmpdir_path, *given])
    assert "needs --" in (err := capsys.readouterr().err) or "1 or more" in err


def test_latest_deposits_refuses_no_number(spark):
    deposits = spark.createDataFrame([("c", "r", "2022-01-01", "2022-01-01")], "company string, reference string, periodEndDate string, depositDate string")
    for n in (None, 0):
        with pytest.raises(ValueError):
            T.latest_deposits(deposits, n)
