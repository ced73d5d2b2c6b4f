"""Compaction in place: the same rows in fewer files, through any stop, and without harm to followers."""

from __future__ import annotations

from datetime import date

import pytest
from helpers import bike, bronze, rows_of

from rillstone import LakeLayout
from rillstone import schemas as S
from rillstone.operators import bike_silver
from rillstone.sources import compact, expire, newest, read_table, stored_dates, write_table
from rillstone.sources.files import Files
from rillstone.streaming import LakeJob, lake_flows

UNTIL = date(2024, 1, 3)


def silver(spark, events):
    return bike_silver(bronze(spark, events), placed=True)


def small_files(spark, layout, turns=3):
    for k in range(turns):
        events = [bike(at=f"2024-01-0{d}T10:00:00Z", available=k) for d in range(1, 5)] + [bike("S002", at="never", available=k)]
        write_table(silver(spark, events), layout, S.SILVER_BIKE)


def stored(spark, layout):
    return rows_of(read_table(spark, layout, S.SILVER_BIKE, audit=True))


def test_few_files_and_the_same_rows(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    assert compact(spark, layout, S.SILVER_BIKE, UNTIL) == 0
    small_files(spark, layout)
    before, n = stored(spark, layout), len(read_table(spark, layout, S.SILVER_BIKE).inputFiles())
    assert compact(spark, layout, S.SILVER_BIKE, UNTIL, since=date(2024, 1, 2)) == 3
    assert compact(spark, layout, S.SILVER_BIKE, UNTIL) == 3
    assert len(read_table(spark, layout, S.SILVER_BIKE).inputFiles()) == n - 4
    assert compact(spark, layout, S.SILVER_BIKE, UNTIL) == 0 and stored(spark, layout) == before
    # Rows that come later for a compacted date are kept and go along with the next run.
    write_table(silver(spark, [bike(at="2024-01-01T11:00:00Z")]), layout, S.SILVER_BIKE)
    assert read_table(spark, layout, S.SILVER_BIKE).count() == len(before) + 1
    assert compact(spark, layout, S.SILVER_BIKE, UNTIL) == 1
    assert read_table(spark, layout, S.SILVER_BIKE).count() == len(before) + 1
    assert stored_dates(spark, layout, S.SILVER_BIKE)[-1] == date(2024, 1, 1)
    assert newest(spark, layout, S.SILVER_BIKE, 8).where("dt = '2024-01-02'").count() == 3
    expire(spark, layout, S.SILVER_BIKE, date(2024, 1, 4), 2)
    assert read_table(spark, layout, S.SILVER_BIKE).count() == 9
    assert not [f for f in read_table(spark, layout, S.SILVER_BIKE).inputFiles() if "dt=2024-01-01" in f]


@pytest.mark.parametrize("step", range(6))
def test_a_run_stopped_anywhere_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, step):
    layout = LakeLayout(str(tmp_path))
    small_files(spark, layout, 2)
    before = stored(spark, layout)
    done = []

    def stopping(name):
        plain = getattr(Files, name)

        def act(self, *paths):
            done.append(name)
            if len(done) > step + 2:  # the first two end an earlier run
                raise OSError("lost")
            return plain(self, *paths)

        return act

    with monkeypatch.context() as patched:
        for name in ("move", "delete"):
            patched.setattr(Files, name, stopping(name))
        try:
            compact(spark, layout, S.SILVER_BIKE, UNTIL)
        except OSError:
            pass
    assert stored(spark, layout) == before
    compact(spark, layout, S.SILVER_BIKE, UNTIL)
    assert stored(spark, layout) == before
    assert len([f for f in read_table(spark, layout, S.SILVER_BIKE).inputFiles() if "dt=2024-01-01" in f]) == 1


def test_followers_read_no_row_again(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    small_files(spark, layout)
    daily = tuple(f for f in lake_flows() if f.target == S.GOLD_BIKE_DAILY)
    assert LakeJob(spark, layout, {}, daily).run_available()["gold_bike_usage_daily"]["rows_in"] == 15
    compact(spark, layout, S.SILVER_BIKE, UNTIL)
    write_table(silver(spark, [bike(at="2024-01-06T10:00:00Z")]), layout, S.SILVER_BIKE)
    seen = LakeJob(spark, layout, {}, daily).run_available()["gold_bike_usage_daily"]
    assert (seen["rows_in"], seen["late_rows_dropped"]) == (1, 0)
    assert [r.bikes_occupied_day for r in read_table(spark, layout, S.GOLD_BIKE_DAILY).orderBy("dt").collect()] == [27] * 4
