"""Newest rows by folder: the same rows, without a look at old folders."""

from __future__ import annotations

import os
import shutil
from datetime import date, timedelta

import pytest
from helpers import bike, bronze, drop_into, rows_of
from pyspark.sql import functions as F

from rillstone import LakeLayout
from rillstone import schemas as S
from rillstone.operators import bike_silver, recent_bike, recent_bike_hourly
from rillstone.sources import EnvelopeFolder, expire, newest, read_table, stored_dates, write_table
from rillstone.sources.files import Files
from rillstone.streaming import LakeJob, backfill_summaries, lake_flows, restate


def silver(spark, events):
    return bike_silver(bronze(spark, events), placed=True)


@pytest.mark.parametrize("how", ["batch", "stream", "both"])
def test_newest_rows_are_those_of_the_whole_table(spark, tmp_path, how):
    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "bike")
    events = [bike(f"S00{d % 3}", at=f"2024-01-0{d}T{h}:30:00Z") for d in range(1, 8) for h in (10, 23)] + [bike(at="never")]
    if how != "stream":
        write_table(silver(spark, events), layout, S.SILVER_BIKE)
    if how != "batch":
        drop_into(spark, folder, events)
        LakeJob(spark, layout, {"bike": EnvelopeFolder(folder)}, lake_flows(one_parse=False)).run_available([S.SILVER_BIKE])
    table = read_table(spark, layout, S.SILVER_BIKE)
    for n in (1, 5, 14, 100):
        found = newest(spark, layout, S.SILVER_BIKE, n)
        assert recent_bike(found, limit=n, newest_partitions=None).collect() == recent_bike(table, limit=n, newest_partitions=None).collect()
        one = newest(spark, layout, S.SILVER_BIKE, n, F.col("station_id") == "S001")
        assert recent_bike(one, "S001", n, None).collect() == recent_bike(table, "S001", n, None).collect()
    expire(spark, layout, S.SILVER_BIKE, date(2024, 1, 9), 3)
    assert newest(spark, layout, S.SILVER_BIKE, 100).count() == read_table(spark, layout, S.SILVER_BIKE).count() > 0


def test_newest_windows_filled_and_restated(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    assert stored_dates(spark, layout, S.GOLD_BIKE_HOURLY) == [] and newest(spark, layout, S.GOLD_BIKE_HOURLY, 3).count() == 0
    write_table(silver(spark, [bike(at=f"2024-01-0{d}T{h}:30:00Z") for d in range(1, 6) for h in (10, 23)]), layout, S.SILVER_BIKE)
    backfill_summaries(spark, layout, date(2024, 1, 9), only=(S.GOLD_BIKE_HOURLY,))
    write_table(silver(spark, [bike(at="2024-01-05T23:40:00Z"), bike(at="2024-01-02T23:40:00Z")]), layout, S.SILVER_BIKE)
    assert restate(spark, layout, S.GOLD_BIKE_HOURLY) == 2
    table = read_table(spark, layout, S.GOLD_BIKE_HOURLY)
    for n in (1, 2, 7, 11):
        found = recent_bike_hourly(newest(spark, layout, S.GOLD_BIKE_HOURLY, n), limit=n, newest_partitions=None)
        assert found.collect() == recent_bike_hourly(table, limit=n, newest_partitions=None).collect()
    assert rows_of(read_table(spark, layout, S.GOLD_BIKE_HOURLY, since=date(2024, 1, 4))) == rows_of(table.where("dt >= '2024-01-04'"))


def test_a_hundred_thousand_files(spark, tmp_path, monkeypatch):
    """Old folders are neither listed nor opened, however many there are."""
    layout = LakeLayout(str(tmp_path / "lake"))
    write_table(silver(spark, [bike(at="2024-01-01T10:00:00Z", available=k) for k in range(5)]), layout, S.SILVER_BIKE)
    root = layout.batch_table(S.SILVER_BIKE)
    first = f"{root}/dt=2024-01-01/station_id=S001"
    file = next(name for name in os.listdir(first) if name.endswith(".parquet"))
    for back in range(1, 2001):
        folder = f"{root}/dt={date(2024, 1, 1) - timedelta(days=back)}/station_id=S001"
        os.makedirs(folder)
        shutil.copy(f"{first}/{file}", f"{folder}/0-{file}")
        for k in range(1, 50):
            os.link(f"{folder}/0-{file}", f"{folder}/{k}-{file}")
    listed, names = [], Files.names
    monkeypatch.setattr(Files, "names", lambda self, path: listed.append(path) or names(self, path))
    found = newest(spark, layout, S.SILVER_BIKE, 5)
    assert found.inputFiles() == [f"file://{first}/{file}"] and len(listed) < 20
    assert recent_bike(found, limit=5, newest_partitions=None).count() == 5
    assert len(newest(spark, layout, S.SILVER_BIKE, 6).inputFiles()) == 51
