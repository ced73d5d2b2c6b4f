"""Rows that came after their window: found, told apart, and summarised again without harm to the rest."""

from __future__ import annotations

import json
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from helpers import bike, drop_into, envelope, plan_of, rows_of, weather
from pyspark.sql import functions as F

from rillstone import LakeLayout
from rillstone import schemas as S
from rillstone.operators import bike_silver, bike_usage, missed_rows, to_bronze, violation_counts, weather_silver, window_gaps
from rillstone.operators.quality import bike_rules
from rillstone.operators.silver import accepted, parsed_messages, refused
from rillstone.session import settings
from rillstone.sources import EnvelopeFolder, expire, expired_before, publish, read_table, rewrite_compact, write_table
from rillstone.sources.files import Files
from rillstone.streaming import LakeJob, backfill_summaries, lake_flows, late_rows, open_windows, restate, summary_gaps
from rillstone.streaming.writer import publish_batch

HOURLY, DAILY = S.GOLD_BIKE_HOURLY, S.GOLD_BIKE_DAILY


@pytest.fixture
def place(tmp_path):
    return SimpleNamespace(layout=LakeLayout(str(tmp_path / "lake")), bike=str(tmp_path / "bike"), weather=str(tmp_path / "weather"))


def job(spark, place, **options):
    sources = {"bike": EnvelopeFolder(place.bike), "weather": EnvelopeFolder(place.weather)}
    return LakeJob(spark, place.layout, sources, lake_flows(**options))


def drop(spark, place, events, first_offset, partition=0):
    rows = envelope(spark, events).withColumn("offset", F.col("offset") + first_offset).withColumn("partition", F.lit(partition))
    publish(rows.coalesce(1), EnvelopeFolder(place.bike))


def silver(spark, events, placed=True):
    taken_in = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return bike_silver(to_bronze(envelope(spark, events), taken_in), placed=placed)


def hours(spark, place, spec=HOURLY):
    return rows_of(read_table(spark, place.layout, spec).select("station_id", "window_start", f"bikes_occupied_{'hour' if spec == HOURLY else 'day'}"))


def test_event_after_a_backfill_is_found_and_counted(spark, place):
    """A late event of a date that was filled in batch: no watermark ever sees it."""
    drop(spark, place, [bike(at=f"2024-01-0{d}T10:00:00Z") for d in range(1, 7)], 0)
    job(spark, place).run_available([S.SILVER_BIKE])
    backfill_summaries(spark, place.layout, date(2024, 1, 4), only=(HOURLY,))
    later = {"summaries_from": date(2024, 1, 4)}
    job(spark, place, **later).run_available([HOURLY])
    assert summary_gaps(spark, place.layout, HOURLY).count() == 0
    drop(spark, place, [bike(at="2024-01-02T15:30:00Z", available=1)], 100)
    seen = job(spark, place, **later).run_available([HOURLY])[HOURLY.view_name]
    assert seen["late_rows_dropped"] == 0 and seen["observed"]["summaries_from"] == {"left_to_backfill": 1}
    found = late_rows(spark, place.layout, HOURLY).collect()
    assert [(r.event_time, r.n_missed, r.certain) for r in found] == [(datetime(2024, 1, 2, 15, 30), 1, True)]
    before = hours(spark, place)
    assert restate(spark, place.layout, HOURLY) == 1
    assert sorted(set(hours(spark, place)) - set(before)) == [("S001", datetime(2024, 1, 2, 15), 9)]
    assert restate(spark, place.layout, HOURLY) == 0 and late_rows(spark, place.layout, HOURLY).count() == 0


def test_late_row_of_a_summarised_window_is_told_apart(spark, place):
    drop(spark, place, [bike(at="2024-01-01T10:05:00Z"), bike(at="2024-01-01T10:06:00Z", available=2), bike("S002", at="2024-01-01T23:59:00Z")], 0)
    drop(spark, place, [bike(at="2024-01-03T10:05:00Z")], 10)
    job(spark, place).run_available([HOURLY])
    drop(spark, place, [bike(at="2024-01-01T10:30:00Z", available=7), bike("S002", at="2024-01-01T23:10:00Z", city="Elsewhere")], 20)
    assert job(spark, place).run_available([HOURLY])[HOURLY.view_name]["late_rows_dropped"] == 2
    found = late_rows(spark, place.layout, HOURLY)
    assert rows_of(found.select("station_id", "bike_city", "event_time", "n_missed", "certain")) == [
        ("S001", "Boston", datetime(2024, 1, 1, 10, 30), 1, True), ("S002", "Elsewhere", datetime(2024, 1, 1, 23, 10), 1, True),
    ]
    assert late_rows(spark, place.layout, HOURLY, until=date(2024, 1, 1)).count() == 0
    assert restate(spark, place.layout, HOURLY) == 2
    expected = bike_usage(read_table(spark, place.layout, S.SILVER_BIKE).where("event_time < '2024-01-03'"), "hour")
    assert rows_of(read_table(spark, place.layout, HOURLY)) == rows_of(expected)
    # A further late row in the same partition: the windows restated before stay.
    drop(spark, place, [bike(at="2024-01-01T11:30:00Z"), bike(at="2024-01-01T10:31:00Z", available=0)], 30)
    job(spark, place).run_available([HOURLY])
    assert restate(spark, place.layout, HOURLY) == 2
    expected = bike_usage(read_table(spark, place.layout, S.SILVER_BIKE).where("event_time < '2024-01-03'"), "hour")
    assert rows_of(read_table(spark, place.layout, HOURLY)) == rows_of(expected)


def test_open_windows_are_no_gaps(spark, place):
    drop(spark, place, [bike(at="2024-01-01T10:05:00Z"), bike(at="2024-01-01T12:05:00Z")], 0)
    job(spark, place).run_available([HOURLY])
    assert summary_gaps(spark, place.layout, HOURLY).count() == 0
    assert summary_gaps(spark, place.layout, HOURLY, closed_until=datetime(2024, 1, 2)).count() == 1
    assert summary_gaps(spark, place.layout, S.GOLD_BIKE_MINUTE).count() == 0  # nothing stored: nothing known to be closed
    state = open_windows(spark, place.layout, HOURLY)
    assert rows_of(state) == [("S001", "Boston", datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 13), 1)]
    drop(spark, place, [bike(at="2024-01-01T12:06:00Z"), bike("S002", at="2024-01-02T00:05:00Z", city=None)], 10)
    job(spark, place).run_available([HOURLY])
    # The state of closed windows is gone.
    assert rows_of(open_windows(spark, place.layout, HOURLY)) == [("S002", None, datetime(2024, 1, 2), datetime(2024, 1, 2, 1), 1)]


def test_rows_that_cannot_be_told_apart_are_all_given(spark):
    events = [bike(at="2024-01-01T10:05:00Z", available=k) for k in range(4)]
    rows = silver(spark, events).withColumn("source_partition", F.col("bikes_available") % 2)
    gold = bike_usage(rows.where("bikes_available < 3"), "hour", audited=True)
    gaps = window_gaps(rows, gold, "1 hour", ["station_id", "bike_city"])
    found = missed_rows(rows, gaps, "1 hour", ["station_id", "bike_city"]).collect()
    assert len(found) == 4 and not any(r.certain for r in found) and {r.n_missed for r in found} == {1}
    # One partition, but the missing row lies before the last that was counted.
    rows = silver(spark, events)
    gold = bike_usage(rows.where("bikes_available <> 1"), "hour", audited=True)
    found = missed_rows(rows, window_gaps(rows, gold, "1 hour", ["station_id", "bike_city"]), "1 hour", ["station_id", "bike_city"])
    assert {r.certain for r in found.collect()} == {False}


def test_rows_counted_twice_are_a_gap_too(spark, place):
    rows = silver(spark, [bike(at="2024-01-01T10:05:00Z"), bike("S002", city=None), bike(None, at="2024-01-01T23:30:00Z")])
    write_table(rows, place.layout, S.SILVER_BIKE)
    write_table(bike_usage(rows, "hour", audited=True), place.layout, HOURLY)
    assert summary_gaps(spark, place.layout, HOURLY).count() == 0
    write_table(bike_usage(rows.where("station_id = 'S001'"), "hour", audited=True), place.layout, HOURLY)
    found = summary_gaps(spark, place.layout, HOURLY).collect()
    assert [(r.station_id, r.n_missed, r.n_summaries) for r in found] == [("S001", -1, 2)]
    assert restate(spark, place.layout, HOURLY) == 1
    assert rows_of(read_table(spark, place.layout, HOURLY)) == rows_of(bike_usage(rows, "hour"))


def test_summaries_without_counts_are_not_judged(spark, place):
    rows = silver(spark, [bike(at="2024-01-01T10:05:00Z"), bike(at="2024-01-01T11:05:00Z")], placed=False)
    write_table(rows, place.layout, S.SILVER_BIKE)
    write_table(bike_usage(rows.where("hour(event_time) = 11"), "hour"), place.layout, HOURLY)
    found = summary_gaps(spark, place.layout, HOURLY).collect()
    assert [(r.window_start.hour, r.n_missed) for r in found] == [(10, 1)]


def test_backfill_twice_is_once_and_ranges_may_touch(spark, place):
    events = [bike(at=f"2024-01-0{d}T{h}:30:00Z", available=d) for d in range(1, 8) for h in (10, 23)]
    write_table(silver(spark, events), place.layout, S.SILVER_BIKE)
    spans = [(date(2024, 1, 4), None), (date(2024, 1, 6), date(2024, 1, 4)), (date(2024, 1, 4), None), (date(2024, 1, 5), date(2024, 1, 3))]
    for until, since in spans:
        backfill_summaries(spark, place.layout, until, since, only=(HOURLY, S.GOLD_BIKE_MINUTE))
    expected = bike_usage(silver(spark, events), "hour").where("window_start < '2024-01-06'")
    assert rows_of(read_table(spark, place.layout, HOURLY)) == rows_of(expected)
    assert read_table(spark, place.layout, S.GOLD_BIKE_MINUTE).count() == 10
    # What came late is in after one more run.
    write_table(silver(spark, [bike(at="2024-01-03T23:40:00Z")]), place.layout, S.SILVER_BIKE)
    backfill_summaries(spark, place.layout, date(2024, 1, 4), date(2024, 1, 3), only=(HOURLY,))
    assert summary_gaps(spark, place.layout, HOURLY).count() == 0


def test_compact_copy_twice_is_once(spark, tmp_path):
    small, few = LakeLayout(str(tmp_path / "a")), LakeLayout(str(tmp_path / "b"))
    for k in range(3):
        write_table(silver(spark, [bike(available=k), bike(at="2024-01-05T00:00:00Z"), bike(at="never")]), small, S.SILVER_BIKE)
    for _ in range(2):
        rewrite_compact(spark, small, few, S.SILVER_BIKE)
    assert rows_of(read_table(spark, few, S.SILVER_BIKE)) == rows_of(read_table(spark, small, S.SILVER_BIKE))
    rewrite_compact(spark, small, few, S.SILVER_BIKE, since=date(2024, 1, 5))  # other dates stay
    assert read_table(spark, few, S.SILVER_BIKE).count() == 9
    with pytest.raises(ValueError, match="one layout"):
        rewrite_compact(spark, small, small, S.SILVER_BIKE)


BROKEN = ["not json", None, "", "{}", '{"station_id":" "}', '{"station_id":"S1","docks_total":"x"}', "[1]"]


def test_one_parse_gives_both_tables(spark):
    bronze = to_bronze(envelope(spark, [bike(), bike(docks=0), *BROKEN]), F.current_timestamp())
    parsed = parsed_messages(bronze, S.BIKE_EVENT)
    assert rows_of(accepted(parsed, S.BIKE_EVENT)) == rows_of(bike_silver(bronze).drop("availability_rate", "utilization_rate"))
    assert refused(parsed).columns == bronze.columns and refused(parsed).count() == len(BROKEN)
    kept = parsed.persist()
    try:
        kept.count()
        for frame in (accepted(kept, S.BIKE_EVENT, placed=True), refused(kept)):
            assert plan_of(frame).count("from_json") == 1 and "InMemoryTableScan" in plan_of(frame)
    finally:
        kept.unpersist()


def test_silver_and_quarantine_from_one_query(spark, place):
    drop_into(spark, place.bike, [bike(), *BROKEN, bike("S002")])
    running = job(spark, place)
    seen = running.run_available([S.SILVER_BIKE, S.QUARANTINE_BIKE])
    assert running.queries["silver_bike_events"] is running.queries["quarantine_bike"]
    assert seen["silver_bike_events"]["observed"]["messages"] == {"n_messages": 9, "refused": 7}
    assert read_table(spark, place.layout, S.SILVER_BIKE).count() == 2
    assert read_table(spark, place.layout, S.QUARANTINE_BIKE).count() == 7
    job(spark, place).run_available([S.SILVER_BIKE])
    drop_into(spark, place.bike, ["once more"])
    job(spark, place).run_available([S.QUARANTINE_BIKE])
    assert read_table(spark, place.layout, S.SILVER_BIKE).count() == 2
    assert read_table(spark, place.layout, S.QUARANTINE_BIKE).count() == 8


def test_a_batch_given_again_adds_nothing(spark, place, monkeypatch):
    rows, checkpoint = silver(spark, [bike(), bike("S002"), bike("S003", at="2024-01-09T00:00:00Z")]), place.layout.checkpoint(S.SILVER_BIKE)

    def publish_it():
        publish_batch(rows, place.layout, S.SILVER_BIKE, checkpoint, 4)

    def stop(after):
        move = Files.move_all

        def moves(self, files):
            move(self, files[:after])
            raise OSError("lost")

        return moves

    # Stopped after no file and after one; then complete; then given twice more.
    for after in (0, 1):
        with monkeypatch.context() as patched:
            patched.setattr(Files, "move_all", stop(after))
            with pytest.raises(OSError):
                publish_it()
    for _ in range(3):
        publish_it()
    assert rows_of(read_table(spark, place.layout, S.SILVER_BIKE, audit=True)) == rows_of(rows.select(*S.SILVER_BIKE.stored_schema.names))
    publish_batch(rows, place.layout, S.SILVER_BIKE, checkpoint, 5)
    assert read_table(spark, place.layout, S.SILVER_BIKE).count() == 6


def test_a_replayed_stream_batch_adds_nothing(spark, place):
    drop_into(spark, place.bike, [bike(), "not json"])
    job(spark, place).run_available([S.SILVER_BIKE])
    # As if the driver had died after the tables were written and before the batch was committed.
    files = Files(spark, place.layout.base)
    files.delete(f"{place.layout.checkpoint(S.SILVER_BIKE)}/commits/0")
    files.delete(f"{place.layout.checkpoint(S.SILVER_BIKE)}/commits/.0.crc")
    drop_into(spark, place.bike, [bike("S002")])
    job(spark, place).run_available([S.SILVER_BIKE])
    assert rows_of(read_table(spark, place.layout, S.SILVER_BIKE).select("station_id")) == [("S001",), ("S002",)]
    assert read_table(spark, place.layout, S.QUARANTINE_BIKE).count() == 1


@pytest.mark.parametrize("one_parse", [True, False])
def test_expired_dates_are_gone(spark, place, one_parse):
    events = [bike(f"S00{d}", at=f"2024-01-0{d}T23:30:00Z") for d in range(1, 8)] + [bike(at="never")]
    drop_into(spark, place.bike, events)
    job(spark, place, one_parse=one_parse).run_available([HOURLY])
    backfill_summaries(spark, place.layout, date(2024, 1, 9), only=(DAILY,))
    everything = read_table(spark, place.layout, S.SILVER_BIKE)
    kept = rows_of(everything.where("dt >= '2024-01-05'"))
    folders = {f"dt=2024-01-0{d}" for d in range(1, 5)} | {"dt=__HIVE_DEFAULT_PARTITION__"}
    gone = expire(spark, place.layout, S.SILVER_BIKE, date(2024, 1, 8), days=3)
    assert {path.rpartition("/")[2] for path in gone} == folders
    assert expired_before(spark, place.layout, S.SILVER_BIKE) == date(2024, 1, 5)
    assert rows_of(read_table(spark, place.layout, S.SILVER_BIKE)) == kept
    for root in place.layout.folders(S.SILVER_BIKE):
        assert folders.isdisjoint(Files(spark, root).names(root))
    # Run again, and with an earlier date: nothing comes back. Later silver is still taken.
    assert expire(spark, place.layout, S.SILVER_BIKE, date(2024, 1, 2), days=3) == []
    drop_into(spark, place.bike, [bike("S009", at="2024-01-09T00:30:00Z")])
    job(spark, place, one_parse=one_parse).run_available([HOURLY])
    assert read_table(spark, place.layout, S.SILVER_BIKE).count() == len(kept) + 1
    # Summaries of dates whose silver is gone are no gaps, and expire by themselves.
    assert summary_gaps(spark, place.layout, DAILY).where("window_start < '2024-01-05'").count() == 0
    expire(spark, place.layout, DAILY, date(2024, 1, 8), days=3)
    assert {r.dt for r in read_table(spark, place.layout, DAILY).collect()} == {date(2024, 1, d) for d in (5, 6, 7, 8)}


def test_totals_of_many_batches_without_a_poll(spark, place):
    messages = envelope(spark, [bike(f"S{k % 3:03d}") for k in range(45)]).withColumn("k", F.col("offset") % 15)
    publish(messages.repartitionByRange(15, "k").drop("k"), EnvelopeFolder(place.bike))
    source = EnvelopeFolder(place.bike, max_files_per_trigger=1)
    flows = tuple(f for f in lake_flows() if f.target == S.BRONZE_BIKE)
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "2"}):  # Spark itself forgets all but two
        running = LakeJob(spark, place.layout, {"bike": source}, flows)
        seen = running.run_available()["bronze_bike"]
    assert len(running.queries["bronze_bike"].recentProgress) <= 2
    assert seen["batches"] > 10 and (seen["rows_in"], seen["active"]) == (45, False)


def test_observed_counts_are_those_of_the_check(spark, place):
    events = [bike(), bike(available=99), {**bike("S002"), "docks_available": 1}, "x", bike(docks=None)]
    drop_into(spark, place.bike, events[:2])
    drop_into(spark, place.bike, events[2:])
    sources = {"bike": EnvelopeFolder(place.bike, max_files_per_trigger=1)}
    for options in ({}, {"on_malformed": "keep"}, {"quarantine": False}):
        layout = LakeLayout(f"{place.layout.base}-{len(json.dumps(options))}")
        seen = LakeJob(spark, layout, sources, lake_flows(**options)).run_available([S.SILVER_BIKE])["silver_bike_events"]["observed"]
        expected = violation_counts(read_table(spark, layout, S.SILVER_BIKE), bike_rules()).first().asDict()
        assert seen["quality"] == expected
    assert "messages" in seen


def test_joined_hours_come_when_both_sides_have_passed(spark, place):
    drop_into(spark, place.bike, [bike(at="2024-01-01T10:05:00Z"), bike("S002", at="2024-01-01T10:06:00Z"), bike(at="2024-01-01T14:00:00Z")])
    drop_into(spark, place.weather, [weather(at="2024-01-01T10:50:00Z", precip=2.0), weather(at="2024-01-01T11:00:00Z")], "weather")
    spec = S.GOLD_WEATHER_BIKE
    job(spark, place, joined=True).run_available([spec])
    assert read_table(spark, place.layout, spec).count() == 0  # the weather's watermark has not passed the hour
    drop_into(spark, place.weather, [weather(at="2024-01-01T15:00:00Z")], "weather")
    drop_into(spark, place.bike, [bike(at="2024-01-01T14:01:00Z")])
    job(spark, place, joined=True).run_available([spec])
    got = read_table(spark, place.layout, spec).select("station_id", "window_start", "sum_precip_mm_hour", "bikes_occupied_hour", "dt")
    assert rows_of(got) == [("S001", datetime(2024, 1, 1, 10), 2.0, 6, date(2024, 1, 1))]
    composed = LakeLayout(f"{place.layout.base}-composed")
    flows = lake_flows(joined=True, composed=True)
    assert {s for f in flows for s in f.sources} == {"bike", "weather"}
    LakeJob(spark, composed, {"bike": EnvelopeFolder(place.bike), "weather": EnvelopeFolder(place.weather)}, flows).run_available([spec])
    assert rows_of(read_table(spark, composed, spec)) == rows_of(read_table(spark, place.layout, spec))


def test_weather_restated(spark, place):
    drop_into(spark, place.weather, [weather(at="2024-01-01T10:05:00Z"), weather(at="2024-01-03T10:05:00Z")], "weather")
    job(spark, place).run_available([S.GOLD_WEATHER_DAILY])
    drop_into(spark, place.weather, [weather(at="2024-01-01T11:05:00Z", temp=5.0)], "weather")
    job(spark, place).run_available([S.GOLD_WEATHER_DAILY])
    assert restate(spark, place.layout, S.GOLD_WEATHER_DAILY, since=date(2024, 1, 1), until=date(2024, 1, 2)) == 1
    assert [r.avg_temp_c_day for r in read_table(spark, place.layout, S.GOLD_WEATHER_DAILY).collect()] == [10.0]
    assert weather_silver(to_bronze(envelope(spark, [weather()], "weather"), F.current_timestamp())).count() == 1
