"""Random small inputs against plain Python arithmetic."""

from __future__ import annotations

import math
import os
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from helpers import bike, bronze, envelope, weather

from rillstone import LakeLayout
from rillstone import schemas as S
from rillstone.operators import (
    bike_minute,
    bike_silver,
    bike_usage,
    to_bronze,
    weather_silver,
    weather_summary,
)
from rillstone.operators.gold import WATERMARK
from rillstone.sources import EnvelopeFolder, read_table
from rillstone.streaming import Flow, LakeJob

START = datetime(2024, 1, 1, 22, 0)
SIZES = {"minute": timedelta(minutes=1), "hour": timedelta(hours=1), "day": timedelta(days=1)}


def iso(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def floor(moment: datetime, size: timedelta) -> datetime:
    epoch = datetime(1970, 1, 1)
    return epoch + ((moment - epoch) // size) * size


def random_bikes(rng: random.Random, n: int) -> list[dict]:
    """A third of the rows belong to one station; some miss a reading or a usable time."""
    events = []
    for _ in range(n):
        station = "S001" if rng.random() < 0.34 else f"S{rng.randint(2, 5):03d}"
        docks = rng.choice([0, 5, 10, 10, None])
        available = rng.choice([None, *range(0, (docks or 4) + 1)])
        moment = START + timedelta(seconds=rng.randint(0, 4 * 3600))
        event = bike(station, iso(moment), available, docks, rng.choice(["North", "South"]))
        if rng.random() < 0.05:
            event["event_time"] = rng.choice([None, "soon"])
        events.append(event)
    return events


def mean(values: list[float]) -> float | None:
    return math.fsum(values) / len(values) if values else None


def grouped(events: list[dict], size: timedelta, city: str) -> dict[tuple, list[dict]]:
    groups = defaultdict(list)
    for e in events:
        if e["event_time"] and e["event_time"] != "soon":
            moment = datetime.strptime(e["event_time"], "%Y-%m-%dT%H:%M:%SZ")
            groups[(e["station_id"], e[city], floor(moment, size))].append(e)
    return groups


def present(events: list[dict], name: str) -> list:
    return [e[name] for e in events if e[name] is not None]


def rates(events: list[dict], part: str) -> list[float]:
    return [
        e[part] / e["docks_total"]
        for e in events
        if e["docks_total"] is not None and e["docks_total"] > 0 and e[part] is not None
    ]


def half_up(x: float) -> int:
    """Halves go away from zero."""
    return int(math.copysign(math.floor(abs(x) + 0.5), x))


def near(a, b) -> bool:
    return a == b if a is None or b is None else math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("grain", ["hour", "day"])
def test_bike_usage(spark, seed, grain):
    events = random_bikes(random.Random(seed), 400)
    groups = grouped(events, SIZES[grain], "bike_city")
    rows = bike_usage(bike_silver(bronze(spark, events)), grain).collect()
    assert len(rows) == len(groups)
    for r in rows:
        g = groups[(r.station_id, r.bike_city, r.window_start)]
        occupied = present(g, "bikes_occupied")
        assert r[f"bikes_occupied_{grain}"] == (sum(occupied) if occupied else None)
        assert near(r[f"bikes_available_avg_{grain}"], mean(present(g, "bikes_available")))
        assert near(r[f"availability_rate_avg_{grain}"], mean(rates(g, "bikes_available")))
        assert near(r[f"utilization_rate_avg_{grain}"], mean(rates(g, "bikes_occupied")))
        assert r.docks_total == max(present(g, "docks_total"), default=None)
        assert r.window_end == r.window_start + SIZES[grain]
        assert r.dt == r.window_end.date()


def test_bike_minute(spark):
    events = random_bikes(random.Random(3), 400)
    groups = grouped(events, SIZES["minute"], "bike_city")
    rows = bike_minute(bike_silver(bronze(spark, events))).collect()
    assert len(rows) == len(groups)
    for r in rows:
        g = groups[(r.station_id, r.bike_city, r.window_start)]
        for name in ("bikes_available", "bikes_occupied"):
            average = mean(present(g, name))
            assert r[name] == (None if average is None else half_up(average))
        assert r.dt == r.window_start.date()


def test_weather_summary(spark):
    rng = random.Random(4)
    events = [
        weather(
            f"S{rng.randint(1, 4):03d}", iso(START + timedelta(seconds=rng.randint(0, 14400))),
            rng.choice([None, round(rng.uniform(-5, 30), 1)]),
            rng.choice([None, 0.0, round(rng.uniform(0, 4), 1)]),
            rng.choice([None, rng.randint(25, 100)]), round(rng.uniform(0, 50), 1),
            rng.randint(990, 1030), city=rng.choice(["North", "South"]),
        )
        for _ in range(300)
    ]
    groups = grouped(events, SIZES["hour"], "weather_city")
    rows = weather_summary(weather_silver(bronze(spark, events)), "hour").collect()
    assert len(rows) == len(groups)
    for r in rows:
        g = groups[(r.station_id, r.weather_city, r.window_start)]
        rain = present(g, "precip_mm")
        assert near(r.sum_precip_mm_hour, math.fsum(rain) if rain else None)
        for field in ("temp_c", "humidity", "wind_kph", "pressure_mb"):
            assert near(r[f"avg_{field}_hour"], mean(present(g, field)))


def test_lateness_over_many_batches(spark, tmp_path):
    """One file per batch, times partly out of order; all transforms in one streaming plan."""
    rng = random.Random(5)
    folder, delay = str(tmp_path / "topic"), timedelta(minutes=15)
    state, expected, dropped = defaultdict(int), {}, 0
    newest = datetime(1970, 1, 1) + delay
    late_before = closing = newest - delay
    seen: set[str] = set()
    for batch in range(8):
        moments = [
            START + timedelta(minutes=35 * batch - rng.choice([0, 5, 20, 50, 100, 200]),
                              seconds=rng.randint(0, 59))
            for _ in range(6)
        ]
        events = [bike(at=iso(m), available=3) for m in moments]
        envelope(spark, events).coalesce(1).write.mode("append").parquet(folder)
        new = {f for f in os.listdir(folder) if f.endswith(".parquet")} - seen
        assert len(new) == 1
        seen |= new
        stamp = 1_700_000_000 + 10 * batch
        os.utime(os.path.join(folder, new.pop()), (stamp, stamp))
        # A batch closes windows by the times of all earlier batches. Its own rows are late
        # only for windows closed before: in the closing batch they still count.
        late_before, closing = closing, newest - delay
        late_groups = set()
        for m in moments:
            start = floor(m, SIZES["hour"])
            if start + SIZES["hour"] <= late_before:
                late_groups.add(start)
            else:
                state[start] += 7
        dropped += len(late_groups)
        newest = max(newest, max(moments))
        for start in [s for s in state if s + SIZES["hour"] <= closing]:
            expected[start] = state.pop(start)
    # A last batch without data closes what the newest rows allow.
    for start in [s for s in state if s + SIZES["hour"] <= newest - delay]:
        expected[start] = state.pop(start)
    assert dropped > 0

    layout = LakeLayout(str(tmp_path / "lake"))
    flow = Flow(
        "bike", S.GOLD_BIKE_HOURLY,
        lambda df: bike_usage(bike_silver(to_bronze(df)), "hour", WATERMARK),
    )
    job = LakeJob(
        spark, layout, {"bike": EnvelopeFolder(folder, max_files_per_trigger=1)}, (flow,)
    )
    progress = job.run_available()
    rows = read_table(spark, layout, S.GOLD_BIKE_HOURLY).collect()
    assert len(rows) == len(expected)
    assert {r.window_start: r.bikes_occupied_hour for r in rows} == expected
    # Counted after the partial aggregate: one per late window and batch, not per event.
    assert progress["gold_bike_usage_hourly"]["late_rows_dropped"] == dropped
