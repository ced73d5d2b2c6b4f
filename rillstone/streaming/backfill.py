"""Summaries of stored silver, in batch: whole dates, and windows that streams left incomplete."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone import schemas as S
from rillstone.layout import LakeLayout
from rillstone.operators.gold import bike_minute, bike_usage, weather_summary
from rillstone.operators.reconcile import missed_rows, window_gaps
from rillstone.session import scratch_dir
from rillstone.sources.expiry import expired_before
from rillstone.sources.tables import FROM_DT, read_table, replace_dates, restated_windows


@dataclass(frozen=True)
class Summary:
    """How a summary table comes from silver."""

    source: S.TableSpec
    size: str
    make: Callable[[DataFrame], DataFrame]


SUMMARIES = {
    S.GOLD_BIKE_HOURLY: Summary(S.SILVER_BIKE, "1 hour", lambda df: bike_usage(df, "hour", audited=True)),
    S.GOLD_BIKE_DAILY: Summary(S.SILVER_BIKE, "1 day", lambda df: bike_usage(df, "day", audited=True)),
    S.GOLD_WEATHER_HOURLY: Summary(S.SILVER_WEATHER, "1 hour", lambda df: weather_summary(df, "hour", audited=True)),
    S.GOLD_WEATHER_DAILY: Summary(S.SILVER_WEATHER, "1 day", lambda df: weather_summary(df, "day", audited=True)),
    S.GOLD_BIKE_MINUTE: Summary(S.SILVER_BIKE, "1 minute", lambda df: bike_minute(df, audited=True)),
}


def _between(df: DataFrame, day: str, since: date | None, until: date | None) -> DataFrame:
    """Dates ``since`` <= day < ``until``, as literals that prune partitions."""
    if since is not None:
        df = df.where(F.col(day) >= F.lit(since))
    if until is not None:
        df = df.where(F.col(day) < F.lit(until))
    return df


def backfill_summaries(
    spark: SparkSession,
    layout: LakeLayout,
    until: date,
    since: date | None = None,
    only: tuple[S.TableSpec, ...] = tuple(SUMMARIES),
) -> None:
    """Fill summary tables with the event dates ``since`` <= dt < ``until`` of stored silver.

    Every window lies within one date, so a range of whole dates gives whole windows in any
    order of files and without watermark: no row is late. Dates filled before are replaced, so a run
    may be repeated, or taken up again after a failure, in ranges as small as the cluster
    needs. Then start the flows with ``summaries_from=until``. What arrives for these dates afterwards is
    found by ``summary_gaps``.
    """
    for target in only:
        summary = SUMMARIES[target]
        silver = read_table(spark, layout, summary.source, audit=True)
        rows = summary.make(_between(silver, "dt", since, until))
        replace_dates(rows, layout, target, layout.filled_table(target))


def summary_gaps(
    spark: SparkSession,
    layout: LakeLayout,
    target: S.TableSpec,
    since: date | None = None,
    until: date | None = None,
    closed_until: datetime | None = None,
) -> DataFrame:
    """Closed windows of a summary whose rows are not those of silver (see ``window_gaps``).

    ``since`` and ``until`` are event dates; dates whose silver has expired are not judged. A window counts as closed when it ends at or before
    ``closed_until``; by default that is the end of the newest window stored, since a
    batch that writes a window writes all that its watermark has passed.
    """
    summary = SUMMARIES[target]
    kept = expired_before(spark, layout, summary.source)
    since = max((d for d in (since, kept) if d is not None), default=None)
    gold = read_table(spark, layout, target, missing_ok=True, audit=True)
    if closed_until is None:
        closed_until = gold.agg(F.max("window_end")).first()[0]
    if closed_until is None:
        closed_until = datetime(1, 1, 1)
    silver = _between(read_table(spark, layout, summary.source, audit=True), "dt", since, until)
    # The partition date of a summary is its start's date or the next.
    stored = _between(gold, "dt", since, None)
    if until is not None:
        stored = stored.where(F.col("dt") <= F.lit(until))
    stored = _between(stored, "window_start", since, until)
    return window_gaps(silver, stored, summary.size, list(target.keys)).where(F.col("window_end") <= F.lit(closed_until))


def late_rows(
    spark: SparkSession,
    layout: LakeLayout,
    target: S.TableSpec,
    since: date | None = None,
    until: date | None = None,
    closed_until: datetime | None = None,
) -> DataFrame:
    """Silver rows that are in no summary though their window is closed (see ``missed_rows``)."""
    gaps = summary_gaps(spark, layout, target, since, until, closed_until)
    silver = _between(read_table(spark, layout, SUMMARIES[target].source, audit=True), "dt", since, until)
    return missed_rows(silver, gaps, SUMMARIES[target].size, list(target.keys))


def restate(
    spark: SparkSession,
    layout: LakeLayout,
    target: S.TableSpec,
    since: date | None = None,
    until: date | None = None,
    closed_until: datetime | None = None,
) -> int:
    """Summarise again the windows that ``summary_gaps`` finds, and only these. Returns their number.

    The corrected rows stand in a folder of their own and take the place of the old ones when the table
    is read; streams and their logs are not touched. A window whose rows were stored twice becomes one.
    A second run finds nothing; one that failed in between is repaired by the next, since what is not in place
    is a gap again. A stored window without any row in silver is left as it is: silver may have expired.
    """
    summary = SUMMARIES[target]
    keys = [*target.keys, "window_start"]
    path = scratch_dir(spark, "gaps")
    gaps = summary_gaps(spark, layout, target, since, until, closed_until)
    gaps.where("n_rows > 0").select(*keys).write.parquet(path)
    found = spark.read.parquet(path)
    count = found.count()
    if not count:
        return 0
    day = F.to_date("window_start").alias(FROM_DT)
    dates = found.select(day).distinct()
    # A replaced partition must hold what was restated in it before, too.
    earlier = restated_windows(spark, layout, target)
    if earlier is not None:
        again = scratch_dir(spark, "windows")
        before = earlier.select(*keys).join(dates, F.to_date("window_start") == F.col(FROM_DT), "left_semi")
        found.union(before).distinct().write.parquet(again)
        found = spark.read.parquet(again)
    low, high = dates.agg(F.min(FROM_DT), F.max(FROM_DT)).first()
    silver = read_table(spark, layout, summary.source, audit=True).where(F.col("dt").between(F.lit(low), F.lit(high)))
    silver = silver.join(dates, F.col("dt") == F.col(FROM_DT), "left_semi")
    wanted = found.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rows = summary.make(silver).join(wanted, same, "left_semi")
    replace_dates(rows, layout, target, layout.restated_table(target))
    return count
