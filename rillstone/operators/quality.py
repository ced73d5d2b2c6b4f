"""Checks of what the producers promise about their readings.

A rule is broken only where it is false; a missing reading breaks nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import CONDITIONS


#: How a rule gets at a reading; rules can be asked of a struct's fields too.
Reading = Callable[[str], Column]


def bike_rules(of: Reading = F.col) -> dict[str, Column]:
    available, occupied = of("bikes_available"), of("bikes_occupied")
    docks, free = of("docks_total"), of("docks_available")
    return {
        "available_in_range": (available >= 0) & (available <= docks),
        "occupied_is_rest": occupied == docks - available,
        "free_docks_match": free == docks - occupied,
    }


def _one_decimal(reading: Column) -> Column:
    return F.round(reading, 1) == reading


def _finite(reading: Column) -> Column:
    return ~F.isnan(reading) & (F.abs(reading) != float("inf"))


def weather_rules(of: Reading = F.col) -> dict[str, Column]:
    measured = [of("temp_c"), of("precip_mm"), of("wind_kph")]
    return {
        "finite": _broken_if_false(*map(_finite, measured)),
        "precip_not_negative": of("precip_mm") >= 0,
        "wind_not_negative": of("wind_kph") >= 0,
        "humidity_in_range": of("humidity").between(25, 100),
        "one_decimal": reduce(Column.__and__, map(_one_decimal, measured)),
        "known_condition": of("condition").isin(*CONDITIONS),
    }


def _broken_if_false(*parts: Column) -> Column:
    """All parts that are known hold."""
    every = F.lit(True)
    for part in parts:
        every = every & F.coalesce(part, F.lit(True))
    return every


def _broken(rule: Column) -> Column:
    return F.coalesce(~rule, F.lit(False))


def _violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    names = F.concat_ws(",", *[F.when(_broken(rule), F.lit(n)) for n, rule in rules.items()])
    any_broken = F.lit(False)
    for rule in rules.values():
        any_broken = any_broken | _broken(rule)
    return df.where(any_broken).withColumn("broken_rules", names)


def bike_violations(silver: DataFrame) -> DataFrame:
    """Rows that break a bike rule, with the names of the broken rules."""
    return _violations(silver, bike_rules())


def weather_violations(silver: DataFrame) -> DataFrame:
    """Rows that break a weather rule, with the names of the broken rules."""
    return _violations(silver, weather_rules())


def violation_counts(
    silver: DataFrame, rules: dict[str, Column], by: list[str] | None = None
) -> DataFrame:
    """Rows checked and rows broken per rule, in one pass, optionally per group."""
    return silver.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(_broken(rule)).alias(name) for name, rule in rules.items()],
    )


def rule_metrics(rules: dict[str, Column], among: Column | None = None) -> list[Column]:
    """The counts of ``violation_counts`` as aggregates, for ``observe`` on a stream; ``among`` says which
    rows are checked."""
    among = F.lit(True) if among is None else among
    counts = [F.count_if(among & _broken(rule)).alias(name) for name, rule in rules.items()]
    return [F.count_if(among).alias("n_rows"), *counts]
