"""Timeframes: fixed durations, annualisation and thresholds, as literals and as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sixteen timeframes in milliseconds; a month is 30 days.
MS = {
    "1s": 1_000, "1m": 60_000, "3m": 180_000, "5m": 300_000, "15m": 900_000, "30m": 1_800_000,
    "1h": 3_600_000, "2h": 7_200_000, "4h": 14_400_000, "6h": 21_600_000, "8h": 28_800_000, "12h": 43_200_000,
    "1d": 86_400_000, "3d": 259_200_000, "1w": 604_800_000, "1M": 2_592_000_000,
}

# Periods in a year of the timeframes that have them; any other counts 365.
YEARLY = {"1m": 525_600, "5m": 105_120, "15m": 35_040, "30m": 17_520, "1h": 8_760, "4h": 2_190, "8h": 1_095, "1d": 365, "1w": 52}
YEARLY_DEFAULT = 365

# The smallest share of the close that a candle's range must span.
FLAT = {"1m": 0.0001, "5m": 0.0001, "15m": 0.0002, "1h": 0.0005, "4h": 0.001, "1d": 0.002}
FLAT_DEFAULT = 0.0001

#: Timeframes that candles of one minute are resampled to.
TARGETS = ("5m", "15m", "1h", "4h", "1d")


def to_ms(timeframe: str) -> int:
    """Milliseconds of a timeframe; an unknown one is an error."""
    if timeframe not in MS:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    return MS[timeframe]


def lookup(table: dict, key: Column, default=None) -> Column:
    pairs = F.create_map(*(F.lit(x) for item in table.items() for x in item))
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def ms_of(timeframe: Column, strict: bool = True) -> Column:
    """Milliseconds of a timeframe column; unknown names raise if strict, else are null."""
    found = lookup(MS, timeframe)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unknown timeframe "), timeframe)).cast("long")) if strict else found


def floor_ms(ms: Column, step: Column) -> Column:
    """The start of the epoch-aligned bucket that holds a time, before 1970 too."""
    return ms - F.pmod(ms, step)


def floor_time(timestamp: Column, step: Column) -> Column:
    return F.timestamp_millis(floor_ms(F.unix_millis(timestamp), step))
