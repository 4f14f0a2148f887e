"""Scalar expressions over rides: time keys, duration bands, labels."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from ridemart.schemas import BANDS, OTHER_PERIOD, PERIODS, RUSH_HOURS, WEEKEND_DAYS


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down, read off the clock fields.

    Taking the difference of two timestamps would convert them to the session's time zone on the way,
    which moves the hour that a change to summer time skips.
    """
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def duration_seconds(start: Column, end: Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def band_key(seconds: Column, bands: Sequence[tuple] = BANDS) -> Column:
    """Band of a duration, NULL for NULL; derived from the band table, and the same as ``in_band`` finds.

    The first band has no lower end and the last no upper one: a negative duration is in the first.
    """
    *closed, last = bands
    key = reduce(
        lambda case, band: case.when(seconds < band[3], F.lit(band[0])),
        closed[1:],
        F.when(seconds < closed[0][3], F.lit(closed[0][0])),
    )
    return key.when(seconds.isNotNull(), F.lit(last[0]))


def in_band(seconds: Column, first: Column, end: Column, bands: Sequence[tuple] = BANDS) -> Column:
    """Whether a duration is in the band stored as ``first`` to ``end``; the outermost bands are open."""
    above = (seconds >= first) | (first == bands[0][2])
    below = (seconds < end) | (end == bands[-1][3])
    return above & below & seconds.isNotNull()


def date_key(ts: Column) -> Column:
    """yyyyMMdd as an integer."""
    day = ts.cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_of_key(key: Column) -> Column:
    parts = [F.floor(key / 10000), F.floor(key / 100) % 100, key % 100]
    return F.make_date(*[part.cast("int") for part in parts])


def month_key_of(key: Column) -> Column:
    """yyyyMM of a yyyyMMdd key."""
    return F.floor(key / 100).cast("int")


def period(hour: Column) -> Column:
    label = F.lit(OTHER_PERIOD)
    for name, first, end in reversed(PERIODS):
        label = F.when((hour >= first) & (hour < end), F.lit(name)).otherwise(label)
    return label


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def is_rush_hour(hour: Column) -> Column:
    return flag(hour.isin(*RUSH_HOURS))


def is_weekend(day: Column) -> Column:
    return flag(F.dayofweek(day).isin(*WEEKEND_DAYS))


def day_type(weekend_flag: Column) -> Column:
    return F.when(weekend_flag == 1, F.lit("Weekend")).when(weekend_flag == 0, F.lit("Weekday"))


def rush_label(rush_flag: Column) -> Column:
    return F.when(rush_flag == 1, F.lit("Rush Hour")).when(rush_flag == 0, F.lit("Non-Rush"))


def route_region(start_region: Column, end_region: Column) -> Column:
    """NULL when either region is."""
    return F.concat(start_region, F.lit(" -> "), end_region)
