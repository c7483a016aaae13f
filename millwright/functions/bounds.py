"""Range tests over the sensor columns of one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millwright.schema import Sensor


def _inside(sensor: Sensor) -> Column:
    # NaN sorts above every number, so it fails the upper bound
    return F.col(sensor.name).between(F.lit(sensor.low), F.lit(sensor.high))


def accepted(sensor: Sensor) -> Column:
    """True when the value is present and inside the accepted range, never NULL."""
    return F.coalesce(_inside(sensor), F.lit(False))


def all_inside(sensors: Sequence[Sensor]) -> Column:
    """Filter form of "every sensor accepted"; plain comparisons reach the scan."""
    test = _inside(sensors[0])
    for sensor in sensors[1:]:
        test = test & _inside(sensor)
    return test


def any_refused(sensors: Sequence[Sensor]) -> Column:
    """The opposite of :func:`all_inside` for absent values too, of plain comparisons as well."""
    test = F.lit(False)
    for sensor in sensors:
        value = F.col(sensor.name)
        test = test | value.isNull() | (value < sensor.low) | (value > sensor.high)
    return test


def violations(sensors: Sequence[Sensor]) -> Column:
    """Names of the sensors outside their accepted range or absent, comma-joined."""
    return F.concat_ws(",", *[F.when(~accepted(s), F.lit(s.name)) for s in sensors])


def unusual(sensor: Sensor) -> Column:
    """True when a present value lies outside the normal range (absent: False)."""
    outside = ~F.col(sensor.name).between(F.lit(sensor.seen_low), F.lit(sensor.seen_high))
    return F.coalesce(outside & ~F.isnan(sensor.name), F.lit(False))


def unusual_names(sensors: Sequence[Sensor]) -> Column:
    """Names of the sensors outside their normal range, comma-joined."""
    return F.concat_ws(",", *[F.when(unusual(s), F.lit(s.name)) for s in sensors])
