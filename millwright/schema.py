"""The sensor schema as data: names, headers, bounds, defaults.

Every operator takes its sensor list as an argument, so a table on another
scale (or with other sensors) only needs its own tuple of ``Sensor``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Sensor:
    """One numeric sensor column.

    ``low``/``high`` is the accepted input range (inclusive), ``default`` the
    value for an absent reading, ``seen_low``/``seen_high`` the documented
    range of normal readings.
    """

    name: str
    header: str
    low: float
    high: float
    default: float
    seen_low: float
    seen_high: float


# Sensor order, file headers, accepted range, default, normal range.
SENSORS: tuple[Sensor, ...] = (
    Sensor("engine_rpm", "Engine rpm", 100.0, 2500.0, 791.0, 161.0, 2239.0),
    Sensor("lub_oil_pressure", "Lub oil pressure", 0.0, 10.0, 3.3, 0.003, 7.266),
    Sensor("fuel_pressure", "Fuel pressure", 0.0, 25.0, 6.7, 0.003, 21.138),
    Sensor("coolant_pressure", "Coolant pressure", 0.0, 10.0, 2.3, 0.002, 7.479),
    Sensor("lub_oil_temp", "lub oil temp", 60.0, 100.0, 77.6, 71.3, 89.6),
    Sensor("coolant_temp", "Coolant temp", 50.0, 200.0, 78.4, 61.7, 195.5),
)

# Target column and its header.
TARGET = "engine_condition"
TARGET_HEADER = "Engine Condition"

FEATURES: tuple[str, ...] = tuple(s.name for s in SENSORS)
HEADERS: dict[str, str] = {s.header: s.name for s in SENSORS} | {TARGET_HEADER: TARGET}


class MissingColumnsError(KeyError):
    """A required column is absent; carries what is missing and what is there."""

    def __init__(self, missing: Sequence[str], available: Sequence[str]):
        self.missing = list(missing)
        self.available = list(available)
        super().__init__(f"missing columns {self.missing}, available {self.available}")


def to_canonical(df: DataFrame) -> DataFrame:
    """Rename the file headers to canonical names; other columns pass through."""
    present = set(df.columns)
    return df.withColumnsRenamed({h: n for h, n in HEADERS.items() if h in present})


def to_headers(df: DataFrame) -> DataFrame:
    """The reverse of :func:`to_canonical`, for file export."""
    present = set(df.columns)
    return df.withColumnsRenamed({n: h for h, n in HEADERS.items() if n in present})


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise unless every name is a column of ``df``, matching case exactly.

    Spark resolves names case-insensitively, so this compares the name strings.
    Metadata only; no job runs.
    """
    available = df.columns
    missing = [n for n in names if n not in set(available)]
    if missing:
        raise MissingColumnsError(missing, available)


def header_schema(labelled: bool = True) -> T.StructType:
    """All-text schema in file header names, as a CSV stream has to declare it."""
    names = [s.header for s in SENSORS] + ([TARGET_HEADER] if labelled else [])
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
