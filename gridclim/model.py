"""Data model: frequencies, schemas and the description of an index."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequency codes.
MONTHLY = "MS"
SEASONAL = "QS-DEC"
ANNUAL = "YS"
WEEKLY_MONDAY = "W-MON"
WEEKLY = "W"
DAILY = "D"
ALL_FREQS = (MONTHLY, SEASONAL, ANNUAL, WEEKLY_MONDAY, WEEKLY, DAILY)
STANDARD_FREQS = (MONTHLY, SEASONAL, ANNUAL)

RINGS = "array<array<struct<x:double,y:double>>>"
REGIONS_SCHEMA = f"region_set string, region string, name string, country string, rings {RINGS}"

_COMPARE = {
    "gt": Column.__gt__,
    "ge": Column.__ge__,
    "lt": Column.__lt__,
    "le": Column.__le__,
}


def compare(left: Column, op: str, right: Any) -> Column:
    """``left op right`` with SQL null logic."""
    if op not in _COMPARE:
        raise ValueError(f"unknown comparison {op!r}, expected one of {sorted(_COMPARE)}")
    return _COMPARE[op](left, right if isinstance(right, Column) else F.lit(right))


@dataclass(frozen=True)
class Threshold:
    """A constant comparison. Missing values are no event."""

    value: float
    op: str = "ge"

    def holds(self, value: Column) -> Column:
        return F.coalesce(compare(value, self.op, float(self.value)), F.lit(False))


@dataclass(frozen=True)
class YearSpan:
    """Calendar years, inclusive. ``strict`` requires both ends."""

    first: int | None = None
    last: int | None = None
    strict: bool = False

    def contains(self, time: Column) -> Column:
        if self.strict and (self.first is None or self.last is None):
            raise ValueError("a strict year span needs both the first and the last year")
        cond = F.lit(True)
        if self.first is not None:
            cond = cond & (time >= F.make_date(F.lit(self.first), F.lit(1), F.lit(1)))
        if self.last is not None:
            cond = cond & (time < F.make_date(F.lit(self.last + 1), F.lit(1), F.lit(1)))
        return cond


@dataclass(frozen=True)
class SeasonWindow:
    """Part of the year between two (month, day) limits.

    Without ``wrap`` the limits never cross the year end: whole months count only
    strictly between the two limit months. With ``wrap`` a start after the end
    means "until the year end and from its beginning".
    """

    start: tuple[int, int]
    end: tuple[int, int]
    wrap: bool = False

    def contains(self, time: Column) -> Column:
        (m1, d1), (m2, d2) = self.start, self.end
        if self.wrap:
            key = F.month(time) * 100 + F.dayofmonth(time)
            lo, hi = m1 * 100 + d1, m2 * 100 + d2
            return key.between(lo, hi) if lo <= hi else (key >= lo) | (key <= hi)
        month, day = F.month(time), F.dayofmonth(time)
        opening = (month == m1) & (day >= d1)
        closing = (month == m2) & (day <= d2)
        return opening | closing | ((month > m1) & (month < m2))


@dataclass(frozen=True)
class PercentileSpec:
    """Reference percentile: ``doy`` (moving day window) or ``regular`` (per period)."""

    value: float
    kind: str = "regular"
    op: str = "gt"
    span: YearSpan = YearSpan()
    window: int = 6
    mask: Threshold | None = None


@dataclass(frozen=True)
class IndexContext:
    """What a hook may need besides its input."""

    variable: str
    freq: str
    options: Mapping[str, Any]
    history: DataFrame | None = None
    percentile: DataFrame | None = None


# What a direct hook receives.
NEEDS_INPUT = "single_dataset"
NEEDS_HISTORY = "historical"
NEEDS_PERCENTILE = "percentile"


@dataclass(frozen=True)
class IndexDef:
    """An index: either a direct hook, or threshold/percentile test plus reducer."""

    name: str
    title: str
    units: str
    inputs: tuple[str, ...]
    direct: Callable[[DataFrame, IndexContext], DataFrame] | None = None
    needs: str = NEEDS_HISTORY
    options: Mapping[str, Any] = field(default_factory=dict)
    percentile: PercentileSpec | None = None
    season: SeasonWindow | None = None
    threshold: Threshold | None = None
    reducer: Callable[[Column], Column] | None = None
    freqs: tuple[str, ...] = STANDARD_FREQS  # what is computed unless asked otherwise
    more_freqs: tuple[str, ...] = ()  # further ones on request

    @property
    def variable(self) -> str:
        return self.inputs[0]

    @property
    def multivariable(self) -> bool:
        return len(self.inputs) > 1

    def variant(self, **changes: Any) -> "IndexDef":
        """A copy with some fields replaced."""
        return dataclasses.replace(self, **changes)


@dataclass(frozen=True)
class IndexConfig:
    """An index offered to users."""

    index: IndexDef
    description: str
    freqs: tuple[str, ...] = STANDARD_FREQS
    extra: Mapping[str, Any] = field(default_factory=dict)

    def __str__(self) -> str:
        return f"{self.description} at {', '.join(self.freqs)}"


def require_columns(df: DataFrame, names: tuple[str, ...] | list[str]) -> None:
    """Fail when the plan is built, not when it runs."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise KeyError(f"missing columns {absent}; available: {df.columns}")
