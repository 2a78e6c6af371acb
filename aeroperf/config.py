"""What a computation needs to know about columns and limits, as frozen records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class KpiSpec:
    """A percentile-reference KPI: a duration, its validity gate, and the reference it is held against."""

    key: tuple[str, ...]
    duration: str
    day: str
    cap: float | None = None
    cap_by: tuple[str, dict] | None = None  # (column, caps of its values)
    p: float = 0.20
    min_n: int = 5
    window_col: str | None = None
    window: tuple[str, str] | None = None  # both ends belong to it
    supplied: tuple[str, ...] = ()


@dataclass(frozen=True)
class MergeSpec:
    """Partial records of one event: grouped by ``key``, chained in time, merged without loss."""

    key: tuple[str, ...]
    start: str
    end: str
    order: tuple[str, ...]  # makes every order total; ends in a unique column
    gap_min: float = 60.0
    union_cols: tuple[str, ...] = ()
    filled_cols: tuple[str, ...] = ()
    identity: str | None = None  # its values are listed in merged_ids
    prefer_filled: str | None = None  # records that have it are first in the merge order
    null_key: str = "exclude"
    split_by: str | None = None  # "day", "month": cut keys that hold too many rows for one task


@dataclass(frozen=True)
class MatchSpec:
    """Nearest-in-time matching of two sides."""

    key: tuple[str, ...]
    left_id: str
    right_id: str
    left_time: str
    right_time: str
    tolerance_min: float
    shift_min: float = 0.0
    null_key: str = "exclude"
    split_by: str | None = None  # as above


#: Study parameters.
REFERENCE_YEAR, MIN_SAMPLE, REFERENCE_P = 2024, 5, 0.20
TAXI_CAP_MIN, RING_CAPS_MIN = 120.0, {"C40": 180.0, "C100": 180.0}
TAXI_KEY = ("ICAO", "PHASE", "STND", "RWY")
RING_KEY = ("ICAO", "PHASE", "RANGE", "CLASS", "RWY", "SECTOR_GROUP")
GAP_MIN, NEAR_MIN, PLAN_TOLERANCE_MIN, SHIFT_MIN = 60.0, 10.0, 180.0, -10.0
SENTINEL_BEFORE = "1980-01-01 00:00:00"


@dataclass(frozen=True)
class ObservedSteps:
    """A result, and the row counts of the steps that led to it."""

    frame: object
    _steps: Callable[[], dict[str, int]]

    @property
    def steps(self) -> dict[str, int]:
        """Known once an action on ``frame`` has run over all of it; waits for that. A stage that runs again after a lost executor may be counted twice."""
        return self._steps()
