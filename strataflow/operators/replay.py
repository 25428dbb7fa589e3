"""Replay clock: real time mapped to days of a field's past, in exact fractions.

Plain driver-side arithmetic, as it decides which days to load, not what is in them.
"""

from __future__ import annotations

import calendar
import math
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from fractions import Fraction

#: Months of the field's life. Fixed values.
FIELD_START = date(2008, 6, 1)
FIELD_END = date(2016, 9, 30)


class NotStarted(ValueError):
    """An instant before the epoch."""


class Exhausted(ValueError):
    """An instant after the last field month."""


def parse_epoch(text: str) -> datetime:
    """An ISO instant; without a zone it is UTC."""
    at = datetime.fromisoformat(text)
    return at if at.tzinfo else at.replace(tzinfo=UTC)


@dataclass(frozen=True)
class ReplayClock:
    """``speed`` field months pass in a real day from ``epoch`` on."""

    epoch: datetime
    speed: Fraction = Fraction(1)
    start: date = FIELD_START
    end: date = FIELD_END

    def __post_init__(self):
        if self.epoch.tzinfo is None:
            raise ValueError("the epoch needs a time zone")
        object.__setattr__(self, "speed", Fraction(self.speed))
        if self.speed <= 0:
            raise ValueError("the speed must be above zero")

    @property
    def months(self) -> int:
        return (self.end.year - self.start.year) * 12 + self.end.month - self.start.month + 1

    def _passed(self, at: datetime) -> Fraction:
        at = at if at.tzinfo else at.replace(tzinfo=UTC)
        return Fraction((at - self.epoch) // timedelta(microseconds=1), 86_400_000_000) * self.speed

    def _month(self, index: int) -> tuple[int, int, int]:
        year, month = divmod(self.start.year * 12 + self.start.month - 1 + index, 12)
        return year, month + 1, calendar.monthrange(year, month + 1)[1]

    def replay_date(self, at: datetime) -> date:
        passed = self._passed(at)
        if passed < 0:
            raise NotStarted(f"{at} lies before the epoch {self.epoch}")
        index = math.floor(passed)
        if index >= self.months:
            raise Exhausted(f"{at} lies after the last field month")
        year, month, days = self._month(index)
        return date(year, month, 1 + math.floor((passed - index) * days))

    def replay_window(self, begin: datetime, end: datetime) -> tuple[date, date]:
        """First and last field day of a real interval whose end is not part of it."""
        return self.replay_date(begin), self.replay_date(max(begin, end - timedelta(microseconds=1)))

    def is_exhausted(self, at: datetime) -> bool:
        return self._passed(at) >= self.months

    def real_instant_for(self, day: date) -> datetime:
        """First microsecond at which ``replay_date`` gives ``day``."""
        if not self.start <= day <= self.end:
            raise ValueError(f"{day} is not a field day")
        index = (day.year - self.start.year) * 12 + day.month - self.start.month
        passed = index + Fraction(day.day - 1, self._month(index)[2])
        return self.epoch + timedelta(microseconds=math.ceil(passed * 86_400_000_000 / self.speed))
