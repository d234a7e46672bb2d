"""Event time parsing and the seasonal ("same season every year") split.

Season parameters from ``end_time`` and ``months = n`` (half width h = 15 n
days): S = day of year of end_time - h, N = day of year of end_time,
E = day of year of end_time + h, Y = year of end_time.  All day arithmetic is
on TIMESTAMP_NTZ wall-clock values in UTC.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import day_number, epoch_ms_to_time, format_datetime


def parse_event_time(df: DataFrame, *, time_col: str = C.CREATE_TIME, out: str = C.EVENT_TIME, text: str | None = C.DATE) -> DataFrame:
    """Epoch-ms column -> typed ``event_time`` (and the reference's DATE text)."""
    df = df.withColumn(out, epoch_ms_to_time(time_col))
    if text is not None:
        df = df.withColumn(text, format_datetime(out))
    return df


@dataclass(frozen=True)
class Season:
    year: int
    start: int  # S
    now: int  # N
    end: int  # E
    end_time: datetime
    half_width: timedelta

    @staticmethod
    def of(end_time: datetime, months: int = 1) -> "Season":
        if not 1 <= months <= 12:
            raise ValueError("months must be between 1 and 12: a wider window is more than a year")
        h = timedelta(days=15 * months)
        doy = lambda t: t.timetuple().tm_yday
        return Season(end_time.year, doy(end_time - h), doy(end_time), doy(end_time + h), end_time, h)

    def bounds(self) -> tuple[int, int, int]:
        return self.start, self.now, self.end


def _year(ts: str) -> Column:
    return F.year(F.col(ts))


def _day(ts: str) -> Column:
    return F.dayofyear(F.col(ts))


def _ntz(t: datetime) -> Column:
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def epoch_ms(t: datetime) -> int:
    """Epoch milliseconds of a wall-clock time in UTC."""
    return (t - datetime(1970, 1, 1)) // timedelta(milliseconds=1)


def _between(ts: str, first: datetime, last: datetime) -> Column:
    """Time range of whole days, as a plain predicate on the column that a scan can use."""
    return (F.col(ts) >= _ntz(first)) & (F.col(ts) < _ntz(last))


def _day_start(year: int, day: int) -> datetime:
    return datetime(year, 1, 1) + timedelta(days=day - 1)


def seasonal_window_predicate(season: Season, *, ts: str = C.EVENT_TIME, year_cap: int | None = None) -> Column:
    """Rows of every year inside [S, E] day-of-year, up to the current season's end."""
    y, (s, n, e) = season.year, season.bounds()
    cap = y if year_cap is None else year_cap
    day, year = _day(ts), _year(ts)
    inside = day.between(s, e) if s < e else (day > s) | (day < e)
    pred = (year <= cap) & inside
    if n < e:
        # Current year: nothing at or after day E.  When E wraps past the year
        # end (N > E) this clause would drop the current December, so it is
        # only applied without a wrap.
        pred = pred & ((year != y) | (day < e))
    return pred


#: The window is spelled out as time ranges for this many years; older rows go by their day of the year.
RANGE_YEARS = 30


def season_ranges(season: Season, *, year_cap: int | None = None, years: int = RANGE_YEARS) -> list[tuple[datetime, datetime]]:
    """The seasonal window of the last ``years`` years up to the cap as time ranges [from, to), in order; ranges that touch are one."""
    y, (s, n, e) = season.year, season.bounds()
    cap = y if year_cap is None else year_cap
    ranges: list[tuple[datetime, datetime]] = []
    for year in range(cap - years + 1, cap + 1):
        start, after = datetime(year, 1, 1), datetime(year + 1, 1, 1)
        current = year == y and n < e  # nothing at or after day E of the current year
        if s < e:
            parts = [(_day_start(year, s), _day_start(year, e if current else e + 1))]
        else:
            parts = [(start, _day_start(year, e))] + ([] if current else [(_day_start(year, s + 1), after)])
        for first, last in parts:
            first, last = max(first, start), min(last, after)
            if first < last:
                if ranges and ranges[-1][1] == first:
                    first = ranges.pop()[0]
                ranges.append((first, last))
    return ranges


def seasonal_window(df: DataFrame, season: Season, *, ts: str = C.EVENT_TIME, year_cap: int | None = None, years: int = RANGE_YEARS) -> DataFrame:
    """Seasonal window (D1): [S, E] of every year, as one plain time range a year.

    The ranges reach the scan as predicates on the raw time column, so row
    groups and files between the seasons are skipped.  Rows older than
    ``years`` years, if any, are held against their day of the year.
    """
    cap = season.year if year_cap is None else year_cap
    floor = datetime(cap - years + 1, 1, 1)
    inside = F.col(ts) < _ntz(floor)
    for first, last in season_ranges(season, year_cap=year_cap, years=years):
        inside = inside | _between(ts, first, last)
    return df.filter(inside & ((F.col(ts) >= _ntz(floor)) | seasonal_window_predicate(season, ts=ts, year_cap=year_cap)))


def seasonal_history(df: DataFrame, season: Season, *, ts: str = C.EVENT_TIME, half_open: bool = False) -> DataFrame:
    """Recent history slice (D2): [S, N] of year Y, or across the year start.

    ``half_open`` leaves day N to the hold-out: [S, N).
    """
    y, (s, n, _) = season.year, season.bounds()
    day, year = _day(ts), _year(ts)
    if s < n:
        pred = (year == y) & day.between(s, n - 1 if half_open else n)
        span = _between(ts, _day_start(y, s), _day_start(y, n + 1))
    else:
        pred = ((year == y - 1) & (day > s)) | ((year == y) & (day < n))
        span = _between(ts, _day_start(y - 1, s), _day_start(y, n))
    return df.filter(span & pred)


def seasonal_future(df: DataFrame, season: Season, *, ts: str = C.EVENT_TIME) -> DataFrame:
    """Hold-out slice (D3): [N, E] of year Y, or across the year end into Y + 1."""
    y, (_, n, e) = season.year, season.bounds()
    day, year = _day(ts), _year(ts)
    if n < e:
        pred = (year == y) & day.between(n, e)
        span = _between(ts, _day_start(y, n), _day_start(y, e + 1))
    else:
        pred = ((year == y) & (day > n)) | ((year == y + 1) & (day < e))
        span = _between(ts, _day_start(y, n), _day_start(y + 1, e))
    return df.filter(span & pred)


def holdout_year_cap(season: Season) -> int:
    """The hold-out may reach into Y + 1 when E wraps; training never does."""
    return season.year + 1 if season.end < season.now else season.year


def bucket_events(df: DataFrame, *, days: int = 4, ts: str = C.EVENT_TIME, out: str = "BUCKET") -> DataFrame:
    """Fixed epoch-anchored tumbling bucket: floor(epoch ms / (days * 86400000))."""
    return df.withColumn(out, F.floor(day_number(ts) / F.lit(days)).cast("long"))
