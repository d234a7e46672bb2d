"""Seasonal slices vs a plain-Python statement of the rules, over random dates."""

from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tastebud.operators.timewin import Season, season_ranges, seasonal_future, seasonal_history, seasonal_window


def _doy(d: date) -> int:
    return d.timetuple().tm_yday


def _window(d: date, s: Season) -> bool:
    y, (a, n, e) = s.year, s.bounds()
    day = _doy(d)
    inside = a <= day <= e if a < e else (day > a or day < e)
    ok = d.year <= y and inside
    if n < e:
        ok = ok and (d.year != y or day < e)
    return ok


def _history(d: date, s: Season) -> bool:
    y, (a, n, _) = s.year, s.bounds()
    day = _doy(d)
    return (d.year == y and a <= day <= n) if a < n else ((d.year == y - 1 and day > a) or (d.year == y and day < n))


def _future(d: date, s: Season) -> bool:
    y, (_, n, e) = s.year, s.bounds()
    day = _doy(d)
    return (d.year == y and n <= day <= e) if n < e else ((d.year == y and day > n) or (d.year == y + 1 and day < e))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    end=st.dates(min_value=date(2015, 1, 1), max_value=date(2018, 12, 31)),
    months=st.integers(min_value=1, max_value=12),
)
def test_slices_match_the_rules(spark, end, months):
    season = Season.of(datetime(end.year, end.month, end.day), months)
    days = [end + timedelta(days=k) for k in range(-800, 400, 3)]
    df = spark.createDataFrame([(d.isoformat(),) for d in days], "t string").selectExpr("CAST(t AS TIMESTAMP_NTZ) AS event_time")
    for op, rule in ((seasonal_window, _window), (seasonal_history, _history), (seasonal_future, _future)):
        got = sorted(r[0].date() for r in op(df, season).collect())
        assert got == [d for d in days if rule(d, season)], (op.__name__, end, months)


@settings(max_examples=150, deadline=None)
@given(
    end=st.dates(min_value=date(2015, 1, 1), max_value=date(2018, 12, 31)),
    months=st.integers(min_value=1, max_value=12),
    later=st.booleans(),
)
def test_ranges_are_the_window_day_by_day(end, months, later):
    season = Season.of(datetime(end.year, end.month, end.day), months)
    cap = season.year + later
    ranges = season_ranges(season, year_cap=cap, years=6)
    assert all(a < b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    for k in range((date(cap + 2, 1, 1) - date(cap - 5, 1, 1)).days):
        d = date(cap - 5, 1, 1) + timedelta(days=k)
        y, (a, n, e) = season.year, season.bounds()
        day = _doy(d)
        want = d.year <= cap and (a <= day <= e if a < e else (day > a or day < e)) and not (n < e and d.year == y and day >= e)
        t = datetime(d.year, d.month, d.day, 13)
        assert want == any(x <= t < z for x, z in ranges), (d, season)


def test_older_rows_go_by_day_and_ranges_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # the plan's filters in full
    for end in (datetime(2018, 6, 15), datetime(2018, 1, 5), datetime(2018, 12, 27)):  # no wrap, and both wraps
        season = Season.of(end, 1)
        days = [end + timedelta(days=k) for k in range(-3000, 500)]
        path = str(tmp_path / f"{end:%Y%m%d}")
        spark.createDataFrame([(d.isoformat(),) for d in days], "t string").selectExpr("CAST(t AS TIMESTAMP_NTZ) AS event_time").write.parquet(path)
        want = sorted(d for d in days if _window(d.date(), season))
        for years in (1, 3, 30):
            df = seasonal_window(spark.read.parquet(path), season, years=years)
            assert sorted(r[0] for r in df.collect()) == want
            pushed = df._jdf.queryExecution().executedPlan().toString()
            pushed = pushed[pushed.index("PushedFilters") :]
            # one lower bound a range; touching ranges are one
            assert pushed.count("GreaterThanOrEqual(event_time") == len(season_ranges(season, years=years)), pushed
    spark.conf.unset("spark.sql.maxMetadataStringLength")
