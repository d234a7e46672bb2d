from datetime import datetime

import pytest
from conftest import rows

from tastebud import columns as C
from tastebud.operators.cleansing import cast_columns, column_profile, fill_item_from_resource
from tastebud.operators.timewin import Season, bucket_events, parse_event_time, seasonal_future, seasonal_history, seasonal_window


def test_fill_item_from_resource_fans_out(spark):
    base = spark.createDataFrame(
        [("u1", "r1", None), ("u1", "r1", "p9"), ("u2", "r2", None), ("u2", None, None), ("u3", "r3", "")],
        "USER_ID string, RES_ID string, PRODUCT_CODE string",
    )
    rmap = spark.createDataFrame([("r1", "p1"), ("r1", "p2"), ("r3", "p3")], "RES_ID string, PRODUCT_CODE string")
    out = fill_item_from_resource(base, rmap)
    assert out.columns == ["USER_ID", "PRODUCT_CODE"]
    assert rows(out) == sorted([("u1", "p1"), ("u1", "p2"), ("u1", "p9"), ("u1", "p9"), ("u3", "")])


def test_fill_item_dedupe_map_keeps_one_product(spark):
    base = spark.createDataFrame([("u1", "r1", None), ("u1", "r1", "p9")], "USER_ID string, RES_ID string, PRODUCT_CODE string")
    rmap = spark.createDataFrame([("r1", "p2"), ("r1", "p1")], "RES_ID string, PRODUCT_CODE string")
    out = fill_item_from_resource(base, rmap, dedupe_map=True)
    assert rows(out) == [("u1", "p1"), ("u1", "p9")]


def test_column_profile_worked_case(spark):
    df = spark.createDataFrame([("x", "1"), ("x", ""), ("y", None), ("x", "2")], "a string, b string")
    got = {r["cname"]: (r["nonePercent"], r["dispersion"], r["modePercent"]) for r in column_profile(df).collect()}
    assert got == {"a": (0.0, 2, 0.75), "b": (0.5, 2, 0.5)}
    # sorted by nonePercent
    assert [r["cname"] for r in column_profile(df).collect()] == ["a", "b"]


def test_column_profile_all_missing_column(spark):
    df = spark.createDataFrame([(None,), ("",)], "a string")
    [r] = column_profile(df).collect()
    assert (r["nonePercent"], r["dispersion"], r["modePercent"]) == (1.0, 0, 0.0)


def test_cast_columns_bad_values_become_null(spark):
    df = spark.createDataFrame([("1", "2.5"), ("", "x")], "a string, b string")
    out = cast_columns(df, ["a", "b"], "double")
    assert rows(out) == [(1.0, 2.5), (None, None)]


@pytest.mark.parametrize(
    "day, expect",
    [(datetime(2017, 3, 20), (64, 79, 94)), (datetime(2017, 1, 5), (356, 5, 20)), (datetime(2017, 12, 25), (344, 359, 9))],
)
def test_season_numbers(day, expect):
    assert Season.of(day, 1).bounds() == expect


def test_season_rejects_wide_windows():
    with pytest.raises(ValueError):
        Season.of(datetime(2017, 3, 20), 13)


def _times(spark, stamps):
    df = spark.createDataFrame([(s,) for s in stamps], "t string")
    return df.selectExpr("CAST(t AS TIMESTAMP_NTZ) AS event_time")


def test_seasonal_window_every_year_up_to_now(spark):
    season = Season.of(datetime(2017, 3, 20), 1)  # S, N, E = 64, 79, 94
    df = _times(spark, ["2016-03-05", "2016-03-03", "2016-04-04", "2017-03-20", "2017-04-03", "2017-04-04", "2018-03-20"])
    got = sorted(str(r[0].date()) for r in seasonal_window(df, season).collect())
    # 2016 (leap): Mar 3 = day 63 and Apr 4 = day 95 fall outside [64, 94]; 2017: only days < 94
    assert got == ["2016-03-05", "2017-03-20", "2017-04-03"]


def test_seasonal_window_keeps_december_when_end_wraps(spark):
    season = Season.of(datetime(2017, 12, 25), 1)  # 344, 359, 9
    df = _times(spark, ["2017-12-20", "2017-12-30", "2017-01-05", "2016-12-28", "2018-01-02"])
    got = sorted(str(r[0].date()) for r in seasonal_window(df, season).collect())
    assert got == ["2016-12-28", "2017-01-05", "2017-12-20", "2017-12-30"]


def test_history_and_future_slices(spark):
    season = Season.of(datetime(2017, 3, 20), 1)
    df = _times(spark, ["2017-03-05", "2017-03-20", "2017-04-04", "2017-03-04", "2016-03-20"])
    hist = sorted(str(r[0].date()) for r in seasonal_history(df, season).collect())
    fut = sorted(str(r[0].date()) for r in seasonal_future(df, season).collect())
    assert hist == ["2017-03-05", "2017-03-20"]
    assert fut == ["2017-03-20", "2017-04-04"]


def test_future_wraps_into_next_year(spark):
    season = Season.of(datetime(2017, 12, 25), 1)
    df = _times(spark, ["2017-12-26", "2018-01-08", "2018-01-09", "2016-12-26"])
    fut = sorted(str(r[0].date()) for r in seasonal_future(df, season).collect())
    assert fut == ["2017-12-26", "2018-01-08"]


def test_parse_event_time_and_buckets(spark):
    df = spark.createDataFrame([(0,), (86_400_000 * 4 - 1,), (86_400_000 * 4,), (1_490_000_000_123,)], "CREATE_TIME long")
    out = bucket_events(parse_event_time(df), days=4).orderBy(C.CREATE_TIME).collect()
    assert [r["BUCKET"] for r in out] == [0, 0, 1, 1_490_000_000_123 // (86_400_000 * 4)]
    assert out[0][C.DATE] == "1970-01-01 00:00:00"
    assert out[3][C.DATE] == "2017-03-20 08:53:20"


def test_history_half_open_leaves_day_n_to_holdout(spark):
    season = Season.of(datetime(2017, 3, 20), 1)
    df = _times(spark, ["2017-03-05", "2017-03-19", "2017-03-20"])
    hist = sorted(str(r[0].date()) for r in seasonal_history(df, season, half_open=True).collect())
    assert hist == ["2017-03-05", "2017-03-19"]
