"""Snapshots by layout, runs published as a whole, texts through the delimited format."""

import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tastebud.sinks import write_delimited
from tastebud.sinks.publish import committed_runs, publish_run, read_published
from tastebud.sources import newest_complete, read_newest, read_results, write_snapshot


def test_the_newest_complete_snapshot_is_read_and_no_other(spark, tmp_path):
    root = str(tmp_path)
    for day, hour in (("2017-03-19", "23"), ("2017-03-20", "4"), ("2017-03-20", "11"), ("2017-03-21", "0")):
        write_snapshot(spark.range(3).select("id", F.lit(f"{day} {hour}").alias("of")), root, {"DAY": day, "HOUR": hour})
    keys = ["DAY", "HOUR"]
    assert newest_complete(spark, root, keys).endswith("DAY=2017-03-21/HOUR=0")
    assert newest_complete(spark, root, keys, as_of=["2017-03-20"]).endswith("DAY=2017-03-20/HOUR=11")  # 11 after 4: numbers
    assert newest_complete(spark, root, keys, as_of=["2017-03-20", "10"]).endswith("HOUR=4")
    assert newest_complete(spark, root, keys, as_of=["2017-03-20", "3"]).endswith("DAY=2017-03-19/HOUR=23")
    assert newest_complete(spark, root, keys, as_of=["2017-03-18"]) is None
    os.remove(tmp_path / "DAY=2017-03-21" / "HOUR=0" / "_SUCCESS")  # half written
    df = read_newest(spark, root, keys)
    assert {(r["of"], str(r.DAY), r.HOUR) for r in df.collect()} == {("2017-03-20 11", "2017-03-20", 11)}
    assert all("DAY=2017-03-20/HOUR=11" in f for f in df.inputFiles())
    # a write that fails leaves no marker, whatever files it got to
    with pytest.raises(Exception):
        write_snapshot(spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id"), F.lit("").alias("of")), root, {"DAY": "2017-03-22", "HOUR": "1"})
    assert read_newest(spark, root, keys).count() == 3
    with pytest.raises(FileNotFoundError):
        read_newest(spark, str(tmp_path / "none"), keys)


def test_a_run_that_fails_midway_leaves_the_former_run(spark, tmp_path):
    root, at = str(tmp_path), {"model": "CosSim", "sub_type": None}
    frame = lambda v: spark.createDataFrame([(1, v)], "USER_ID int, PRODUCT_CODE string")
    publish_run({"a": frame("old"), "b": frame("old")}, root, op_time="2017032000", **at)
    broken = frame("new").withColumn("PRODUCT_CODE", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        publish_run({"a": frame("new"), "b": broken}, root, op_time="2017032100", **at)
    for name in ("a", "b"):  # neither product is of the failed run
        assert [r.PRODUCT_CODE for r in read_published(spark, root, name, **at).collect()] == ["old"]
    publish_run({"a": frame("new"), "b": frame("new")}, root, op_time="2017032100", **at)
    publish_run({"a": frame("newer"), "b": frame("newer")}, root, op_time="2017032100", **at)  # a rerun
    assert [r.PRODUCT_CODE for r in read_published(spark, root, "b", **at).collect()] == ["newer"]
    assert [r.PRODUCT_CODE for r in read_published(spark, root, "b", op_time="2017032000", **at).collect()] == ["old"]
    assert len(committed_runs(spark, root, **at)) == 3
    with pytest.raises(KeyError):
        read_published(spark, root, "c", **at)
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, "a", model="ALS", sub_type=None)


TEXTS = st.one_of(st.none(), st.text(alphabet="a#,%\"\\\n\r 0F25é'|", max_size=8))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXTS, st.one_of(st.none(), st.lists(TEXTS, max_size=4)), st.sampled_from(["#", "|"])), min_size=1, max_size=12))
def test_any_text_comes_back_as_it_was(spark, tmp_path, data):
    sep = data[0][2]
    rows = [(k, t, a) for k, (t, a, _) in enumerate(data)]
    path = str(tmp_path / f"t{random.random()}")
    write_delimited(spark.createDataFrame(rows, "k int, t string, a array<string>").coalesce(1), path, sep=sep)
    back = read_results(spark, path, ["k", "t", "a"], sep=sep, types={"k": "int", "a": "array<string>"})
    assert sorted((r.k, r.t, r.a) for r in back.collect()) == rows
