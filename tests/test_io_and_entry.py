import os
import tempfile

import pytest
from conftest import rows

import __spark_entry__ as entry
from pyspark.sql import types as T

from tastebud import columns as C
from tastebud.operators.compare import find_user, model_history
from tastebud.plans.compare_run import run_compare
from tastebud.sinks import run_folder, write_avro, write_partitioned, write_product
from tastebud.registry import QUERIES
from tastebud.session import cut_lineage, drop_scratch, ensure_checkpoint_dir
from tastebud.sources import latest_snapshot, read_results, scan_log

SF = "/root/testdata/sf0.001"


def test_delimited_round_trip_and_layout(spark):
    root = tempfile.mkdtemp(prefix="tastebud-test-")
    df = spark.createDataFrame([("u1", "p1", 1), ("u1", "p2", 2)], "USER_ID string, PRODUCT_CODE string, RANK int")
    path = write_product(df, root, model="CosSim", sub_type=None, product="User-recommendations", op_time="2017032000")
    assert path == os.path.join(root, "CosSim", "2017-03-20-00", "User-recommendations")
    back = read_results(spark, path, [C.USER_ID, C.PRODUCT_CODE, C.RANK], types={C.RANK: "int"})
    assert rows(back) == [("u1", "p1", 1), ("u1", "p2", 2)]
    lines = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            with open(os.path.join(path, f)) as fh:
                lines += [ln.strip() for ln in fh if ln.strip()]
    assert sorted(lines) == ["u1#p1#1#2017032000", "u1#p2#2#2017032000"]  # run stamp appended


def test_partitioned_products_overwrite_one_run(spark):
    root = tempfile.mkdtemp(prefix="tastebud-test-")
    path = os.path.join(root, "recs")
    a = spark.createDataFrame([("u1", "p1")], "USER_ID string, PRODUCT_CODE string")
    write_partitioned(a, path, model="ALS", sub_type="x", op_time="2017032000")
    write_partitioned(a, path, model="ALS", sub_type="x", op_time="2017032100")
    write_partitioned(a.limit(0).union(spark.createDataFrame([("u2", "p2")], a.schema)), path, model="ALS", sub_type="x", op_time="2017032000")
    got = rows(spark.read.parquet(path).selectExpr("USER_ID", "CAST(op_time AS STRING) AS op_time"))
    assert got == [("u1", "2017032100"), ("u2", "2017032000")]


def test_avro_never_becomes_another_format(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tastebud-test-"), "avro")
    try:
        write_avro(spark.createDataFrame([("a",)], "x string"), path)
    except Exception as e:  # the data source is not deployed here
        assert "avro" in str(e).lower() and not os.path.exists(path)
    else:
        assert spark.read.format("avro").load(path).count() == 1


def test_scan_log_checks_its_columns(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tastebud-test-"), "log")
    spark.createDataFrame([("u", 5)], "USER_ID string, CREATE_TIME int").write.parquet(path)
    good = T.StructType([T.StructField("USER_ID", T.StringType()), T.StructField("CREATE_TIME", T.IntegerType())])
    assert scan_log(spark, path, schema=good).count() == 1
    for name, kind in (("PRODUCT_CODE", T.StringType()), ("CREATE_TIME", T.LongType())):
        with pytest.raises(ValueError, match=name):
            scan_log(spark, path, schema=T.StructType([*good.fields[:1], T.StructField(name, kind)]))


def test_shared_folder_is_required_off_a_local_master():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_scratch_tables_can_be_dropped(spark):
    t = cut_lineage(spark.range(5))
    assert t.count() == 5 and drop_scratch(spark) >= 1
    assert not os.path.exists(t.inputFiles()[0].removeprefix("file://")) if t.inputFiles() else True


def test_history_logs_hold_date_text_and_no_stamp(spark):
    root = tempfile.mkdtemp(prefix="tastebud-test-")
    df = spark.createDataFrame([("u1", "p1", "2000-06-14 00:00:00")], "USER_ID string, PRODUCT_CODE string, DATE string")
    path = write_product(df, root, model="AR", sub_type="TimeWindow", product="User-history-logs", op_time="2000061500")
    assert spark.read.text(path).first()[0] == "u1#p1#2000-06-14 00:00:00"


def test_scan_and_latest_snapshot(spark):
    ev = scan_log(spark, f"{SF}/events.parquet", time_col="ts", since="2024-01-02 00:00:00", until="2024-01-03 00:00:00")
    assert ev.count() > 0
    assert ev.filter("ts < TIMESTAMP_NTZ'2024-01-02 00:00:00' OR ts >= TIMESTAMP_NTZ'2024-01-03 00:00:00'").count() == 0
    snap = spark.createDataFrame([("a", "2017-03-19"), ("b", "2017-03-20"), ("c", "2017-03-20"), ("d", "2017-03-21")], "k string, day string")
    assert rows(latest_snapshot(snap, snapshot_col="day", as_of="2017-03-20"), "k") == [("b",), ("c",)]


def test_find_user_by_id_name_or_account(spark):
    users = spark.createDataFrame([("1", "Ann"), ("2", "Bo")], "PERSON_ID string, NAME string")
    accounts = spark.createDataFrame([("1", "acct-1"), ("2", "acct-2"), ("2", "acct-2")], "PERSON_ID string, ACCOUNT string")
    for q in ("2", "Bo", "acct-2"):
        assert rows(find_user(users, accounts, q), C.USER_ID, C.ACCOUNT, C.NAME) == [("2", "acct-2", "Bo")]
    with pytest.raises(ValueError):
        model_history("Unknown")


def test_compare_run_reads_saved_products(spark):
    root = tempfile.mkdtemp(prefix="tastebud-test-")
    recs = spark.createDataFrame([("1", "p1", 1), ("2", "p2", 1)], "USER_ID string, PRODUCT_CODE string, RANK int")
    hist = spark.createDataFrame([("1", "p2")], "USER_ID string, PRODUCT_CODE string")
    for name, df in (("User-recommendations", recs), ("User-history-logs", hist)):
        write_product(df, root, model="Association", sub_type="Time_Window", product=name, op_time="2017032000")
    users = spark.createDataFrame([("1", "Ann"), ("2", "Bo")], "PERSON_ID string, NAME string")
    accounts = spark.createDataFrame([("1", "acct-1"), ("2", "acct-2")], "PERSON_ID string, ACCOUNT string")
    items = spark.createDataFrame([("p1", "one"), ("p2", "two")], "PRODUCT_CODE string, PRODUCT_NAME string")
    out = run_compare(
        run_folder(root, "Association", "Time_Window", "2017032000"), model="Association", user="Ann",
        users=users, accounts=accounts, items=items, save_to=os.path.join(root, "Comparison"),
    )
    assert rows(out["User-recommendations"], C.USER_ID, C.PRODUCT_NAME) == [("1", "one")]
    assert rows(out["User-historys"], C.USER_ID, C.PRODUCT_NAME) == [("1", "two")]
    assert os.path.isdir(os.path.join(root, "Comparison", "User-historys"))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [C.USER_ID, C.PRODUCT_CODE, C.PREDICTION, C.RANK]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    assert not any(name.startswith("op") and name[2:3].isdigit() for name in QUERIES)


def test_libsvm_and_text_sinks(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T

    from tastebud.sinks import write_libsvm, write_text

    root = tempfile.mkdtemp(prefix="tastebud-test-")
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    df = spark.createDataFrame([(1.0, Vectors.sparse(4, [0, 3], [2.0, 5.0]))], schema)
    write_libsvm(df, os.path.join(root, "svm"))
    back = spark.read.format("libsvm").option("numFeatures", 4).load(os.path.join(root, "svm")).collect()
    assert back[0]["label"] == 1.0 and back[0]["features"].toArray().tolist() == [2.0, 0.0, 0.0, 5.0]
    write_text(spark.createDataFrame([("a : 1",)], "v string"), os.path.join(root, "txt"))
    assert [r.value for r in spark.read.text(os.path.join(root, "txt")).collect()] == ["a : 1"]


def test_scan_log_prunes_date_partitions(spark):
    from pyspark.sql import functions as F

    root = tempfile.mkdtemp(prefix="tastebud-test-")
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("day", F.to_date("ts"))
    ev.write.partitionBy("day").parquet(os.path.join(root, "events"))
    df = scan_log(spark, os.path.join(root, "events"), partition_filter=F.col("day") == F.lit("2024-01-03").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert df.count() == ev.filter(F.col("day") == F.lit("2024-01-03").cast("date")).count() > 0


def test_rules_run_refuses_empty_slices(spark):
    from datetime import datetime

    from tastebud.plans.params import RulesParams
    from tastebud.plans.rules_run import run_rules
    from tastebud.sources import bindings as B

    log = B.shopping_log(spark, SF)
    with pytest.raises(ValueError, match="empty"):
        run_rules([log], RulesParams(end_time=datetime(1990, 6, 15), min_support=0.02, min_confidence=0.15))


def test_raw_log_contract_scan_parse_and_rate(spark):
    """Reference-style raw logs: text files, epoch-ms times, scores as text, read with the declared schema."""
    from tastebud.columns import SCORE_LOG_SCHEMA
    from tastebud.operators.ratings import avg_ratings
    from tastebud.operators.timewin import parse_event_time

    root = tempfile.mkdtemp(prefix="tastebud-test-")
    path = os.path.join(root, "score")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write("u1,r1,p1,4,1490000000123\nu1,r1,p1,2,1490000001000\nu2,r2,,x,1490000002000\n")
    raw = scan_log(spark, path, fmt="csv", schema=SCORE_LOG_SCHEMA)
    parsed = parse_event_time(raw, time_col=C.SCORE_TIME)
    assert [r[C.DATE] for r in parsed.orderBy(C.SCORE_TIME).collect()][0] == "2017-03-20 08:53:20"
    assert rows(avg_ratings(raw)) == [("u1", "p1", 3.0)]


def test_write_all_products_of_two_runs(spark):
    from datetime import datetime

    from tastebud.operators.ratings import avg_ratings
    from tastebud.plans.cosine_run import run_cosine
    from tastebud.plans.params import CosineParams, RulesParams
    from tastebud.plans.rules_run import run_rules
    from tastebud.sinks import write_products
    from tastebud.sources import bindings as B

    root = tempfile.mkdtemp(prefix="tastebud-test-")
    rules = run_rules([B.shopping_log(spark, SF)], RulesParams(end_time=datetime(2000, 6, 15), min_support=0.02, min_confidence=0.15))
    cos = run_cosine(avg_ratings(B.purchase_log(spark, SF)), CosineParams())
    paths = write_products(rules, root, model="Association", sub_type="Time_Window", op_time="2000061500")
    paths.update(write_products(cos, root, model="CosSim", sub_type=None, op_time="2000061500"))
    for name, path in paths.items():
        assert os.path.isdir(path) and any(f.startswith("part-") for f in os.listdir(path)), name
    metrics = read_results(spark, paths["Recommendation-metrics"], [C.METRIC, C.VALUE]).collect()
    assert [r[C.METRIC] for r in metrics][:2] == ["OP_TIME", "ARGUMENTS"]
    assert os.path.isdir(os.path.join(root, "Association", "Time_Window", "2000-06-15-00", "User-frequent-priors"))


def test_write_all_products_of_model_runs(spark):
    from tastebud.operators.ratings import avg_ratings
    from tastebud.plans.als_run import run_als
    from tastebud.plans.params import AlsParams, SegmentParams
    from tastebud.plans.segments_run import run_clusters
    from tastebud.sinks import write_products
    from tastebud.sources import bindings as B

    root = tempfile.mkdtemp(prefix="tastebud-test-")
    ratings = avg_ratings(B.event_score_log(spark, SF, ("purchase", "view")))
    als = run_als(ratings, AlsParams(rank=4, reg=0.1, max_iter=3, blocks=2))
    seg = run_clusters(ratings, SegmentParams(k=3, max_iter=5))
    paths = write_products(als, root, model="ALS", sub_type=None, op_time="2000061500")
    paths.update({f"c-{k}": v for k, v in write_products(seg, root, model="Cluster", sub_type=None, op_time="2000061500").items()})
    for name, path in paths.items():
        assert os.path.isdir(path) and any(f.startswith("part-") for f in os.listdir(path)), name
    factors = read_results(spark, paths["User-factors"], [C.USER_ID, "factors", C.OP_TIME]).collect()
    assert factors and all(len(r["factors"].split(",")) == 4 and r[C.OP_TIME] == "2000061500" for r in factors)
