"""Properties of the plans that matter on large, skewed tables."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from offhours import session
from offhours.operators.merge import keep_one, new_only
from offhours.operators.ranking import counted_order
from offhours.plans.gold import stress_index
from offhours.schemas import SILVER_CANDLES, SILVER_EVENTS
from offhours.sources import lake


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_index_reads_the_events_once_and_joins_by_key(spark, tmp_path, without_broadcast):
    t = dt.datetime(2024, 1, 2, 10)
    spark.createDataFrame([(t, 1.0, 1.0, 1.0, 1.0, 1, 0.0, None)], SILVER_CANDLES).write.parquet(
        str(tmp_path / "c")
    )
    spark.createDataFrame([], SILVER_EVENTS).write.parquet(str(tmp_path / "e"))
    candles = spark.read.schema(SILVER_CANDLES).parquet(str(tmp_path / "c"))
    events = spark.read.schema(SILVER_EVENTS).parquet(str(tmp_path / "e"))
    plan = plan_of(stress_index(candles, events))
    assert plan.count(f"{tmp_path}/e]") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    scan = next(line for line in plan.split("\n") if f"{tmp_path}/e]" in line)
    assert "Actor1Name" not in scan and "ActionGeo_Lat" not in scan
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert "_day" in below or "keys=[]" in below, below


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = plan_of(keep_one(df, ["k"]))
    exchange = plan.index("Exchange")
    assert "partial_min" in plan[exchange:]
    assert keep_one(df, ["k"]).count() == 667


def test_known_keys_are_looked_up_in_the_key_column_only(spark, tmp_path):
    spark.range(100).select("id", F.lit("x").alias("wide")).write.parquet(str(tmp_path / "t"))
    existing = spark.read.parquet(str(tmp_path / "t"))
    new = spark.range(90, 110).select("id", F.lit("y").alias("wide"))
    added = new_only(existing, new, ["id"])
    assert "ReadSchema: struct<id:bigint>" in plan_of(added)
    assert sorted(r.id for r in added.collect()) == list(range(100, 110))


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "k int, v int")
    assert sorted(keep_one(df, ["k"]).collect(), key=str) == sorted([(None, 1), (1, 5)], key=str)
    assert new_only(df, df, ["k"]).isEmpty()


def test_a_hot_day_is_split_over_files(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = spark.range(60_000).select(
        (F.lit(start) + F.make_dt_interval(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20)))
        .alias("Datetime"),
        F.rand(1).alias("v"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        lake.write_days(rows.repartition(8), str(tmp_path / "t"), "Datetime")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/t/date=2024-01-01/*.parquet")) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_ranks_of_a_value_held_by_a_third(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v")
    )
    ordered = counted_order(df, [], "v")
    hot = ordered.where("v = 7").first()
    assert hot.n == 10_001 and hot.n_total == 30_000
    last = ordered.orderBy(F.desc("v")).first()
    assert last.n_below == 29_999


def test_shared_folder_comes_from_the_session(spark):
    root = session.checkpoint_root(spark)
    assert session.checkpoint_root(spark) == root
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")
    assert session.fresh_folder(spark, "x").startswith(root)
