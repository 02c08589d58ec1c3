"""What the physical plans must and must not contain, and how hot keys are handled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidewheel.operators import asof, cleaning, features, modeling, monitoring, upsert
from tidewheel.operators.profiling import Policy
from tidewheel.plans import testbed as tb
from tidewheel.schemas import AUDIT
from tidewheel.session import require_adaptive

QUERIES = contract.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fit_model"}))
def test_no_python_and_no_pairing(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("Python", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in plan


def test_monitoring_predicates_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "audits")
    tb.audits(spark, sf_dir).write.parquet(path)
    start, end = (F.timestamp_seconds(F.lit(t)) for t in (1_704_067_200, 1_704_153_600))
    picked = monitoring.select_window(spark.read.schema(AUDIT).parquet(path), start, end, "3")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(picked.select("event_id"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    for part in (
        "GreaterThanOrEqual(served_at",
        "LessThan(served_at",
        "LessThanOrEqual(target_at",
        "EqualTo(model_version",
    ):
        assert part in pushed
    columns = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert columns == "struct<event_id:string,served_at:timestamp,target_at:timestamp,model_version:string>"


def test_keep_first_shrinks_groups_before_the_shuffle(spark, sf_dir):
    judged = cleaning.evaluate(tb.records(spark, sf_dir), Policy(True, 900), 900)
    for df in (
        cleaning.accepted_rows(judged),
        upsert.keep_last(tb.actuals(spark, sf_dir), ["station_id"], ["event_id"]),
    ):
        above, below = plan_of(df).split("Exchange hashpartitioning", 1)
        assert "WindowGroupLimit" in above and "Final" in above
        assert "WindowGroupLimit" in below and "Partial" in below


def test_history_is_sorted_in_day_slices(spark, sf_dir):
    plan = plan_of(tb.history(spark, sf_dir))
    window = plan.split("Window [", 1)[1]
    assert "Exchange hashpartitioning(station_id" in window
    assert "_slice" in window.split("Exchange hashpartitioning(")[1].split(")")[0]


@pytest.fixture()
def tiny_skew(spark):
    """Splitting starts at a few kilobytes, and joins shuffle."""
    changes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_predictions(spark, rows):
    """Half of the rows ask for the same second of the same station."""
    n = F.col("id")
    hot = n % 2 == 0
    return spark.range(0, rows, 1, 8).select(
        F.concat(F.lit("r"), n.cast("string")).alias("event_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), (n % 500).cast("string"))).alias("station_id"),
        F.when(hot, 5000).otherwise(n % 9000).alias("target_at"),
        F.repeat(F.lit("x"), 40).alias("payload"),
    )


def test_a_hot_second_is_split(spark, tiny_skew):
    asked = hot_predictions(spark, 40_000)
    seen = spark.range(0, 20_000, 1, 8).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 500).cast("string")))
        .alias("station_id"),
        (F.col("id") % 9000).alias("last_reported"),
        (F.col("id") % 30).alias("num_bikes_available"),
    )
    joined = asof.nearest_asof(asked, seen, 120)
    joined.persist()
    assert joined.count() == 40_000
    hot = joined.where("station_id = 'hot'")
    assert hot.select("actual_at").distinct().collect()[0][0] == 5001 or hot.where(
        "abs(actual_at - target_at) > 2"
    ).isEmpty()
    assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    joined.unpersist()


def test_copies_of_a_hot_event_do_not_meet(spark, tiny_skew):
    judged = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("arrival"),
        F.lit(None).cast("string").alias("reason"),
    )
    tagged = cleaning.tag_outcomes(judged)
    sizes = [
        r.n for r in tagged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    ]
    assert sum(sizes) == 40_000 and max(sizes) < 40_000 / 4
    counts = {r.outcome: r["count"] for r in tagged.groupBy("outcome").count().collect()}
    assert counts == {"accepted": 20_001, "duplicate": 19_999}


def test_requests_of_a_hot_station_are_spread(spark, tiny_skew):
    latest = spark.range(100).select(
        F.col("id").cast("string").alias("station_id"), F.col("id").alias("v")
    )
    requests = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("q"), F.col("id").cast("string")).alias("request_id"),
        F.lit("7").alias("station_id"),
    )
    looked = modeling.lookup_latest(requests, latest)
    sizes = [
        r.n for r in looked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    ]
    assert sum(sizes) == 40_000 and max(sizes) < 40_000 / 3
    assert looked.where("v <> 7 OR v IS NULL").isEmpty()


def test_a_hot_station_is_sorted_by_many_tasks(spark, tiny_skew):
    staged = spark.range(0, 30_000, 1, 8).select(
        F.lit("hot").alias("station_id"),
        F.timestamp_seconds(F.col("id") * 900).alias("event_timestamp"),
        (F.col("id") % 20).alias("available_bikes"),
        (20 - F.col("id") % 20).alias("available_docks"),
        F.lit(20).cast("bigint").alias("capacity"),
        F.lit("x").alias("source_name"),
    )
    history = features.feature_history(staged)
    sizes = [
        r.n for r in history.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    ]
    assert sum(sizes) == 30_000 and len(sizes) > 8 and max(sizes) < 30_000 / 4
    assert history.where("target_available_bikes_15m IS NULL").count() == 1


def test_jobs_need_adaptive_execution(spark):
    require_adaptive(spark)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="skewJoin"):
            require_adaptive(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
