"""Plans under a hot key that holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from paperlane.operators import joins, order, predictions, profile, tokens

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_after_run(frame):
    frame.toPandas()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    return spark.range(0, 300000, 1, 16).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


@pytest.mark.parametrize("build", [
    lambda hot, other: joins.drop_known(hot, other, ["k"]),
    lambda hot, other: joins.only_listed(hot, other, ["k"]),
    lambda hot, other: joins.flag_listed(hot, other, ["k"], "f"),
    lambda hot, other: joins.enrich(hot, other, ["k"]),
    lambda hot, other: joins.outer_with_parents(hot, other, ["k"]),
    lambda hot, other: joins.lookup_with_fallback(
        hot, other.select("k", F.lit("a").alias("t"), F.lit(1).alias("o")),
        other.select("k", F.lit("b").alias("t")), "k", "t", "o"),
], ids=["drop_known", "only_listed", "flag_listed", "enrich", "outer_with_parents", "lookup_with_fallback"])
def test_hot_key_is_split(spark, no_broadcast, hot, build):
    other = spark.range(0, 200000, 1, 8).select(F.col("id").alias("k"))
    assert "skew=true" in plan_after_run(build(hot, other))


def test_known_keys_stay_right_when_split(spark, no_broadcast, hot):
    known = spark.range(0, 100000).select(F.col("id").alias("k"))
    assert joins.drop_known(hot, known, ["k"]).filter("k < 100000").count() == 0


def test_keep_first_limits_groups_before_the_shuffle(spark, hot):
    plan = order.keep_first(hot, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_no_window_over_all_rows(spark, hot):
    frame = hot.select("k", F.rand(1).alias("s"), (F.col("k") == 7).alias("g"))
    plan = profile.describe(frame, "s", "g")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_counters_join_keys_and_not_rows(spark, hot):
    known = spark.range(0, 10).select(F.col("id").alias("k"))
    row = profile.load_counters(hot, known, "k").first()
    assert row.n_total == 300000 and row.n_known + row.n_new == 300000
    assert row.n_known == hot.filter("k < 10").count()


def test_ranked_rows_are_shuffled_once(spark, no_broadcast, hot):
    rows = hot.withColumn("hot", F.col("k") == 7)
    plan = order.shuffled_rank(rows, ["hot"], "v")._jdf.queryExecution().executedPlan().toString()
    # the rows once; the few counts per cell, per group, and back per cell
    assert plan.count("Exchange hashpartitioning") == 4
    assert "Filter" not in plan


def test_values_are_not_shuffled_for_the_cell_totals(spark, no_broadcast):
    frame = spark.range(1000).select((F.col("id") % 7).cast("double").alias("s"))
    totals = order.running_totals(frame, "s", {"n": F.count("*")}, [2.0, 4.0])
    plan = totals._jdf.queryExecution().executedPlan().toString()
    # per value, per cell of values, and the counts per cell; those few go to one window and back
    assert plan.count("Exchange hashpartitioning") <= 4


@pytest.mark.parametrize("build", [
    lambda rows: predictions.decisions(rows), lambda rows: predictions.pivot_first(rows, ["name", "class_prob"]),
    lambda rows: predictions.flatten(rows, ["ticket_uuid", "created_at"], pairs=["a__name"]),
    lambda rows: predictions.daily_volume(predictions.decisions(rows)),
], ids=["decisions", "pivot", "flatten", "daily_volume"])
def test_text_ids_are_aggregated_by_hash(spark, build):
    kinds = "id long, attachment_id string, ticket_uuid string, created_at timestamp, type string, subtype string, value string"
    rows = spark.createDataFrame([(1, "a", "t", None, "a", "name", "x")], kinds)
    plan = build(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Expand" not in plan


def test_counts_are_made_once(spark, tmp_path):
    spark.range(100).select((F.col("id") % 7).cast("string").alias("k")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    frame = profile.status_distribution(rows, "k")
    assert plan_after_run(frame).split("== Initial Plan ==")[0].count("FileScan") == 1


def test_sorted_results_are_in_order(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("c", 3), (None, 4)], "k string, v int")
    assert [r.k for r in profile.value_counts(rows, "k").collect()] == ["c", "a", "b"]
    words = spark.createDataFrame([(["x", "y", "y"],), (["a"],)], "t array<string>")
    assert [r.token for r in tokens.token_frequency(words, "t").collect()] == ["y", "a", "x"]


def test_cells_follow_the_partitions(spark):
    rows = spark.range(500).select("id", (F.col("id") % 3).alias("g"))
    expected = None
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found = sorted(map(tuple, order.shuffled_rank(rows, ["g"], "id").collect()))
            expected = expected or found
            assert found == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
