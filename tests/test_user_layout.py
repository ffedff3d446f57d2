"""Requests for one user read one folder and give the rows of the all-user jobs."""

from pyspark.sql import functions as F

from paths import SF01
from sparkrec.plans import datasets, registry
from sparkrec.sources.user_layout import BUCKETS, bucket_of, read_user, write_by_user


def test_one_folder_is_read(spark, tmp_path):
    train = datasets.load(spark, SF01, "r1").train
    path = str(tmp_path / "by_user")
    write_by_user(train, path)
    mine = read_user(spark, path, registry.ONE_USER)
    assert sorted(mine.collect()) == sorted(train.filter(F.col("user_id") == registry.ONE_USER).collect()) != []
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(user_bucket" in plan and "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in plan
    folder = train.filter(bucket_of(F.col("user_id"), BUCKETS) == bucket_of(F.lit(registry.ONE_USER), BUCKETS)).count()
    assert folder < 0.05 * train.count()


def test_a_hot_user_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).otherwise(1000).alias("user_id"), F.col("id").alias("item_id"))
    write_by_user(rows, str(tmp_path / "hot"), buckets=8)
    hot = read_user(spark, str(tmp_path / "hot"), 1000, buckets=8)
    assert hot.count() == 20_000 and hot.select(F.input_file_name()).distinct().count() > 1
    assert read_user(spark, str(tmp_path / "hot"), -1, buckets=8).count() == 0


def test_same_rows_as_for_all_users(spark):
    for one, all_ in (("popular_items_one_user", "popular_items_for_users"), ("user_profile_one_user", "user_profile"), ("watch_history_one_user", "watch_history")):
        got = registry.QUERIES[one](spark, SF01)
        want = registry.QUERIES[all_](spark, SF01).filter(F.col("user_id") == registry.ONE_USER)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) != []
