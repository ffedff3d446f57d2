"""Tables laid out by user: a request for one user reads that user's folder alone.

Rows are written to one folder per bucket of users (a hash of the id), ranges of
(bucket, user, item) at a time, so a user with very many rows is written by several
tasks. A reader names the bucket in its filter, which leaves one folder to list, and
within its files the sorted user ids let Parquet skip row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "user_bucket"
BUCKETS = 64


def bucket_of(user_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user_id.cast("bigint")), F.lit(buckets)).cast("int")


def write_by_user(df: DataFrame, path: str, buckets: int = BUCKETS, order: str = "item_id") -> None:
    """Write `df`, which has user_id and `order`, in folders by bucket of users."""
    if BUCKET in df.columns:
        raise ValueError(f"{BUCKET} is the name of the folders")
    keys = [BUCKET, "user_id", order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.withColumn(BUCKET, bucket_of(F.col("user_id"), buckets)).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").partitionBy(BUCKET).parquet(path))


def read_user(spark: SparkSession, path: str, user_id: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows of one user, from a table that `write_by_user` wrote with as many buckets."""
    mine = F.col(BUCKET) == bucket_of(F.lit(user_id), buckets)
    return spark.read.parquet(path).filter(mine & (F.col("user_id") == user_id)).drop(BUCKET)
