"""Rating-shaped views derived from the driver's Parquet tables.

The original system reads MovieLens files (users, movies, ratings). The test
tables are TPC-H-like, so the same shapes are derived from them:

* users      <- customer
* items_raw  <- part (title "name (year)", '|'-separated genres)
* ratings r1 <- lineitem joined to orders (sparse: many items, few ratings each)
* ratings r2 <- events (dense: 100 items, many ratings each)

Each rating view keeps the latest row per (user, item), like a ratings table
with one rating per user and item. That de-duplication is a hash aggregate
with map-side partial aggregation, so a (user, item) key with very many raw
rows is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.functions.columns import AGE_CODES
from sparkrec.session import spread
from sparkrec.sources.tables import read_table

# Fixed values of the derivation: rating_id = user_id * 1,000,000,000 + item_id (ids
# stay apart for item ids below the factor);
# a title has no year when p_partkey % 50 = 0; an item has no genres when
# p_partkey % 97 = 0; release year = 1950 + p_size.
RATING_ID_FACTOR = 1_000_000_000


def users_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ages = F.array(*[F.lit(a) for a in AGE_CODES])
    return c.select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.element_at(ages, (F.col("c_custkey") % 7 + 1).cast("int")).cast("int").alias("age"),
        (F.col("c_nationkey") % 21).cast("int").alias("occupation"),
        F.format_string("%05d", F.col("c_custkey")).alias("zip_code"),
    )


def items_raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    year = (F.lit(1950) + F.col("p_size")).cast("string")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("item_id"),
        F.when(F.col("p_partkey") % 50 == 0, F.col("p_name"))
         .otherwise(F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")"))).alias("title"),
        F.when(F.col("p_partkey") % 97 != 0,
               F.concat(F.regexp_replace(F.col("p_name"), " ", "|"), F.lit("|"), F.col("p_type")))
         .alias("genres"),
    )


def _with_rating_id(df: DataFrame) -> DataFrame:
    return df.select(
        (F.col("user_id") * RATING_ID_FACTOR + F.col("item_id")).alias("rating_id"),
        "user_id", "item_id", "rating", "ts")


def ratings_r1_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse ratings: user = o_custkey, item = l_partkey,
    rating = ceil(l_quantity / 5) * 0.5, time = o_orderdate.

    The orders are joined in tasks of a bounded number of lines: the aggregation
    sorts what a task has joined."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = li.count()  # from the files' footers
    j = spread(li, lines, "l_orderkey").join(spread(o, lines, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    latest = j.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        F.max(F.struct("o_orderdate", "l_orderkey", "l_linenumber", "l_quantity")).alias("m"))
    return _with_rating_id(latest.select(
        "user_id", "item_id",
        (F.ceil(F.col("m.l_quantity") / 5) * F.lit(0.5)).cast("double").alias("rating"),
        F.col("m.o_orderdate").alias("ts")))


def _events_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    return e.select(
        "event_id", "ts", "user_id", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"))


def ratings_r2_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ratings: user = user_id, item = props.k,
    rating = 0.5 * least(10, 1 + floor(value / 8)), time = ts."""
    e = _events_keyed(spark, sf_dir)
    latest = e.groupBy("user_id", "item_id").agg(
        F.max(F.struct("ts", "event_id", "value")).alias("m"))
    steps = F.least(F.lit(10), F.lit(1) + F.floor(F.col("m.value") / 8))
    return _with_rating_id(latest.select(
        "user_id", "item_id", (steps * F.lit(0.5)).cast("double").alias("rating"),
        F.col("m.ts").alias("ts")))


def ratings_r2_uncapped_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event ratings before the scale cap, one per event: the input that
    the rating range filter cleans."""
    e = _events_keyed(spark, sf_dir)
    return e.select(
        F.col("event_id").alias("rating_id"), "user_id", "item_id",
        ((F.lit(1) + F.floor(F.col("value") / 8)) * F.lit(0.5)).cast("double").alias("rating"),
        "ts")
