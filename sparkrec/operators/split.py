"""Per-user time split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.functions.columns import MIN_USER_RATINGS, TEST_RATIO

RATING_COLS = ["rating_id", "user_id", "item_id", "rating", "ts"]


def min_activity_filter(ratings: DataFrame, min_ratings: int = MIN_USER_RATINGS) -> DataFrame:
    """Ratings of users with at least `min_ratings` ratings.

    The count is a partial (map-side) aggregate; the semi join on user_id is
    split by AQE when one user holds a large share of the rows."""
    active = (ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= min_ratings).select("user_id"))
    return ratings.join(active, "user_id", "left_semi")


def cut_points(ratings: DataFrame, ratio: float = TEST_RATIO,
               min_ratings: int = MIN_USER_RATINGS) -> DataFrame:
    """One row per active user: the time `cut_ts` at which its newest
    max(1, floor(n*ratio)) ratings begin, and how many of the ratings of exactly
    that time still belong to them (`need`, of `at_cut`).

    Ratings are counted per day and per time first, with map-side aggregation;
    the windows see the days of a user, and the times of its one cut day, never
    its ratings, so a very active user is no hot window."""
    day = F.to_date("ts")
    per_day = ratings.groupBy("user_id", day.alias("day")).agg(F.count(F.lit(1)).alias("c"))
    newest = Window.partitionBy("user_id").orderBy(F.col("day").desc())
    whole = Window.partitionBy("user_id")
    cut_day = (per_day.withColumn("cum", F.sum("c").over(newest))
               .withColumn("n", F.sum("c").over(whole))
               .withColumn("k", F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(float(ratio)))))
               .filter((F.col("n") >= min_ratings) & (F.col("cum") >= F.col("k"))
                       & (F.col("cum") - F.col("c") < F.col("k")))
               .select("user_id", "day", (F.col("k") - F.col("cum") + F.col("c")).alias("k")))
    per_ts = ratings.groupBy("user_id", day.alias("day"), "ts").agg(F.count(F.lit(1)).alias("c"))
    times = per_ts.join(cut_day, ["user_id", "day"])
    newest = Window.partitionBy("user_id").orderBy(F.col("ts").desc())
    return (times.withColumn("cum", F.sum("c").over(newest))
            .filter((F.col("cum") >= F.col("k")) & (F.col("cum") - F.col("c") < F.col("k")))
            .select("user_id", F.col("ts").alias("cut_ts"), F.col("c").alias("at_cut"),
                    (F.col("k") - F.col("cum") + F.col("c")).alias("need")))


def label_split(ratings: DataFrame, ratio: float = TEST_RATIO,
                min_ratings: int = MIN_USER_RATINGS) -> DataFrame:
    """Ratings of active users with `is_test`: the newest max(1, floor(n*ratio))
    ratings of each user (ties in time broken by rating_id, newest first).

    Lazy: the small table of cut points is joined to the ratings on user_id (one
    row per user, so AQE can split a hot user). Only ratings of exactly the cut
    time, where more than enough share it, are numbered."""
    cuts = cut_points(ratings, ratio, min_ratings)
    tied = (ratings.select("user_id", F.col("ts").alias("cut_ts"), "rating_id")
            .join(cuts.filter(F.col("at_cut") > F.col("need")), ["user_id", "cut_ts"]))
    order = Window.partitionBy("user_id").orderBy(F.col("rating_id").desc())
    first = (tied.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") == F.col("need"))
             .select("user_id", F.col("rating_id").alias("first_id")))
    marks = cuts.select("user_id", "cut_ts").join(first, "user_id", "left")
    at_cut = (F.col("ts") == F.col("cut_ts")) & (
        F.col("first_id").isNull() | (F.col("rating_id") >= F.col("first_id")))
    return (ratings.select(*RATING_COLS).join(marks, "user_id")
            .select(*RATING_COLS, ((F.col("ts") > F.col("cut_ts")) | at_cut).alias("is_test")))


def split_by_time(ratings: DataFrame, ratio: float = TEST_RATIO,
                  min_ratings: int = MIN_USER_RATINGS) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the newest 20% (at least one) of each user's ratings in test."""
    labelled = label_split(ratings, ratio, min_ratings)
    train = labelled.filter(~F.col("is_test")).select(*RATING_COLS)
    test = labelled.filter(F.col("is_test")).select(*RATING_COLS)
    return train, test


def split_stats(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train/Test rows: count, distinct users, distinct items, mean rating, and
    each part's share of all split ratings."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("dataset"),
            F.count(F.lit(1)).alias("count"),
            F.countDistinct("user_id").alias("unique_users"),
            F.countDistinct("item_id").alias("unique_items"),
            (F.sum("rating") / F.count("rating")).alias("avg_rating"))
    both = one(train, "Train").unionByName(one(test, "Test"))
    total = F.sum("count").over(Window.partitionBy())  # two rows
    return both.withColumn("ratio", F.try_divide(F.col("count"), total))
