"""Dataset profiles (C1-C6). All are aggregates with map-side partial
aggregation; per-user / per-item counts are computed once and bucketed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.operators.ranking import global_rank, number_rows


def _scalar(df: DataFrame, expr: Column) -> Column:
    return df.agg(expr).scalar()


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """Per rating value its count and share, with the overall mean,
    median and sample standard deviation on every row."""
    per_value = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # one row per distinct rating value
    return per_value.select(
        "rating", "count", (F.col("count") / total).alias("share"),
        _scalar(ratings, F.sum("rating") / F.count("rating")).alias("mean_rating"),
        _scalar(ratings, F.median("rating")).alias("median_rating"),
        _scalar(ratings, _stddev_from_sums("rating")).alias("std_rating"))


def _stddev_from_sums(c: str) -> Column:
    """Sample standard deviation from the exact sums n, sum x, sum x^2 (ratings
    are multiples of 0.5, so the sums are exact and the result is the same in
    any engine and for any partitioning); null for a single value."""
    x = F.col(c)
    n = F.count(x).cast("double")
    s1, s2 = F.sum(x), F.sum(x * x)
    return F.sqrt(F.try_divide(s2 - s1 * s1 / n, n - F.lit(1.0)))


def _bucket_profile(counts: DataFrame, edges: list[tuple[str, int | None, int | None]],
                    unit: str) -> DataFrame:
    bucket = None
    for label, lo, hi in edges:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("n") >= lo)
        if hi is not None:
            cond = cond & (F.col("n") <= hi)
        bucket = F.when(cond, F.lit(label)) if bucket is None else bucket.when(cond, F.lit(label))
    per_bucket = counts.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias(unit))
    return per_bucket.select(
        "bucket", unit,
        _scalar(counts, F.min("n")).alias("min_ratings"),
        _scalar(counts, F.median("n").cast("double")).alias("median_ratings"),
        _scalar(counts, F.max("n")).alias("max_ratings"))


# Activity buckets of the original analysis.
USER_BUCKETS = [("<=20", None, 20), ("21-50", 21, 50), (">50", 51, None)]
ITEM_BUCKETS = [("<=5", None, 5), ("6-20", 6, 20), ("21-50", 21, 50), (">50", 51, None)]


def user_activity_profile(ratings: DataFrame) -> DataFrame:
    """Users per activity bucket, with min / median / max ratings per user."""
    counts = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return _bucket_profile(counts, USER_BUCKETS, "users")


def item_popularity_profile(ratings: DataFrame) -> DataFrame:
    """Items per popularity bucket, with min / median / max ratings per item."""
    counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return _bucket_profile(counts, ITEM_BUCKETS, "items")


def top_rated_items_by_count(ratings: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """C4: the n items with the most ratings."""
    s = (ratings.groupBy("item_id")
         .agg(F.count(F.lit(1)).alias("rating_count"), F.sum("rating").alias("_sum"))
         .join(items, "item_id")
         .select("item_id", "title", "release_year", "rating_count",
                 (F.col("_sum") / F.col("rating_count")).alias("avg_rating")))
    order = [F.col("rating_count").desc(), F.col("item_id").asc()]
    return number_rows(s.orderBy(*order).limit(n), order, "rank")


def matrix_stats(train: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Users, items, stored ratings and sparsity % of the rating matrix.
    Items are those seen in train, or all of `items` when given."""
    base = train.agg(F.countDistinct("user_id").alias("n_users"),
                     F.countDistinct("item_id").alias("_seen"),
                     F.count(F.lit(1)).alias("nnz"))
    n_items = F.col("_seen") if items is None else _scalar(items, F.count(F.lit(1)))
    base = base.select("n_users", n_items.alias("n_items"), "nnz")
    cells = F.col("n_users").cast("double") * F.col("n_items").cast("double")
    return base.withColumn("sparsity_pct",
                           F.lit(100.0) * (F.lit(1.0) - F.try_divide(F.col("nnz"), cells)))


def genre_profile(ratings: DataFrame, item_genres: DataFrame, genres: DataFrame) -> DataFrame:
    """Per genre the number of ratings, their share of all ratings, the mean
    rating, and the genre's rank by count and by mean.

    Ratings are counted and summed per item before they meet the bridge, so an item
    with very many ratings is one row there; the ranks are numbered over sorted ranges."""
    per_item = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("rating").alias("_sum"))
    g = (per_item.join(item_genres, "item_id")
         .groupBy("genre_id").agg(F.sum("_n").alias("rating_count"), F.sum("_sum").alias("_sum"))
         .join(genres, "genre_id"))
    total = _scalar(ratings, F.count(F.lit(1)))
    g = g.select("genre_name", "rating_count",
                 (F.col("rating_count") / total).alias("share"),
                 (F.col("_sum") / F.col("rating_count")).alias("avg_rating"))
    by_count = global_rank(g, [F.col("rating_count").desc(), F.col("genre_name")], "rank_by_count")
    return global_rank(by_count, [F.col("avg_rating").desc(), F.col("genre_name")], "rank_by_avg")
