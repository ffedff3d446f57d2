"""Popularity recommenders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import round_half_up, weighted_rating
from sparkrec.operators.ranking import global_rank, join_on_rank, number_rows, top_n_per

# Ranks up to this go through a broadcast join (at most this many item rows).
LOW_RANKS = 10_000


def mean_rating(train: DataFrame) -> Column:
    """C: mean of all train ratings, as a scalar subquery (evaluated once)."""
    return train.agg((F.sum("rating") / F.count("rating")).alias("c")).scalar()


def item_stats(train: DataFrame, min_ratings: int) -> DataFrame:
    """item_id, rating_count (v), avg_rating (R, unrounded) and weighted_rating
    (unrounded) of items with v >= min_ratings. Aggregated before any join."""
    stats = (train.groupBy("item_id")
             .agg(F.count(F.lit(1)).alias("rating_count"), F.sum("rating").alias("_sum"))
             .filter(F.col("rating_count") >= min_ratings))
    avg = F.col("_sum") / F.col("rating_count")
    return stats.select(
        "item_id", "rating_count", avg.alias("avg_rating"),
        weighted_rating(F.col("rating_count"), avg, min_ratings, mean_rating(train))
        .alias("weighted_rating"))


def _popular(train: DataFrame, items: DataFrame, min_ratings: int) -> DataFrame:
    s = item_stats(train, min_ratings).join(items, "item_id")
    return s.select(
        "item_id", "title", "release_year", "rating_count",
        round_half_up("avg_rating", 2).alias("avg_rating"),
        round_half_up("weighted_rating", 2).alias("weighted_rating"))


def _pop_order() -> list[Column]:
    """The original sorts by the output alias, i.e. the rounded weighted rating."""
    return [F.col("weighted_rating").desc(), F.col("rating_count").desc(), F.col("item_id").asc()]


def popular_items(train: DataFrame, items: DataFrame, n: int = 10,
                  min_ratings: int = 30) -> DataFrame:
    """Global top n by Bayesian weighted rating (v >= min_ratings)."""
    top = _popular(train, items, min_ratings).orderBy(*_pop_order()).limit(n)
    return number_rows(top, _pop_order(), "rank")


def popular_ranked(train: DataFrame, items: DataFrame, min_ratings: int = 30) -> DataFrame:
    """Every qualifying item with its global popularity rank `pop_rank`."""
    return global_rank(_popular(train, items, min_ratings), _pop_order(), "pop_rank")


def popular_items_for_users(train: DataFrame, items: DataFrame, users: DataFrame | None = None,
                            n: int = 10, min_ratings: int = 30,
                            low_ranks: int | None = None) -> DataFrame:
    """For every user, the top n popular items the user has not rated.

    Rank bound: a user with w rated items only needs global ranks 1..n+w, so the
    candidate rows are n*|users| + ratings - never users x items."""
    ranked = popular_ranked(train, items, min_ratings)
    watched = train.select("user_id", "item_id")
    if users is None:
        users = watched.select("user_id").distinct()
    else:  # requested users are cut out before anything is counted for them
        watched = watched.join(users.select("user_id").distinct(), "user_id", "left_semi")
    w = watched.groupBy("user_id").agg(F.count(F.lit(1)).alias("_w"))
    budget = users.select("user_id").join(w, "user_id", "left").select(
        "user_id", (F.lit(n) + F.coalesce(F.col("_w"), F.lit(0))).alias("_l"))
    cand = budget.select("user_id", F.explode(F.sequence(F.lit(1).cast("bigint"),
                                                         F.col("_l").cast("bigint"))).alias("pop_rank"))
    low = max(LOW_RANKS if low_ranks is None else low_ranks, 1)
    cand = (join_on_rank(cand, ranked, [], "pop_rank", low)
            .join(watched, ["user_id", "item_id"], "left_anti"))
    out = top_n_per(cand, ["user_id"], ["pop_rank"], n)
    return out.select("user_id", "rank", "item_id", "title", "release_year", "rating_count",
                      "avg_rating", "weighted_rating")


def popular_items_for_user(ranked: DataFrame, rated: DataFrame, n: int = 10) -> DataFrame:
    """D2 for one user, from the ranked list (`popular_ranked`) and the user's own
    ratings: of ranks 1..n+w, w the number of rated items, the first n unrated."""
    mine = rated.select("item_id").distinct()
    last = F.lit(n) + mine.agg(F.count(F.lit(1))).scalar()
    left = ranked.filter(F.col("pop_rank") <= last).join(mine, "item_id", "left_anti")
    return number_rows(left.orderBy("pop_rank").limit(n), ["pop_rank"]).select(
        "rank", "item_id", "title", "release_year", "rating_count", "avg_rating", "weighted_rating")


def similarity_seed_items(train: DataFrame, min_ratings: int = 100,
                          limit: int | None = 500) -> DataFrame:
    """D3: ids of the `limit` most rated items (None: all) with >= min_ratings
    ratings, numbered by count (ties by item_id)."""
    counts = (train.groupBy("item_id").agg(F.count(F.lit(1)).alias("rating_count"))
              .filter(F.col("rating_count") >= min_ratings))
    order = [F.col("rating_count").desc(), F.col("item_id").asc()]
    if limit is None:
        return global_rank(counts, order, "seed_rank")
    return number_rows(counts.orderBy(*order).limit(limit), order, "seed_rank")


def volume_popularity(train: DataFrame, items: DataFrame, n: int = 10,
                      min_ratings: int = 30) -> DataFrame:
    """Documented variant, weighted_rating = rating_count * avg_rating
    (unrounded), v >= min_ratings."""
    s = (train.groupBy("item_id")
         .agg(F.count(F.lit(1)).alias("rating_count"), F.sum("rating").alias("_sum"))
         .filter(F.col("rating_count") >= min_ratings)
         .join(items, "item_id"))
    avg = F.col("_sum") / F.col("rating_count")
    s = s.select("item_id", "title", "rating_count", avg.alias("avg_rating"),
                 (F.col("rating_count") * avg).alias("weighted_rating"))
    order = [F.col("weighted_rating").desc(), F.col("item_id").asc()]
    return number_rows(s.orderBy(*order).limit(n), order, "rank")
