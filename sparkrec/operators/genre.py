"""Genre recommenders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import round_half_up
from sparkrec.operators.popularity import item_stats
from sparkrec.operators.ranking import join_on_rank, rank_within_groups, top_n_per
from sparkrec.session import spread

# Rows of the per-genre ranked lists that may go through a broadcast join.
LOW_RANK_ROWS = 100_000


def _by_user(ratings: DataFrame, lists: DataFrame) -> DataFrame:
    """The ratings with their items' `_genres` (one list per item), dealt by user.

    A rating is one row until it is at its user's task, so neither shuffle grows with
    the genres of an item; what a task sums is one row per user and genre."""
    return spread(ratings.join(lists, "item_id"), ratings.count(), "user_id")


def _genre_scores(train: DataFrame, item_genres: DataFrame, genres: DataFrame,
                  users: DataFrame | None, min_per_genre: int) -> DataFrame:
    """(user, genre): rating_count, rating sum (= count * avg) over the
    user's train ratings joined to the bridge; count >= min_per_genre."""
    r = train.select("user_id", "item_id", "rating")
    if users is not None:
        r = r.join(users.select("user_id"), "user_id", "left_semi")
    lists = item_genres.groupBy("item_id").agg(F.collect_list("genre_id").alias("_genres"))
    g = (_by_user(r, lists).select("user_id", "rating", F.explode("_genres").alias("genre_id"))
         .groupBy("user_id", "genre_id")
         .agg(F.count(F.lit(1)).alias("rating_count"), F.sum("rating").alias("pref"))
         .filter(F.col("rating_count") >= min_per_genre))
    return g.join(genres, "genre_id")


def user_genre_preference(train: DataFrame, item_genres: DataFrame, genres: DataFrame,
                          users: DataFrame | None = None, min_per_genre: int = 3,
                          top_n: int = 3) -> DataFrame:
    """Each user's top genres by preference score = count * avg rating.
    Ordered by the rounded score (the original sorts by the output alias)."""
    g = _genre_scores(train, item_genres, genres, users, min_per_genre)
    g = g.select(
        "user_id", "genre_name", "rating_count",
        round_half_up(F.col("pref") / F.col("rating_count"), 2).alias("avg_rating"),
        round_half_up("pref", 2).alias("preference_score"))
    return top_n_per(g, ["user_id"], [F.col("preference_score").desc(), F.col("genre_name")],
                     top_n).select("user_id", "rank", "genre_name", "rating_count",
                                   "avg_rating", "preference_score")


def _genre_budgets(train: DataFrame, item_genres: DataFrame, genres: DataFrame, stats: DataFrame,
                   users: DataFrame | None, min_per_genre: int, top_n: int) -> tuple[DataFrame, DataFrame]:
    """Each user's top genres by the unrounded preference, with `_w`, how many of the
    genre's ranked items the user has rated; and the ranked (item, genre) pairs.

    One pass over ratings and bridge: the bridge has one row per (item, genre), with
    the number of its rows there and whether the item is ranked, so counts, sums and
    rated items come from the same aggregation."""
    bridge = (item_genres.groupBy("item_id", "genre_id").agg(F.count(F.lit(1)).alias("_copies"))
              .join(stats, "item_id", "left"))
    r = train.select("user_id", "item_id", "rating")
    if users is not None:
        r = r.join(users.select("user_id").distinct(), "user_id", "left_semi")
    marked = bridge.select("item_id", F.struct("genre_id", "_copies", F.col("weighted_rating").isNotNull().cast("int").alias("_ranked")).alias("g"))
    lists = marked.groupBy("item_id").agg(F.collect_list("g").alias("_genres"))
    g = (_by_user(r, lists).select("user_id", "rating", F.inline("_genres")).groupBy("user_id", "genre_id")
         .agg(F.sum("_copies").alias("_n"), F.sum(F.col("rating") * F.col("_copies")).alias("pref"), F.sum("_ranked").alias("_w"))
         .filter(F.col("_n") >= min_per_genre).join(genres, "genre_id"))
    top = top_n_per(g, ["user_id"], [F.col("pref").desc(), F.col("genre_name")], top_n)
    return top.select("user_id", "genre_id", "genre_name", "pref", "_w"), bridge.filter("weighted_rating IS NOT NULL").drop("_copies")


def genre_pool(train: DataFrame, item_genres: DataFrame, genres: DataFrame, users: DataFrame | None = None,
               n: int = 10, min_per_genre: int = 3, top_genres_n: int = 3, min_movie_ratings: int = 20,
               low_rank_rows: int | None = None) -> DataFrame:
    """E2 without the item's details: user_id, rank, item_id, genre_name, rating_count,
    avg_rating, weighted_rating and combined (unrounded).

    Within one (user, genre) the order is the genre's weighted-rating order,
    so only the first n + w items of the genre can reach the top n, where w is
    the number of the user's rated items among them. Candidates are therefore
    about users * genres * n rows, never users x catalogue."""
    budget, genre_items = _genre_budgets(train, item_genres, genres, item_stats(train, min_movie_ratings),
                                         users, min_per_genre, top_genres_n)
    ranked = rank_within_groups(
        genre_items, ["genre_id"], [F.col("weighted_rating").desc(), F.col("item_id").asc()],
        rank_col="g_rank")
    watched = train.select("user_id", "item_id")
    if users is not None:
        watched = watched.join(users.select("user_id").distinct(), "user_id", "left_semi")
    cand = budget.select("user_id", "genre_id", "genre_name", "pref",
                         F.explode(F.sequence(F.lit(1).cast("bigint"),
                                              (F.col("_w") + F.lit(n)).cast("bigint"))).alias("g_rank"))
    n_genres = max(1, genres.count())  # the genre vocabulary: one small count
    # 0 for a vocabulary beyond the bound: then no rank is broadcast
    low = (LOW_RANK_ROWS if low_rank_rows is None else low_rank_rows) // n_genres
    cand = (join_on_rank(cand, ranked, ["genre_id"], "g_rank", low)
            .join(watched, ["user_id", "item_id"], "left_anti")
            .withColumn("combined", F.col("weighted_rating") * (F.col("pref") / F.lit(100.0))))
    return top_n_per(cand, ["user_id"],
                     [F.col("combined").desc(), F.col("weighted_rating").desc(),
                      F.col("item_id").asc(), F.col("genre_name").asc()], n)


def genre_recommendations(train: DataFrame, items: DataFrame, item_genres: DataFrame,
                          genres: DataFrame, genre_strings: DataFrame,
                          users: DataFrame | None = None, n: int = 10,
                          min_per_genre: int = 3, top_genres_n: int = 3,
                          min_movie_ratings: int = 20,
                          low_rank_rows: int | None = None) -> DataFrame:
    """Unseen items of each user's top genres, by combined score =
    weighted_rating * preference / 100. One row per (item, preferred genre),
    so an item can appear once per genre."""
    top = genre_pool(train, item_genres, genres, users, n, min_per_genre, top_genres_n, min_movie_ratings, low_rank_rows)
    return (top.join(items, "item_id").join(genre_strings, "item_id", "left")
            .select("user_id", "rank", "item_id", "title", "release_year",
                    F.col("genre_name").alias("preferred_genre"), "genres", "rating_count",
                    round_half_up("avg_rating", 2).alias("avg_rating"),
                    round_half_up("weighted_rating", 2).alias("weighted_rating"),
                    round_half_up("combined", 2).alias("combined_score")))
