"""Lookups behind the original UI (J1-J5), as all-user / all-item jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import genre_string, round_half_up
from sparkrec.operators.ranking import number_rows, top_n_per


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp without time zone (the
    original stores time as epoch seconds); independent of the session zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def user_profile(users: DataFrame, train: DataFrame) -> DataFrame:
    """User attributes with their train rating count and mean (round 2);
    users without ratings show 0 and null. Ratings are aggregated per user
    before the join."""
    per_user = train.groupBy("user_id").agg(F.count("rating").alias("total_ratings"),
                                            F.sum("rating").alias("_sum"))
    return (users.join(per_user, "user_id", "left")
            .select("user_id", "gender", "age", "occupation",
                    F.coalesce(F.col("total_ratings"), F.lit(0)).alias("total_ratings"),
                    round_half_up(F.col("_sum") / F.col("total_ratings"), 2).alias("avg_rating")))


def user_list(users: DataFrame) -> DataFrame:
    """Distinct user ids (sorted on output)."""
    return users.select("user_id").distinct().orderBy("user_id")


def watch_history(train: DataFrame, items: DataFrame, genre_strings: DataFrame,
                  users: DataFrame | None = None, limit: int = 50) -> DataFrame:
    """Per user the `limit` train ratings with the highest rating, newest
    first among equal ratings, with title and genre string."""
    r = train if users is None else train.join(users.select("user_id"), "user_id", "left_semi")
    top = top_n_per(r, ["user_id"], [F.col("rating").desc(), F.col("ts").desc(),
                                     F.col("item_id").asc()], limit)
    return (top.join(items.select("item_id", "title"), "item_id")
            .join(genre_strings, "item_id", "left")
            .select("user_id", "rank", "item_id", "title", "genres", "rating",
                    epoch_seconds("ts").alias("timestamp")))


def history_rating_filter(history: DataFrame, min_rating: float) -> DataFrame:
    """Keep history rows with rating >= min_rating (after the limit)."""
    return history.filter(F.col("rating") >= min_rating)


def title_search(items: DataFrame, item_genres: DataFrame, genres: DataFrame,
                 train: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Case-insensitive LIKE '%query%' on titles ('%' and '_' in the query
    act as wildcards). rating_count is the original's count over the genre
    fan-out (ratings x genre rows); distinct_rating_count is the true count."""
    hits = items.filter(F.lower("title").like(f"%{query.lower()}%")).select("item_id", "title")
    fan = item_genres.groupBy("item_id").agg(F.count(F.lit(1)).alias("_genre_rows"))
    per_item = (train.join(hits.select("item_id"), "item_id", "left_semi")
                .groupBy("item_id").agg(F.count("rating").alias("_cnt"),
                                        F.sum("rating").alias("_sum")))
    names = (item_genres.join(hits.select("item_id"), "item_id", "left_semi")
             .join(genres, "genre_id")
             .groupBy("item_id").agg(genre_string(F.collect_set("genre_name")).alias("genres")))
    j = (hits.join(fan.select("item_id", "_genre_rows"), "item_id", "left")
         .join(per_item, "item_id", "left").join(names, "item_id", "left"))
    cnt = F.coalesce(F.col("_cnt"), F.lit(0))
    out = j.select(
        "item_id", "title", "genres",
        F.coalesce(F.col("_sum") / F.col("_cnt"), F.lit(0.0)).alias("avg_rating"),
        (cnt * F.coalesce(F.col("_genre_rows"), F.lit(1))).alias("rating_count"),
        cnt.alias("distinct_rating_count"))
    order = [F.col("rating_count").desc(), F.col("item_id").asc()]
    return number_rows(out.orderBy(*order).limit(limit), order, "rank")


# Which output column is "the score" of each recommender, in the
# original display's order of preference, and the places it rounds them to.
SCORE_PREFERENCE = [("weighted_rating", 2), ("combined_score", 2), ("recommendation_score", 4),
                    ("predicted_rating", 2), ("hybrid_score", 4)]
UNIFIED_ALGORITHMS = ("popularity", "genre", "similarity", "ml", "hybrid")


def unified_recommendations(results: dict[str, DataFrame]) -> DataFrame:
    """Recommendations of several algorithms in one shape: algorithm,
    user_id, rank, item_id, title, genres, score (the first present of
    weighted_rating, combined_score, recommendation_score, predicted_rating,
    hybrid_score, rounded 2/2/4/2/4), avg_rating (round 2) and rating_count
    when the algorithm reports them. Unknown algorithm names are an error."""
    out = None
    for algo, df in results.items():
        if algo not in UNIFIED_ALGORITHMS:
            raise ValueError(f"unknown algorithm: {algo}")
        cols = set(df.columns)
        score_col, places = next((c, p) for c, p in SCORE_PREFERENCE if c in cols)
        has_stats = "avg_rating" in cols and "rating_count" in cols
        part = df.select(
            F.lit(algo).alias("algorithm"), "user_id", "rank", "item_id", "title",
            (F.col("genres") if "genres" in cols else F.lit(None).cast("string")).alias("genres"),
            round_half_up(score_col, places).alias("score"),
            (round_half_up("avg_rating", 2) if has_stats else F.lit(None).cast("double"))
            .alias("avg_rating"),
            (F.col("rating_count").cast("bigint") if has_stats else F.lit(None).cast("bigint"))
            .alias("rating_count"))
        out = part if out is None else out.unionByName(part)
    return out
