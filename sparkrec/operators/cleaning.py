"""Cleaning: titles and years, the genre dictionary and bridge, rating checks,
and the row-count audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import (
    MAX_RATING, MIN_RATING, genre_string, rating_step_check, release_year,
    title_without_year,
)
from sparkrec.operators.ranking import global_rank


def title_year(items_raw: DataFrame) -> DataFrame:
    """Items with the trailing "(YYYY)" moved out of the title into release_year."""
    return items_raw.select(
        "item_id",
        title_without_year("title").alias("title"),
        release_year("title").alias("release_year"))


def _genre_tokens(items_raw: DataFrame) -> DataFrame:
    return (items_raw.filter(F.col("genres").isNotNull())
            .select("item_id", F.explode(F.split("genres", r"\|")).alias("genre_name")))


def genre_dictionary(items_raw: DataFrame) -> DataFrame:
    """Distinct genre names, numbered 1..n in name order (distributed rank, so
    a large tag vocabulary does not land in one task)."""
    names = _genre_tokens(items_raw).select("genre_name").distinct()
    return global_rank(names, ["genre_name"], "genre_id").select(
        F.col("genre_id").cast("int").alias("genre_id"), "genre_name")


def item_genre_bridge(items_raw: DataFrame, genres: DataFrame) -> DataFrame:
    """One row per (item, genre token); repeated tokens stay repeated."""
    return (_genre_tokens(items_raw)
            .join(genres, "genre_name")
            .select("item_id", "genre_id"))


def item_genre_strings(item_genres: DataFrame, genres: DataFrame) -> DataFrame:
    """item_id -> '|'-joined distinct genre names in name order."""
    return (item_genres.join(genres, "genre_id")
            .groupBy("item_id")
            .agg(genre_string(F.collect_set("genre_name")).alias("genres")))


def rating_in_range(rating: str | Column = "rating") -> Column:
    r = F.col(rating) if isinstance(rating, str) else rating
    return r.between(MIN_RATING, MAX_RATING)


def rating_range_filter(ratings: DataFrame) -> DataFrame:
    """Ratings inside [0.5, 5.0]."""
    return ratings.filter(rating_in_range())


def rating_range_report(ratings: DataFrame) -> DataFrame:
    """One row: how many ratings the range filter keeps and rejects."""
    ok = rating_in_range()
    return ratings.agg(
        F.count(F.when(ok, 1)).alias("kept"),
        F.count(F.when(~ok | F.col("rating").isNull(), 1)).alias("rejected"))


def rating_step_report(values: DataFrame, value_col: str) -> DataFrame:
    """Per distinct raw value: whether it is a valid rating, and how often it occurs."""
    return (values.groupBy(F.col(value_col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("is_valid", rating_step_check("value")))


def row_count_audit(users: DataFrame, items: DataFrame, genres: DataFrame,
                    item_genres: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row with the row count of each table; each count is a scalar
    subquery, like the original's SELECT (SELECT count(*) ...), ... ."""
    def cnt(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()
    return users.agg(F.count(F.lit(1)).alias("users")).select(
        "users", cnt(items).alias("items"), cnt(genres).alias("genres"),
        cnt(item_genres).alias("item_genres"), cnt(ratings).alias("ratings"))
