"""Registered queries: one Spark job per operator of the inventory, each with
fixed parameters and (where SQL can express it) a DuckDB oracle.

Parameters follow FIXTURES.md for sf0.01 and up: popularity and genre run on
the sparse r1 ratings (min 20 ratings per item); similarity, CF and hybrid on
the dense r2 ratings (seed >= 30 ratings, >= 20 common raters); evaluation takes
all test users; "liked" is rating >= 4.0.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.functions.columns import round_half_up
from sparkrec.operators import cleaning
from sparkrec.operators import factors as fac
from sparkrec.operators import genre as genre_ops
from sparkrec.operators import hybrid as hyb
from sparkrec.operators import lookup
from sparkrec.operators import metrics as met
from sparkrec.operators import popularity as pop
from sparkrec.operators import profile
from sparkrec.operators import similarity as sim_ops
from sparkrec.operators import split as split_ops
from sparkrec.operators.lookup import epoch_seconds
from sparkrec.plans import datasets
from sparkrec.plans.oracle_views import mr, rnd, with_views, wr
from sparkrec.session import app_id, ensure_checkpoint_dir, materialize
from sparkrec.sources import delimited, fixtures, sinks, user_layout, versions
from sparkrec.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- popularity

POP_M = 20


def _pop_base(m: int) -> str:
    return f"""
stats AS (SELECT item_id, count(*) AS v, sum(rating) / count(*) AS r FROM train
          GROUP BY item_id HAVING count(*) >= {m}),
cmean AS (SELECT sum(rating) / count(*) AS c FROM train),
pop AS (SELECT s.item_id, i.title, i.release_year, s.v AS rating_count,
               {rnd('s.r', 2)} AS avg_rating, {rnd(wr('s.v', 's.r', m, 'cmean.c'), 2)} AS weighted_rating
        FROM stats s JOIN items i ON s.item_id = i.item_id CROSS JOIN cmean)"""


@register("popular_items", with_views("r1", """
SELECT * FROM (
  SELECT item_id, title, release_year, rating_count, avg_rating, weighted_rating,
         row_number() OVER (ORDER BY weighted_rating DESC, rating_count DESC, item_id) AS rank
  FROM pop) WHERE rank <= 10""", _pop_base(POP_M)))
def q_popular_items(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return pop.popular_items(d.train, d.items, n=10, min_ratings=POP_M)


@register("popular_items_for_users", with_views("r1", """
SELECT user_id, rank, item_id, title, release_year, rating_count, avg_rating, weighted_rating FROM (
  SELECT u.user_id, p.*,
         row_number() OVER (PARTITION BY u.user_id
                            ORDER BY p.weighted_rating DESC, p.rating_count DESC, p.item_id) AS rank
  FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN pop p
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = p.item_id))
WHERE rank <= 10""", _pop_base(POP_M)))
def q_popular_items_for_users(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return pop.popular_items_for_users(d.train, d.items, n=10, min_ratings=POP_M)


def _stats_cte(name: str, m: int) -> str:
    """Item stats with unrounded v, r and weighted rating, v >= m."""
    return f"""
{name} AS (SELECT s.item_id, s.v, s.r, {wr('s.v', 's.r', m, 'cm.c')} AS wr
           FROM (SELECT item_id, count(*) AS v, sum(rating) / count(*) AS r FROM train
                 GROUP BY item_id HAVING count(*) >= {m}) s
           CROSS JOIN (SELECT sum(rating) / count(*) AS c FROM train) cm)"""


def _epoch(col: str) -> str:
    return f"date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {col})"


@register("similarity_seed_items", with_views("r2", """
SELECT item_id, rating_count, seed_rank FROM (
  SELECT item_id, count(*) AS rating_count,
         row_number() OVER (ORDER BY count(*) DESC, item_id) AS seed_rank
  FROM train GROUP BY item_id HAVING count(*) >= 30) WHERE seed_rank <= 500"""))
def q_similarity_seed_items(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return pop.similarity_seed_items(d.train, min_ratings=30, limit=500)


@register("volume_popularity", with_views("r1", f"""
SELECT * FROM (
  SELECT s.item_id, i.title, s.v AS rating_count, s.r AS avg_rating, s.v * s.r AS weighted_rating,
         row_number() OVER (ORDER BY s.v * s.r DESC, s.item_id) AS rank
  FROM (SELECT item_id, count(*) AS v, sum(rating) / count(*) AS r FROM train
        GROUP BY item_id HAVING count(*) >= {POP_M}) s JOIN items i ON s.item_id = i.item_id)
WHERE rank <= 10"""))
def q_volume_popularity(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return pop.volume_popularity(d.train, d.items, n=10, min_ratings=POP_M)


# ------------------------------------------------------------------ cleaning


@register("title_year", with_views(None, "SELECT item_id, title, release_year FROM items"))
def q_title_year(spark, sf_dir):
    return cleaning.title_year(fixtures.items_raw_view(spark, sf_dir))


@register("genre_dictionary", with_views(None, "SELECT genre_id, genre_name FROM genres"))
def q_genre_dictionary(spark, sf_dir):
    return cleaning.genre_dictionary(fixtures.items_raw_view(spark, sf_dir))


@register("item_genre_bridge", with_views(None, "SELECT item_id, genre_id FROM item_genres"))
def q_item_genre_bridge(spark, sf_dir):
    raw = fixtures.items_raw_view(spark, sf_dir)
    return cleaning.item_genre_bridge(raw, cleaning.genre_dictionary(raw))


@register("item_genre_string", with_views(None, """
SELECT i.item_id, gs.genres FROM items i LEFT JOIN genre_strings gs ON i.item_id = gs.item_id"""))
def q_item_genre_string(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return d.items.select("item_id").join(d.genre_strings, "item_id", "left")


@register("rating_range_filter", """
SELECT count(*) FILTER (WHERE r BETWEEN 0.5 AND 5.0) AS kept,
       count(*) FILTER (WHERE NOT (r BETWEEN 0.5 AND 5.0) OR r IS NULL) AS rejected
FROM (SELECT CAST((1 + floor(value / 8)) * 0.5 AS DOUBLE) AS r FROM events)""")
def q_rating_range_filter(spark, sf_dir):
    return cleaning.rating_range_report(fixtures.ratings_r2_uncapped_view(spark, sf_dir))


@register("rating_step_check", """
SELECT value, count(*) AS n_rows,
       coalesce(value BETWEEN 0.5 AND 5.0
                AND abs(value - (0.5 + round_even((value - 0.5) / 0.5, 0) * 0.5)) <= 0.001,
                false) AS is_valid
FROM (SELECT l_quantity / 10 AS value FROM lineitem) GROUP BY value""")
def q_rating_step_check(spark, sf_dir):
    vals = read_table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 10).alias("value"))
    return cleaning.rating_step_report(vals, "value")


@register("row_count_audit", with_views("r1", """
SELECT (SELECT count(*) FROM users) AS users, (SELECT count(*) FROM items) AS items,
       (SELECT count(*) FROM genres) AS genres, (SELECT count(*) FROM item_genres) AS item_genres,
       (SELECT count(*) FROM ratings) AS ratings"""))
def q_row_count_audit(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return cleaning.row_count_audit(d.users, d.items, d.genres, d.item_genres, d.ratings)


# --------------------------------------------------------------------- split


@register("min_activity_filter", with_views("r1", f"""
SELECT rating_id, user_id, item_id, rating, {_epoch('ts')} AS timestamp FROM ratings
WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= 5)"""))
def q_min_activity_filter(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    f = split_ops.min_activity_filter(d.ratings, 5)
    return f.select("rating_id", "user_id", "item_id", "rating",
                    epoch_seconds("ts").alias("timestamp"))


@register("split_by_time", with_views("r1", """
SELECT rating_id, user_id, item_id, rating, is_test FROM labelled"""))
def q_split_by_time(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return (d.train.select("rating_id", "user_id", "item_id", "rating", F.lit(False).alias("is_test"))
            .unionByName(d.test.select("rating_id", "user_id", "item_id", "rating",
                                       F.lit(True).alias("is_test"))))


@register("split_by_time_r2", with_views("r2", """
SELECT rating_id, user_id, item_id, rating, is_test FROM labelled"""))
def q_split_by_time_r2(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return (d.train.select("rating_id", "user_id", "item_id", "rating", F.lit(False).alias("is_test"))
            .unionByName(d.test.select("rating_id", "user_id", "item_id", "rating",
                                       F.lit(True).alias("is_test"))))


@register("split_stats", with_views("r1", """
SELECT dataset, count, unique_users, unique_items, avg_rating,
       count / NULLIF(sum(count) OVER (), 0) AS ratio FROM (
  SELECT 'Train' AS dataset, count(*) AS count, count(DISTINCT user_id) AS unique_users,
         count(DISTINCT item_id) AS unique_items, sum(rating) / count(rating) AS avg_rating FROM train
  UNION ALL
  SELECT 'Test', count(*), count(DISTINCT user_id), count(DISTINCT item_id),
         sum(rating) / count(rating) FROM test)"""))
def q_split_stats(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return split_ops.split_stats(d.train, d.test)


# ------------------------------------------------------------------- profile


@register("rating_distribution", with_views("r1", """
SELECT rating, count(*) AS count, count(*) / sum(count(*)) OVER () AS share,
       (SELECT sum(rating) / count(rating) FROM ratings) AS mean_rating,
       (SELECT CAST(median(rating) AS DOUBLE) FROM ratings) AS median_rating,
       (SELECT sqrt((sum(rating * rating) - sum(rating) * sum(rating) / CAST(count(rating) AS DOUBLE))
                    / (CAST(count(rating) AS DOUBLE) - 1.0)) FROM ratings) AS std_rating
FROM ratings GROUP BY rating"""))
def q_rating_distribution(spark, sf_dir):
    return profile.rating_distribution(datasets.load(spark, sf_dir, "r1").ratings)


def _bucket_sql(key: str, unit: str, edges: list[tuple[str, int | None, int | None]]) -> str:
    whens = []
    for label, lo, hi in edges:
        conds = ([f"n >= {lo}"] if lo is not None else []) + ([f"n <= {hi}"] if hi is not None else [])
        whens.append(f"WHEN {' AND '.join(conds)} THEN '{label}'")
    return f"""
SELECT CASE {' '.join(whens)} END AS bucket, count(*) AS {unit},
       (SELECT min(n) FROM c) AS min_ratings,
       (SELECT CAST(median(n) AS DOUBLE) FROM c) AS median_ratings,
       (SELECT max(n) FROM c) AS max_ratings
FROM c GROUP BY 1"""


@register("user_activity_profile", with_views(
    "r1", _bucket_sql("user_id", "users", profile.USER_BUCKETS),
    "c AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)"))
def q_user_activity_profile(spark, sf_dir):
    return profile.user_activity_profile(datasets.load(spark, sf_dir, "r1").ratings)


@register("item_popularity_profile", with_views(
    "r1", _bucket_sql("item_id", "items", profile.ITEM_BUCKETS),
    "c AS (SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id)"))
def q_item_popularity_profile(spark, sf_dir):
    return profile.item_popularity_profile(datasets.load(spark, sf_dir, "r1").ratings)


@register("top_rated_items_by_count", with_views("r1", """
SELECT * FROM (
  SELECT s.item_id, i.title, i.release_year, s.rating_count, s.avg_rating,
         row_number() OVER (ORDER BY s.rating_count DESC, s.item_id) AS rank
  FROM (SELECT item_id, count(*) AS rating_count, sum(rating) / count(*) AS avg_rating
        FROM ratings GROUP BY item_id) s JOIN items i ON s.item_id = i.item_id)
WHERE rank <= 10"""))
def q_top_rated_items_by_count(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return profile.top_rated_items_by_count(d.ratings, d.items, 10)


@register("matrix_stats", with_views("r1", """
SELECT n_users, n_items, nnz,
       100.0 * (1.0 - nnz / NULLIF(CAST(n_users AS DOUBLE) * CAST(n_items AS DOUBLE), 0)) AS sparsity_pct
FROM (SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
             count(*) AS nnz FROM train)"""))
def q_matrix_stats(spark, sf_dir):
    return profile.matrix_stats(datasets.load(spark, sf_dir, "r1").train)


@register("genre_profile", with_views("r1", """
SELECT genre_name, rating_count, share, avg_rating,
       row_number() OVER (ORDER BY rating_count DESC, genre_name) AS rank_by_count,
       row_number() OVER (ORDER BY avg_rating DESC, genre_name) AS rank_by_avg
FROM (SELECT g.genre_name, count(*) AS rating_count,
             count(*) / (SELECT count(*) FROM ratings) AS share,
             sum(r.rating) / count(*) AS avg_rating
      FROM ratings r JOIN item_genres ig ON r.item_id = ig.item_id
      JOIN genres g ON ig.genre_id = g.genre_id GROUP BY g.genre_name)"""))
def q_genre_profile(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return profile.genre_profile(d.ratings, d.item_genres, d.genres)


# --------------------------------------------------------------------- genre

GENRE_M = 20

_PREF_CTE = """
user_genre_scores AS (
  SELECT t.user_id, ig.genre_id, g.genre_name, count(*) AS rating_count, sum(t.rating) AS pref
  FROM train t JOIN item_genres ig ON t.item_id = ig.item_id
  JOIN genres g ON ig.genre_id = g.genre_id
  GROUP BY t.user_id, ig.genre_id, g.genre_name HAVING count(*) >= 3)"""


@register("user_genre_preference", with_views("r1", f"""
SELECT user_id, rank, genre_name, rating_count, avg_rating, preference_score FROM (
  SELECT user_id, genre_name, rating_count, {rnd('pref / rating_count', 2)} AS avg_rating,
         {rnd('pref', 2)} AS preference_score,
         row_number() OVER (PARTITION BY user_id ORDER BY {rnd('pref', 2)} DESC, genre_name) AS rank
  FROM user_genre_scores) WHERE rank <= 3""", _PREF_CTE))
def q_user_genre_preference(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return genre_ops.user_genre_preference(d.train, d.item_genres, d.genres)


def _genre_rec_sql(n: int, m: int, top_g: int = 3) -> tuple[str, str]:
    """Naive all-user form: every unseen item of a user's top genres is scored."""
    ctes = _PREF_CTE + "," + _stats_cte("item_wr", m) + f""",
top_user_genres AS (
  SELECT user_id, genre_id, genre_name, pref FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pref DESC, genre_name) AS grn
    FROM user_genre_scores) WHERE grn <= {top_g}),
unseen_in_genre AS (
  SELECT DISTINCT p.user_id, ig.item_id, p.genre_name, p.pref
  FROM top_user_genres p JOIN item_genres ig ON ig.genre_id = p.genre_id
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = p.user_id AND t.item_id = ig.item_id)),
scored_items AS (
  SELECT c.user_id, c.item_id, c.genre_name, s.v, s.r, s.wr, s.wr * (c.pref / 100.0) AS combined
  FROM unseen_in_genre c JOIN item_wr s ON c.item_id = s.item_id),
genre_recs AS (
  SELECT x.user_id,
         row_number() OVER (PARTITION BY x.user_id
                            ORDER BY x.combined DESC, x.wr DESC, x.item_id, x.genre_name) AS rank,
         x.item_id, i.title, i.release_year, x.genre_name AS preferred_genre, gs.genres,
         x.v AS rating_count, {rnd('x.r', 2)} AS avg_rating, {rnd('x.wr', 2)} AS weighted_rating,
         {rnd('x.combined', 2)} AS combined_score
  FROM scored_items x JOIN items i ON x.item_id = i.item_id
  LEFT JOIN genre_strings gs ON x.item_id = gs.item_id)"""
    return ctes, f"SELECT * FROM genre_recs WHERE rank <= {n}"


_ctes, _sel = _genre_rec_sql(10, GENRE_M)


@register("genre_recommendations", with_views("r1", _sel, _ctes))
def q_genre_recommendations(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return genre_ops.genre_recommendations(d.train, d.items, d.item_genres, d.genres,
                                           d.genre_strings, n=10, min_movie_ratings=GENRE_M)


# -------------------------------------------------------------------- lookup


@register("user_profile", with_views("r1", f"""
SELECT u.user_id, u.gender, u.age, u.occupation, count(t.rating) AS total_ratings,
       {rnd('sum(t.rating) / count(t.rating)', 2)} AS avg_rating
FROM users u LEFT JOIN train t ON u.user_id = t.user_id
GROUP BY u.user_id, u.gender, u.age, u.occupation"""))
def q_user_profile(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return lookup.user_profile(d.users, d.train)


@register("user_list", with_views(None, "SELECT DISTINCT user_id FROM users"))
def q_user_list(spark, sf_dir):
    return lookup.user_list(fixtures.users_view(spark, sf_dir))


_HISTORY = f"""
hist AS (
  SELECT t.user_id,
         row_number() OVER (PARTITION BY t.user_id ORDER BY t.rating DESC, t.ts DESC, t.item_id) AS rank,
         t.item_id, i.title, gs.genres, t.rating, {_epoch('t.ts')} AS timestamp
  FROM train t JOIN items i ON t.item_id = i.item_id
  LEFT JOIN genre_strings gs ON t.item_id = gs.item_id)"""


@register("watch_history", with_views("r1", "SELECT * FROM hist WHERE rank <= 50", _HISTORY))
def q_watch_history(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return lookup.watch_history(d.train, d.items, d.genre_strings, limit=50)


@register("history_rating_filter", with_views(
    "r1", "SELECT * FROM hist WHERE rank <= 50 AND rating >= 4.0", _HISTORY))
def q_history_rating_filter(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return lookup.history_rating_filter(
        lookup.watch_history(d.train, d.items, d.genre_strings, limit=50), 4.0)


SEARCH_TERM = "gear"


@register("title_search", with_views("r1", f"""
SELECT * FROM (
  SELECT item_id, title, genres, avg_rating, rating_count, distinct_rating_count,
         row_number() OVER (ORDER BY rating_count DESC, item_id) AS rank
  FROM (SELECT i.item_id, i.title,
               (SELECT string_agg(DISTINCT g.genre_name, '|' ORDER BY g.genre_name)
                FROM item_genres ig JOIN genres g ON ig.genre_id = g.genre_id
                WHERE ig.item_id = i.item_id) AS genres,
               coalesce((SELECT sum(t.rating) / count(t.rating) FROM train t WHERE t.item_id = i.item_id), 0.0) AS avg_rating,
               (SELECT count(t.rating) FROM items i2 LEFT JOIN item_genres ig ON i2.item_id = ig.item_id
                JOIN train t ON t.item_id = i2.item_id WHERE i2.item_id = i.item_id) AS rating_count,
               (SELECT count(t.rating) FROM train t WHERE t.item_id = i.item_id) AS distinct_rating_count
        FROM items i WHERE lower(i.title) LIKE '%{SEARCH_TERM}%'))
WHERE rank <= 20"""))
def q_title_search(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return lookup.title_search(d.items, d.item_genres, d.genres, d.train, SEARCH_TERM, 20)


# ---------------------------------------------------------------- similarity

SEED_MIN, SEED_LIMIT, MIN_COMMON = 30, None, 20  # all items with enough ratings


_SIMS: dict[tuple, tuple[DataFrame, DataFrame]] = {}


def similarity_table(d: datasets.RatingData, seed_min: int, min_common: int,
                     seed_limit: int | None = SEED_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(seed items, similarity table). Like the original's stored similarity
    table, the pairs are computed once per session and written under the
    checkpoint folder; the recommenders read the written table."""
    spark = d.train.sparkSession
    key = (app_id(spark), d.folder, d.kind, seed_min, min_common, seed_limit)
    if key not in _SIMS:
        seed = materialize(pop.similarity_seed_items(d.train, seed_min, seed_limit), "seed")
        sims = materialize(sim_ops.item_similarities(d.train, seed, min_common), "similarities")
        _SIMS[key] = (seed, sims)
    return _SIMS[key]


def r2_similarities(d: datasets.RatingData) -> tuple[DataFrame, DataFrame]:
    return similarity_table(d, SEED_MIN, MIN_COMMON)


def _sim_ctes(seed_min: int, seed_limit: int | None, min_common: int) -> str:
    cut = f" WHERE seed_rank <= {seed_limit}" if seed_limit else ""
    return f"""
seed AS (SELECT item_id, seed_rank FROM (
           SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS seed_rank
           FROM train GROUP BY item_id HAVING count(*) >= {seed_min}){cut}),
seed_ratings AS (SELECT t.user_id, t.item_id, t.rating, s.seed_rank FROM train t JOIN seed s USING (item_id)),
co_rated AS (
  SELECT x.item_id AS item_id_1, y.item_id AS item_id_2, count(*) AS common_users,
         sum(x.rating * y.rating) AS dot, sum(x.rating * x.rating) AS sq1, sum(y.rating * y.rating) AS sq2
  FROM seed_ratings x JOIN seed_ratings y ON x.user_id = y.user_id AND x.item_id < y.item_id
  GROUP BY x.item_id, y.item_id),
sims AS (SELECT item_id_1, item_id_2, common_users,
                {rnd('dot / (sqrt(sq1) * sqrt(sq2))', 4)} AS similarity_score
         FROM co_rated WHERE common_users >= {min_common} AND sq1 > 0 AND sq2 > 0),
edges AS (SELECT item_id_1 AS src, item_id_2 AS dst, similarity_score, common_users FROM sims
          UNION ALL
          SELECT item_id_2, item_id_1, similarity_score, common_users FROM sims),
liked_edges AS (
  SELECT t.user_id, e.src, e.dst, e.similarity_score, t.rating
  FROM train t JOIN edges e ON e.src = t.item_id
  WHERE t.rating >= 4.0
    AND NOT EXISTS (SELECT 1 FROM train w WHERE w.user_id = t.user_id AND w.item_id = e.dst))"""


_SIM_CTES = _sim_ctes(SEED_MIN, SEED_LIMIT, MIN_COMMON)


@register("item_similarities", with_views("r2", "SELECT * FROM sims", _SIM_CTES))
def q_item_similarities(spark, sf_dir):
    return r2_similarities(datasets.load(spark, sf_dir, "r2"))[1]


@register("pair_similarity", with_views("r2", f"""
SELECT x.item_id AS item_id_1, y.item_id AS item_id_2, count(*) AS common_users,
       CASE WHEN sum(x.rating * x.rating) > 0 AND sum(y.rating * y.rating) > 0
            THEN sum(x.rating * y.rating)
                 / (sqrt(sum(x.rating * x.rating)) * sqrt(sum(y.rating * y.rating)))
            ELSE 0.0 END AS similarity
FROM seed_ratings x JOIN seed_ratings y ON x.user_id = y.user_id AND x.seed_rank < y.seed_rank
GROUP BY x.item_id, y.item_id HAVING count(*) >= {MIN_COMMON}""", _SIM_CTES))
def q_pair_similarity(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    seed = pop.similarity_seed_items(d.train, SEED_MIN, SEED_LIMIT)
    return sim_ops.pair_similarity_batch(d.train, seed, MIN_COMMON)


@register("pair_similarity_pairs", with_views("r2", f"""
SELECT x.item_id AS item_id_1, y.item_id AS item_id_2, count(*) AS common_users,
       CASE WHEN sum(x.rating * x.rating) > 0 AND sum(y.rating * y.rating) > 0
            THEN sum(x.rating * y.rating)
                 / (sqrt(sum(x.rating * x.rating)) * sqrt(sum(y.rating * y.rating)))
            ELSE 0.0 END AS similarity
FROM seed_ratings x JOIN seed_ratings y ON x.user_id = y.user_id AND x.item_id < y.item_id
JOIN sims s ON s.item_id_1 = x.item_id AND s.item_id_2 = y.item_id
GROUP BY x.item_id, y.item_id HAVING count(*) >= {MIN_COMMON}""", _SIM_CTES))
def q_pair_similarity_pairs(spark, sf_dir):
    """F1 over a table of pairs: those of the stored similarity table."""
    d = datasets.load(spark, sf_dir, "r2")
    return sim_ops.pair_similarity(d.train, r2_similarities(d)[1].select("item_id_1", "item_id_2"), MIN_COMMON)


@register("similarity_summary", with_views("r2", """
SELECT (SELECT count(*) FROM seed) AS items,
       CAST((SELECT count(*) FROM seed) * ((SELECT count(*) FROM seed) - 1) / 2 AS BIGINT) AS possible_pairs,
       count(*) AS pairs_found,
       CAST(sum(CAST(similarity_score AS DECIMAL(6,4))) AS DOUBLE) / NULLIF(count(*), 0) AS score_mean,
       median(similarity_score) AS score_median, min(similarity_score) AS score_min,
       max(similarity_score) AS score_max,
       CAST(sum(common_users) AS DOUBLE) / NULLIF(count(*), 0) AS common_mean,
       median(CAST(common_users AS DOUBLE)) AS common_median,
       min(common_users) AS common_min, max(common_users) AS common_max,
       count(*) / NULLIF(CAST((SELECT count(*) FROM seed) * ((SELECT count(*) FROM seed) - 1) / 2 AS BIGINT), 0)
         * 100.0 AS coverage_pct
FROM sims""", _SIM_CTES))
def q_similarity_summary(spark, sf_dir):
    seed, sims = r2_similarities(datasets.load(spark, sf_dir, "r2"))
    return sim_ops.similarity_summary(sims, seed)


@register("similar_items", with_views("r2", """
SELECT * FROM (
  SELECT e.src AS item_id,
         row_number() OVER (PARTITION BY e.src ORDER BY e.similarity_score DESC, e.dst) AS rank,
         e.dst AS similar_item_id, i.title, gs.genres, e.similarity_score, e.common_users
  FROM edges e JOIN items i ON i.item_id = e.dst LEFT JOIN genre_strings gs ON gs.item_id = e.dst)
WHERE rank <= 10""", _SIM_CTES))
def q_similar_items(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return sim_ops.similar_items(r2_similarities(d)[1], d.items, d.genre_strings, n=10)


_CF_AGG = """,
cf_agg AS (
  SELECT user_id, dst AS item_id,
         sum(CAST(similarity_score AS DECIMAL(6,4)) * CAST(rating AS DECIMAL(3,1))) AS exact,
         count(DISTINCT src) AS based_on_count,
         string_agg(DISTINCT CAST(src AS VARCHAR), ',' ORDER BY CAST(src AS VARCHAR)) AS based_on_items
  FROM liked_edges GROUP BY user_id, dst),
cf_recs AS (
  SELECT c.user_id, row_number() OVER (PARTITION BY c.user_id ORDER BY c.exact DESC, c.item_id) AS rank,
         c.item_id, i.title, gs.genres,
         CAST(round(c.exact * CAST(0.2 AS DECIMAL(2,1)), 4) AS DOUBLE) AS recommendation_score,
         c.based_on_count, c.based_on_items
  FROM cf_agg c JOIN items i ON i.item_id = c.item_id LEFT JOIN genre_strings gs ON gs.item_id = c.item_id)"""
_CF_CTES = _SIM_CTES + _CF_AGG


@register("cf_recommendations", with_views("r2", "SELECT * FROM cf_recs WHERE rank <= 10", _CF_CTES))
def q_cf_recommendations(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return sim_ops.cf_recommendations(d.train, r2_similarities(d)[1], d.items, d.genre_strings, n=10)


@register("cf_predicted_rating", with_views("r2", """
SELECT user_id, rank, item_id, predicted_rating, source_count FROM (
  SELECT user_id, item_id, predicted_rating, source_count,
         row_number() OVER (PARTITION BY user_id ORDER BY predicted_rating DESC, item_id) AS rank
  FROM (SELECT user_id, dst AS item_id,
               CAST(sum(CAST(similarity_score AS DECIMAL(6,4)) * CAST(rating AS DECIMAL(3,1))) AS DOUBLE)
               / NULLIF(CAST(sum(CAST(similarity_score AS DECIMAL(6,4))) AS DOUBLE), 0) AS predicted_rating,
               count(*) AS source_count
        FROM liked_edges GROUP BY user_id, dst HAVING count(*) >= 2))
WHERE rank <= 10""", _CF_CTES))
def q_cf_predicted_rating(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return sim_ops.cf_predicted_rating(d.train, r2_similarities(d)[1], n=10)


# ---------------------------------------------------------------- evaluation


EVAL_MIN_TEST, EVAL_LIMIT, K = 10, 1000, 10
R1_SEED_MIN, R1_MIN_COMMON = 20, 2


def r1_eval(d: datasets.RatingData) -> tuple[DataFrame, DataFrame]:
    users = met.eval_users(d.test)
    return users, met.ground_truth(d.test, users)


def r1_recommenders(d: datasets.RatingData, users: DataFrame, n: int = K) -> dict[str, DataFrame]:
    sims = similarity_table(d, R1_SEED_MIN, R1_MIN_COMMON)[1]
    return {
        "popularity": pop.popular_items_for_users(d.train, d.items, users, n=n, min_ratings=POP_M),
        "genre": genre_ops.genre_recommendations(d.train, d.items, d.item_genres, d.genres,
                                                 d.genre_strings, users=users, n=n,
                                                 min_movie_ratings=GENRE_M),
        "cf": sim_ops.cf_recommendations(d.train, sims, d.items, d.genre_strings, users=users, n=n),
    }


_EVAL_CTES = f"""
ev_users AS (SELECT DISTINCT user_id FROM test),
truth AS (SELECT u.user_id, t.item_id FROM ev_users u
          LEFT JOIN (SELECT user_id, item_id FROM test WHERE rating >= 4.0) t ON u.user_id = t.user_id),
""" + _pop_base(POP_M) + f""",
pop_recs AS (
  SELECT user_id, rank, item_id FROM (
    SELECT u.user_id, p.item_id,
           row_number() OVER (PARTITION BY u.user_id
                              ORDER BY p.weighted_rating DESC, p.rating_count DESC, p.item_id) AS rank
    FROM ev_users u CROSS JOIN pop p
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = p.item_id))
  WHERE rank <= {K})"""

_ALL_RECS_CTES = (_EVAL_CTES + "," + _genre_rec_sql(K, GENRE_M)[0] + ","
                  + _sim_ctes(R1_SEED_MIN, SEED_LIMIT, R1_MIN_COMMON) + _CF_AGG + f""",
stacked AS (
  SELECT 'popularity' AS algorithm, user_id, rank, item_id FROM pop_recs
  UNION ALL
  SELECT 'genre', user_id, rank, item_id FROM genre_recs
  WHERE rank <= {K} AND user_id IN (SELECT user_id FROM ev_users)
  UNION ALL
  SELECT 'cf', user_id, rank, item_id FROM cf_recs
  WHERE rank <= {K} AND user_id IN (SELECT user_id FROM ev_users))""")


def _metric_sql(recs: str, k: int, algos: list[str] | None = None) -> tuple[str, str]:
    """(ctes, select) computing hit rate / precision / recall of `recs`."""
    a = "algorithm, " if algos else ""
    base_x = (" CROSS JOIN (VALUES " + ", ".join(f"('{x}')" for x in algos) + ") v(algorithm)"
              if algos else "")
    join_a = " AND h.algorithm = b.algorithm" if algos else ""
    ctes = f"""
rk AS (SELECT DISTINCT {a}user_id, item_id FROM {recs} WHERE rank <= {k}),
ti AS (SELECT DISTINCT user_id, item_id FROM truth WHERE item_id IS NOT NULL),
hits AS (SELECT {a}user_id, count(*) AS hits FROM rk JOIN ti USING (user_id, item_id)
         GROUP BY {a}user_id),
sizes AS (SELECT user_id, count(*) AS n_truth FROM ti GROUP BY user_id),
base AS (SELECT * FROM (SELECT DISTINCT user_id FROM ev_users
                        WHERE user_id IN (SELECT user_id FROM truth)){base_x}),
pu AS (SELECT {'b.algorithm, ' if algos else ''}b.user_id, coalesce(h.hits, 0) AS hits,
              coalesce(s.n_truth, 0) AS n_truth
       FROM base b LEFT JOIN hits h ON h.user_id = b.user_id{join_a}
       LEFT JOIN sizes s ON s.user_id = b.user_id),
summary AS (
  SELECT {a}count(*) AS n_users,
         {mr('sum(CASE WHEN hits > 0 THEN 1 ELSE 0 END) / count(*)')} AS hit_rate,
         {mr(f'sum(hits) / (count(*) * {k})')} AS precision,
         {mr('sum(CASE WHEN n_truth > 0 THEN hits / n_truth ELSE 0.0 END) / count(*)')} AS recall,
         {k} AS k
  FROM pu {'GROUP BY algorithm' if algos else ''})"""
    return ctes, "SELECT * FROM summary"


@register("eval_users_heavy", with_views("r1", f"""
SELECT user_id, rating_count, user_rank FROM (
  SELECT user_id, count(*) AS rating_count,
         row_number() OVER (ORDER BY count(*) DESC, user_id) AS user_rank
  FROM test GROUP BY user_id HAVING count(*) >= {EVAL_MIN_TEST}) WHERE user_rank <= {EVAL_LIMIT}"""))
def q_eval_users_heavy(spark, sf_dir):
    return met.eval_users_heavy(datasets.load(spark, sf_dir, "r1").test, EVAL_LIMIT, EVAL_MIN_TEST)


@register("ground_truth", with_views("r1", "SELECT user_id, item_id FROM truth", _EVAL_CTES))
def q_ground_truth(spark, sf_dir):
    return r1_eval(datasets.load(spark, sf_dir, "r1"))[1]


@register("positive_test_items", with_views("r1", f"""
SELECT user_id, item_id, rating, {_epoch('ts')} AS timestamp FROM test WHERE rating >= 4.0"""))
def q_positive_test_items(spark, sf_dir):
    p = met.positive_test_items(datasets.load(spark, sf_dir, "r1").test)
    return p.select("user_id", "item_id", "rating", epoch_seconds("ts").alias("timestamp"))


@register("eval_users_first", with_views("r1", f"""
SELECT DISTINCT user_id FROM test WHERE rating >= 4.0 ORDER BY user_id LIMIT {EVAL_LIMIT}"""))
def q_eval_users_first(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return met.eval_users_first(met.positive_test_items(d.test), EVAL_LIMIT)


@register("relevance_stats", with_views("r1", f"""
SELECT count(DISTINCT user_id) AS n_users, count(item_id) AS total_relevant,
       {mr('count(item_id) / count(DISTINCT user_id)')} AS avg_relevant FROM truth""", _EVAL_CTES))
def q_relevance_stats(spark, sf_dir):
    return met.relevance_stats(r1_eval(datasets.load(spark, sf_dir, "r1"))[1])


def _pop_eval(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    users, truth = r1_eval(d)
    recs = pop.popular_items_for_users(d.train, d.items, users, n=K, min_ratings=POP_M)
    return d, users, truth, recs


_m_ctes, _m_sel = _metric_sql("pop_recs", K)


@register("evaluate_recommendations", with_views("r1", _m_sel, _EVAL_CTES + "," + _m_ctes))
def q_evaluate_recommendations(spark, sf_dir):
    _, users, truth, recs = _pop_eval(spark, sf_dir)
    return met.evaluate_recommendations(recs, truth, users, K)


@register("hit_rate_at_k", with_views("r1", "SELECT n_users, k, hit_rate FROM summary",
                                      _EVAL_CTES + "," + _m_ctes))
def q_hit_rate_at_k(spark, sf_dir):
    _, users, truth, recs = _pop_eval(spark, sf_dir)
    return met.hit_rate_at_k(recs, truth, users, K)


@register("precision_at_k", with_views("r1", "SELECT n_users, k, precision FROM summary",
                                       _EVAL_CTES + "," + _m_ctes))
def q_precision_at_k(spark, sf_dir):
    _, users, truth, recs = _pop_eval(spark, sf_dir)
    return met.precision_at_k(recs, truth, users, K)


@register("recall_at_k", with_views("r1", "SELECT n_users, k, recall FROM summary",
                                    _EVAL_CTES + "," + _m_ctes))
def q_recall_at_k(spark, sf_dir):
    _, users, truth, recs = _pop_eval(spark, sf_dir)
    return met.recall_at_k(recs, truth, users, K)


@register("ndcg_at_k", with_views("r1", f"""
SELECT count(*) AS n_users,
       {mr('sum(CASE WHEN i.idcg > 0 THEN coalesce(d.dcg, 0.0) / i.idcg ELSE 0.0 END) / count(*)')} AS ndcg,
       {K} AS k
FROM (SELECT DISTINCT user_id FROM ev_users WHERE user_id IN (SELECT user_id FROM test)) b
LEFT JOIN (SELECT r.user_id, sum(t.rating / log2(r.rank + 1.0)) AS dcg
           FROM pop_recs r JOIN test t ON t.user_id = r.user_id AND t.item_id = r.item_id
           WHERE r.rank <= {K} GROUP BY r.user_id) d ON d.user_id = b.user_id
LEFT JOIN (SELECT user_id, sum(rating / log2(rn + 1.0)) AS idcg FROM (
             SELECT user_id, rating,
                    row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn
             FROM test) WHERE rn <= {K} GROUP BY user_id) i ON i.user_id = b.user_id""",
    _EVAL_CTES))
def q_ndcg_at_k(spark, sf_dir):
    d, users, _, recs = _pop_eval(spark, sf_dir)
    return met.ndcg_at_k(recs, d.test, users, K)


@register("rmse_lists", with_views("r1", f"""
SELECT count(*) AS n_pairs,
       {mr('coalesce(sqrt(avg(power(t.rating - s.r, 2))), 0.0)')} AS rmse
FROM test t JOIN (SELECT item_id, sum(rating) / count(*) AS r FROM train GROUP BY item_id) s
ON s.item_id = t.item_id"""))
def q_rmse_lists(spark, sf_dir):
    """RMSE of the item-mean predictor (the popularity recommender's avg_rating)
    against every test rating whose item has train ratings."""
    d = datasets.load(spark, sf_dir, "r1")
    item_mean = d.train.groupBy("item_id").agg((F.sum("rating") / F.count("rating")).alias("predicted"))
    pairs = d.test.select("item_id", F.col("rating").alias("actual")).join(item_mean, "item_id")
    return met.rmse(pairs)


_c_ctes, _ = _metric_sql("stacked", K, ["popularity", "genre", "cf"])


_COMPARE_SELECT = """
SELECT *, row_number() OVER (ORDER BY hit_rate DESC, algorithm) AS rank_by_hit,
       algorithm = first_value(algorithm) OVER (ORDER BY hit_rate DESC, algorithm
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS best_hit_rate,
       algorithm = first_value(algorithm) OVER (ORDER BY precision DESC, algorithm
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS best_precision,
       algorithm = first_value(algorithm) OVER (ORDER BY recall DESC, algorithm
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS best_recall
FROM summary"""


@register("compare_algorithms", with_views("r1", _COMPARE_SELECT, _ALL_RECS_CTES + "," + _c_ctes))
def q_compare_algorithms(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    users, truth = r1_eval(d)
    return met.compare_algorithms(r1_recommenders(d, users), truth, users, K)


@register("relative_improvement", with_views("r1", f"""
SELECT a.metric, 'popularity' AS base, 'genre' AS other, a.value AS base_value, b.value AS other_value,
       {mr('(b.value - a.value) / a.value * 100.0')} AS improvement_pct
FROM (UNPIVOT (SELECT * FROM summary WHERE algorithm = 'popularity')
      ON hit_rate, precision, recall INTO NAME metric VALUE value) a
JOIN (UNPIVOT (SELECT * FROM summary WHERE algorithm = 'genre')
      ON hit_rate, precision, recall INTO NAME metric VALUE value) b ON a.metric = b.metric""",
    _ALL_RECS_CTES + "," + _c_ctes))
def q_relative_improvement(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    users, truth = r1_eval(d)
    recs = r1_recommenders(d, users)
    m = met.compare_algorithms({k: recs[k] for k in ("popularity", "genre")}, truth, users, K)
    return met.relative_improvement(m, "popularity", "genre")


# ------------------------------------------------------------------- factors

SVD_K = 20
_MODELS: dict[tuple, fac.SVDModel] = {}


def trained_model(spark, sf_dir: str, kind: str = "r2", k: int = SVD_K) -> fac.SVDModel:
    key = (app_id(spark), sf_dir, kind, k)
    if key not in _MODELS:
        _MODELS[key] = fac.svd_train(datasets.load(spark, sf_dir, kind).train, k=k)
    return _MODELS[key]


@register("rating_matrix", with_views("r2", """
SELECT t.user_id, t.item_id, CAST(dense_rank() OVER (ORDER BY t.item_id) - 1 AS BIGINT) AS item_idx,
       t.rating - (SELECT sum(rating) / count(rating) FROM train) AS value
FROM train t"""))
def q_rating_matrix(spark, sf_dir):
    return fac.rating_matrix(datasets.load(spark, sf_dir, "r2").train)[0]


@register("svd_train")
def q_svd_train(spark, sf_dir):
    m = trained_model(spark, sf_dir)
    return spark.createDataFrame([(i, s) for i, s in enumerate(m.singular_values)],
                                 "factor int, singular_value double")


# as many factors as the rank allows (fewer users than k at the smallest size)
_RESIDUAL_SQL = f"""
SELECT factor::INTEGER AS factor, true AS solves_items, true AS solves_users, true AS unit_length, true AS in_order
FROM (SELECT unnest(range({SVD_K})) AS factor)
WHERE factor < (SELECT least(count(DISTINCT user_id), count(DISTINCT item_id)) FROM train)"""


def _residuals(spark, sf_dir: str, kind: str) -> DataFrame:
    """Whether each stored factor of the truncated model is a singular vector of the
    ratings, to 1e-6: the ratings are multiplied with the stored tables again."""
    m = trained_model(spark, sf_dir, kind)
    falling = [a >= b for a, b in zip(m.singular_values, [*m.singular_values[1:], 0.0])]
    order = F.broadcast(spark.createDataFrame(list(enumerate(falling)), "factor int, in_order boolean"))  # k rows
    return fac.svd_residuals(m, datasets.load(spark, sf_dir, kind).train).join(order, "factor").select(
        "factor", (F.col("item_residual") <= 1e-6).alias("solves_items"), (F.col("user_residual") <= 1e-9).alias("solves_users"),
        (F.abs(F.col("length") - 1) <= 1e-9).alias("unit_length"), "in_order")


@register("svd_residuals_r1", with_views("r1", _RESIDUAL_SQL))
def q_svd_residuals_r1(spark, sf_dir):
    return _residuals(spark, sf_dir, "r1")


@register("svd_residuals_r2", with_views("r2", _RESIDUAL_SQL))
def q_svd_residuals_r2(spark, sf_dir):
    return _residuals(spark, sf_dir, "r2")


@register("svd_predict")
def q_svd_predict(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return fac.svd_predict(trained_model(spark, sf_dir), d.test.select("user_id", "item_id"))


@register("svd_recommendations")
def q_svd_recommendations(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return fac.svd_recommendations(trained_model(spark, sf_dir), d.train, d.items,
                                   d.genre_strings, n=10)


@register("model_save_load")
def q_model_save_load(spark, sf_dir):
    """Round trip through Parquet; the reloaded model predicts the test pairs."""
    d = datasets.load(spark, sf_dir, "r2")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparkrec/models/svd-{uuid.uuid4().hex[:8]}"
    fac.model_save(trained_model(spark, sf_dir), path)
    return fac.svd_predict(fac.model_load(spark, path), d.test.select("user_id", "item_id"))


@register("rmse_pairs")
def q_rmse_pairs(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    pred = fac.svd_predict(trained_model(spark, sf_dir),
                           d.test.select("user_id", "item_id", F.col("rating").alias("actual")))
    return met.rmse(pred.withColumnRenamed("predicted_rating", "predicted"))


# At full rank the model is known without an SVD: A = U S V^T exactly, so a rated
# cell predicts its own rating (clipped to 1..5), any other cell the global mean,
# and the squared singular values add up to the squared entries of A.
FULL_RANK = 128  # r2 has 100 items

_FULL_CTES = """
mu AS (SELECT sum(rating) / count(*) AS mu FROM train),
ml_recs AS (
  SELECT u.user_id, row_number() OVER (PARTITION BY u.user_id ORDER BY i.item_id) AS rank, i.item_id,
         ROUND(mu.mu, 10) AS predicted_rating
  FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN (SELECT DISTINCT item_id FROM train) i CROSS JOIN mu
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = i.item_id))"""

_FULL_PREDICT = """
SELECT l.user_id, l.item_id,
       ROUND(CASE WHEN l.is_test THEN mu.mu ELSE greatest(1.0, least(5.0, l.rating)) END, 6) AS predicted_rating
FROM labelled l CROSS JOIN mu"""


def _predict_all(spark, sf_dir: str, model: fac.SVDModel) -> DataFrame:
    d = datasets.load(spark, sf_dir, "r2")
    pairs = d.train.unionByName(d.test).select("user_id", "item_id")
    return fac.svd_predict(model, pairs).select(
        "user_id", "item_id", F.round("predicted_rating", 6).alias("predicted_rating"))


@register("svd_train_full_rank", with_views("r2", """
SELECT ROUND(sum((rating - mu.mu) * (rating - mu.mu)), 4) AS energy, ROUND(max(mu.mu), 6) AS global_mean
FROM train CROSS JOIN mu""", _FULL_CTES))
def q_svd_train_full_rank(spark, sf_dir):
    m = trained_model(spark, sf_dir, k=FULL_RANK)
    energy = sum(x * x for x in m.singular_values)
    return spark.createDataFrame([(round(energy, 4), round(m.global_mean, 6))], "energy double, global_mean double")


@register("svd_predict_full_rank", with_views("r2", _FULL_PREDICT, _FULL_CTES))
def q_svd_predict_full_rank(spark, sf_dir):
    """G3 for every train and test cell."""
    return _predict_all(spark, sf_dir, trained_model(spark, sf_dir, k=FULL_RANK))


@register("model_save_load_full_rank", with_views("r2", _FULL_PREDICT, _FULL_CTES))
def q_model_save_load_full_rank(spark, sf_dir):
    """The same predictions from the model written and read again."""
    path = _scratch(spark, "svd-full")
    fac.model_save(trained_model(spark, sf_dir, k=FULL_RANK), path)
    return _predict_all(spark, sf_dir, fac.model_load(spark, path))


@register("svd_recommendations_full_rank", with_views("r2", """
SELECT r.user_id, r.rank, r.item_id, i.title, gs.genres, r.predicted_rating
FROM ml_recs r JOIN items i ON i.item_id = r.item_id LEFT JOIN genre_strings gs ON gs.item_id = r.item_id
WHERE r.rank <= 10""", _FULL_CTES))
def q_svd_recommendations_full_rank(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return fac.svd_recommendations(trained_model(spark, sf_dir, k=FULL_RANK), d.train, d.items, d.genre_strings, n=10)


@register("rmse_pairs_full_rank", with_views("r2", """
SELECT count(*) AS n_pairs, ROUND(sqrt(avg((t.rating - mu.mu) * (t.rating - mu.mu))), 6) AS rmse
FROM test t CROSS JOIN mu""", _FULL_CTES))
def q_rmse_pairs_full_rank(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    pred = fac.svd_predict(trained_model(spark, sf_dir, k=FULL_RANK),
                           d.test.select("user_id", "item_id", F.col("rating").alias("actual")))
    return met.rmse(pred.withColumnRenamed("predicted_rating", "predicted")).withColumn("rmse", F.round("rmse", 6))


# -------------------------------------------------------------------- hybrid

HYB_M = 30


_POOLS: dict[tuple, DataFrame] = {}


def r2_pools(spark, sf_dir: str, k: int | None = None) -> DataFrame:
    """Every train user's candidates by genre and item CF, and by the factor model of
    rank `k` if given: user_id, item_id, algo, score, rank. Written once a session;
    hybrid, comparison and sweep read the same tables, each recommender runs once."""
    d = datasets.load(spark, sf_dir, "r2")

    def pool(name: str, recs: Callable[[], DataFrame], score: Column) -> DataFrame:
        key = (app_id(spark), sf_dir, name)
        if key not in _POOLS:
            _POOLS[key] = materialize(recs().select("user_id", "item_id", F.lit(name.split("-")[0]).alias("algo"), score.cast("double").alias("score"), "rank"), f"pool_{name}")
        return _POOLS[key]

    out = pool("genre", lambda: genre_ops.genre_pool(d.train, d.item_genres, d.genres, n=hyb.POOL, min_movie_ratings=HYB_M),
               round_half_up("combined", 2))
    out = out.unionByName(pool("similarity", lambda: sim_ops.cf_pool(d.train, r2_similarities(d)[1], n=hyb.POOL), F.col("recommendation_score")))
    if k is not None:
        out = out.unionByName(pool(f"ml-{k}", lambda: fac.svd_pool(trained_model(spark, sf_dir, k=k), d.train, n=hyb.POOL), F.col("predicted_rating")))
    return out


def r2_candidates(spark, sf_dir: str, with_ml: bool, users: DataFrame | None = None,
                  k: int = SVD_K) -> tuple[datasets.RatingData, DataFrame]:
    """H1: the candidates of the given users (all train users by default), who are train users."""
    d = datasets.load(spark, sf_dir, "r2")
    pools = r2_pools(spark, sf_dir, k if with_ml else None).drop("rank")
    if users is None:
        users = d.train.select("user_id").distinct()
    else:
        pools = pools.join(users.select("user_id").distinct(), "user_id", "left_semi")
    top = pop.popular_items(d.train, d.items, n=hyb.POOL, min_ratings=HYB_M)
    popular = hyb.hybrid_candidates({"popularity": hyb.global_pool(top, users, hyb.POOL)})
    return d, popular.unionByName(pools.select(popular.columns))


_HYB_CTES = (_pop_base(HYB_M) + "," + _genre_rec_sql(hyb.POOL, HYB_M)[0] + "," + _CF_CTES + f""",
hyb_users AS (SELECT DISTINCT user_id FROM train),
cand AS (
  SELECT u.user_id, p.item_id, 'popularity' AS algo, p.weighted_rating AS score
  FROM hyb_users u CROSS JOIN (SELECT * FROM (SELECT *, row_number() OVER (
      ORDER BY weighted_rating DESC, rating_count DESC, item_id) AS rk FROM pop) WHERE rk <= {hyb.POOL}) p
  UNION ALL
  SELECT user_id, item_id, 'genre', combined_score FROM genre_recs WHERE rank <= {hyb.POOL}
  UNION ALL
  SELECT user_id, item_id, 'similarity', recommendation_score FROM cf_recs WHERE rank <= {hyb.POOL}),
wide AS (
  SELECT user_id, item_id,
         max(CASE WHEN algo = 'popularity' THEN score END) AS weighted_rating,
         min(CASE WHEN algo = 'genre' THEN score END) AS combined_score,
         max(CASE WHEN algo = 'similarity' THEN score END) AS recommendation_score,
         max(CASE WHEN algo = 'ml' THEN score END) AS predicted_rating
  FROM cand GROUP BY user_id, item_id)""")


def _norm_sql(col: str, name: str) -> str:
    x = f"coalesce({col}, 0.0)"
    lo, hi = f"min({x}) OVER u", f"max({x}) OVER u"
    return (f"CASE WHEN max(CASE WHEN {col} IS NOT NULL THEN 1 ELSE 0 END) OVER u = 0 THEN 0.0 "
            f"WHEN abs({lo} - {hi}) <= 1e-8 + 1e-5 * abs({hi}) THEN 1.0 "
            f"ELSE ({x} - {lo}) / ({hi} - {lo}) END AS {name}")


_NORM_CTE = f""",
norm AS (
  SELECT user_id, item_id, weighted_rating, combined_score, recommendation_score, predicted_rating,
         {_norm_sql('weighted_rating', 'popularity_norm')},
         {_norm_sql('combined_score', 'genre_norm')},
         {_norm_sql('recommendation_score', 'similarity_norm')},
         {_norm_sql('predicted_rating', 'ml_norm')}
  FROM wide WINDOW u AS (PARTITION BY user_id)),
blend AS (
  SELECT *, 0.1 * popularity_norm + 0.2 * genre_norm + 0.3 * similarity_norm + 0.4 * ml_norm
            AS hybrid_score FROM norm),
details AS (
  SELECT i.item_id, i.title,
         (SELECT string_agg(DISTINCT g.genre_name, '|' ORDER BY g.genre_name)
          FROM item_genres ig JOIN genres g ON ig.genre_id = g.genre_id WHERE ig.item_id = i.item_id) AS genres,
         (SELECT sum(t.rating) / count(t.rating) FROM train t WHERE t.item_id = i.item_id) AS avg_rating,
         (SELECT count(*) FROM train t WHERE t.item_id = i.item_id)
           * greatest(1, (SELECT count(*) FROM item_genres ig WHERE ig.item_id = i.item_id)) AS rating_count,
         (SELECT count(*) FROM train t WHERE t.item_id = i.item_id) AS distinct_rating_count
  FROM items i)"""


@register("hybrid_candidates", with_views("r2", "SELECT user_id, item_id, algo, score FROM cand",
                                          _HYB_CTES))
def q_hybrid_candidates(spark, sf_dir):
    return r2_candidates(spark, sf_dir, with_ml=False)[1]


@register("hybrid_scores_wide", with_views("r2", "SELECT * FROM wide", _HYB_CTES))
def q_hybrid_scores_wide(spark, sf_dir):
    return hyb.hybrid_scores_wide(r2_candidates(spark, sf_dir, with_ml=False)[1])


@register("min_max_normalize", with_views("r2", "SELECT * FROM norm", _HYB_CTES + _NORM_CTE))
def q_min_max_normalize(spark, sf_dir):
    return hyb.min_max_normalize(hyb.hybrid_scores_wide(r2_candidates(spark, sf_dir, False)[1]))


@register("hybrid_blend", with_views("r2", "SELECT * FROM blend", _HYB_CTES + _NORM_CTE))
def q_hybrid_blend(spark, sf_dir):
    wide = hyb.hybrid_scores_wide(r2_candidates(spark, sf_dir, False)[1])
    return hyb.hybrid_blend(hyb.min_max_normalize(wide))


@register("item_details", with_views("r2", "SELECT * FROM details", _HYB_CTES + _NORM_CTE))
def q_item_details(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r2")
    return hyb.item_details(d.items, d.item_genres, d.genres, d.train)


@register("hybrid_recommendations_no_ml", with_views("r2", """
SELECT * FROM (
  SELECT b.user_id, row_number() OVER (PARTITION BY b.user_id ORDER BY b.hybrid_score DESC, b.item_id) AS rank,
         b.item_id, d.title, d.genres, d.avg_rating, d.rating_count, b.hybrid_score
  FROM blend b JOIN details d ON d.item_id = b.item_id) WHERE rank <= 10""", _HYB_CTES + _NORM_CTE))
def q_hybrid_recommendations_no_ml(spark, sf_dir):
    """H5 when the factor model is unavailable: default weights, the ML term is 0."""
    d, cand = r2_candidates(spark, sf_dir, with_ml=False)
    return hyb.hybrid_recommendations(cand, hyb.item_details(d.items, d.item_genres, d.genres, d.train))


@register("hybrid_recommendations")
def q_hybrid_recommendations(spark, sf_dir):
    d, cand = r2_candidates(spark, sf_dir, with_ml=True)
    return hyb.hybrid_recommendations(cand, hyb.item_details(d.items, d.item_genres, d.genres, d.train))


_CF_POOL = f"SELECT user_id, item_id, 'similarity', recommendation_score FROM cf_recs WHERE rank <= {hyb.POOL})"
_ML_HYB_CTES = _FULL_CTES + "," + _HYB_CTES.replace(_CF_POOL, _CF_POOL[:-1] + f"""
  UNION ALL
  SELECT user_id, item_id, 'ml', predicted_rating FROM ml_recs WHERE rank <= {hyb.POOL})""")


@register("hybrid_recommendations_full_rank", with_views("r2", """
SELECT * FROM (
  SELECT b.user_id, row_number() OVER (PARTITION BY b.user_id ORDER BY b.hybrid_score DESC, b.item_id) AS rank,
         b.item_id, d.title, d.genres, d.avg_rating, d.rating_count, b.hybrid_score
  FROM blend b JOIN details d ON d.item_id = b.item_id) WHERE rank <= 10""", _ML_HYB_CTES + _NORM_CTE))
def q_hybrid_recommendations_full_rank(spark, sf_dir):
    """H5 with all four algorithms, the factor model at full rank."""
    d, cand = r2_candidates(spark, sf_dir, with_ml=True, k=FULL_RANK)
    return hyb.hybrid_recommendations(cand, hyb.item_details(d.items, d.item_genres, d.genres, d.train))


@register("two_way_blend", with_views("r2", """
SELECT user_id, item_id, genre_norm, similarity_norm,
       10.0 * (0.4 * genre_norm + 0.6 * similarity_norm) AS blend_score FROM (
  SELECT user_id, item_id,
         """ + _norm_sql('combined_score', 'genre_norm') + """,
         """ + _norm_sql('recommendation_score', 'similarity_norm') + """
  FROM (SELECT user_id, item_id,
               min(CASE WHEN algo = 'genre' THEN score END) AS combined_score,
               max(CASE WHEN algo = 'similarity' THEN score END) AS recommendation_score
        FROM cand WHERE algo IN ('genre', 'similarity') GROUP BY user_id, item_id)
  WINDOW u AS (PARTITION BY user_id))""", _HYB_CTES))
def q_two_way_blend(spark, sf_dir):
    return hyb.two_way_blend(r2_candidates(spark, sf_dir, with_ml=False)[1])


def _r2_eval(d: datasets.RatingData) -> tuple[DataFrame, DataFrame]:
    users = met.eval_users(d.test)
    return users, met.ground_truth(d.test, users)


@register("weight_sweep")
def q_weight_sweep(spark, sf_dir):
    """The five named weightings, candidates and normalisation computed once."""
    d = datasets.load(spark, sf_dir, "r2")
    users, truth = _r2_eval(d)
    _, cand = r2_candidates(spark, sf_dir, with_ml=True, users=users)
    norm = hyb.min_max_normalize(hyb.hybrid_scores_wide(cand))
    recs = hyb.sweep_recommendations(norm, hyb.WEIGHT_CONFIGS, n=K)
    return met.evaluate_recommendations(recs, truth, users, K, key="config",
                                        key_values=list(hyb.WEIGHT_CONFIGS))


_COMPARE_SVD_CTES = _EVAL_CTES + "," + _FULL_CTES + "," + _CF_CTES + f""",
stacked AS (
  SELECT 'popularity' AS algorithm, user_id, rank, item_id FROM pop_recs
  UNION ALL
  SELECT 'cf', user_id, rank, item_id FROM cf_recs WHERE rank <= {K} AND user_id IN (SELECT user_id FROM ev_users)
  UNION ALL
  SELECT 'svd', user_id, rank, item_id FROM ml_recs WHERE rank <= {K} AND user_id IN (SELECT user_id FROM ev_users))"""
_v_ctes, _ = _metric_sql("stacked", K, ["popularity", "cf", "svd"])


@register("compare_algorithms_svd_full_rank", with_views("r2", _COMPARE_SELECT, _COMPARE_SVD_CTES + "," + _v_ctes))
def q_compare_algorithms_svd_full_rank(spark, sf_dir):
    """I13 with the factor model (at full rank) beside popularity and item CF, on r2."""
    d = datasets.load(spark, sf_dir, "r2")
    users, truth = _r2_eval(d)
    return met.compare_algorithms({
        "popularity": pop.popular_items_for_users(d.train, d.items, users, n=K, min_ratings=POP_M),
        "cf": sim_ops.cf_recommendations(d.train, r2_similarities(d)[1], d.items, d.genre_strings, users=users, n=K),
        "svd": fac.svd_recommendations(trained_model(spark, sf_dir, k=FULL_RANK), d.train, d.items, d.genre_strings, users=users, n=K),
    }, truth, users, K)


_COMPARE_ALL_CTES = _ML_HYB_CTES + f""",
ev_users AS (SELECT DISTINCT user_id FROM test),
truth AS (SELECT u.user_id, t.item_id FROM ev_users u
          LEFT JOIN (SELECT user_id, item_id FROM test WHERE rating >= 4.0) t ON u.user_id = t.user_id),
pop_recs AS (
  SELECT user_id, rank, item_id FROM (
    SELECT u.user_id, p.item_id, row_number() OVER (
      PARTITION BY u.user_id ORDER BY p.weighted_rating DESC, p.rating_count DESC, p.item_id) AS rank
    FROM ev_users u CROSS JOIN pop p
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = p.item_id))
  WHERE rank <= {K}),
stacked AS (
  SELECT 'popularity' AS algorithm, user_id, rank, item_id FROM pop_recs
  UNION ALL
  SELECT 'genre', user_id, rank, item_id FROM genre_recs WHERE rank <= {K} AND user_id IN (SELECT user_id FROM ev_users)
  UNION ALL
  SELECT 'cf', user_id, rank, item_id FROM cf_recs WHERE rank <= {K} AND user_id IN (SELECT user_id FROM ev_users)
  UNION ALL
  SELECT 'svd', user_id, rank, item_id FROM ml_recs WHERE rank <= {K} AND user_id IN (SELECT user_id FROM ev_users))"""
_all_ctes, _ = _metric_sql("stacked", K, ["popularity", "genre", "cf", "svd"])


def _compare_all(spark, sf_dir: str, k: int) -> DataFrame:
    """I13 over all four algorithms, on r2; the pools' first ranks are the lists."""
    d = datasets.load(spark, sf_dir, "r2")
    users, truth = _r2_eval(d)
    lists = r2_pools(spark, sf_dir, k).filter(F.col("rank") <= K).join(users, "user_id", "left_semi")
    return met.compare_algorithms({
        "popularity": pop.popular_items_for_users(d.train, d.items, users, n=K, min_ratings=HYB_M),
        **{name: lists.filter(F.col("algo") == algo) for name, algo in (("genre", "genre"), ("cf", "similarity"), ("svd", "ml"))},
    }, truth, users, K)


@register("compare_algorithms_all_full_rank", with_views("r2", _COMPARE_SELECT, _COMPARE_ALL_CTES + "," + _all_ctes))
def q_compare_algorithms_all_full_rank(spark, sf_dir):
    return _compare_all(spark, sf_dir, FULL_RANK)


@register("compare_algorithms_all")
def q_compare_algorithms_all(spark, sf_dir):
    return _compare_all(spark, sf_dir, SVD_K)


def _sweep_sql() -> str:
    algos = ("popularity", "genre", "similarity", "ml")
    vals = ", ".join("('" + name + "', " + ", ".join(repr(float(w.get(a, 0.0))) for a in algos) + ")"
                     for name, w in hyb.WEIGHT_CONFIGS.items())
    return f""",
ev_users AS (SELECT DISTINCT user_id FROM test),
truth AS (SELECT u.user_id, t.item_id FROM ev_users u
          LEFT JOIN (SELECT user_id, item_id FROM test WHERE rating >= 4.0) t ON u.user_id = t.user_id),
sweep_recs AS (
  SELECT * FROM (
    SELECT c.config AS algorithm, n.user_id, n.item_id,
           row_number() OVER (PARTITION BY c.config, n.user_id
                              ORDER BY 0.0 + c.wp * popularity_norm + c.wg * genre_norm
                                       + c.ws * similarity_norm + c.wm * ml_norm DESC, n.item_id) AS rank
    FROM norm n CROSS JOIN (VALUES {vals}) c(config, wp, wg, ws, wm)) WHERE rank <= {K})"""


_s_ctes, _ = _metric_sql("sweep_recs", K, list(hyb.WEIGHT_CONFIGS))


@register("weight_sweep_full_rank", with_views(
    "r2", "SELECT algorithm AS config, n_users, hit_rate, precision, recall, k FROM summary",
    _ML_HYB_CTES + _NORM_CTE + _sweep_sql() + "," + _s_ctes))
def q_weight_sweep_full_rank(spark, sf_dir):
    """I15 with the factor model at full rank."""
    d = datasets.load(spark, sf_dir, "r2")
    users, truth = _r2_eval(d)
    _, cand = r2_candidates(spark, sf_dir, with_ml=True, users=users, k=FULL_RANK)
    norm = hyb.min_max_normalize(hyb.hybrid_scores_wide(cand))
    recs = hyb.sweep_recommendations(norm, hyb.WEIGHT_CONFIGS, n=K)
    return met.evaluate_recommendations(recs, truth, users, K, key="config",
                                        key_values=list(hyb.WEIGHT_CONFIGS)).select(
        "config", "n_users", "hit_rate", "precision", "recall", "k")


_GRID = hyb.two_weight_configs()


def _grid_sql() -> str:
    vals = ", ".join(f"('{name}', {w['genre']!r}, {w['similarity']!r})" for name, w in _GRID.items())
    return f""",
ev_users AS (SELECT DISTINCT user_id FROM test),
truth AS (SELECT u.user_id, t.item_id FROM ev_users u
          LEFT JOIN (SELECT user_id, item_id FROM test WHERE rating >= 4.0) t ON u.user_id = t.user_id),
g2 AS (
  SELECT user_id, item_id,
         {_norm_sql('combined_score', 'genre_norm')},
         {_norm_sql('recommendation_score', 'similarity_norm')}
  FROM (SELECT user_id, item_id,
               min(CASE WHEN algo = 'genre' THEN score END) AS combined_score,
               max(CASE WHEN algo = 'similarity' THEN score END) AS recommendation_score
        FROM cand WHERE algo IN ('genre', 'similarity') AND user_id IN (SELECT user_id FROM ev_users)
        GROUP BY user_id, item_id)
  WINDOW u AS (PARTITION BY user_id)),
grid_recs AS (
  SELECT * FROM (
    SELECT c.config AS algorithm, g2.user_id, g2.item_id,
           row_number() OVER (PARTITION BY c.config, g2.user_id
                              ORDER BY 0.0 + c.wg * g2.genre_norm + c.wc * g2.similarity_norm DESC,
                                       g2.item_id) AS rank
    FROM g2 CROSS JOIN (VALUES {vals}) c(config, wg, wc)) WHERE rank <= {K})"""


_g_ctes, _ = _metric_sql("grid_recs", K, list(_GRID))


@register("two_weight_grid", with_views(
    "r2", "SELECT algorithm AS config, n_users, hit_rate, precision, recall, k FROM summary",
    _HYB_CTES + _grid_sql() + "," + _g_ctes))
def q_two_weight_grid(spark, sf_dir):
    """I16: genre weight 0.1..0.5 with CF weight 1 - w, evaluated on all r2 test users."""
    d = datasets.load(spark, sf_dir, "r2")
    users, truth = _r2_eval(d)
    _, cand = r2_candidates(spark, sf_dir, with_ml=False, users=users)
    two = cand.filter(F.col("algo").isin("genre", "similarity"))
    norm = hyb.min_max_normalize(hyb.hybrid_scores_wide(two), ("genre", "similarity"))
    recs = hyb.sweep_recommendations(norm, _GRID, n=K)
    return met.evaluate_recommendations(recs, truth, users, K, key="config",
                                        key_values=list(_GRID)).select(
        "config", "n_users", "hit_rate", "precision", "recall", "k")


# --------------------------------------------------------- sources and sinks


def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for a file round trip."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/sparkrec/{app_id(spark)}/{name}-{uuid.uuid4().hex[:8]}"


@register("read_delimited", with_views("r1", f"""
SELECT 'users' AS file, concat_ws('::', user_id, gender, age, occupation, zip_code) AS line FROM users
UNION ALL SELECT 'movies', concat_ws('::', item_id, title, genres) FROM items_raw
UNION ALL SELECT 'ratings', concat_ws('::', user_id, item_id, rating, {_epoch('ts')}) FROM ratings"""))
def q_read_delimited(spark, sf_dir):
    """A1: the r1 users, items and ratings exported as `::` Latin-1 text, then
    read back with the fixed layouts; returns the rows of all three files."""
    d = datasets.load(spark, sf_dir, "r1")
    folder = _scratch(spark, "dat")
    delimited.write_delimited(d.users, f"{folder}/users.dat")
    delimited.write_delimited(d.items_raw, f"{folder}/movies.dat")
    delimited.write_delimited(
        d.ratings.select("user_id", "item_id", "rating", epoch_seconds("ts").alias("timestamp")),
        f"{folder}/ratings.dat")
    parts = [df.select(F.lit(name).alias("file"), F.concat_ws("::", *df.columns).alias("line"))
             for name, df in delimited.read_all(spark, folder).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("snapshot_write", with_views("r1", """
SELECT 'users' AS table_name, count(*) AS parquet_rows, count(*) AS csv_rows FROM users
UNION ALL SELECT 'movies', count(*), count(*) FROM items
UNION ALL SELECT 'genres', count(*), count(*) FROM genres
UNION ALL SELECT 'movie_genres', count(*), count(*) FROM item_genres
UNION ALL SELECT 'ratings', count(*), count(*) FROM ratings
UNION ALL SELECT 'ratings_train', count(*), count(*) FROM train
UNION ALL SELECT 'ratings_test', count(*), count(*) FROM test"""))
def q_snapshot_write(spark, sf_dir):
    """Every table replaced as a whole (Parquet) and exported as headed
    CSV; rows read back from both."""
    d = datasets.load(spark, sf_dir, "r1")
    tables = {"users": d.users, "movies": d.items, "genres": d.genres,
              "movie_genres": d.item_genres, "ratings": d.ratings,
              "ratings_train": d.train, "ratings_test": d.test}
    folder = _scratch(spark, "snapshot")
    pq = sinks.snapshot_write(tables, f"{folder}/parquet")
    csv = sinks.snapshot_write(tables, f"{folder}/csv", csv=True)
    out = None
    for name in tables:
        n_pq = spark.read.parquet(pq[name]).agg(F.count(F.lit(1))).scalar()
        part = spark.read.option("header", True).csv(csv[name]).agg(
            F.lit(name).alias("table_name"), n_pq.alias("parquet_rows"),
            F.count(F.lit(1)).alias("csv_rows"))
        out = part if out is None else out.unionByName(part)
    return out


_EXPORTS = {
    "users": ["user_id", "gender", "age", "occupation", "zip_code"],
    "movies": ["item_id", "title", "release_year"],
    "genres": ["genre_id", "genre_name"],
    "movie_genres": ["item_id", "genre_id"],
    "ratings_train": ["rating_id", "user_id", "item_id", "rating", "ts"],
    "ratings_test": ["rating_id", "user_id", "item_id", "rating", "ts"],
}
_EXPORT_VIEWS = {"movies": "items", "movie_genres": "item_genres", "ratings_train": "train", "ratings_test": "test"}


def _export_sql() -> str:
    parts = [f"SELECT '{name}' AS table_name, concat_ws('::', {', '.join(_epoch(c) if c == 'ts' else c for c in cols)}) AS line "
             f"FROM {_EXPORT_VIEWS.get(name, name)}" for name, cols in _EXPORTS.items()]
    return f"SELECT f.format, e.* FROM ({' UNION ALL '.join(parts)}) e CROSS JOIN (VALUES ('parquet'), ('csv')) f(format)"


@register("snapshot_values", with_views("r1", _export_sql()))
def q_snapshot_values(spark, sf_dir):
    """A first version whose train and test are swapped, then all tables replaced at
    once; every row of the newest version, read back from Parquet and from CSV."""
    d = datasets.load(spark, sf_dir, "r1")
    tables = {"users": d.users, "movies": d.items, "genres": d.genres, "movie_genres": d.item_genres,
              "ratings_train": d.train, "ratings_test": d.test}
    folder, out = _scratch(spark, "versions"), None
    for fmt in ("parquet", "csv"):
        sinks.snapshot_write({"ratings_train": d.test, "ratings_test": d.train}, f"{folder}/{fmt}", csv=fmt == "csv")
        sinks.snapshot_write(tables, f"{folder}/{fmt}", csv=fmt == "csv")
        newest = versions.current(spark, f"{folder}/{fmt}")
        for name, cols in _EXPORTS.items():
            line = F.concat_ws("::", *[epoch_seconds(c) if c == "ts" else F.col(c) for c in cols])
            part = versions.read(spark, f"{folder}/{fmt}", name, newest).select(
                F.lit(fmt).alias("format"), F.lit(name).alias("table_name"), line.alias("line"))
            out = part if out is None else out.unionByName(part)
    return out


@register("append_similarities", with_views("r2", "SELECT * FROM sims", _SIM_CTES))
def q_append_similarities(spark, sf_dir):
    """Create the similarity table, then append the same job's pairs again
    (a re-run); stored pairs are skipped, so each pair is stored once."""
    sims = r2_similarities(datasets.load(spark, sf_dir, "r2"))[1]
    path = _scratch(spark, "item_similarities")
    sinks.append_similarities(spark, sims, path)
    return sinks.append_similarities(spark, sims, path)


@register("append_similarities_batches", with_views("r2", """
SELECT row_number() OVER (ORDER BY item_id_1 % 2, item_id_1, item_id_2) AS similarity_id,
       item_id_1, item_id_2, common_users, similarity_score, CAST(1 + item_id_1 % 2 AS INTEGER) AS batch FROM sims""", _SIM_CTES))
def q_append_similarities_batches(spark, sf_dir):
    """The pairs of even first items, then all pairs in a second batch; ids go on
    from the first batch and its rows keep their time of creation."""
    sims = r2_similarities(datasets.load(spark, sf_dir, "r2"))[1]
    path = _scratch(spark, "similarity_batches")
    for day, batch in ((1, sims.filter("item_id_1 % 2 = 0")), (2, sims)):
        sinks.append_similarities(spark, batch, path, created_at=F.make_timestamp(*map(F.lit, (2024, 1, day, 0, 0, 0))))
    return sinks.similarity_table(spark, path).select(
        "similarity_id", *sims.columns, F.dayofmonth("created_at").alias("batch"))


# ------------------------------------------------------- requests for one user

ONE_USER = 7
_LAYOUTS: dict[tuple, str] = {}


def _one_users_train(spark, sf_dir: str, kind: str) -> DataFrame:
    """The train ratings of ONE_USER, from the split laid out by user (written once a session)."""
    key = (app_id(spark), sf_dir, kind)
    if key not in _LAYOUTS:
        path = _scratch(spark, f"train_by_user_{kind}")
        user_layout.write_by_user(datasets.load(spark, sf_dir, kind).train, path)
        _LAYOUTS[key] = path
    return user_layout.read_user(spark, _LAYOUTS[key], ONE_USER)


@register("popular_items_one_user", with_views("r1", f"""
SELECT * FROM (
  SELECT {ONE_USER}::BIGINT AS user_id, item_id, title, release_year, rating_count, avg_rating, weighted_rating,
         row_number() OVER (ORDER BY weighted_rating DESC, rating_count DESC, item_id) AS rank
  FROM pop WHERE item_id NOT IN (SELECT item_id FROM train WHERE user_id = {ONE_USER})) WHERE rank <= 10""", _pop_base(POP_M)))
def q_popular_items_one_user(spark, sf_dir):
    """D2 as the page asks for it: the ranked list is a stored table, one user's ratings are read."""
    d = datasets.load(spark, sf_dir, "r1")
    key = (app_id(spark), sf_dir, "ranked")
    if key not in _POOLS:
        _POOLS[key] = materialize(pop.popular_ranked(d.train, d.items, POP_M).orderBy("pop_rank"), "popular_ranked")
    return pop.popular_items_for_user(_POOLS[key], _one_users_train(spark, sf_dir, "r1"), n=10).withColumn(
        "user_id", F.lit(ONE_USER).cast("bigint"))


@register("user_profile_one_user", with_views("r1", f"""
SELECT u.user_id, u.gender, u.age, u.occupation, count(t.rating) AS total_ratings,
       {rnd('sum(t.rating) / count(t.rating)', 2)} AS avg_rating
FROM users u LEFT JOIN train t ON t.user_id = u.user_id WHERE u.user_id = {ONE_USER}
GROUP BY u.user_id, u.gender, u.age, u.occupation"""))
def q_user_profile_one_user(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return lookup.user_profile(d.users.filter(F.col("user_id") == ONE_USER), _one_users_train(spark, sf_dir, "r1"))


@register("watch_history_one_user", with_views("r1", f"SELECT * FROM hist WHERE rank <= 50 AND user_id = {ONE_USER}", _HISTORY))
def q_watch_history_one_user(spark, sf_dir):
    d = datasets.load(spark, sf_dir, "r1")
    return lookup.watch_history(_one_users_train(spark, sf_dir, "r1"), d.items, d.genre_strings, limit=50)


@register("svd_recommendations_one_user_full_rank", with_views("r2", f"""
SELECT r.user_id, r.rank, r.item_id, i.title, gs.genres, r.predicted_rating
FROM ml_recs r JOIN items i ON i.item_id = r.item_id LEFT JOIN genre_strings gs ON gs.item_id = r.item_id
WHERE r.rank <= 10 AND r.user_id = {ONE_USER}""", _FULL_CTES))
def q_svd_recommendations_one_user_full_rank(spark, sf_dir):
    """G4 for one user: the user's factors and ratings are all that is read of the users."""
    d = datasets.load(spark, sf_dir, "r2")
    m = trained_model(spark, sf_dir, k=FULL_RANK)
    mine = replace(m, user_factors=m.user_factors.filter(F.col("user_id") == ONE_USER))
    return fac.svd_recommendations(mine, _one_users_train(spark, sf_dir, "r2"), d.items, d.genre_strings, n=10)


_UNIFIED_SQL = f"""
SELECT * FROM (
  SELECT 'popularity' AS algorithm, u.user_id, p.rk AS rank, p.item_id, p.title,
         CAST(NULL AS VARCHAR) AS genres, p.weighted_rating AS score, p.avg_rating,
         CAST(p.rating_count AS BIGINT) AS rating_count
  FROM hyb_users u CROSS JOIN (SELECT * FROM (SELECT *, row_number() OVER (
      ORDER BY weighted_rating DESC, rating_count DESC, item_id) AS rk FROM pop) WHERE rk <= 10) p
  UNION ALL
  SELECT 'genre', user_id, rank, item_id, title, genres, {rnd('weighted_rating', 2)},
         {rnd('avg_rating', 2)}, CAST(rating_count AS BIGINT)
  FROM genre_recs WHERE rank <= 10
  UNION ALL
  SELECT 'similarity', user_id, rank, item_id, title, genres, {rnd('recommendation_score', 4)},
         CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)
  FROM cf_recs WHERE rank <= 10)"""


@register("unified_recommendations", with_views("r2", _UNIFIED_SQL, _HYB_CTES))
def q_unified_recommendations(spark, sf_dir):
    """J6 over popularity (global list), genre (min 30) and item CF for all users."""
    d = datasets.load(spark, sf_dir, "r2")
    users = d.train.select("user_id").distinct()
    sims = r2_similarities(d)[1]
    return lookup.unified_recommendations({
        "popularity": hyb.global_pool(pop.popular_items(d.train, d.items, n=10, min_ratings=HYB_M),
                                      users, 10),
        "genre": genre_ops.genre_recommendations(d.train, d.items, d.item_genres, d.genres,
                                                 d.genre_strings, n=10, min_movie_ratings=HYB_M),
        "similarity": sim_ops.cf_recommendations(d.train, sims, d.items, d.genre_strings, n=10),
    })


_UNIFIED_FULL_SQL = _UNIFIED_SQL.rstrip()[:-1] + f"""
  UNION ALL
  SELECT 'ml', r.user_id, r.rank, r.item_id, i.title, gs.genres, {rnd('r.predicted_rating', 2)},
         CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)
  FROM ml_recs r JOIN items i ON i.item_id = r.item_id LEFT JOIN genre_strings gs ON gs.item_id = r.item_id
  WHERE r.rank <= 10
  UNION ALL
  SELECT 'hybrid', h.user_id, h.rank, h.item_id, d.title, d.genres, {rnd('h.hybrid_score', 4)},
         {rnd('d.avg_rating', 2)}, CAST(d.rating_count AS BIGINT)
  FROM (SELECT user_id, item_id, hybrid_score,
               row_number() OVER (PARTITION BY user_id ORDER BY hybrid_score DESC, item_id) AS rank FROM blend) h
  JOIN details d ON d.item_id = h.item_id WHERE h.rank <= 10)"""


@register("unified_recommendations_all_full_rank", with_views("r2", _UNIFIED_FULL_SQL, _ML_HYB_CTES + _NORM_CTE))
def q_unified_recommendations_all_full_rank(spark, sf_dir):
    """J6 over all five algorithms, the factor model at full rank."""
    return _unified_all(spark, sf_dir, FULL_RANK)


@register("unified_recommendations_all")
def q_unified_recommendations_all(spark, sf_dir):
    """J6 over all five algorithms, including the factor model and the hybrid."""
    return _unified_all(spark, sf_dir, SVD_K)


def _unified_all(spark, sf_dir: str, k: int) -> DataFrame:
    d = datasets.load(spark, sf_dir, "r2")
    users = d.train.select("user_id").distinct()
    sims = r2_similarities(d)[1]
    _, cand = r2_candidates(spark, sf_dir, with_ml=True, k=k)
    return lookup.unified_recommendations({
        "popularity": hyb.global_pool(pop.popular_items(d.train, d.items, n=10, min_ratings=HYB_M),
                                      users, 10),
        "genre": genre_ops.genre_recommendations(d.train, d.items, d.item_genres, d.genres,
                                                 d.genre_strings, n=10, min_movie_ratings=HYB_M),
        "similarity": sim_ops.cf_recommendations(d.train, sims, d.items, d.genre_strings, n=10),
        "ml": fac.svd_recommendations(trained_model(spark, sf_dir, k=k), d.train, d.items,
                                      d.genre_strings, n=10),
        "hybrid": hyb.hybrid_recommendations(
            cand, hyb.item_details(d.items, d.item_genres, d.genres, d.train)),
    })
