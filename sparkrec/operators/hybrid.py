"""Weighted hybrid recommender (H1-H7) and weight sweeps.

Candidates of every algorithm are stacked into one long frame
(user_id, item_id, algo, score) and pivoted by conditional aggregation, so
per-user normalisation and blending are grouped aggregates and windows over
a user's candidate pool (bounded by pool size x algorithms).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.functions.columns import genre_string, is_close
from sparkrec.operators.ranking import top_n_per

# Fixed values of the original hybrid: algorithm names, default weights,
# candidate pool per algorithm, and the five named weightings it compares.
ALGOS = ("popularity", "genre", "similarity", "ml")
DEFAULT_WEIGHTS = {"popularity": 0.1, "genre": 0.2, "similarity": 0.3, "ml": 0.4}
POOL = 100
WEIGHT_CONFIGS = {
    "Default (ML-focused)": {"popularity": 0.1, "genre": 0.2, "similarity": 0.3, "ml": 0.4},
    "Balanced": {"popularity": 0.25, "genre": 0.25, "similarity": 0.25, "ml": 0.25},
    "CF-focused": {"popularity": 0.1, "genre": 0.2, "similarity": 0.5, "ml": 0.2},
    "Genre-focused": {"popularity": 0.1, "genre": 0.5, "similarity": 0.2, "ml": 0.2},
    "Pure ML": {"popularity": 0.0, "genre": 0.0, "similarity": 0.0, "ml": 1.0},
}
SCORE_COLUMN = {"popularity": "weighted_rating", "genre": "combined_score",
                "similarity": "recommendation_score", "ml": "predicted_rating"}


def check_weights(weights: Mapping[str, float] | None) -> dict[str, float]:
    """Default weights, or custom ones that must sum to 1 (numpy isclose)."""
    if weights is None:
        return dict(DEFAULT_WEIGHTS)
    total = sum(weights.values())
    if not abs(total - 1.0) <= 1e-8 + 1e-5 * 1.0:  # numpy.isclose(total, 1.0)
        raise ValueError(f"Weights must sum to 1.0, got {total}")
    return dict(weights)


def global_pool(popular_top: DataFrame, users: DataFrame, pool: int = POOL) -> DataFrame:
    """The same global list for every user: users x ranks 1..pool joined to the
    ranked list on rank (an equi-join with a list bounded by the pool size)."""
    u = users.select("user_id", F.explode(F.sequence(F.lit(1), F.lit(pool))).alias("rank"))
    return u.join(F.broadcast(popular_top), "rank")


def hybrid_candidates(results: Mapping[str, DataFrame]) -> DataFrame:
    """H1: stack each algorithm's pool (user_id, item_id, <its score column>)
    into (user_id, item_id, algo, score). Absent algorithms contribute nothing."""
    long = None
    for algo, df in results.items():
        part = df.select("user_id", "item_id", F.lit(algo).alias("algo"),
                         F.col(SCORE_COLUMN[algo]).cast("double").alias("score"))
        long = part if long is None else long.unionByName(part)
    return long


def hybrid_scores_wide(candidates: DataFrame) -> DataFrame:
    """H2: one row per (user, item) with each algorithm's score; for an item the
    genre recommender lists twice, the last (= lowest) score is kept."""
    aggs = []
    for algo in ALGOS:
        s = F.when(F.col("algo") == algo, F.col("score"))
        aggs.append((F.min(s) if algo == "genre" else F.max(s)).alias(SCORE_COLUMN[algo]))
    return candidates.groupBy("user_id", "item_id").agg(*aggs)


def min_max_normalize(wide: DataFrame, algos: Sequence[str] = ALGOS) -> DataFrame:
    """H3: per user and algorithm, (x - min) / (max - min) over the user's
    candidates with a missing score counted as 0; all equal (isclose) -> 1.0;
    an algorithm with no candidate for the user -> 0."""
    u = Window.partitionBy("user_id")
    out = wide
    for algo in algos:
        c = SCORE_COLUMN[algo]
        x = F.coalesce(F.col(c), F.lit(0.0))
        lo, hi = F.min(x).over(u), F.max(x).over(u)
        present = F.max(F.col(c).isNotNull().cast("int")).over(u) == 1
        norm = (F.when(~present, F.lit(0.0))
                 .when(is_close(lo, hi), F.lit(1.0))
                 .otherwise((x - lo) / (hi - lo)))
        out = out.withColumn(f"{algo}_norm", norm)
    return out


def hybrid_blend(normalized: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """H4: hybrid_score = sum of weight * normalised score (unknown names ignored)."""
    w = check_weights(weights)
    terms = [F.lit(float(w[a])) * F.col(f"{a}_norm") for a in ALGOS if a in w]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return normalized.withColumn("hybrid_score", total)


def item_details(items: DataFrame, item_genres: DataFrame, genres: DataFrame,
                 train: DataFrame) -> DataFrame:
    """H6: title, genre string, mean train rating, and rating_count as the
    original reports it (count x number of genre rows, from its join fan-out);
    distinct_rating_count is the true count."""
    per_item = train.groupBy("item_id").agg(F.count("rating").alias("_cnt"),
                                            F.sum("rating").alias("_sum"))
    g = (item_genres.join(genres, "genre_id").groupBy("item_id")
         .agg(F.count(F.lit(1)).alias("_rows"), genre_string(F.collect_set("genre_name")).alias("genres")))
    cnt = F.coalesce(F.col("_cnt"), F.lit(0))
    return (items.select("item_id", "title").join(g, "item_id", "left").join(per_item, "item_id", "left")
            .select("item_id", "title", "genres", (F.col("_sum") / F.col("_cnt")).alias("avg_rating"),
                    (cnt * F.coalesce(F.col("_rows"), F.lit(1))).alias("rating_count"),
                    cnt.alias("distinct_rating_count")))


def hybrid_recommendations(candidates: DataFrame, details: DataFrame,
                           weights: Mapping[str, float] | None = None, n: int = 10,
                           watched: DataFrame | None = None) -> DataFrame:
    """H5: blend, top n per user by hybrid score (ties by item_id), with item
    details. Rated items stay unless `watched` is given (the global popularity
    pool is not filtered in the original)."""
    blended = hybrid_blend(min_max_normalize(hybrid_scores_wide(candidates)), weights)
    if watched is not None:
        blended = blended.join(watched.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    top = top_n_per(blended, ["user_id"], [F.col("hybrid_score").desc(), F.col("item_id")], n)
    return top.join(details, "item_id").select(
        "user_id", "rank", "item_id", "title", "genres", "avg_rating", "rating_count",
        "hybrid_score")


def two_way_blend(candidates: DataFrame, w_genre: float = 0.4, w_cf: float = 0.6,
                  scale: float = 10.0) -> DataFrame:
    """H7 (documented variant): scale * (w_genre * norm(genre) + w_cf * norm(cf))
    with the same per-user min-max rules, on a 0..scale range."""
    two = candidates.filter(F.col("algo").isin("genre", "similarity"))
    norm = min_max_normalize(hybrid_scores_wide(two), ("genre", "similarity"))
    return norm.withColumn("blend_score", F.lit(scale) * (
        F.lit(w_genre) * F.col("genre_norm") + F.lit(w_cf) * F.col("similarity_norm"))) \
        .select("user_id", "item_id", "genre_norm", "similarity_norm", "blend_score")


def weights_frame(spark, configs: Mapping[str, Mapping[str, float]]) -> DataFrame:
    rows = [(name, *[float(w.get(a, 0.0)) for a in ALGOS]) for name, w in configs.items()]
    return spark.createDataFrame(rows, "config string, " + ", ".join(f"w_{a} double" for a in ALGOS))


def sweep_recommendations(normalized: DataFrame, configs: Mapping[str, Mapping[str, float]],
                          n: int = 10) -> DataFrame:
    """Top n per (config, user) for several weightings from ONE normalised
    score frame: the candidates and normalisation are computed once and each
    row is expanded once per configuration (a list bounded by the configs)."""
    for w in configs.values():
        check_weights(w)
    spark = normalized.sparkSession
    cfg = weights_frame(spark, configs)
    algos = [a for a in ALGOS if f"{a}_norm" in normalized.columns]
    x = normalized.select("user_id", "item_id", *[f"{a}_norm" for a in algos],
                          F.explode(F.array(*[F.lit(c) for c in configs])).alias("config"))
    x = x.join(F.broadcast(cfg), "config")
    score: Column = F.lit(0.0)
    for a in algos:
        score = score + F.col(f"w_{a}") * F.col(f"{a}_norm")
    x = x.withColumn("hybrid_score", score)
    return top_n_per(x, ["config", "user_id"], [F.col("hybrid_score").desc(), F.col("item_id")], n) \
        .select("config", "user_id", "rank", "item_id", "hybrid_score")


def two_weight_configs(steps: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5)) -> dict[str, dict[str, float]]:
    """I16 grid: genre weight w1, CF weight 1 - w1."""
    return {f"genre={w:.1f}": {"genre": w, "similarity": round(1.0 - w, 10)} for w in steps}
