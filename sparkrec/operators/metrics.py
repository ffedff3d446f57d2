"""Offline evaluation (I1-I14) as set-based jobs.

Recommendations are a DataFrame (user_id, rank, item_id[, score]), one row per
list position; ground truth is (user_id, item_id) with a null item for a user
who has no liked test item. Every metric takes the evaluated users explicitly,
so a user whose recommender returned nothing still counts (as a miss).

The original averages per-user fractions in floating point, whose last bits
depend on summation order; metric outputs are rounded to 12 decimals so the
result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.functions.columns import LIKED_RATING
from sparkrec.operators.ranking import number_rows, top_n_per

METRIC_SCALE = 12


def metric_round(c: Column) -> Column:
    return F.round(c.cast("decimal(38,18)"), METRIC_SCALE).cast("double")


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(num.cast("double") / F.nullif(den, F.lit(0)).cast("double"), F.lit(0.0))


# ------------------------------------------------------------ users & truth

def eval_users(test: DataFrame, min_ratings: int = 1) -> DataFrame:
    """All test users with at least `min_ratings` test ratings."""
    return (test.groupBy("user_id").agg(F.count(F.lit(1)).alias("rating_count"))
            .filter(F.col("rating_count") >= min_ratings).select("user_id"))


def eval_users_heavy(test: DataFrame, limit: int = 1000, min_ratings: int = 20) -> DataFrame:
    """The `limit` heaviest test users with >= min_ratings test ratings,
    most first (ties by id)."""
    c = (test.groupBy("user_id").agg(F.count(F.lit(1)).alias("rating_count"))
         .filter(F.col("rating_count") >= min_ratings))
    order = [F.col("rating_count").desc(), F.col("user_id").asc()]
    return number_rows(c.orderBy(*order).limit(limit), order, "user_rank")


def ground_truth(test: DataFrame, users: DataFrame, min_rating: float = LIKED_RATING) -> DataFrame:
    """Liked test items of the given users; a user without any keeps one
    row with a null item (an empty list that counts as a miss)."""
    liked = test.filter(F.col("rating") >= min_rating).select("user_id", "item_id")
    return users.select("user_id").distinct().join(liked, "user_id", "left")


def positive_test_items(test: DataFrame, min_rating: float = LIKED_RATING) -> DataFrame:
    """Liked test items per user; users without any are absent."""
    return test.filter(F.col("rating") >= min_rating).select("user_id", "item_id", "rating", "ts")


def eval_users_first(positive: DataFrame, sample: int = 1000) -> DataFrame:
    """I4: the first `sample` user ids (ascending) among users with liked test items."""
    return positive.select("user_id").distinct().orderBy("user_id").limit(sample)


def relevance_stats(truth: DataFrame) -> DataFrame:
    """Evaluated users, total liked test items and the mean per user."""
    s = truth.agg(F.countDistinct("user_id").alias("n_users"),
                  F.count("item_id").alias("total_relevant"))
    return s.withColumn("avg_relevant",
                        metric_round(_ratio(F.col("total_relevant"), F.col("n_users"))))


# ------------------------------------------------------------------ metrics

def _per_user_hits(recs: DataFrame, truth: DataFrame, users: DataFrame, k: int,
                   key: str | None = None, key_values: Sequence[str] = ()) -> DataFrame:
    """One row per ([config], user) in both `users` and the truth: hits in the
    top k (as a set) and the size of the truth set. With `key`, `recs` holds
    several configurations stacked and `key_values` names them all."""
    keys = [key] if key else []
    recs_k = recs.filter(F.col("rank") <= k).select(*keys, "user_id", "item_id").distinct()
    truth_items = truth.filter(F.col("item_id").isNotNull()).select("user_id", "item_id").distinct()
    hits = (recs_k.join(truth_items, ["user_id", "item_id"])
            .groupBy(*keys, "user_id").agg(F.count(F.lit(1)).alias("hits")))
    sizes = truth_items.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_truth"))
    base = (users.select("user_id").distinct()
            .join(truth.select("user_id").distinct(), "user_id", "left_semi"))
    if key:  # every evaluated user once per configuration
        base = base.select("user_id", F.explode(F.array(*[F.lit(v) for v in key_values])).alias(key))
    return (base.join(hits, [*keys, "user_id"], "left").join(sizes, "user_id", "left")
            .select(*keys, "user_id", F.coalesce(F.col("hits"), F.lit(0)).alias("hits"),
                    F.coalesce(F.col("n_truth"), F.lit(0)).alias("n_truth")))


def _summarise(per_user: DataFrame, k: int, keys: Sequence[str] = ()) -> DataFrame:
    n = F.count(F.lit(1))
    recall_u = F.when(F.col("n_truth") > 0, F.col("hits") / F.col("n_truth")).otherwise(F.lit(0.0))
    g = per_user.groupBy(*keys) if keys else per_user.groupBy()
    return g.agg(
        n.alias("n_users"),
        metric_round(_ratio(F.sum(F.when(F.col("hits") > 0, 1).otherwise(0)), n)).alias("hit_rate"),
        metric_round(_ratio(F.sum("hits"), n * F.lit(k))).alias("precision"),
        metric_round(_ratio(F.sum(recall_u), n)).alias("recall"),
    ).withColumn("k", F.lit(k))


def hit_rate_at_k(recs: DataFrame, truth: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Share of users with at least one liked item in their top k."""
    return evaluate_recommendations(recs, truth, users, k).select("n_users", "k", "hit_rate")


def precision_at_k(recs: DataFrame, truth: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Mean of |top k ∩ truth| / k (divided by k even for shorter lists)."""
    return evaluate_recommendations(recs, truth, users, k).select("n_users", "k", "precision")


def recall_at_k(recs: DataFrame, truth: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """I8: mean of hits / |truth|; a user with empty truth adds 0 but counts."""
    return evaluate_recommendations(recs, truth, users, k).select("n_users", "k", "recall")


def evaluate_recommendations(recs: DataFrame, truth: DataFrame, users: DataFrame,
                             k: int = 10, key: str | None = None,
                             key_values: Sequence[str] = ()) -> DataFrame:
    """Hit rate, precision and recall at k in one pass (per `key` value
    when recommendations of several configurations are stacked)."""
    keys = [key] if key else []
    return _summarise(_per_user_hits(recs, truth, users, k, key, key_values), k, keys)


def ndcg_at_k(recs: DataFrame, test_ratings: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """gain = the user's actual test rating, discount log2(position + 1);
    ideal = the user's test ratings sorted descending, top k. Recommendations
    are not de-duplicated."""
    tr = test_ratings.select("user_id", "item_id", "rating")
    disc = F.log2(F.col("rank").cast("double") + F.lit(1.0))
    dcg = (recs.filter(F.col("rank") <= k).select("user_id", "rank", "item_id")
           .join(tr, ["user_id", "item_id"])
           .groupBy("user_id").agg(F.sum(F.col("rating") / disc).alias("dcg")))
    ideal = (top_n_per(tr, ["user_id"], [F.col("rating").desc(), F.col("item_id")], k)
             .groupBy("user_id").agg(F.sum(F.col("rating") / disc).alias("idcg")))
    base = users.select("user_id").distinct().join(tr.select("user_id").distinct(), "user_id",
                                                   "left_semi")
    per_user = base.join(dcg, "user_id", "left").join(ideal, "user_id", "left").select(
        F.when(F.col("idcg") > 0, F.coalesce(F.col("dcg"), F.lit(0.0)) / F.col("idcg"))
         .otherwise(F.lit(0.0)).alias("ndcg"))
    n = F.count(F.lit(1))
    return per_user.agg(n.alias("n_users"),
                        metric_round(_ratio(F.sum("ndcg"), n)).alias("ndcg")).withColumn("k", F.lit(k))


def rmse(pairs: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """sqrt(mean((actual - predicted)^2)) over paired rows; 0 if none."""
    err = F.pow(F.col(actual) - F.col(predicted), 2)
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                     metric_round(F.coalesce(F.sqrt(F.avg(err)), F.lit(0.0))).alias("rmse"))


# ---------------------------------------------------------------- comparison

def compare_algorithms(results: dict[str, DataFrame], truth: DataFrame, users: DataFrame,
                       k: int = 10) -> DataFrame:
    """Metrics of several algorithms on the same users, ranked by hit
    rate, with the best algorithm per metric flagged (ties: name order)."""
    stacked = None
    for name, recs in results.items():
        r = recs.select(F.lit(name).alias("algorithm"), "user_id", "rank", "item_id")
        stacked = r if stacked is None else stacked.unionByName(r)
    m = evaluate_recommendations(stacked, truth, users, k, key="algorithm",
                                 key_values=list(results))
    # all algorithms were asked for every user; metrics rows = one per algorithm
    w = Window.partitionBy()
    out = m.withColumn("rank_by_hit", F.row_number().over(
        Window.orderBy(F.col("hit_rate").desc(), F.col("algorithm"))).cast("bigint"))
    for metric in ("hit_rate", "precision", "recall"):
        first = F.min_by("algorithm", F.struct(-F.col(metric), F.col("algorithm"))).over(w)
        out = out.withColumn(f"best_{metric}", F.col("algorithm") == first)
    return out


def relative_improvement(metrics: DataFrame, base: str, other: str) -> DataFrame:
    """(other - base) / base * 100 for each metric of two algorithms; null
    where the base is 0 (the ratio is not defined)."""
    long = metrics.select("algorithm", F.expr(
        "stack(3, 'hit_rate', hit_rate, 'precision', precision, 'recall', recall) "
        "AS (metric, value)"))
    a = long.filter(F.col("algorithm") == base).select("metric", F.col("value").alias("base_value"))
    b = long.filter(F.col("algorithm") == other).select("metric", F.col("value").alias("other_value"))
    return a.join(b, "metric").select(
        "metric", F.lit(base).alias("base"), F.lit(other).alias("other"), "base_value",
        "other_value",
        metric_round(F.try_divide(F.col("other_value") - F.col("base_value"), F.col("base_value"))
                     * F.lit(100.0)).alias("improvement_pct"))
