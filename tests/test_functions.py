"""Hand-worked goldens (FIXTURES.md section 4) for the column functions and metrics."""

import math

import pytest
from pyspark.sql import functions as F

from sparkrec.functions.columns import (
    clamp_top_n, rating_step_check, release_year, title_without_year, weighted_rating,
)
from sparkrec.operators import metrics as met


def test_step_check(spark):
    vals = [None, "x", "0", "0.4", "0.5", "3.25", "3.5", "3.5005", "5.0", "5.5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r["ok"] for r in df.select("i", rating_step_check("v").alias("ok")).orderBy("i").collect()]
    assert got == [False, False, False, False, True, False, True, True, True, False]


def test_top_n_rule():
    assert [clamp_top_n(x) for x in [None, 0, -1, "a", 7, 50, 51]] == [10, 10, 10, 10, 7, 50, 50]


def test_titles(spark):
    df = spark.createDataFrame([(t,) for t in ["Toy Story (1995)", "No Year", " X (2000) ", "A (1990) B"]],
                               "t string")
    rows = df.select(title_without_year("t").alias("title"), release_year("t").alias("y")).collect()
    assert [r["y"] for r in rows] == [1995, None, 2000, None]
    assert [r["title"] for r in rows] == ["Toy Story", "No Year", "X", "A (1990) B"]


def test_bayes(spark):
    df = spark.createDataFrame([(5, 5.0), (1000, 4.8)], "v long, r double")
    got = [r[0] for r in df.select(weighted_rating(F.col("v"), F.col("r"), 30, F.lit(3.6))).collect()]
    assert got[0] == pytest.approx(3.80, abs=1e-9) and got[1] == pytest.approx(4.765, abs=1e-3)


def _recs(spark, d):
    return spark.createDataFrame([(u, i + 1, it) for u, lst in d.items() for i, it in enumerate(lst)],
                                 "user_id long, rank int, item_id long")


def _truth(spark, d):
    rows = [(u, it) for u, lst in d.items() for it in lst] + [(u, None) for u, lst in d.items() if not lst]
    return spark.createDataFrame(rows, "user_id long, item_id long")


def _users(spark, ids):
    return spark.createDataFrame([(u,) for u in ids], "user_id long")


def test_metric_dummy(spark):
    recs = _recs(spark, {1: list(range(101, 111)), 2: list(range(201, 211))})
    truth = _truth(spark, {1: [103, 105, 120, 121], 2: [201, 210, 220]})
    m = met.evaluate_recommendations(recs, truth, _users(spark, [1, 2]), 10).first()
    assert m["hit_rate"] == 1.0 and m["precision"] == pytest.approx(0.2)
    assert m["recall"] == pytest.approx(0.583333, abs=1e-6)


def test_three_users(spark):
    recs = _recs(spark, {1: [1, 2] + list(range(100, 108)), 2: list(range(200, 210)),
                         3: [1, 2, 3] + list(range(300, 307))})
    truth = _truth(spark, {1: [1, 2, 10, 11, 12], 2: [1, 2, 3], 3: [1, 2, 3, 10, 11, 12, 13, 14]})
    m = met.evaluate_recommendations(recs, truth, _users(spark, [1, 2, 3]), 10).first()
    assert m["hit_rate"] == pytest.approx(2 / 3)
    assert m["precision"] == pytest.approx(0.166667, abs=1e-6)
    assert m["recall"] == pytest.approx(0.258333, abs=1e-6)


def test_rmse_dummy(spark):
    pairs = spark.createDataFrame(list(zip([4.0, 3.5, 5.0, 2.0], [3.8, 3.6, 4.9, 2.2])),
                                  "actual double, predicted double")
    assert met.rmse(pairs).first()["rmse"] == pytest.approx(math.sqrt(0.025), abs=1e-9)
    assert met.rmse(pairs.limit(0)).first()["rmse"] == 0.0


def test_ground_truth_modes(spark):
    test = spark.createDataFrame([(1, 10, 5.0), (1, 11, 2.0), (2, 20, 3.0)],
                                 "user_id long, item_id long, rating double").withColumn(
        "ts", F.current_timestamp())
    users = _users(spark, [1, 2])
    recs = _recs(spark, {1: [10], 2: [20]})
    keep = met.ground_truth(test, users)               # I2: user 2 stays, counts as a miss
    assert met.evaluate_recommendations(recs, keep, users, 10).first()["n_users"] == 2
    drop = met.positive_test_items(test).select("user_id", "item_id")  # I3: user 2 absent
    m = met.evaluate_recommendations(recs, drop, users, 10).first()
    assert m["n_users"] == 1 and m["hit_rate"] == 1.0


def test_ndcg_simple(spark):
    recs = _recs(spark, {1: [1, 2, 3]})
    tr = spark.createDataFrame([(1, 2, 4.0), (1, 9, 5.0)], "user_id long, item_id long, rating double")
    got = met.ndcg_at_k(recs, tr, _users(spark, [1]), 10).first()["ndcg"]
    exp = (4.0 / math.log2(3)) / (5.0 / math.log2(2) + 4.0 / math.log2(3))
    assert got == pytest.approx(exp, abs=1e-12)


def test_rounding_is_done_once(spark):
    """0.5239497 is 0.5239: rounded to six places first it would become 0.5240."""
    from sparkrec.functions.columns import round_half_up
    rows = [(0.52394970584, 0.5239), (-0.52394970584, -0.5239), (0.52395, 0.524), (2.5e-5, 0.0), (0.12345, 0.1235), (-0.12345, -0.1235), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "x double, want double")
    assert all(r["got"] == r["want"] for r in df.select("want", round_half_up("x", 4).alias("got")).collect())


def test_ratio_of_nothing_is_null(spark):
    from sparkrec.operators.metrics import relative_improvement
    from sparkrec.operators.profile import rating_distribution
    m = spark.createDataFrame([("a", 0.0, 0.5, 0.1), ("b", 0.2, 1.0, 0.1)], "algorithm string, hit_rate double, precision double, recall double")
    got = {r["metric"]: r["improvement_pct"] for r in relative_improvement(m, "a", "b").collect()}
    assert got == {"hit_rate": None, "precision": 100.0, "recall": 0.0}
    one = rating_distribution(spark.createDataFrame([(4.0,)], "rating double")).collect()
    assert one[0]["std_rating"] is None and one[0]["mean_rating"] == 4.0
