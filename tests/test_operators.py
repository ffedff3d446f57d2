"""Small hand-made frames for the split, CF and hybrid rules (FIXTURES.md 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkrec.operators import hybrid as hyb
from sparkrec.operators import similarity as sim
from sparkrec.operators.split import split_by_time


def test_split_edges(spark):
    rows, rid = [], 0
    for user, n in [(1, 4), (2, 5), (3, 6), (4, 10), (5, 11)]:
        for j in range(n):
            rid += 1
            ts = dt.datetime(2020, 1, 1) + dt.timedelta(days=j // 2)  # pairs of equal times
            rows.append((rid, user, 100 + j, 3.0, ts))
    df = spark.createDataFrame(rows, "rating_id long, user_id long, item_id long, rating double, ts timestamp")
    train, test = split_by_time(df)
    counts = {r["user_id"]: r["count"] for r in test.groupBy("user_id").count().collect()}
    assert counts == {2: 1, 3: 1, 4: 2, 5: 2}
    assert train.filter("user_id = 1").count() == 0
    # newest first, ties in time broken by the higher rating_id
    t = test.filter("user_id = 4").select("rating_id").collect()
    assert sorted(r[0] for r in t) == [rid - 11 - 1, rid - 11]
    # every test time >= the user's last train time
    last = train.groupBy("user_id").agg(F.max("ts").alias("m"))
    assert test.join(last, "user_id").filter("ts < m").count() == 0


def test_cf_predicted_rating_golden(spark):
    train = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.5)], "user_id long, item_id long, rating double")
    sims = spark.createDataFrame([(1, 3, 20, 0.92), (2, 3, 20, 0.88)],
                                 "item_id_1 long, item_id_2 long, common_users long, similarity_score double")
    got = sim.cf_predicted_rating(train, sims).first()
    assert got["item_id"] == 3 and got["predicted_rating"] == pytest.approx(4.755556, abs=1e-6)


def _cand(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, algo string, score double")


def test_hybrid_edges(spark):
    # all equal scores -> normalised 1.0
    c = _cand(spark, [(1, 10, "popularity", 4.0), (1, 11, "popularity", 4.0)])
    n = hyb.min_max_normalize(hyb.hybrid_scores_wide(c)).orderBy("item_id").collect()
    assert [r["popularity_norm"] for r in n] == [1.0, 1.0]
    assert [r["ml_norm"] for r in n] == [0.0, 0.0]            # algorithm missing -> 0
    # an item lacking one algorithm's score counts as 0 before normalising
    c = _cand(spark, [(1, 10, "popularity", 4.0), (1, 11, "popularity", 3.0), (1, 12, "genre", 2.0)])
    n = {r["item_id"]: r for r in hyb.min_max_normalize(hyb.hybrid_scores_wide(c)).collect()}
    assert n[12]["popularity_norm"] == 0.0 and n[11]["popularity_norm"] == pytest.approx(0.75)
    # item twice in the genre rows -> the lower score is kept
    c = _cand(spark, [(1, 10, "genre", 3.0), (1, 10, "genre", 2.0), (1, 11, "genre", 1.0)])
    w = {r["item_id"]: r["combined_score"] for r in hyb.hybrid_scores_wide(c).collect()}
    assert w[10] == 2.0


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        hyb.check_weights({"popularity": 0.5, "genre": 0.6})
    assert hyb.check_weights(None) == hyb.DEFAULT_WEIGHTS
