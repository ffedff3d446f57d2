
import pytest
from pyspark.sql import functions as F

from paths import SF01
from sparkrec.plans import datasets
from sparkrec.plans.registry import QUERIES, r2_similarities


@pytest.fixture(scope="module")
def r1(spark):
    return datasets.load(spark, SF01, "r1")


def test_split_partitions_ratings(spark, r1):
    active = r1.ratings.join(r1.ratings.groupBy("user_id").count().filter("count >= 5"), "user_id",
                             "left_semi")
    assert r1.train.count() + r1.test.count() == active.count()
    assert r1.train.join(r1.test, "rating_id", "left_semi").count() == 0


@pytest.mark.parametrize("name", ["popular_items_for_users", "genre_recommendations"])
def test_no_watched_items(spark, r1, name):
    recs = QUERIES[name](spark, SF01)
    assert recs.join(r1.train, ["user_id", "item_id"], "left_semi").count() == 0


def test_cf_and_similarity_ranges(spark):
    d = datasets.load(spark, SF01, "r2")
    sims = r2_similarities(d)[1]
    assert sims.filter("similarity_score <= 0 OR similarity_score > 1 OR item_id_1 >= item_id_2").count() == 0
    recs = QUERIES["cf_recommendations"](spark, SF01)
    assert recs.join(d.train, ["user_id", "item_id"], "left_semi").count() == 0


def _one_user_equals_batch(spark, run, u):
    from pyspark.sql import functions as F
    all_users = run(None)
    one = run(spark.createDataFrame([(u,)], "user_id long"))
    a = sorted(tuple(r) for r in all_users.filter(F.col("user_id") == u).collect())
    b = sorted(tuple(r) for r in one.collect())
    assert a == b and len(a) > 0


def test_batch_equals_single_user(spark, r1):
    from sparkrec.operators.genre import genre_recommendations
    from sparkrec.operators.popularity import popular_items_for_users
    from sparkrec.operators.similarity import cf_recommendations
    u = r1.train.select("user_id").orderBy("user_id").first()["user_id"]
    _one_user_equals_batch(spark, lambda us: popular_items_for_users(
        r1.train, r1.items, us, n=10, min_ratings=20), u)
    _one_user_equals_batch(spark, lambda us: genre_recommendations(
        r1.train, r1.items, r1.item_genres, r1.genres, r1.genre_strings, users=us), u)
    d = datasets.load(spark, SF01, "r2")
    sims = r2_similarities(d)[1]
    u2 = QUERIES["cf_recommendations"](spark, SF01).select("user_id").orderBy("user_id").first()[0]
    _one_user_equals_batch(spark, lambda us: cf_recommendations(
        d.train, sims, d.items, d.genre_strings, users=us), u2)


def test_test_ratings_are_newest(spark, r1):
    last_train = r1.train.groupBy("user_id").agg(F.max("ts").alias("m"))
    assert r1.test.join(last_train, "user_id").filter("ts < m").count() == 0


def test_metrics_in_unit_range(spark):
    m = QUERIES["compare_algorithms"](spark, SF01).collect()
    for r in m:
        for k in ("hit_rate", "precision", "recall"):
            assert 0.0 <= r[k] <= 1.0
    h = QUERIES["hybrid_recommendations_no_ml"](spark, SF01)
    assert h.filter("hybrid_score < 0 OR hybrid_score > 1.0000001").count() == 0


def test_rank_joins_without_broadcast(spark, r1):
    """Large-catalogue path: no automatic broadcasts and almost every candidate
    in the shuffled high-rank branch give the same rows."""
    from sparkrec.operators.genre import genre_recommendations
    from sparkrec.operators.popularity import popular_items_for_users
    base_p = popular_items_for_users(r1.train, r1.items, n=10, min_ratings=20)
    base_g = genre_recommendations(r1.train, r1.items, r1.item_genres, r1.genres, r1.genre_strings)
    exp_p, exp_g = sorted(map(tuple, base_p.collect())), sorted(map(tuple, base_g.collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = popular_items_for_users(r1.train, r1.items, n=10, min_ratings=20, low_ranks=2)
        g = genre_recommendations(r1.train, r1.items, r1.item_genres, r1.genres, r1.genre_strings,
                                  low_rank_rows=22)
        assert sorted(map(tuple, p.collect())) == exp_p
        assert sorted(map(tuple, g.collect())) == exp_g
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
