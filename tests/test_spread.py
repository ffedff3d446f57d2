"""Tasks that multiply or sort rows are as many as these rows ask for, not as their
compressed bytes do; and pairs and residuals are shuffled packed."""

import re

import pytest
from pyspark.sql import functions as F

from sparkrec import session
from sparkrec.operators import factors as fac
from sparkrec.operators import genre as genre_ops
from sparkrec.operators import similarity as sim_ops
from sparkrec.sources import fixtures
from test_skew import _hot_pairs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _dealt(df):
    """{keys: partitions} of the shuffles with a named count."""
    found = re.findall(r"hashpartitioning\((.*?), (\d+)\), REPARTITION_BY_NUM", _plan(df))
    return {re.sub(r"#\d+L?", "", keys): int(n) for keys, n in found}


def _hits(sims, rows):
    degree = {}
    for s in sims.collect():
        for i in (s.item_id_1, s.item_id_2):
            degree[i] = degree.get(i, 0) + 1
    return sum(degree.get(i, 0) for _, i, r in rows if r >= 4.0)


def test_cf_tasks_follow_the_multiplied_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    rows, train = _hot_pairs(spark)
    sims = session.materialize(sim_ops.item_similarities(train, train.select("item_id").distinct(), min_common=2), "sims")
    want = -(-(_hits(sims, rows) + len(rows)) // 100)
    for recs in (sim_ops.cf_pool(train, sims), sim_ops.cf_predicted_rating(train, sims)):
        assert _dealt(recs) == {"user_id, dst": want}
        assert not recs.join(train, ["user_id", "item_id"], "left_semi").count()


def test_cf_rated_items_of_a_null_user(spark):
    """A null user equals no other: none of its ratings takes a target out."""
    sims = spark.createDataFrame([(1, 2, 5, 0.5), (2, 3, 5, 0.25)], "item_id_1 long, item_id_2 long, common_users long, similarity_score double")
    train = spark.createDataFrame([(None, 1, 4.0), (None, 2, 4.0), (8, 1, 4.0), (8, 2, 4.0)], "user_id long, item_id long, rating double")
    got = {(r.user_id, r.item_id): (r.recommendation_score, r.based_on_items) for r in sim_ops.cf_pool(train, sims).collect()}
    assert got == {(None, 1): (0.4, "2"), (None, 2): (0.4, "1"), (None, 3): (0.2, "2"), (8, 3): (0.2, "2")}


def test_genre_tasks_follow_the_ratings(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    rows, train = _hot_pairs(spark)
    bridge = spark.createDataFrame([(i, i % 7) for i in range(400)] + [(i, i % 3) for i in range(400)], "item_id long, genre_id int")
    genres = spark.createDataFrame([(g, f"g{g}") for g in range(7)], "genre_id int, genre_name string")
    n = -(-len(rows) // 10)
    got = genre_ops.user_genre_preference(train, bridge, genres, min_per_genre=1, top_n=7)
    assert _dealt(got) == {"user_id": n}
    want = {}
    for u, i, r in rows:
        for g in (i % 7, i % 3):
            c, t = want.get((u, f"g{g}"), (0, 0.0))
            want[u, f"g{g}"] = (c + 1, t + r)
    assert {(r.user_id, r.genre_name): (r.rating_count, r.preference_score) for r in got.collect()} == want
    budget = genre_ops._genre_budgets(train, bridge, genres, train.select("item_id", F.lit(1.0).alias("weighted_rating")).distinct(), None, 1, 7)[0]
    assert _dealt(budget) == {"user_id": n}
    assert {(r.user_id, r.genre_name): r.pref for r in budget.collect()} == {k: t for k, (_, t) in want.items()}


def test_orders_are_joined_in_tasks_of_bounded_lines(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    lines = spark.range(1000).select((F.col("id") % 300).alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"),
                                     F.col("id").cast("int").alias("l_linenumber"), (F.col("id") % 50 + 1.0).alias("l_quantity"))
    orders = spark.range(250).select(F.col("id").alias("o_orderkey"), (F.col("id") % 20).alias("o_custkey"),
                                     F.timestamp_seconds(F.col("id") * 86400).alias("o_orderdate"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    got = fixtures.ratings_r1_view(spark, str(tmp_path))
    assert _dealt(got) == {"l_orderkey": 100, "o_orderkey": 100}
    last = {}
    for i in range(1000):
        if (o := i % 300) < 250:
            last[o % 20, i % 50] = max(last.get((o % 20, i % 50), (-1,)), (o, i, i % 50 + 1))
    assert {(r.user_id, r.item_id): r.rating for r in got.collect()} == {k: -(-v[2] // 5) * 0.5 for k, v in last.items()}


@pytest.mark.parametrize("raters", [7, 100_000])
def test_pairs_are_shuffled_packed(spark, monkeypatch, raters):
    _, train = _hot_pairs(spark)
    seed = train.groupBy("item_id").agg(F.min("rating").alias("x")).select("item_id", (-F.col("item_id")).alias("seed_rank"))
    for pairs in (sim_ops.item_similarities, sim_ops.pair_similarity_batch):
        monkeypatch.setattr(sim_ops, "FEW_PAIRS", 10 ** 9)
        want = sorted(pairs(train, seed, min_common=2).collect())
        monkeypatch.setattr(sim_ops, "FEW_PAIRS", 0)
        monkeypatch.setattr(sim_ops, "MANY_RATERS", raters)
        for block in (16, 512):
            packed = pairs(train, seed, min_common=2, block=block)
            assert not re.search(r"hashpartitioning\([^()]*item_id_2", _plan(packed))
            assert sorted(packed.collect()) == want


def test_residuals_are_not_shuffled_by_factor(spark):
    _, train = _hot_pairs(spark)
    got = fac.svd_residuals(fac.svd_train(train, k=5), train)
    assert not re.search(r"hashpartitioning\((user|item)_id#\d+L?, factor", _plan(got))
    rows = got.collect()
    assert sorted(r.factor for r in rows) == list(range(5))
    assert all(r.user_residual < 1e-9 and r.item_residual <= 1e-6 and abs(r.length - 1) < 1e-9 for r in rows)
