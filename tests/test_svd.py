"""SVD model against a dense numpy SVD and brute-force recommendations."""

import numpy as np
import pytest

from paths import SF01
from sparkrec.operators import factors as fac
from sparkrec.plans import datasets


def test_svd_matches_numpy(spark, tmp_path_factory):
    d = datasets.load(spark, SF01, "r2")
    k = 10
    m = fac.svd_train(d.train, k=k, tolerance=1e-11)
    tr = d.train.toPandas()
    users, items = np.sort(tr.user_id.unique()), np.sort(tr.item_id.unique())
    ui = {u: i for i, u in enumerate(users)}
    ii = {x: i for i, x in enumerate(items)}
    mu = tr.rating.sum() / len(tr)
    a = np.zeros((len(users), len(items)))
    for u, i, r in zip(tr.user_id, tr.item_id, tr.rating):
        a[ui[u], ii[i]] = r - mu
    u_, s_, vt = np.linalg.svd(a, full_matrices=False)
    p = np.clip(mu + (u_[:, :k] * s_[:k]) @ vt[:k], 1, 5)
    np.testing.assert_allclose(m.singular_values, s_[:k], rtol=1e-8)
    pred = fac.svd_predict(m, d.test.select("user_id", "item_id")).toPandas()
    exp = [p[ui[u], ii[i]] if (u in ui and i in ii) else mu for u, i in zip(pred.user_id, pred.item_id)]
    np.testing.assert_allclose(pred.predicted_rating.to_numpy(), exp, atol=1e-6)
    # recommendations: brute force over unrated items, ties by item id
    recs = fac.svd_recommendations(m, d.train, d.items, d.genre_strings, n=10).toPandas()
    watched = tr.groupby("user_id").item_id.apply(set).to_dict()
    for u, g in recs.groupby("user_id"):
        row = p[ui[u]]
        cand = sorted((-row[j], items[j]) for j in range(len(items)) if items[j] not in watched[u])
        assert list(g.sort_values("rank").item_id) == [c[1] for c in cand[:10]]
    # save / load round trip keeps predictions
    path = str(tmp_path_factory.mktemp("model"))
    fac.model_save(m, path)
    again = fac.svd_predict(fac.model_load(spark, path), d.test.select("user_id", "item_id")).toPandas()
    merged = pred.merge(again, on=["user_id", "item_id"])
    np.testing.assert_allclose(merged.predicted_rating_x, merged.predicted_rating_y, atol=1e-12)


def test_svd_orthonormal_and_unseen(spark):
    d = datasets.load(spark, SF01, "r2")
    m = fac.svd_train(d.train, k=10)
    v = np.vstack(m.item_factors.orderBy("item_idx").toPandas()["factors"].to_numpy())
    np.testing.assert_allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-8)
    pairs = spark.createDataFrame([(-1, 0), (int(d.train.first()["user_id"]), -5)],
                                  "user_id long, item_id long")
    got = [r["predicted_rating"] for r in fac.svd_predict(m, pairs).collect()]
    assert got == [m.global_mean, m.global_mean]  # unseen user / item: the mean, unclipped


def test_pure_ml_weighting_equals_svd_recommender(spark):
    """Min-max normalisation keeps the order of the ML candidates, so the
    'Pure ML' weighting of the sweep scores exactly like the SVD recommender."""
    from sparkrec.operators import hybrid as hyb
    from sparkrec.operators import metrics as met
    from sparkrec.plans.registry import K, _r2_eval, r2_candidates, trained_model
    d = datasets.load(spark, SF01, "r2")
    users, truth = _r2_eval(d)
    _, cand = r2_candidates(spark, SF01, with_ml=True, users=users)
    norm = hyb.min_max_normalize(hyb.hybrid_scores_wide(cand))
    cfg = {"Pure ML": hyb.WEIGHT_CONFIGS["Pure ML"]}
    sweep = met.evaluate_recommendations(hyb.sweep_recommendations(norm, cfg, n=K), truth, users, K,
                                         key="config", key_values=list(cfg)).first()
    svd = fac.svd_recommendations(trained_model(spark, SF01), d.train, d.items, d.genre_strings,
                                  users=users, n=K)
    direct = met.evaluate_recommendations(svd, truth, users, K).first()
    for m in ("n_users", "hit_rate", "precision", "recall"):
        assert sweep[m] == direct[m]


def test_svd_of_sparse_ratings_converges(spark):
    """r1: far more items than the block; the spectrum is flat, so the residuals
    are tested and not the single vectors."""
    d = datasets.load(spark, SF01, "r1")
    k = 10
    m = fac.svd_train(d.train, k=k)
    assert m.residual <= 1e-6 and m.products > 5
    tr = d.train.toPandas()
    users, u = np.unique(tr.user_id, return_inverse=True)
    items, i = np.unique(tr.item_id, return_inverse=True)
    a = np.zeros((len(users), len(items)))
    a[u, i] = tr.rating - tr.rating.mean()
    best = np.linalg.svd(a, compute_uv=False)[:k]
    np.testing.assert_allclose(m.singular_values, best, rtol=1e-7)
    v = np.vstack(m.item_factors.orderBy("item_idx").toPandas()["factors"].to_numpy())
    np.testing.assert_allclose(v.T @ v, np.eye(k), atol=1e-8)
    us = m.user_factors.orderBy("user_id").toPandas()
    np.testing.assert_allclose(np.vstack(us["factors"].to_numpy()), a @ v, atol=1e-8)
    off = a.T @ (a @ v) - v * np.array(m.singular_values) ** 2
    assert np.linalg.norm(off, axis=0).max() <= 2e-6 * best[0] ** 2


def falling_ratings(spark, n_users=60, n_items=50):
    """Ratings of a matrix whose singular values fall quickly, with holes."""
    rng = np.random.default_rng(3)
    a = sum(8 * 0.6 ** f * np.outer(rng.standard_normal(n_users), rng.standard_normal(n_items)) for f in range(12))
    rows = [(u, i, float(a[u, i])) for u in range(n_users) for i in range(n_items) if (u * 7 + i * 3) % 11]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_restarts_and_block_tables_find_the_same_model(spark, monkeypatch):
    """A basis that restarts, tasks that add up before the driver does, and vectors as
    tables of blocks, against the exact decomposition."""
    train = falling_ratings(spark)
    tr = train.toPandas()
    a = np.zeros((60, 50))
    a[tr.user_id, tr.item_id] = tr.rating - tr.rating.mean()
    best = np.linalg.svd(a, compute_uv=False)[:3]
    monkeypatch.setattr(fac, "BLOCK", 16)
    monkeypatch.setattr(fac, "BASIS_BLOCKS", 4)
    for local in (8 * 50 * 28, 0):  # the least that takes the first way; none
        m = fac.svd_train(train, k=3, tolerance=1e-9, local_bytes=local)
        assert m.residual <= 1e-9
        np.testing.assert_allclose(m.singular_values, best, rtol=1e-9)
        assert all(abs(r["length"] - 1) < 1e-9 and r["item_residual"] < 1e-8 and r["user_residual"] < 1e-9
                   for r in fac.svd_residuals(m, train).collect())


def test_more_factors_than_rank(spark):
    """Ratings of rank two about their mean: what is nothing but noise is left out."""
    train = spark.createDataFrame([(u, i, 3.0 + (1 if (u + i) % 2 else -1)) for u in range(12) for i in range(10)],
                                  "user_id long, item_id long, rating double")
    m = fac.svd_train(train, k=6)
    assert m.k == 1 and abs(m.singular_values[0] - 120 ** 0.5) < 1e-9
    got = fac.svd_predict(m, train.select("user_id", "item_id", "rating")).collect()
    assert all(abs(r["predicted_rating"] - r["rating"]) < 1e-9 for r in got)


def test_no_convergence_is_reported(spark, monkeypatch):
    monkeypatch.setattr(fac, "MOST_PRODUCTS", 1)
    monkeypatch.setattr(fac, "CHECK_EVERY", 1)
    with pytest.raises(RuntimeError, match="no convergence"):
        fac.svd_train(falling_ratings(spark), k=3, tolerance=1e-12)


def test_blocks_and_slices_do_not_matter(spark, monkeypatch):
    """Many small blocks, and V scored in slices, give the same model and lists."""
    d = datasets.load(spark, SF01, "r2")
    users = d.train.select("user_id").distinct().orderBy("user_id").limit(40)
    whole = fac.svd_train(d.train, k=5)
    want = fac.svd_recommendations(whole, d.train, d.items, d.genre_strings, users=users).toPandas()
    monkeypatch.setattr(fac, "BLOCK", 64)
    parts = fac.svd_train(d.train, k=5)
    np.testing.assert_allclose(parts.singular_values, whole.singular_values, rtol=1e-8)
    budget = users.selectExpr("user_id", "10L AS _l")
    a, b = (fac.svd_scores_topl(whole, budget, slice_bytes=n).orderBy("user_id", "predicted_rating", "item_idx").toPandas() for n in (1 << 28, 8 * 5 * 30))
    assert len(b) == 4 * len(a)
    best = b.sort_values(["user_id", "predicted_rating", "item_idx"], ascending=[True, False, True]).groupby("user_id").head(10)
    assert set(map(tuple, best[["user_id", "item_idx"]].to_numpy())) == set(map(tuple, a[["user_id", "item_idx"]].to_numpy()))
    assert len(want) == 400


@pytest.mark.parametrize("columns", [0, 2])
def test_frequent_singular_values_converge(spark, monkeypatch, columns):
    """A singular value that is more frequent than the block of vectors is wide: vectors
    as tables of blocks, products shuffled or sent by the driver a few columns at a time;
    rows above the bound for long ones."""
    monkeypatch.setattr(fac, "BLOCK", 256)
    monkeypatch.setattr(fac, "LONG_ROW", 10)
    monkeypatch.setattr(fac, "MOST_PRODUCTS", 150)
    rng = np.random.default_rng(5)
    cells = {(u, i): float(r) for u, i, r in zip(rng.integers(0, 12, 90).tolist(), rng.integers(0, 15, 90).tolist(), rng.integers(1, 11, 90) / 2)}
    copies = 40
    train = spark.createDataFrame([(12 * c + u, 15 * c + i, r) for c in range(copies) for (u, i), r in cells.items()],
                                  "user_id long, item_id long, rating double")
    a = np.zeros((12, 15))
    for (u, i), r in cells.items():
        a[u, i] = r - np.mean(list(cells.values()))
    best = np.repeat(np.linalg.svd(a, compute_uv=False), copies)[:2]
    m = fac.svd_train(train, k=2, local_bytes=24 * 15 * copies * columns)
    assert m.residual <= 1e-6
    np.testing.assert_allclose(m.singular_values, best, rtol=1e-9)
    assert all(abs(r["length"] - 1) < 1e-9 and r["item_residual"] <= 1e-6 and r["user_residual"] < 1e-9
               for r in fac.svd_residuals(m, train).collect())


def test_jagged_rows_times_vectors():
    """Packed by key, with a long key and with more values than a byte numbers."""
    rng = np.random.default_rng(1)
    for n_values in (10, 10_000):
        key = np.sort(np.concatenate([rng.integers(0, 50, 2_000), np.full(30_000, 50)]))
        other, v = rng.integers(0, 300, len(key)), rng.integers(0, n_values, len(key)) / 7
        x = rng.standard_normal((300, 3))
        want, got = np.zeros((51, 3)), np.zeros((51, 3))
        np.add.at(want, key, v[:, None] * x[other])
        for b in fac._jagged(key, other, v):
            ids, *packed = (np.frombuffer(c[0].as_py(), t) for c, t in zip(b.columns, (np.int32, np.int32, np.int32, np.float64, np.uint8)))
            got[ids] = fac._jagged_times(*packed, x)
        np.testing.assert_allclose(got, want, atol=1e-8)
