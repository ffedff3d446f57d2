"""op9 against all pairs."""

import numpy as np
import pytest

from sparkrec.llm.metric_join import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, component_id string"


def brute(rows, c=0.93):
    ok = [(k, i, np.array(e, float), label) for k, (i, e, label) in enumerate(rows)
          if label is not None and i is not None and e and None not in e and np.isfinite(e).all() and np.any(e)]
    links = {k: 0 for k in range(len(rows))}
    parent = {i: i for i, _, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (k, i, x, label) in enumerate(ok):
        for m, j, y, other in ok[:n]:
            if label == other and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= c:
                links[k] += 1
                links[m] += 1
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, links[k], top(i), i == top(i)) for k, (i, _, _) in enumerate(rows))


def clusters(seed, n=400, dims=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((25, dims))
    rows = []
    for i in range(n):
        x = centres[rng.integers(25)] + rng.standard_normal(dims) * rng.choice([0.0, 0.05, 0.3, 1.0])
        rows.append((i, [float(v) for v in x.astype(np.float32)], int(rng.integers(3)) if rng.random() > 0.1 else None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, e, label, 7, "x") for i, e, label in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed,cell_rows,block_rows", [(1, 2000, 4000), (2, 20, 4000), (3, 10, 15)])
def test_equals_all_pairs(spark, seed, cell_rows, block_rows):
    rows = clusters(seed)
    got = near_vectors(frame(spark, rows), cell_rows=cell_rows, block_rows=block_rows).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, None, 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0),
            (8, [1.0, None], 0), (9, [], 0), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 0), (12, [1.0, 0.0], 0), (13, [1e30, 0.0], 0)]
    got = sorted(tuple(r) for r in near_vectors(frame(spark, rows)).collect())
    assert got == brute(rows)
    assert dict((r[0], r[1]) for r in got)[12] == 3
    alone = near_vectors(frame(spark, [(None, [1.0, 0.0], 0)])).collect()[0]
    assert alone["component_id"] is None and alone["kept"] and alone["n_links"] == 0
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_rows_link(spark):
    got = near_vectors(frame(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [-1.0, 2.0], 0)])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
