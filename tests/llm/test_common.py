"""Connected components and block cutting."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sparkrec.llm.common import components, mix64, rewrite_texts, text_blocks


def union_find(edges):
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return sorted((x, top(x)) for x in parent)


def graphs():
    rng = random.Random(3)
    yield [(i, i + 1) for i in range(60)]  # a chain
    yield [(i, (7 * i + 3) % 50) for i in range(50)] + [(900, i) for i in range(800, 899)]  # cycles and a hub
    yield [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    yield [(5, 3), (3, 5), (5, 3), (1, 2)]


@pytest.mark.parametrize("edges", list(graphs()))
def test_components_equal_union_find(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    own = [e for e in edges if e[0] != e[1]]
    assert sorted(tuple(r) for r in components(df, "a", "b").collect()) == union_find(own)


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1)], "src long, dst long")).collect() == []


def test_blocks_hold_whole_texts():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["ab", "é" * 10, "", "xyz"])], ["doc_id", "text"])
    got = list(text_blocks([batch, batch], 8))
    texts = [(i, data[a:b].tobytes().decode()) for ids, data, starts in got for i, a, b in zip(ids, starts, starts[1:])]
    assert texts == [(1, "ab"), (2, "é" * 10), (3, ""), (4, "xyz")] * 2
    assert all(len(data) <= 8 or len(ids) == 1 for ids, data, _ in got if len(data))


def test_mix64_is_a_bijection_on_samples():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(mix64(x))) == len(x)


def test_rewriting_keeps_columns(make_docs):
    docs = make_docs([(1, "aa"), (2, None), (3, "drop")])
    out = rewrite_texts(docs, lambda t: None if t == "drop" else t + "!")
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["text"], r["n_chars"], r["kept"]) for r in out.collect()) == [(1, "aa!", 3, "x"), (2, "!", 1, "x")]
