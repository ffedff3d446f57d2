"""op8: learns planted words, holds rows out, and scores whole texts."""

import random
import zlib

import numpy as np
import pytest
from rows import ODD

from sparkrec.llm.toxicity import ConvNet, STEP, thresholds, toxicity, train


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.3
        if bad:
            own[rng.randrange(len(own))] = rng.choice(["vilestuff", "nastyword", "horridly" + rng.choice(words)])
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def frames(spark, make_docs):
    rows, labels = corpus()
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(rows), {i: t for i, _, t in labels}


def test_held_out_accuracy(frames):
    docs, labels, _, truth = frames
    got = toxicity(docs, labels).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_held_out_labels_are_never_read(frames, spark):
    docs, labels, _, truth = frames
    flipped = spark.createDataFrame([(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in truth.items()], "doc_id long, quality int, toxic int")
    a, b = ({r["doc_id"]: r["score"] for r in toxicity(docs, own).collect()} for own in (labels, flipped))
    assert a == b


def test_odd_rows_and_missing_labels(make_docs, empty_docs, frames, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity(make_docs(ODD), none).collect()
    assert len(got) == len(ODD) and {r["score"] for r in got} == {0.0}
    got = toxicity(make_docs(ODD).drop("lang"), frames[1]).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity(empty_docs, none).collect() == []


def test_long_texts_are_scored_whole():
    rows, labels = corpus()
    net = train([t for _, t in rows], np.array([t for _, _, t in labels]))
    tables = net.tables()
    clean = " ".join(["abcd"] * (3 * STEP))
    low, high = net.score_texts([clean, clean + " vilestuff"], tables)
    assert high > 0.7 > low
    for at in (STEP - 1, STEP, 2 * STEP - 2):  # wherever the word lies, also across steps
        words = clean.split()
        words[at] = "vilestuff"
        assert net.score_texts([" ".join(words)], tables)[0] > 0.7


def test_scores_equal_a_plain_convolution():
    rng = np.random.default_rng(1)
    net = ConvNet.fresh(np.array([1, 2, 3]), 4, (1, 2), 3, 0)
    net.emb = rng.standard_normal(net.emb.shape).astype(np.float32)
    net.emb[0] = 0
    from sparkrec.llm.toxicity import indexed, slots_of
    text = "one two three two one"
    hashes, rows = indexed([text])
    net.known = np.unique(hashes[hashes != 0])[:3]
    e = np.concatenate([net.emb[slots_of(hashes, net.known)].sum(axis=1)[rows[0]], np.zeros((1, 4))])
    feats = []
    for w in (1, 2):
        act = np.array([sum(e[t + j] @ net.filters[w][j] for j in range(w)) for t in range(5)])
        feats.append(np.maximum(act.max(axis=0) + net.bias[w], 0))
    want = 1 / (1 + np.exp(-(np.concatenate(feats) @ net.out + net.out_bias)))
    assert net.score_texts([text], net.tables())[0] == pytest.approx(want, abs=1e-5)


def test_thresholds_by_language(spark):
    rows = [(i, lang, s, False) for i, (lang, s) in enumerate([("en", 0.9), ("en", 0.4), ("en", 0.2), ("de", 0.45), ("de", 0.1), ("fr", 0.3)])]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, score double, held_out boolean")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0), (3, 1), (4, 0), (5, 0)], "doc_id long, toxic int")
    got = {r["lang"]: r["threshold"] for r in thresholds(scored, labels).collect()}
    assert 0.4 < got["en"] <= 0.9 and 0.1 < got["de"] <= 0.45 and got["fr"] == 0.7
