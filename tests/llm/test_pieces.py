"""op7 against all segmentations, and exact round trips."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from rows import ODD

from sparkrec.llm.pieces import Vocabulary, decode_ids, model_segmentations, n_best_segmentations, segment_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary(PATH)


def every_segmentation(vocab, word):
    edges = vocab.lattice(word)

    def back(j):
        if j == 0:
            yield 0.0, ()
        for i, own, s in edges[j]:
            for total, ids in back(i):
                yield total + s, ids + own

    return sorted(back(len(word)), reverse=True)


def some_words(n):
    rng = random.Random(1)
    fixed = ["▁the", "▁▁ration", "▁日本x", "ner.", "\n", "▁ß€", "▁", "▁çé", "😀"]
    return fixed + ["▁" + "".join(rng.choice("theranosiéç") for _ in range(rng.randint(1, 9))) for _ in range(n)]


def test_words_against_all_segmentations(vocab):
    words = some_words(250)
    flat, bounds, score, gap = vocab.best(words)
    for k, w in enumerate(words):
        every = every_segmentation(vocab, w)
        top = vocab.n_best(w, 5)
        assert [s for s, _ in top] == [s for s, _ in every[:5]] and all(t in every for t in top)
        assert score[k] == every[0][0] and gap[k] == (every[0][0] - every[1][0] if len(every) > 1 else np.inf)
        assert (score[k], tuple(flat[bounds[k]:bounds[k + 1]].tolist())) in every


@pytest.mark.parametrize("text", ["the cat", "a b c", "in ner\nat", "x", "thation on", "日 a", "é  é"])
def test_whole_texts_against_all_segmentations(vocab, text):
    words = vocab.split(text)
    _, _, score, gap = vocab.best(words)
    every = sorted((sum(s for s, _ in c) for c in itertools.product(*(every_segmentation(vocab, w) for w in words))), reverse=True)
    assert vocab.text_scores(words, float(score.sum()), gap, 4) == pytest.approx(every[:4])


def test_words_split_the_whole_lattice(vocab):
    """No piece reaches over a cut: the pieces of a text are those of its words."""
    text = "▁the▁cat.\n▁x"
    cuts = set(itertools.accumulate(map(len, vocab.words.findall(text))))
    for j, own in enumerate(vocab.lattice(text)):
        assert all(not any(i < c < j for c in cuts) for i, _, _ in own)


def test_rows_and_round_trip(make_docs, empty_docs, sf_docs, spark):
    rows = [*ODD, *((10_000 + i, t) for i, t in sf_docs[1][:40]), (2000, "a▁b")]
    got = segment_texts(make_docs(rows), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["round_trip"] == (r["doc_id"] != 2000)
        assert r["scores"][0] == r["best_score"] and r["scores"] == sorted(r["scores"], reverse=True) and len(r["scores"]) <= 4
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_pieces"] == by[2]["n_pieces"] == 0 and by[2]["scores"] == [0.0]
    assert segment_texts(empty_docs, PATH).collect() == []


def test_decoding(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["The cat sat.", " two  spaces", "日本語 ☃ é", "", "line\nbreak"]
    ids = [model.encode(t) for t in texts]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*ids, None])], "doc_id long, ids array<int>")
    out = {r["doc_id"]: r["text"] for r in decode_ids(df, PATH).collect()}
    assert [out[i] for i in range(6)] == [*texts, ""]


def test_the_n_best_segmentations_themselves(vocab, make_docs):
    """Ids and scores against all segmentations; every one decodes to its text."""
    texts = ["the cat", "a b c", "in ner\nat", "x", "thation on", "日 a", "é  é", "the the the the the the", None]
    table = n_best_segmentations(make_docs(list(enumerate(texts))), PATH)
    got = {r["doc_id"]: r["segmentations"] for r in table.collect()}
    for i, text in enumerate(texts):
        parts = [every_segmentation(vocab, w) for w in vocab.split(text or "")][:4]
        ways = [tuple(s["ids"]) for s in got[i]]
        assert len(set(ways)) == len(ways)
        if len(vocab.split(text or "")) <= 4:
            every = {sum((ids for _, ids in c), ()): sum(s for s, _ in c) for c in itertools.product(*parts)}
            assert [s["score"] for s in got[i]] == pytest.approx(sorted(every.values(), reverse=True)[:4])
            assert all(every[w] == pytest.approx(s["score"]) for w, s in zip(ways, got[i]))
    each = table.selectExpr("doc_id", "explode(segmentations.ids) AS ids")
    out = [(r["doc_id"], r["text"]) for r in decode_ids(each, PATH).collect()]
    assert len(out) == sum(map(len, got.values())) and all(t == (texts[i] or "") for i, t in out)


def test_equal_scores_give_different_segmentations(vocab):
    """A word whose best segmentation is not the one that A* finds first among equals."""
    found = [(-1.0, (7,)), (-1.0, (8,)), (-2.0, (9,))]
    vocab.n_best, kept = (lambda word, n: found[:n]), vocab.n_best
    try:
        ways = vocab.text_best(["w"], -1.0, np.array([0.0]), 3, lambda at: (8,))
    finally:
        vocab.n_best = kept
    assert ways == [(-1.0, {}), (-1.0, {0: (7,)}), (-2.0, {0: (9,)})]


def test_model_segmentation_is_the_library_s(make_docs, sf_docs):
    """The model's own encoding stands beside the N best, which differ from it on most words of English."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t) for i, (_, t) in enumerate(sf_docs[1][:20])] + [(100, None), (101, "The quick brown fox understands international agreements.")]
    docs = make_docs(rows)
    own = {r["doc_id"]: list(r["ids"]) for r in model_segmentations(docs, PATH).collect()}
    assert own == {i: model.encode(t or "") for i, t in rows}
    assert {r["doc_id"]: r["text"] for r in decode_ids(model_segmentations(docs, PATH), PATH).collect()} == {i: t or "" for i, t in rows}
    best = {r["doc_id"]: list(r["segmentations"][0]["ids"]) for r in n_best_segmentations(docs, PATH).collect()}
    assert own[100] == best[100] == [] and own[101] != best[101]
