"""op1 against the tokenizers library on whole texts."""

import random

import public_tokenizers
import pytest
from rows import ODD
from tokenizers import Tokenizer

from sparkrec.llm.token_counts import SPLIT_PATTERN, Encoder, count_tokens, stable_keys

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def counts(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect()), key=str)


def expected(rows, library):
    out = []
    for i, t in rows:
        n = library(t or "")
        out.append((i, len((t or "").encode()), n, n > 512))
    return sorted(out, key=str)


def test_given_documents_and_odd_rows(make_docs, empty_docs, sf_docs, library):
    df, rows = sf_docs
    assert counts(count_tokens(df, PATH)) == expected(rows, library)
    assert counts(count_tokens(make_docs(ODD), PATH)) == expected(ODD, library)
    assert count_tokens(empty_docs, PATH).collect() == []


def test_small_chunks_splice_exactly(make_docs, sf_docs, library):
    rows = [*sf_docs[1][:60], (1000, "a" * 5000), (1001, "日本語" * 700), (1002, "x <|endoftext|>" * 300), (1003, " \n  " * 900)]
    got = counts(count_tokens(make_docs(rows), PATH, chunk_bytes=256, overlap_bytes=24, widen=4))
    assert got == expected(rows, library)


def test_encoder_equals_library_on_random_text(library):
    rng = random.Random(5)
    enc = Encoder(PATH)
    signs = ["a", "Z", "'s", " ", "  ", "\n", "\t", "9", "é", "日", "😀", " ", " ", ".", "--", "<|endoftext|>", "'ll", "ſ", "٣"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 25)))
        assert len(enc.ids(text)) == library(text), repr(text)


def test_pattern_is_the_published_one():
    assert SPLIT_PATTERN == public_tokenizers.PATTERN


def test_stable_boundaries_split_the_encoding():
    import numpy as np
    rng = random.Random(2)
    enc = Encoder(PATH)
    for _ in range(300):
        text = "".join(rng.choice(["ab", " ", "\n", "C.", "  ", "7", "é", "<|endoftext|>"]) for _ in range(30))
        ids = np.array(enc.ids(text), np.int64)
        if not len(ids):
            continue
        raw = text.encode()
        keys, before = stable_keys(raw, ids, np.cumsum(enc.lengths[ids]), 0, len(raw), 0)
        for key, n in zip(keys, before):
            assert len(enc.ids(raw[:key >> 34].decode())) == n
            assert n + len(enc.ids(raw[key >> 34:].decode())) == len(ids)
