"""op3 against a brute-force scan of all windows."""

import hashlib
import random

import pytest
from rows import ODD

from sparkrec.llm import suffix_dedup as S


def brute(rows, n=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - n + 1):
            if raw[p:p + n] in seen:
                covered[p:p + n] = b"\1" * n
            seen.add(raw[p:p + n])
        runs = sum(c and not (p and covered[p - 1]) for p, c in enumerate(covered))
        out.append((i, len(raw), sum(covered), runs, hashlib.sha256(bytes(b for b, c in zip(raw, covered) if not c)).hexdigest()))
    return out


def result(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, texts=40):
    """Texts that share passages at random places, periodic stretches and copies."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(rng.randint(15, 60)) for _ in range(6)]
    rows = []
    for i in range(texts):
        t = "".join(rng.choice([prose(rng.randint(0, 30)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 40):], "ab" * rng.randint(0, 120), "x" * rng.randint(0, 300)])
                    for _ in range(rng.randint(0, 6)))
        rows.append((i * 3, t))
    return [*rows, (1000, rows[5][1]), (1001, rows[5][1] + "!")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("max_bucket", [20_000, 1])
def test_equals_brute_force(make_docs, seed, max_bucket):
    rows = corpus(seed)
    assert result(S.repeated_bytes(make_docs(rows), max_bucket=max_bucket)) == brute(rows)


@pytest.mark.parametrize("held_rows", [1, 4, 40])
def test_reduced_buckets_and_wide_anchors(make_docs, held_rows):
    rows = corpus(5)
    assert result(S.repeated_bytes(make_docs(rows), held_rows=held_rows, bucket_bytes=500)) == brute(rows)


def test_wide_anchor_has_one_first_occurrence(make_docs):
    rng = random.Random(6)
    shared = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(i, f"{rng.random()} {i % 30:050} {shared} {i % 30:050} {rng.random()}") for i in range(90)]
    docs = make_docs(rows)
    assert result(S.repeated_bytes(docs, held_rows=8)) == brute(rows)
    texts = {i: t.encode() for i, t in rows}
    groups = {}
    for r in S.maximal_repeats(docs, held_rows=8).collect():
        groups.setdefault(r["group"], []).append(r)
    for own in groups.values():
        assert len({texts[r["doc"]][r["start"]:r["finish"]] for r in own}) == 1
        assert [r["first"] for r in sorted(own, key=lambda r: (r["doc"], r["start"]))] == [True] + [False] * (len(own) - 1)


def test_given_documents(sf_docs):
    df, rows = sf_docs
    assert result(S.repeated_bytes(df)) == brute(rows)


def test_blocks_and_flushes_do_not_matter(make_docs, monkeypatch):
    rows = corpus(3)
    docs = make_docs(rows)
    raw = [(i, 0, t) for i, t in rows]
    monkeypatch.setattr(S, "BLOCK", 300)
    monkeypatch.setattr(S, "FLUSH", 1000)
    import pyarrow as pa
    import numpy as np
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in raw]) for k in range(3)], ["doc", "digest", "text"])
    small = list(S._blocks([batch], 100))
    windows = {}
    for info, data, bounds in small:
        starts, n, place, mu, seg = S.segments(data, bounds, 100)
        own = np.searchsorted(bounds, starts, side="right") - 1
        for s, k, p, o, m in zip(starts, n, place, own, mu):
            for j in range(k):
                doc, _, base = info[o]
                windows[doc, base + int(s - bounds[o]) + j] = int(m)
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - 99):
            assert (i, p) in windows
    content = {}
    texts = {i: t.encode() for i, t in rows}
    for (i, p), m in windows.items():  # equal windows have equal anchors
        assert content.setdefault(texts[i][p:p + 100], m) == m
    assert docs.count() == len(rows)


def test_odd_rows(make_docs, empty_docs):
    got = S.repeated_bytes(make_docs(ODD)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_bytes"] == by[2]["n_bytes"] == by[2]["n_removed"] == 0
    assert by[7]["n_removed"] == 150_000 - 5 and by[7]["n_spans"] == 1  # "word " repeats after one period
    assert S.repeated_bytes(empty_docs).collect() == []


def test_repeated_rows_are_one_document(make_docs):
    text = " ".join(f"w{k}" for k in range(200))
    got = sorted(tuple(r)[:3] for r in S.repeated_bytes(make_docs([(1, text), (1, text), (2, text)])).collect())
    n = len(text)
    assert got == [(1, n, 0), (1, n, 0), (2, n, n)]


def test_groups_have_all_occurrences(make_docs):
    rng = random.Random(4)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30))
    shared = prose()
    rows = [(i, f"{prose()} {shared} {prose()}") for i in range(5)]
    found = S.maximal_repeats(make_docs(rows)).collect()
    texts = {i: t.encode() for i, t in rows}
    covered = {i: bytearray(len(t)) for i, t in texts.items()}
    for g in {r["group"] for r in found}:
        own = [r for r in found if r["group"] == g]
        strings = {texts[r["doc"]][r["start"]:r["finish"]] for r in own}
        assert len(strings) == 1 and len(strings.pop()) >= 100 and len(own) > 1
        assert [r["first"] for r in sorted(own, key=lambda r: (r["doc"], r["start"]))] == [True] + [False] * (len(own) - 1)
        for r in own:
            covered[r["doc"]][r["start"]:r["finish"]] = b"\1" * (r["finish"] - r["start"])
    for i, t in texts.items():  # the passage is covered in every document, the first too
        at = t.index(shared.encode())
        assert all(covered[i][at:at + len(shared)])


def test_cut_texts_are_valid(make_docs):
    text = "é" * 300
    rows = [(1, "a" + text), (2, text + "b"), (3, None)]
    out = {r["doc_id"]: r["text"] for r in S.remove_repeats(make_docs(rows)).collect()}
    assert set(out) == {1, 2, 3} and out[2].endswith("b") and set(out[2]) <= {"é", "b"} and out[3] is None


def test_prefix_intervals():
    assert sorted(S.prefix_intervals([2, 3, 3, 0, 1])) == [(1, 4, 5), (2, 0, 3), (3, 1, 3)]
    assert list(S.prefix_intervals([])) == []


def test_removing_keeps_columns_of_any_name(make_docs):
    passage = hashlib.sha512(b"p").hexdigest() + hashlib.sha512(b"q").hexdigest()
    docs = make_docs([(1, passage), (2, f"own words {passage} and more")]).selectExpr("*", "'d' AS doc_no", "'t' AS TEXT_HASH", "'s' AS cut_spans")
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns
    assert [(r["text"], r["doc_no"], r["TEXT_HASH"], r["cut_spans"], r["_doc"], r["_digest"], r["_spans"]) for r in out.orderBy("doc_id").collect()] == [
        (passage, "d", "t", "s", "x", "x", "x"), ("own words  and more", "d", "t", "s", "x", "x", "x")]
