"""op10 against all pairs by full sets."""

import random
import re

import numpy as np
import pytest
from rows import ODD

from sparkrec.llm import minhash as M
from sparkrec.llm.minhash import drop_near_duplicates, near_duplicates


def sets_of(rows, words):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((i, {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())))
    return out


def brute(rows, words=2, percent=80):
    sets = sets_of(rows, words)
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), top(i), i == top(i)) for i, s in sets)


def variants(seed, groups=12):
    """Groups of texts that differ by a few words, near the bound too."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 14, 40, 120, 150, 190, 260, 500]))]
        for _ in range(rng.randint(2, 14)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 14))):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((i, " ".join(own[:len(own) - rng.randint(0, len(own) // 12)])))
            i += rng.randint(1, 3)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(make_docs, seed):
    rows = variants(seed)
    got = sorted(tuple(r) for r in near_duplicates(make_docs(rows), words=2).collect())
    assert got == brute(rows)


def test_given_documents(sf_docs):
    df, rows = sf_docs
    assert sorted(tuple(r) for r in near_duplicates(df, words=2).collect()) == brute(rows)


def test_chain_without_a_common_centre(make_docs):
    """a-b-c-d link in a row only: no star reaches all of them."""
    words = [f"t{k}" for k in range(140)]
    rows = [(i, " ".join(words[8 * i:8 * i + 90])) for i in range(5)]
    got = near_duplicates(make_docs(rows), words=2).collect()
    assert {r["component_id"] for r in got} == {0}


def test_odd_rows(make_docs, empty_docs):
    got = near_duplicates(make_docs(ODD), words=2).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert by[1]["n_shingles"] == by[3]["n_shingles"] == 0 and by[3]["kept"]
    assert by[5]["component_id"] == 4 and not by[5]["kept"] and by[7]["n_shingles"] == 1 and by[1]["component_id"] == 1
    assert near_duplicates(empty_docs).collect() == []


def test_dropping_keeps_one_of_each(make_docs):
    rows = variants(5)
    kept = {r["doc_id"] for r in drop_near_duplicates(make_docs(rows), words=5).collect()}
    assert kept == {i for i, _, _, k in brute(rows, words=5) if k}


def test_densified_sketches_of_equal_sets_are_equal():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 1 << 63, 7, dtype=np.uint64))
    owner = np.repeat([0, 1], 7)
    sketch = M.densified(owner, np.concatenate([a, a]), 2, 200)
    assert (sketch[0] == sketch[1]).all() and set(sketch[0].tolist()) <= set(a.tolist())


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[200:])  # 800 of 1200 shared
    sketch = M.densified(np.repeat([0, 1], 1000), np.concatenate([a, b]), 2, 200)
    assert abs((sketch[0] == sketch[1]).mean() - 2 / 3) < 0.12


def test_dropping_tells_rows_with_one_id_apart(make_docs):
    """One row of each component stays, whatever its id; a unique text never goes."""
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcdef"}
    rows = [(3, text["a"]), (5, text["a"]), (5, text["b"]), (7, text["c"]), (7, text["c"]), (7, text["c"]),
            (None, text["d"]), (None, text["d"]), (None, text["e"]), (9, text["e"] + " more"), (10, text["f"]), (11, None), (12, "")]
    kept = sorted(((r["doc_id"], r["text"]) for r in drop_near_duplicates(make_docs(rows), words=5).collect()), key=str)
    want = [(3, text["a"]), (5, text["b"]), (7, text["c"]), (None, text["d"]), (9, text["e"] + " more"), (10, text["f"]), (11, None), (12, "")]
    assert kept == sorted(want, key=str)


def test_one_id_with_different_texts(make_docs):
    """Sets link, and ids only name them: an unrelated text keeps its own component."""
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(3, text), (5, text + " more"), (5, " ".join(f"x{k}" for k in range(60))), (5, text + " more"), (9, " ".join(f"x{k}" for k in range(60)))]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(make_docs(rows), words=2).collect())
    assert got == sorted([(3, 59, 3, True), (5, 60, 3, False), (5, 60, 3, False), (5, 59, 5, True), (9, 59, 5, False)])


def test_dropping_keeps_columns_of_any_name(make_docs):
    docs = make_docs([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None)]).selectExpr("*", "'r' AS row_no", "'R' AS row_no__", "'q' AS `odd.name`")
    kept = drop_near_duplicates(docs, words=5)
    assert kept.columns == docs.columns
    assert [(r["doc_id"], r["row_no"], r["_row"], r["odd.name"]) for r in kept.orderBy("doc_id").collect()] == [(1, "r", "x", "q"), (3, "r", "x", "q")]
