"""op11 against a trie built from whole sequences."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkrec.llm.prefix_trie import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_key(row):
    role, text = row[2] or "", row[3] or ""
    return (row[1] is not None, row[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest())


def brute(rows, rebuild=True):
    """Every node from sets of members of whole prefixes."""
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=turn_key):
        own[r[0]].append((r[2] or "", r[3] or ""))
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple([*own.get(c - int(math.fmod(c, 20)), [])[:h], *turns[h:]]) if rebuild else tuple(turns)
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = (len(members[s]) - 1) * words + sum(saved[k] for k in kids[s])
    return sorted((min(m), len(s), min(members[s[:-1]]) if s else -1, len(m), len(kids[s]), leaves[s], saved[s],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(s)))).encode()).hexdigest()) for s, m in members.items())


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("depth", "path", "words", "key", "node", "block"):
        df = df.withColumn(name, F.lit("x"))
    out = trie(df, **options)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())
    assert got == brute(rows, options.get("rebuild", True))


ODD = [(0, 0, "user", "a b"), (0, 1, "assistant", "c\td \x0b e"), (0, None, None, None), (1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, 5, "", ""),
       (2, 0, "user", "a b"), (3, 3, "user", ""), (21, 0, "user", "no base"), (None, 0, "user", "lost"), (40, 0, "system", "x"), (41, 1, "system", "x"),
       (42, 0, "syste", "mx"), (43, 2, "é", "naïve café 日本"), (44, 7, "a", "long " * 3000), (45, None, "a", "z"), (45, None, "b", "y"), (-3, 0, "user", "a b")]


def test_odd_rows(spark):
    check(spark, ODD)
    check(spark, ODD, rebuild=False)


def test_no_conversations(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []
    check(spark, [(None, 0, "user", "lost")])
    check(spark, [(5, None, None, None)])


@pytest.mark.parametrize("most_cells", [30, 200_000])
def test_random_conversations(spark, most_cells):
    """Short and long ones, shared beginnings, copies; small limits split hot groups."""
    draw = random.Random(most_cells)
    rows = []
    stem = [("user" if i % 2 else "assistant", f"stem {i}") for i in range(13)]
    for c in range(90):
        turns = stem[:draw.randrange(14)] if draw.random() < 0.6 else []
        turns = turns + [(draw.choice(["user", "assistant"]), draw.choice(["x", "y y", ""])) for _ in range(draw.randrange(1, 5))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(turns)]
    check(spark, rows, most_cells=most_cells, rebuild=most_cells > 30)


def test_very_many_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(400, 900) for t in range(3)] + [(3000, t, "user", f"{t}") for t in range(700)]
    check(spark, rows, rebuild=False, most_cells=50)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    check(spark, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
