"""op13: the jump sequence in plain Python, the key law, gapless slots, whole files."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rows import ODD
from sparkrec.llm.sharding import jump, shard, write_shards


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def plain_key(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:16], 16)


def test_jump_equals_the_plain_sequence():
    keys = np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert jump(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    assert jump(np.zeros(0, np.uint64), 24).tolist() == []
    with pytest.raises(ValueError):
        jump(keys, 0)


def test_a_shard_more_takes_rows_only_into_itself():
    keys = np.random.default_rng(2).integers(0, 2**64, 20_000, dtype=np.uint64)
    old, new = jump(keys, 24), jump(keys, 25)
    assert set(new[old != new]) == {24}
    assert 600 < (old != new).sum() < 1000  # one in 25
    assert max(Counter(old.tolist()).values()) < 1.2 * 20_000 / 24


def check(docs, rows, shards):
    out = [r.asDict() for r in shard(docs, shards=shards).collect()]
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in out:
        assert r["law"] == "key" and r["shard"] == plain_jump(plain_key(r["doc_id"]), shards)
        assert r["grown_shard"] == plain_jump(plain_key(r["doc_id"]), shards + 1)
        slots[r["shard"]].append(r)
    for own in slots.values():
        own.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        order = [(plain_key(r["doc_id"]), r["text_crc32"], r["size"]) for r in own]
        assert order == sorted(order)


def test_odd_rows(make_docs):
    check(make_docs(ODD), ODD, 3)


def test_one_id_with_most_rows(make_docs):
    rows = [(7, f"text {i % 5}") for i in range(300)] + [(i, "x") for i in range(100)]
    check(make_docs(rows), rows, 4)


def test_given_documents(sf_docs):
    check(*sf_docs, 24)


def test_empty_table(empty_docs):
    assert shard(empty_docs).collect() == []


def test_files_hold_all_rows_and_columns(make_docs, tmp_path):
    docs = make_docs(ODD).withColumn("shard", F.lit("mine")).withColumn("value", F.lit(None).cast("string"))
    write_shards(docs, str(tmp_path / "out"), shards=5, files=2)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.drop("shard_no").collect())) == sorted(map(str, docs.collect()))
    assert all(r["shard_no"] == plain_jump(plain_key(r["doc_id"]), 5) for r in back.collect())
    with pytest.raises(ValueError):
        write_shards(docs.withColumn("shard_no", F.lit(1)), str(tmp_path / "no"))
