"""op2: every piece in one bin, no bin too full, and a plan that is worth it."""

import random

import pytest
from rows import ODD

from sparkrec.llm.packing import best_plan, default_cost, make_plan, pack

SIZES = (64, 128, 256)


def check_bins(rows, sizes):
    bins = {}
    for r in rows:
        if r["n_bytes"]:
            bins.setdefault(r["bin_id"], []).append(r)
        else:
            assert r["bin_id"] is None and r["capacity"] is None
    for own in bins.values():
        capacity = {r["capacity"] for r in own}
        used = sum(r["n_bytes"] for r in own)
        assert len(capacity) == 1 and capacity == {min(c for c in sizes if c >= used)}  # downsized
        at = 0
        for r in sorted(own, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["n_bytes"]
    assert sorted(bins) == list(range(len(bins)))
    return bins


def simple_best_fit(lengths, sizes):
    """Best fit decreasing, one item at a time, largest bins, downsized at the end."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((k for k, r in enumerate(rooms) if r >= n), key=lambda k: rooms[k], default=None)
        if fit is None:
            rooms.append(sizes[-1])
            fit = len(rooms) - 1
        rooms[fit] -= n
    return sum(default_cost(min(c for c in sizes if c >= sizes[-1] - r), sizes[-1]) for r in rooms)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_byte_is_packed_once(make_docs, seed):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.choice([0, 1, 5, 64, 256, 257, 600, rng.randint(0, 300)])) for i in range(200)]
    got = pack(make_docs(rows), capacities=SIZES).collect()
    check_bins(got, SIZES)
    for i, t in rows:
        own = sorted((r["piece"], r["start"], r["n_bytes"]) for r in got if r["doc_id"] == i)
        assert own == [(k, k * 256, min(256, len(t) - k * 256)) for k in range(max(1, -(-len(t) // 256)))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_plan_equals_plain_best_fit_and_joint_is_no_worse(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 256) for _ in range(300)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plain = make_plan(counts, [256], SIZES, default_cost)
    assert plain.cost == pytest.approx(simple_best_fit(lengths, SIZES))
    assert best_plan(counts, SIZES).cost <= plain.cost


def test_odd_rows_and_hot_lengths(make_docs, empty_docs, monkeypatch):
    import sparkrec.llm.packing as P
    monkeypatch.setattr(P, "NUMBERED", 7)
    rows = ODD + [(100 + i, "y" * 50) for i in range(90)]
    got = pack(make_docs(rows), capacities=SIZES).collect()
    check_bins(got, SIZES)
    assert sum(r["n_bytes"] for r in got) == sum(len((t or "").encode()) for _, t in rows)
    assert pack(empty_docs).collect() == []
