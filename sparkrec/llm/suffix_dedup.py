"""Repeated passages across a corpus: maximal repeats from bucketed suffix arrays.

One suffix array over the corpus would need all texts in one place. Here the
windows (strings of `min_len` bytes) are dealt into buckets by a function of
their content, so that equal windows always meet, and every bucket builds its
own enhanced suffix array:

1. *Anchors.* The anchor of a window is its smallest hashed K-gram (leftmost
   among equal ones): equal windows have their anchors at the same offset. Runs
   of windows with one anchor form a segment, about 35 windows long. A document
   sends one row of numbers a segment: the hash of the anchor's K-gram, a hash
   of the segment's bytes, and where it is.
2. *Buckets by anchor.* Segments whose anchor occurs once in the corpus repeat
   nothing and end here. Where all segments of an anchor are equal, they are a
   repeat with all its occurrences and no text is needed. Equal segments are
   reduced to their first occurrence before the shuffle, and again in it.
   The number of buckets follows the input's bytes, a task holds one bucket at
   a time, and an anchor in more contexts than a task may hold is settled by a
   partially aggregated minimum instead.
3. *Suffix arrays.* Only the first occurrences of differing segments of an
   anchor (the edges of repeats) send their text. It is cut by window offset
   into parts, bucketed by the bytes that all windows of a part share; every
   bucket sorts its suffixes, computes common prefixes of neighbours, drops
   classes that all extend to the left by the same byte, and a stack scan gives
   the tree of common-prefix intervals. Each interval of `min_len` or more is a
   maximal repeat group with all its occurrences.
4. A bucket with more than `max_bucket` parts (the edge of a passage that a
   large share of the corpus holds, in as many contexts) is taken apart into
   single windows, whose first occurrences are a partially aggregated minimum,
   so no task ever holds such a bucket.

A repeat that is longer than a segment comes out as consecutive groups, and an
occurrence within a segment that equals an earlier one is listed in that
segment's group, whose first occurrence stands for it in the suffix arrays. Every
occurrence but the first of a group is a repeated span; the union of these is
exactly the bytes covered by a `min_len`-byte string that also starts earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import all_columns, free_name, materialize, mix64

#: Bytes hashed together to choose anchors; shorter than a window.
K = 32
#: Texts are hashed in blocks of this size, which bounds a task's memory.
BLOCK = 1 << 20
#: Text bytes whose segments are pre-aggregated before they are shuffled.
FLUSH = 8 << 20
#: Text bytes whose segments share a bucket of anchors, on average.
BUCKET_BYTES = 32 << 20
#: Segments that a task holds of a bucket before it reduces them.
HELD = 1 << 21
#: Window offsets that a part of a segment spans at most.
PART = 36
#: Low bits of an ordered hash that hold the place in a block (BLOCK + min_len fits).
PLACE = np.uint64(21)

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        factors = np.ones((2, max(n, BLOCK + 4096)), np.uint64)
        factors[:, 1:] = np.array([[_BASE], [pow(_BASE, -1, 1 << 64)]], np.uint64)
        _POWERS[:] = np.cumprod(factors, axis=1)
    return _POWERS[0], _POWERS[1]


class Rolling:
    """Hashes of any substrings of one byte array, from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=self.sums[1:])

    def at(self, starts: np.ndarray, lengths) -> np.ndarray:
        return mix64((self.sums[starts + lengths] - self.sums[starts]) * self.down[starts] + np.asarray(lengths).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix64((self.sums[length:] - self.sums[:n]) * self.down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    have, step = x, 1
    while 2 * step <= width:
        have = np.minimum(have[:-step], have[step:])
        step *= 2
    rest = width - step
    return np.minimum(have[:len(have) - rest], have[rest:]) if rest else have


def segments(data: np.ndarray, pieces: np.ndarray, min_len: int) -> tuple[np.ndarray, ...]:
    """Segments of a block: starts, windows, places of the anchor in them, anchor hashes, segment hashes.

    `pieces` are the bounds of the texts in `data`; windows that cross one are
    none. Starts count from the begin of the block.
    """
    none = np.zeros(0, np.int64)
    nothing = none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    if len(data) < min_len:
        return nothing
    roll = Rolling(data)
    grams = roll.all(K)
    lowest = sliding_min(((grams >> PLACE) << PLACE) | np.arange(len(grams), dtype=np.uint64), min_len - K + 1)
    anchor = (lowest & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, np.int32)  # +1 where a text's windows begin, -1 behind their end
    long_enough = pieces[1:] - pieces[:-1] >= min_len
    np.add.at(valid, pieces[:-1][long_enough], 1)
    np.add.at(valid, np.minimum(pieces[1:][long_enough] - min_len + 1, len(anchor)), -1)
    at = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(at):
        return nothing
    own = anchor[at]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    starts, anchors = at[first], own[first]
    windows = np.diff(np.concatenate([first, [len(at)]]))
    seg = roll.at(starts, windows + (min_len - 1)) ^ mix64((anchors - starts).astype(np.uint64))
    return starts, windows, anchors - starts, grams[anchors], seg


def _order(*keys: np.ndarray) -> np.ndarray:
    """Indices that sort by the first key, then the second, and so on."""
    return np.lexsort(keys[::-1])


def _same_as_before(*keys: np.ndarray) -> np.ndarray:
    """For sorted rows: is the row equal to the one before it in all keys?"""
    same = np.ones(len(keys[0]), bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[1:] == k[:-1]
    return same


def _repeated(x: np.ndarray) -> np.ndarray:
    """Indices of the values that occur twice or more."""
    order = np.argsort(x, kind="stable")
    same = _same_as_before(x[order])
    return order[same | np.concatenate([same[1:], [False]])]


#: What a segment sends: anchor hash, segment hash, document (id, digest), start, windows
#: (with COPIED if its block holds a later copy), place of the anchor.
FIELDS = (("mu", np.uint64), ("seg", np.uint64), ("doc", np.int64), ("digest", np.int64), ("start", np.int32), ("n", np.uint8), ("place", np.uint8))
COPIED = 128
#: Places of open segments, without and with a later copy (see `_open`).
OPEN, OPEN_COPIED = -1, -2
SENT = "bucket int, " + ", ".join(f"{name} binary" for name, _ in FIELDS)
#: Occurrences of repeat groups (first: the earliest one), and, with a place, segments whose text is asked for.
FOUND = "doc long, digest long, start int, finish int, group long, first boolean, place int"


def _send_segments(min_len: int, buckets: int) -> Callable:
    """Stage 1: texts to rows of packed segments by bucket of their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, data, bounds in _blocks(batches, min_len):
            starts, n, place, mu, seg = segments(data, bounds, min_len)
            own = np.searchsorted(bounds, starts, side="right") - 1
            info = np.array(rows, np.int64).reshape(-1, 3)
            held.append((mu, seg, info[own, 0], info[own, 1], starts - bounds[own] + info[own, 2], n, place))
            size += len(data)
            if size >= FLUSH:
                yield from _pack(held, buckets)
                held, size = [], 0
        yield from _pack(held, buckets)

    return run


def _blocks(batches: Iterable[pa.RecordBatch], min_len: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Blocks of texts, long ones cut so that each window lies in one piece:
    ((doc, digest, offset) of the pieces, bytes, bounds)."""
    rows, parts, held = [], [], 0
    for b in batches:
        for doc, digest, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            raw = text.as_py().encode()
            for lo in range(0, max(1, len(raw) - min_len + 1), BLOCK):
                piece = raw[lo:lo + BLOCK + min_len - 1]
                if rows and held + len(piece) > BLOCK:
                    yield rows, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
                    rows, parts, held = [], [], 0
                rows.append((doc, digest, lo))
                parts.append(piece)
                held += len(piece)
    if rows:
        yield rows, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def _pack(held: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Of equal segments only the first goes to the anchor's bucket; the others
    are repeats already and go, without an anchor, to a bucket of their document."""
    if not held:
        return
    mu, seg, doc, digest, start, n, place = (np.concatenate(c) for c in zip(*held))
    again = np.zeros(len(mu), bool)
    twice = _repeated(mix64(mu) + seg)
    twice = twice[_order(mu[twice], seg[twice], doc[twice], digest[twice], start[twice])]
    row_again = _flag(twice, _same_as_before(mu[twice], seg[twice], doc[twice], digest[twice], start[twice]), len(n))
    twice = twice[~row_again[twice]]
    again[twice] = same = _same_as_before(mu[twice], seg[twice])
    n = n + np.where(_flag(twice, ~same & np.concatenate([same[1:], [False]])[:len(same)], len(n)), COPIED, 0)
    to = np.where(again, mix64(doc.astype(np.uint64)) % np.uint64(buckets), (mu >> PLACE) % np.uint64(buckets)).astype(np.int64)
    order = _order(to, again, doc, start)
    order = order[~row_again[order]]
    cut = np.flatnonzero(~_same_as_before(to[order], again[order]))
    size, known = np.diff([*cut, len(order)]), ~again[order[cut]]
    packed = [pa.array(to[order[cut]], pa.int32())]
    for col, (name, kind) in zip((mu, seg, doc, digest, start, n, place), FIELDS):
        bare = name in ("mu", "place")  # what repeats already go without
        ends = np.concatenate([[0], np.cumsum(size * known if bare else size)]) * np.dtype(kind).itemsize
        values = np.ascontiguousarray(col[order[~again[order]] if bare else order].astype(kind))
        packed.append(pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]))
    yield pa.RecordBatch.from_arrays(packed, ["bucket", *(name for name, _ in FIELDS)])


def _flag(at: np.ndarray, which: np.ndarray, size: int) -> np.ndarray:
    flags = np.zeros(size, bool)
    flags[at[which]] = True
    return flags


def _match_anchors(min_len: int, held_rows: int) -> Callable:
    """Stage 2: occurrences of equal segments, and the segments whose text is asked for.

    Rows arrive sorted by bucket, and a bucket is held at a time. At `held_rows`
    segments it is reduced to the first of each kind; an anchor that even then has
    more than a quarter of them (the edge of a passage in very many contexts)
    leaves the task as open rows, which a partially aggregated minimum settles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, size, limit, wide = None, [], 0, held_rows, np.zeros(0, np.uint64)
        for b in batches:
            for at, *packed in zip(b.column(0).to_pylist(), *(b.column(1 + k) for k in range(len(FIELDS)))):
                own = [np.frombuffer(p.as_py(), kind) for p, (_, kind) in zip(packed, FIELDS)]
                if not len(own[0]):
                    yield _found(own[2], own[3], own[4], own[4] + own[5] + np.int32(min_len - 1), own[1], False)
                    continue
                if at != bucket:
                    yield from _settle(held, wide, min_len)
                    bucket, held, size, limit, wide = at, [], 0, held_rows, wide[:0]
                held.append(own)
                size += len(own[0])
                if size >= limit:
                    rows, copies = _reduced(held)
                    yield _spans(copies, min_len, False)
                    begins = np.flatnonzero(~_same_as_before(rows[0]))
                    kinds = np.diff([*begins, len(rows[0])])
                    wide = np.union1d(wide, rows[0][begins[kinds > held_rows // 4]])
                    out = np.isin(rows[0], wide)
                    yield from _open(_take(rows, out), min_len)
                    held = [_take(rows, ~out)]
                    size = len(held[0][0])
                    limit = max(held_rows, 2 * size)
        yield from _settle(held, wide, min_len)

    return run


def _take(rows: list[np.ndarray], which: np.ndarray) -> list[np.ndarray]:
    return [c[which] for c in rows]


def _reduced(held: list[list[np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The first of each kind of segment (equal anchor and segment), sorted by anchor
    and marked COPIED if there is a later one, and the later ones; equal rows count once."""
    rows = [np.concatenate(c) for c in zip(*held)]
    rows = _take(rows, _order(*rows[:5]))
    leads = np.flatnonzero(~_same_as_before(rows[0], rows[1]))
    marked = np.maximum.reduceat(rows[5] & COPIED, leads) if len(leads) else rows[5]
    rows[5] = (rows[5] & (COPIED - 1)) | np.repeat(marked, np.diff([*leads, len(rows[0])]))
    rows = _take(rows, ~_same_as_before(*rows[:5]))
    copy = _same_as_before(rows[0], rows[1])
    rows[5][~copy & np.concatenate([copy[1:], [False]])[:len(copy)]] |= COPIED
    return _take(rows, ~copy), _take(rows, copy)


def _settle(held: list[list[np.ndarray]], wide: np.ndarray, min_len: int) -> Iterator[pa.RecordBatch]:
    """What a whole bucket gives: repeated segments, and those of anchors with several kinds, whose text is asked for."""
    if not held:
        return
    if len(wide):
        rows = [np.concatenate(c) for c in zip(*held)]
        out = np.isin(rows[0], wide)
        yield from _open(_take(rows, out), min_len)
        held = [_take(rows, ~out)]
    mu, n = (np.concatenate([h[k] for h in held]) for k in (0, 5))
    keep = np.union1d(_repeated(mu), np.flatnonzero(n >= COPIED))
    rows, copies = _reduced([[np.concatenate(c)[keep] for c in zip(*held)]])
    yield _spans(copies, min_len, False)
    yield _spans(_take(rows, rows[5] >= COPIED), min_len, True)
    same = _same_as_before(rows[0])
    asked = _take(rows, same | np.concatenate([same[1:], [False]])[:len(same)])
    yield _asked(asked, min_len)


def _spans(rows: list[np.ndarray], min_len: int, first: bool, place: np.ndarray | None = None) -> pa.RecordBatch:
    _, seg, doc, digest, start, n, _ = rows
    return _found(doc, digest, start, start + (n & (COPIED - 1)) + np.int32(min_len - 1), seg, first, place)


def _asked(rows: list[np.ndarray], min_len: int) -> pa.RecordBatch:
    mu, _, doc, digest, start, n, place = rows
    return _found(doc, digest, start, start + (n & (COPIED - 1)) + np.int32(min_len - 1), mu, True, place)


def _open(rows: list[np.ndarray], min_len: int) -> Iterator[pa.RecordBatch]:
    """Segments of an anchor with too many kinds for a task: their text is asked
    for, and which of equal ones is the first is left to `maximal_repeats`."""
    yield _asked(rows, min_len)
    yield _spans(rows, min_len, False, np.where(rows[5] >= COPIED, OPEN_COPIED, OPEN))


def _found(doc, digest, start, finish, group, first: bool, place=None) -> pa.RecordBatch:
    size = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(digest, pa.int64()), pa.array(start.astype(np.int32)), pa.array(finish.astype(np.int32)),
         pa.array(np.ascontiguousarray(group).view(np.int64)), pa.array(np.full(size, first)),
         pa.nulls(size, pa.int32()) if place is None else pa.array(place.astype(np.int32))],
        ["doc", "digest", "start", "finish", "group", "first", "place"])


PARTS = "bucket long, doc long, digest long, start int, bytes binary"


def _cut_parts(min_len: int) -> Callable:
    """Stage 3a: the texts of asked segments, cut into parts by distance from the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, digest, text, asked in zip(*(b.column(k) for k in range(4))):
                raw, doc, digest = text.as_py().encode(), doc.as_py(), digest.as_py()
                for a in asked.as_py():
                    out += _parts(raw, doc, digest, a["start"], a["finish"], a["start"] + a["place"], min_len)
                if len(out) > 20_000:
                    yield _batch(out, PART_KINDS)
                    out = []
            yield _batch(out, PART_KINDS)

    return run


def _parts(raw: bytes, doc: int, digest: int, start: int, finish: int, anchor: int, min_len: int) -> list[tuple]:
    """Parts of one segment. All windows of the segment hold its anchor; a part
    takes the windows whose distance to the anchor lies in one range of PART, and
    its bucket is a hash of the bytes that all windows of that range share."""
    out, at = [], start
    while at <= finish - min_len:
        level = (anchor - at) // PART
        last = min(finish - min_len, anchor - level * PART)
        lo = anchor - level * PART
        shared = raw[lo:lo - PART + 1 + min_len]
        key = int.from_bytes(hashlib.blake2b(shared, digest_size=8, salt=level.to_bytes(4, "little")).digest(), "little", signed=True)
        out.append((key, doc, digest, at, raw[at:last + min_len]))
        at = last + 1
    return out


PART_KINDS = {"bucket": pa.int64(), "doc": pa.int64(), "digest": pa.int64(), "start": pa.int32(), "bytes": pa.binary()}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.values())], list(kinds))


def _suffix_arrays(min_len: int, flush: int = 20_000) -> Callable:
    """Stage 3b: maximal repeat groups of buckets, which arrive sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(5))):
                if len(held) >= flush and row[0] != held[-1][0]:
                    yield from repeat_groups(held, min_len)
                    held = []
                held.append(row)
        if held:
            yield from repeat_groups(held, min_len)

    return run


def repeat_groups(parts: list[tuple], min_len: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of the maximal repeats of `min_len` bytes or more among
    parts (bucket, doc, digest, start, bytes)."""
    parts = list({p[:4]: p for p in parts}.values())  # equal rows send equal parts
    size = np.array([len(p[4]) for p in parts])
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(p[4] for p in parts), np.uint8)
    n = size - min_len + 1
    part = np.repeat(np.arange(len(parts)), n)
    inside = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
    at = (ends - size)[part] + inside
    roll = Rolling(data)

    # classes of equal windows, and the class of the window one byte to the left
    windows = roll.at(at, min_len)
    order = np.argsort(windows, kind="stable")
    new = ~_same_as_before(windows[order])
    cls = np.empty(len(order), np.int64)
    cls[order] = np.cumsum(new) - 1
    times = np.bincount(cls)
    left = np.where(inside > 0, np.concatenate([[0], cls[:-1]]), -1 - np.arange(len(cls)))
    member = order[times[cls[order]] > 1]
    if not len(member):
        return
    begins = np.flatnonzero(~_same_as_before(cls[member]))
    low, high = np.minimum.reduceat(left[member], begins), np.maximum.reduceat(left[member], begins)
    count = np.diff([*begins, len(member)])
    diverse = (low != high) | (low < 0) | (times[np.maximum(low, 0)] != count)
    member = member[np.repeat(diverse, count)]  # the others extend to the left, all by the same byte
    if not len(member):
        return

    # enhanced suffix array: suffixes by class, then by the bytes that follow; common prefix with the one before
    rest = (ends[part] - at)[member] - min_len
    wide = -(-max(1, int(rest.max())) // 8) * 8
    follow = np.zeros((len(member), wide), np.uint8)
    for k in range(wide):
        more = rest > k
        follow[more, k] = data[at[member[more]] + min_len + k]
    words = follow.view(">u8")
    order = _order(cls[member], *(words[:, k] for k in range(words.shape[1])), rest)
    member, rest, follow = member[order], rest[order], follow[order]
    differ = follow[1:] != follow[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), wide)
    common = min_len + np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    common[cls[member[1:]] != cls[member[:-1]]] = 0

    doc, digest = (np.array([p[k] for p in parts], np.int64)[part[member]] for k in (1, 2))
    start = np.array([p[3] for p in parts], np.int64)[part[member]] + inside[member]
    rank = np.empty(len(member), np.int64)
    rank[_order(doc, digest, start)] = np.arange(len(member))
    lefts = left[member]
    who, length, first = [], [], []
    for depth, lo, hi in prefix_intervals(common.tolist()):
        own = lefts[lo:hi + 1]
        if own[0] >= 0 and (own == own[0]).all():
            continue  # no left diversity: a longer repeat holds this one
        i = np.arange(lo, hi + 1)
        who.append(i)
        length.append(np.full(len(i), depth))
        first.append(rank[i] == rank[i].min())
    if not who:
        return
    who, length, first = np.concatenate(who), np.concatenate(length), np.concatenate(first)
    group = roll.at(at[member[who]], length)
    for earliest in (True, False):
        i = first == earliest
        yield _found(doc[who[i]], digest[who[i]], start[who[i]], start[who[i]] + length[i], group[i], earliest)


def prefix_intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """Stack scan: (length, first, last) of every common-prefix interval, where
    common[i] is the prefix that suffixes i and i + 1 share."""
    stack: list[tuple[int, int]] = []  # (length, first suffix), lengths rising
    for i, c in enumerate([*common, 0]):
        lo = i
        while stack and stack[-1][0] > c:
            depth, lo = stack.pop()
            yield depth, lo, i
        if c and (not stack or stack[-1][0] < c):
            stack.append((c, lo))


def _split_windows(min_len: int) -> Callable:
    """Stage 4: every window of the parts of too large buckets, as a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 5000):
                rows = list(zip(*(b.column(k)[lo:lo + 5000].to_pylist() for k in range(5))))
                size = np.array([len(r[4]) for r in rows])
                n = size - min_len + 1
                part = np.repeat(np.arange(len(rows)), n)
                inside = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
                roll = Rolling(np.frombuffer(b"".join(r[4] for r in rows), np.uint8))
                hashes = roll.at((np.cumsum(size) - size)[part] + inside, min_len)
                start = np.array([r[3] for r in rows])[part] + inside
                yield _found(np.array([r[1] for r in rows])[part], np.array([r[2] for r in rows])[part], start, start + min_len, hashes, False)

    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, digest, text): documents in the order that decides which occurrence is first.

    Null ids come last; rows with equal ids come in the order of a hash of their
    text, and equal rows count as one document.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(text).alias("digest"), text.alias("text"))


def maximal_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_len: int = 100,
                    max_bucket: int = 20_000, bucket_bytes: int = BUCKET_BYTES, held_rows: int = HELD) -> DataFrame:
    """All occurrences of repeated strings: doc, digest, start, finish (bytes), group, first.

    ``group`` is a hash of the repeated string; of every group one occurrence,
    the earliest, is ``first``. The union of the others is exactly the set of
    bytes covered by a `min_len`-byte string that also starts earlier.
    """
    if not K < min_len <= K + COPIED - 2:
        raise ValueError(f"min_len must lie in {K + 1}..{K + COPIED - 2}")
    texts = keyed(docs, id_col, text_col)
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts_to_send = texts.where(F.octet_length("text") >= min_len)
    n_bytes = texts_to_send.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(4 * tasks, -(-n_bytes // bucket_bytes))  # a task holds one bucket at a time, so this bounds its memory at any size
    sent = texts_to_send.mapInArrow(_send_segments(min_len, buckets), SENT)
    found = materialize(sent.repartition(tasks, "bucket").sortWithinPartitions("bucket")
                        .mapInArrow(_match_anchors(min_len, held_rows), FOUND), "anchors")

    asked = found.where("place >= 0").groupBy("doc", "digest").agg(F.collect_list(F.struct("start", "finish", "place")).alias("asked"))
    with_text = texts.join(asked, ["doc", "digest"]).select("doc", "digest", "text", "asked")
    parts = materialize(with_text.mapInArrow(_cut_parts(min_len), PARTS), "parts")
    large = parts.groupBy("bucket").count().where(F.col("count") > max_bucket).select("bucket")
    groups = (parts.join(large, "bucket", "left_anti").select("bucket", "doc", "digest", "start", "bytes")
              .repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_suffix_arrays(min_len), FOUND))
    single = (parts.join(large, "bucket", "left_semi").select("bucket", "doc", "digest", "start", "bytes")
              .mapInArrow(_split_windows(min_len), FOUND).drop("first", "place"))
    firsts = single.groupBy("group").agg(F.min(F.struct("doc", "digest", "start")).alias("lead"), F.count("*").alias("times")).where("times > 1")
    split = single.join(firsts, "group").select(
        "doc", "digest", "start", "finish", "group", (F.struct("doc", "digest", "start") == F.col("lead")).alias("first"))
    open_ = (found.where("place < 0").groupBy("group", "doc", "digest", "start", "finish")
             .agg((F.min("place") == OPEN_COPIED).alias("copied")))
    firsts = open_.groupBy("group").agg(F.min(F.struct("doc", "digest", "start")).alias("lead"), F.count("*").alias("times"),
                                        F.max("copied").alias("known")).where("times > 1 OR known")
    opened = open_.join(firsts, "group").select(
        "doc", "digest", "start", "finish", "group", (F.struct("doc", "digest", "start") == F.col("lead")).alias("first"))
    columns = ["doc", "digest", "start", "finish", "group", "first"]
    return (found.where("place is null").select(columns).union(groups.select(columns)).union(split.select(columns))
            .union(opened.select(columns)))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs of the union of half-open spans."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for lo, hi in runs:
        kept.append(raw[at:lo])
        at = hi
    return b"".join([*kept, raw[at:]])


def _repeated_runs(docs: DataFrame, id_col: str, text_col: str, options: dict) -> DataFrame:
    """Per document (doc, digest), its repeated spans: no more than its length."""
    spans = maximal_repeats(docs, id_col=id_col, text_col=text_col, **options).where(~F.col("first"))
    return spans.groupBy("doc", "digest").agg(F.collect_set(F.struct("start", "finish")).alias("spans"))


def repeated_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per input row.

    Null texts count as empty. Null ids come last in the order of documents;
    rows with equal ids are ordered by a hash of their text, and equal rows are
    one document whose result is repeated. Texts shorter than `min_len` are
    kept whole.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
                       F.xxhash64(text).alias("digest"), text.alias("text"))
    joined = rows.join(_repeated_runs(docs, id_col, text_col, options), ["doc", "digest"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(2).to_pylist()):
                raw = text.as_py().encode()
                runs = merged([(s["start"], s["finish"]) for s in spans or ()])
                out.append((len(raw), sum(hi - lo for lo, hi in runs), len(runs), hashlib.sha256(without(raw, runs)).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with repeated bytes cut from the texts, all columns and rows kept.

    A span that begins or ends inside a character is narrowed to whole
    characters, so the text stays valid UTF-8. ``n_chars`` is renewed.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc, digest, spans_ = (free_name(c, docs) for c in ("doc_no", "text_hash", "cut_spans"))
    marked = docs.withColumns({doc: F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)), digest: F.xxhash64(text)})
    runs = _repeated_runs(docs, id_col, text_col, options).select(F.col("doc").alias(doc), F.col("digest").alias(digest), F.col("spans").alias(spans_))
    joined = marked.join(runs, [doc, digest], "left").select(*all_columns(docs), spans_)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                place = {f.name: i for i, f in enumerate(b.schema)}
                texts = b.column(place[text_col]).to_pylist()
                for i, spans in enumerate(b.column(place[spans_]).to_pylist()):
                    if spans:
                        raw = texts[i].encode()
                        runs = [whole_characters(raw, lo, hi) for lo, hi in merged([(s["start"], s["finish"]) for s in spans])]
                        texts[i] = without(raw, [(lo, hi) for lo, hi in runs if lo < hi]).decode()
                fresh = {text_col: texts}
                if "n_chars" in place and pa.types.is_integer(b.schema.field("n_chars").type):
                    fresh["n_chars"] = [len(t) if t is not None else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fresh[c], b.schema.field(c).type) if c in fresh else b.column(place[c]) for c in schema.names], schema.names)

    return joined.mapInArrow(run, schema)


def whole_characters(raw: bytes, lo: int, hi: int) -> tuple[int, int]:
    """The part of a span that holds whole characters only."""
    while lo < hi and raw[lo] & 0xC0 == 0x80:
        lo += 1
    while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
        hi -= 1
    return lo, hi
