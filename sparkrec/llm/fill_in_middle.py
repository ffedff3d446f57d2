"""Fill-in-the-middle transformation with cuts at line ends.

A text's bytes are seen as fixed blocks. A Fenwick tree over the blocks holds how
many units (lines) end in each and how many code points begin in it. The block in
which a unit ends is found by binary lifting down the tree, the byte by looking
at that block alone, and the code points before a cut are a prefix sum of the tree
and a count within the block. The text is never split into a list of lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import pick

#: The marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes of a block of the tree.
BLOCK = 1024
NEWLINE = 0x0A
#: Rows of an output batch, so that a batch holds few long texts at once.
ROWS = 256


class Blocks:
    """A text's blocks: a Fenwick tree of unit and code-point counts."""

    def __init__(self, raw: bytes, block: int = BLOCK):
        self.raw = np.frombuffer(raw, np.uint8)
        self.block = block
        starts = np.arange(0, len(raw), block)
        ends = (self.raw == NEWLINE).astype(np.int64)
        if len(raw):
            ends[-1] = 1  # what follows the last newline is a unit as well
        begins = ((self.raw & 0xC0) != 0x80).astype(np.int64)
        self.tree = np.zeros((len(starts) + 1, 2), np.int64)
        if len(raw):
            self.tree[1:, 0] = np.add.reduceat(ends, starts)
            self.tree[1:, 1] = np.add.reduceat(begins, starts)
            for i in range(1, len(self.tree)):
                above = i + (i & -i)
                if above < len(self.tree):
                    self.tree[above] += self.tree[i]
        self.n = int(self._before(len(starts), 0))
        self.chars = int(self._before(len(starts), 1))

    def _before(self, blocks: int, what: int) -> int:
        """Units (0) or code points (1) of the first `blocks` blocks."""
        total = 0
        while blocks:
            total += int(self.tree[blocks, what])
            blocks &= blocks - 1
        return total

    def _block_of(self, unit: int) -> tuple[int, int]:
        """The block in which the `unit`-th unit (from 1) ends, and the units that end before it."""
        at, passed = 0, 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            below = at + step
            if below < len(self.tree) and passed + int(self.tree[below, 0]) < unit:
                at, passed = below, passed + int(self.tree[below, 0])
            step >>= 1
        return at, passed

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code point) after the first `units` units."""
        if units <= 0:
            return 0, 0
        if units >= self.n:
            return len(self.raw), self.chars
        block, passed = self._block_of(units)
        lo = block * self.block
        own = self.raw[lo:lo + self.block]
        end = int(np.flatnonzero(own == NEWLINE)[units - passed - 1]) + 1
        return lo + end, self._before(block, 1) + int(np.count_nonzero((own[:end] & 0xC0) != 0x80))


@dataclass(frozen=True)
class Plan:
    """How to draw: `seed` goes before the id in the hash, `rate` per cent of the
    texts are transformed, `spm` per cent of those put the suffix first."""

    seed: str = "7:"
    rate: int = 100
    spm: int = 50

    def draws(self, doc_id) -> tuple[int, int, int, int]:
        digest = hashlib.sha256(f"{self.seed}{'' if doc_id is None else doc_id}".encode()).digest()
        return tuple(int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4))


def transform(doc_id, text: str, plan: Plan = Plan(), block: int = BLOCK) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars and the output of one text."""
    raw = text.encode()
    blocks = Blocks(raw, block)
    h1, h2, h3, h4 = plan.draws(doc_id)
    if not raw or h3 % 100 >= plan.rate or any(m in text for m in MARKS):
        return blocks.n, "plain", None, None, text
    a, b = h1 % (blocks.n + 1), h2 % (blocks.n + 1)
    (lo, first), (hi, second) = blocks.cut(min(a, b)), blocks.cut(max(a, b))
    prefix, middle, suffix = raw[:lo].decode(), raw[lo:hi].decode(), raw[hi:].decode()
    p, s, m = MARKS
    if h4 % 100 < plan.spm:
        return blocks.n, "spm", first, second - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return blocks.n, "psm", first, second - first, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan(), block: int = BLOCK) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per row of `docs`.

    Null texts count as empty; empty texts and those with a mark in them stay
    plain, with null counts. Rows without id draw as the empty text; rows that share
    an id draw alike. One pass without a shuffle; a task holds one text and its blocks.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                rows = [transform(i, t.as_py(), plan, block) for i, t in zip(b.column(0).to_pylist(), b.column(1))]
                n, form, first, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.string())], names)

    return pick(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that `output` was made from.

    A transformed text holds no mark, and no mark can begin in one part and end in
    the next (each begins with < and ends with > and holds neither elsewhere), so the
    first mark of each kind is the one that was put in.
    """
    p, s, m = MARKS

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.char_length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.char_length(one) + len(second) + 1, F.char_length(body))
        two = F.substring_index(rest, m, 1)
        return one, two, F.substring(rest, F.char_length(two) + len(m) + 1, F.char_length(rest))

    prefix, suffix, middle = parts(p, s)
    suffix2, prefix2, middle2 = parts(s, p)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output))


def digests(transformed: DataFrame) -> DataFrame:
    """The columns of `fill_in_middle` with hashes of the output and of the restored text."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                              sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
