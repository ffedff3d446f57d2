"""Embedding near-duplicates: an exact range join in the metric of unit vectors.

A cosine of at least c is a distance of at most r = sqrt(2 - 2c) between unit
vectors. Pivots (a bounded sample) split every label's vectors into cells by
nearest pivot. If x and y link and lie in cells i and j, the triangle inequality
gives d(y, p_i) <= R_i + r, with R_i the radius of cell i, and
d(y, p_i) <= d(y, p_j) + 2r; so y is copied to every smaller cell i that meets
both, and each cell joins its own vectors with its own and the copied ones, on
its own. Cells of many vectors are joined in blocks, so a task holds two blocks
at most. Equal vectors are one vector with a weight.

A cell gives back link counts and, for each vector, the smallest vector that its
links in the block reach: rows in proportion to the vectors, not to the links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import components, materialize

#: Slack for rounding in the bounds; the cosine itself decides links.
SLACK = 1e-9


def unit_vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) to (vec_id, label, unit): null unit where the
    vector is null, empty, zero or has a null or non-finite component."""
    for b in batches:
        units = []
        for v in b.column(2).to_pylist():
            unit = None
            if v and None not in v:
                x = np.array(v, np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top
                    unit = (x / np.sqrt(x @ x)).tobytes()
            units.append(unit)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(units, pa.binary())], ["vec_id", "label", "unit"])


def _matrix(units: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


def _by_group(b: pa.RecordBatch, pivots: dict) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """Rows of a batch by group: (row numbers, cells of the group, distances)."""
    rows: dict[str, list[int]] = {}
    for i, g in enumerate(b.column("g").to_pylist()):
        rows.setdefault(g, []).append(i)
    units = b.column("unit").to_pylist()
    for g, own in rows.items():
        if g in pivots:
            cells, p = pivots[g]
            yield own, cells, _distances(_matrix([units[i] for i in own]), p)
        else:
            yield own, [-1], np.zeros((len(own), 1))


def _assign(pivots: dict):
    """Home cell and distance to its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, away = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
            for own, cells, d in _by_group(b, pivots):
                nearest = d.argmin(axis=1)
                home[own] = np.array(cells, np.int32)[nearest]
                away[own] = d[np.arange(len(own)), nearest]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home), pa.array(away)], [*b.schema.names, "cell", "away"])

    return run


def _deal(pivots: dict, radius: dict[int, float], r: float):
    """Each vector to its home cell, and to smaller cells whose vectors it may link with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home = b.column("cell").to_numpy()
            at, cell, own_home = [np.arange(b.num_rows)], [home], [np.ones(b.num_rows, bool)]
            for own, cells, d in _by_group(b, pivots):
                own, cells = np.array(own), np.array(cells, np.int32)
                reach = np.array([radius.get(int(c), -np.inf) for c in cells]) + r + SLACK
                nearest = d.min(axis=1, keepdims=True)
                row, k = np.nonzero((d <= reach) & (d <= nearest + 2 * r + SLACK) & (cells[None, :] < home[own][:, None]))
                at.append(own[row])
                cell.append(cells[k])
                own_home.append(np.zeros(len(row), bool))
            at = np.concatenate(at)
            for lo in range(0, len(at), 10_000):
                i = pa.array(at[lo:lo + 10_000])
                yield pa.RecordBatch.from_arrays(
                    [b.column("g").take(i), b.column("lead").take(i), b.column("weight").take(i), b.column("unit").take(i),
                     pa.array(np.concatenate(cell)[lo:lo + 10_000]), pa.array(np.concatenate(own_home)[lo:lo + 10_000])],
                    ["g", "lead", "weight", "unit", "cell", "home"])

    return run


def join_block(left: tuple, right: tuple, min_cos: float, step: int = 500) -> tuple[np.ndarray, ...]:
    """Links of two blocks (vectors, leads, weights, home flags; all of `left` are home).

    Returns link counts and the smallest lead reached, for left and right. Counts
    of home-to-home links are kept at the left only: the mirrored pair comes up
    with the blocks changed about.
    """
    (x, x_lead, x_weight, _), (y, y_lead, y_weight, y_home) = left, right
    linked = np.zeros((len(x), len(y)), bool)
    for lo in range(0, len(x), step):
        linked[lo:lo + step] = x[lo:lo + step] @ y.T >= min_cos
    order = np.argsort(y_lead, kind="stable")  # a vector doesn't link with itself
    lo, hi = (np.searchsorted(y_lead, x_lead, side, sorter=order) for side in ("left", "right"))
    for i in np.flatnonzero(hi > lo):
        for j in order[lo[i]:hi[i]]:
            linked[i, j] &= not (x[i] == y[j]).all()
    x_links = linked @ y_weight
    y_links = np.where(y_home, 0, x_weight @ linked)
    x_low, y_low = x_lead.copy(), y_lead.copy()
    rows = np.flatnonzero(linked.any(axis=1))
    last = np.iinfo(np.int64).max
    while len(rows):
        before = x_low[rows].sum(dtype=object), y_low.sum(dtype=object)
        for lo in range(0, len(rows), step):
            own = rows[lo:lo + step]
            part = linked[own]
            x_low[own] = np.minimum(x_low[own], np.where(part, y_low, last).min(axis=1))
            y_low = np.minimum(y_low, np.where(part, x_low[own][:, None], last).min(axis=0))
        if before == (x_low[rows].sum(dtype=object), y_low.sum(dtype=object)):
            break
    return x_links, x_low, y_links, y_low


def _join_cell(min_cos: float):
    def run(table: pa.Table) -> pa.Table:
        sides = []
        for flag in (True, False):
            t = table.filter(pc.equal(table.column("left"), flag))
            units = t.column("unit").to_pylist()
            sides.append((_matrix(units) if units else np.zeros((0, 1)), t.column("lead").to_numpy(), t.column("weight").to_numpy(),
                          t.column("home").to_numpy(zero_copy_only=False) if len(units) else np.zeros(0, bool)))
        lead, links, low = (np.zeros(0, np.int64) for _ in range(3))
        if len(sides[0][1]) and len(sides[1][1]):
            x_links, x_low, y_links, y_low = join_block(*sides, min_cos)
            lead = np.concatenate([sides[0][1], sides[1][1]])
            links, low = np.concatenate([x_links, y_links]), np.concatenate([x_low, y_low])
            some = (links > 0) | (low != lead)
            lead, links, low = lead[some], links[some], low[some]
        return pa.table({"lead": pa.array(lead, pa.int64()), "links": pa.array(links.astype(np.int64)), "low": pa.array(low, pa.int64())})

    return run


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 min_cos: float = 0.93, cell_rows: int = 2000, max_pivots: int = 4096, block_rows: int = 4000) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Vectors link if their labels are equal and not null, their lengths are equal
    and their cosine, in double precision, is at least `min_cos`. Vectors that
    are null, empty, zero or hold null or non-finite components link with
    nothing. Equal vectors of one label link with each other; rows that repeat
    an id are vectors of their own but one node of a component. Rows without id
    have no component and are kept. Pivots only shape the cells: about one in
    `cell_rows` vectors, `max_pivots` at most, so what the tasks get of them is
    bounded, and any choice gives the same links.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = materialize(rows.mapInArrow(unit_vectors, "vec_id long, label string, unit binary"), "units")
    valid = rows.where("vec_id is not null and label is not null and unit is not null").withColumn(
        "g", F.concat_ws(":", F.length("unit").cast("string"), "label"))
    classes = materialize(valid.groupBy("g", "unit").agg(F.min("vec_id").alias("lead"), F.count("*").alias("weight")), "classes")

    r = float(np.sqrt(2 - 2 * min_cos))
    total = classes.count()
    share = min(1 / cell_rows, max_pivots / (2 * max(total, 1)))
    # a pivot for about every 1 / share vectors, by a hash of the vector; the limit makes the bound sure
    chosen = classes.where(F.pmod(F.xxhash64("unit", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))).select("g", "unit").orderBy("unit", "g").limit(max_pivots).collect()
    pivots: dict = {}
    for cell, p in enumerate(chosen):
        cells, own = pivots.setdefault(p["g"], ([], []))
        cells.append(cell)
        own.append(bytes(p["unit"]))
    pivots = {g: (cells, _matrix(own)) for g, (cells, own) in pivots.items()}

    names = "g string, unit binary, lead long, weight long"
    assigned = materialize(classes.mapInArrow(_assign(pivots), names + ", cell int, away double"), "cells")
    radius = {c: d for c, d in assigned.where("cell >= 0").groupBy("cell").agg(F.max("away")).collect()}  # one row per pivot at most
    dealt = materialize(assigned.select("g", "lead", "weight", "unit", "cell").mapInArrow(_deal(pivots, radius, r), "g string, lead long, weight long, unit binary, cell int, home boolean"), "dealt")

    # cells in blocks: home vectors of block a against all vectors of block b
    sizes = dealt.groupBy("g", "cell").agg(F.ceil(F.count_if("home") / block_rows).cast("int").alias("n_a"), F.ceil(F.count("*") / block_rows).cast("int").alias("n_b"))
    salted = dealt.join(sizes, ["g", "cell"]).withColumn("salt", F.xxhash64("unit"))
    a, b = F.pmod("salt", "n_a").cast("int"), F.pmod(F.shiftright("salt", 20), "n_b").cast("int")
    as_left = salted.where("home").select("*", F.lit(True).alias("left"), a.alias("a"), F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)).alias("b"))
    as_right = salted.where("n_a > 0").select("*", F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("a"), b.alias("b"))
    columns = ["g", "cell", "a", "b", "left", "lead", "weight", "unit", "home"]
    blocks = as_left.select(columns).union(as_right.select(columns)).groupBy("g", "cell", "a", "b")
    found = materialize(blocks.applyInArrow(_join_cell(min_cos), "lead long, links long, low long"), "links")

    links = found.groupBy("lead").agg(F.sum("links").alias("links"))
    named = components(found.where("low != lead"), "lead", "low").select(F.col("node").alias("lead"), "component")
    judged = classes.join(links, "lead", "left").join(named, "lead", "left").select(
        "g", "unit", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "lead").alias("component_id"))
    linked = valid.join(judged, ["g", "unit"]).select("vec_id", "n_links", "component_id")
    others = rows.where("vec_id is null or label is null or unit is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(others).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
