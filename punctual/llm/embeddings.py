"""Near-duplicate embeddings by collision counting on random projections.

**Method.** Vectors of length 1 are projected on many random directions. Two vectors at cosine ``c`` lie
``sqrt(2 - 2c) * N(0, 1)`` apart on each. A window of half-width ``window`` around a query's place on one direction holds
its near neighbours with probability ``p``; a pair is verified when the number of directions on which each lies in the
other's window reaches the count that pairs at the threshold reach with probability ``RECALL``. Verified cosines are
computed in double precision; nothing below the threshold is linked.

**Candidates.** One window holds a constant share of all vectors, so counting collisions over whole sorted directions
grows with the square of the table. Therefore the directions are first cut into cells, several windows wide, and pairs
are counted only where all directions of one of several sets put both in the same cell; the number of directions in a
set follows the logarithm of the largest label, the number of sets the wanted recall. Within such a cell the counting
works on all directions. A pair that meets in several sets belongs to the first of them.

**Hot cells** are cut into blocks that meet pairwise (``blocks``); a block pair yields one row per linked vector, with
its number of links and the least vector it is connected to in there, never the pairs. Equal vectors of a label are one
vector with a count.

Results in edge cases: vectors that are null, empty, zero or hold null, NaN or infinite components, and vectors with a
null label, link with nothing and are kept; vectors of different length never link; repeated rows link with each other;
a null id is a vector like any other, and is never a component's smallest id while another is; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .blocks import block_pairs, in_block_pairs
from .components import connected
from .hashing import mix

BLOCK_ROWS = 512
DIRECTIONS = 24
# A cell is so many times as wide as the distance of two vectors at the threshold, the window half so many times.
CELL_DISTANCES = 8.0
WINDOW_DISTANCES = 2.5
RECALL = 0.999
# About the chance that two unrelated unit vectors share a cell on one direction.
UNRELATED_SHARE = 0.5


class Plan(NamedTuple):
    """All numbers that the search uses, chosen by ``plan``."""

    threshold: float
    cell: float
    window: float
    least_count: int
    set_size: int
    sets: int
    seed: int


def plan(threshold: float, largest: int, seed: int = 0) -> Plan:
    """Choose set size, number of sets and the collision count for labels of up to ``largest`` vectors."""
    distance = math.sqrt(2 - 2 * threshold)
    inside = math.erf(WINDOW_DISTANCES / math.sqrt(2))
    least, tail = DIRECTIONS, 0.0
    while least > 0:
        tail += math.comb(DIRECTIONS, least) * inside**least * (1 - inside) ** (DIRECTIONS - least)
        if tail >= RECALL:
            break
        least -= 1
    set_size = max(4, round(math.log(max(largest, 2)) / -math.log(UNRELATED_SHARE)))
    # The mean gap on a direction is distance * sqrt(2 / pi); that share of a cell's width is lost to its border.
    together = (1 - math.sqrt(2 / math.pi) / CELL_DISTANCES) ** set_size
    sets = math.ceil(math.log(1 - RECALL) / math.log(1 - together))
    return Plan(threshold, CELL_DISTANCES * distance, WINDOW_DISTANCES * distance, least, set_size, sets, seed)


def _directions(plan: Plan, size: int) -> tuple[np.ndarray, np.ndarray]:
    chance = np.random.default_rng([plan.seed, size])
    directions = chance.normal(size=(size, max(DIRECTIONS, plan.sets * plan.set_size)))
    return directions, chance.uniform(0, plan.cell, plan.sets * plan.set_size)


def cell_keys(plan: Plan, projected: np.ndarray, shifts: np.ndarray, label: np.ndarray) -> np.ndarray:
    """For every vector and set, a 64-bit key of the label and the cell."""
    used = plan.sets * plan.set_size
    cells = np.floor((projected[:, :used] + shifts) / plan.cell).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(projected), plan.sets, plan.set_size)
    keys = mix(label.astype(np.uint64)[:, None] + np.arange(1, plan.sets + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for at in range(plan.set_size):
        keys = mix(keys ^ cells[:, :, at])
    return keys


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length 1."""
    flat = np.array(column.to_pylist(), np.float64)
    flat /= np.abs(flat).max(axis=1)[:, None]
    return flat / np.sqrt((flat * flat).sum(axis=1))[:, None]


def _cells(plan: Plan):
    def run(batches):
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            sizes = np.array([len(vector) for vector in batch.column("vector").to_pylist()])
            for size in np.unique(sizes):
                size = int(size)
                part = batch.filter(pa.array(sizes == size))
                if size not in made:
                    made[size] = _directions(plan, size)
                directions, shifts = made[size]
                projected = _matrix(part.column("vector")) @ directions
                keys = cell_keys(plan, projected, shifts, part.column("label").to_numpy())
                rows = np.repeat(np.arange(part.num_rows), plan.sets)
                taken = part.take(pa.array(rows))
                sets = pa.array(np.tile(np.arange(plan.sets, dtype=np.int32), part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(name) for name in ("node", "label", "copies", "vector")]
                    + [sets, pa.array(keys.reshape(-1).astype(np.int64))],
                    ["node", "label", "copies", "vector", "set", "cell"],
                )

    return run


def components_of(linked: np.ndarray) -> np.ndarray:
    """The least connected place of every row of a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(plan: Plan):
    """The links of one block pair: a row per linked vector."""
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def run(rows: pa.Table) -> pa.RecordBatch | None:
        vectors = _matrix(rows.column("vector"))
        size = vectors.shape[1]
        if size not in made:
            made[size] = _directions(plan, size)
        directions, shifts = made[size]
        projected = vectors @ directions
        counts = np.zeros((len(vectors), len(vectors)), np.int16)
        for at in range(DIRECTIONS):
            place = projected[:, at]
            counts += np.abs(place[:, None] - place[None, :]) <= plan.window
        found = counts >= plan.least_count
        np.fill_diagonal(found, False)
        own, low, high = (rows.column(name).to_numpy() for name in ("own", "low", "high"))
        if low[0] != high[0]:
            found &= own[:, None] != own[None, :]
        label = rows.column("label").to_numpy()
        found &= label[:, None] == label[None, :]
        if not found.any():
            return None
        keys = cell_keys(plan, projected, shifts, label)
        for earlier in range(int(rows.column("set")[0].as_py())):
            found &= keys[:, earlier][:, None] != keys[:, earlier][None, :]
        found &= vectors @ vectors.T >= plan.threshold
        if not found.any():
            return None
        links = found @ rows.column("copies").to_numpy()
        nodes = rows.column("node").combine_chunks()
        has = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [nodes.take(pa.array(has)), nodes.take(pa.array(components_of(found)[has])), pa.array(links[has].astype(np.int64))],
            ["node", "other", "links"],
        )

    return run


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def link(
    table: DataFrame, vec_id: str, vector: str, label: str, threshold: float = 0.98, seed: int = 0
) -> DataFrame:
    """One row per vector: the id, ``n_links``, ``component_id`` (smallest id reachable) and ``kept``."""
    spark = table.sparkSession
    usable = F.coalesce(_usable(F.col(vector)) & F.col(label).isNotNull(), F.lit(False))
    # Two seeded hashes name a class of equal vectors of a label.
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(salt), "tag", "vector")), 16, "0") for salt in (1, 2)]
    slim = table.select(
        F.col(vec_id).alias("id"),
        F.when(usable, F.col(vector)).cast("array<double>").alias("vector"),
        F.when(usable, F.col(label)).alias("tag"),
    ).withColumn("node", F.when(F.col("vector").isNotNull(), F.unhex(F.concat(*halves))))
    classes = stored(
        spark,
        slim.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("id").alias("least_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vector").alias("vector"),
            F.first(F.xxhash64("tag", F.size("vector"))).alias("label"),
        ),
        "vector-classes",
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    chosen = plan(threshold, largest, seed)
    celled = classes.select("node", "label", "copies", "vector").mapInArrow(
        _cells(chosen), "node binary, label long, copies long, vector array<double>, set int, cell long"
    )
    found = stored(
        spark,
        in_block_pairs(block_pairs(celled, "cell", "node", BLOCK_ROWS), _links(chosen), "node binary, other binary, links long"),
        "vector-links",
    )
    roots = connected(found, "node", "other")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = (
        classes.select("node", "least_id", "copies")
        .join(counted, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    component = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = rooted.join(component, "root").select(
        F.col("node").alias("_node"), "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    out = slim.select("id", "node").join(known, F.col("node") == F.col("_node"), "left")
    component_id = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.col("id").eqNullSafe(component_id).alias("kept"),
    )
