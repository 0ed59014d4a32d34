"""Exact top-k by inner product as a Voronoi join.

Vectors become integers and equal ones are folded: of a vector's ids only the ``k + 1`` least can be in any
result. Pivots, a bounded sample, split data and queries into cells. Neighbouring cells of data are put together to blocks,
and of queries to groups; large cells are cut into several. A data cell's summary is its pivot, radius, the span along the
pivot's direction, the greatest distance from that direction, and the greatest norm; a query cell's is its pivot, radius and
the least of its queries' scores so far. A query first solves the block of one near cell, which gives a lower bound of its
k-th score. From the summaries alone it then follows which groups may find anything in which cells: a block is replicated to
those groups and no others, and a query of the group goes to it once, if its own bound of one of the block's cells
reaches its score. Within a block, cells that no query of a slice can use are left out in the same way.

Bounds of a query q, u being the pivot's direction: ``max(q.u low, q.u high) + |q - (q.u) u| rest`` and ``q.p + |q| radius``,
the lesser. A query cell's bound is its pivot's, plus its radius times the greatest norm in the data cell.
Summaries, at most ``MAX_PIVOTS`` cells and one more for each vector length that no pivot has, are all that the driver sees.

Defined cases: null vectors and vectors with null, NaN or infinite components take no part. A null id takes no part.
Vectors are compared with others of the same length only. Equal rows (same id and vector) count as one; several vectors of an
id are separate candidates and never candidates of their own id's queries. With fewer than k candidates all are returned. Ties go
to smaller ids. Scores are computed in whole numbers, beyond 2**53 in Python's
own; beyond a long they are given as the largest or smallest one. Extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.shared import materialize

#: At most so many pivots; their vectors and cell summaries are all that the driver sees.
MAX_PIVOTS = 256
BLOCK_ROWS = 20_000
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def whole_numbers(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, or null if a component isn't a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def fold(vectors: DataFrame, k: int) -> DataFrame:
    """v, ids: each distinct vector with its ``k + 1`` least ids in order."""
    first = Window.partitionBy("v").orderBy("id")
    return (
        vectors.groupBy("v", "id").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of equal length as the rows of a matrix."""
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers."""
    if not queries.size or not data.size:
        return np.zeros((len(queries), len(data)), np.int64)
    bound = float(np.abs(queries.astype(float)).max()) * float(np.abs(data.astype(float)).max()) * queries.shape[1]
    if bound < 2**53:
        return (queries.astype(np.float64) @ data.astype(np.float64).T).astype(np.int64)
    return queries.astype(object) @ data.astype(object).T


@dataclass
class Places:
    """Where the rows of each cell go: neighbours together up to a limit, a larger cell in several parts."""

    cells: list[int]
    first: np.ndarray
    parts: np.ndarray

    @staticmethod
    def pack(order: list[int], rows: dict[int, int], limit: int) -> Places:
        first, parts, number, filled = [], [], 0, 0
        cells = [c for c in order if rows.get(c)]
        for cell in cells:
            if filled and filled + rows[cell] > limit:
                number, filled = number + 1, 0
            first.append(number)
            parts.append(-(-rows[cell] // limit))
            filled += rows[cell]
            if parts[-1] > 1:
                number, filled = number + parts[-1], 0
        return Places(cells, np.array(first, np.int64), np.array(parts, np.int64))

    def starts(self) -> np.ndarray:
        """Index of the first cell of each place."""
        return np.flatnonzero(np.diff(self.first, prepend=-1))


def in_chain(pivots: np.ndarray) -> list[int]:
    """The pivots in an order in which neighbours follow one another."""
    left, chain = list(range(1, len(pivots))), [0]
    while left:
        chain.append(left.pop(int(((pivots[left] - pivots[chain[-1]]) ** 2).sum(1).argmin())))
    return chain


class Cells:
    """The pivots of one vector length, and what is known of the data in each cell; small enough for every task."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.norms = np.sqrt((pivots**2).sum(1))
        self.directions = pivots / np.where(self.norms > 0, self.norms, 1)[:, None]
        self.order = in_chain(pivots)
        self.rows: dict[int, int] = {}
        self.low, self.high, self.rest, self.radius, self.norm = np.zeros((5, len(pivots)))

    def learn(self, summary: list) -> None:
        for row in summary:
            self.rows[row.cell] = row.n
            for name in ("high", "rest", "radius", "norm"):
                getattr(self, name)[row.cell] = row[name]
            self.low[row.cell] = row.low

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Cell of each vector, and its measures there: distance from the pivot, place along its direction and beside it, norm."""
        cell = np.zeros(len(vectors), np.int64)
        measures = {name: np.zeros(len(vectors)) for name in MEASURES}
        for begin in range(0, len(vectors), 4096):
            at = slice(begin, begin + 4096)
            part = vectors[at].astype(np.float64)
            square = (part**2).sum(1)[:, None] - 2 * part @ self.pivots.T + (self.pivots**2).sum(1)
            chosen = cell[at] = square.argmin(1)
            along = (part * self.directions[chosen]).sum(1)
            measures["apart"][at] = np.sqrt(((part - self.pivots[chosen]) ** 2).sum(1))
            measures["along"][at] = along
            measures["beside"][at] = np.sqrt(((part - along[:, None] * self.directions[chosen]) ** 2).sum(1))
            measures["norm"][at] = np.sqrt((part**2).sum(1))
        return cell, measures

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of each query's products with the data in each cell."""
        square = (queries**2).sum(1)[:, None]
        along = queries @ self.directions.T
        beside = np.sqrt(np.maximum(square - along**2, 0) + 1e-12 * square)
        tube = np.maximum(along * self.low, along * self.high) + beside * self.rest
        ball = along * self.norms + np.sqrt(square) * self.radius
        # Rounding may cost a little: the slack only makes a query visit more.
        slack = 1e-9 * np.sqrt(square) * (self.norm + self.norms) + 1e-6
        found = np.minimum(tube, ball) + slack
        found[:, [c for c in range(len(self.pivots)) if not self.rows.get(c)]] = -np.inf
        return found

    def group_bounds(self, radius: np.ndarray) -> np.ndarray:
        """The same for all queries within ``radius`` of each pivot."""
        return self.bounds(self.pivots) + radius[:, None] * self.norm * (1 + 1e-9)


MEASURES = ("apart", "along", "beside", "norm")


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.Table]:
    """The rows of a batch, vectors of one length at a time."""
    lengths = np.diff(batch.column(column).offsets.to_numpy())
    for size in np.unique(lengths):
        yield pa.Table.from_batches([batch]).take(pa.array(np.flatnonzero(lengths == size)))


class Space:
    """The cells of every vector length."""

    def __init__(self, pivots: list[list[int]]):
        self.cells: dict[int, Cells] = {}
        for size in {len(p) for p in pivots}:
            self.cells[size] = Cells(np.array([p for p in pivots if len(p) == size], np.float64).reshape(-1, size))

    def of(self, size: int) -> Cells:
        # A length without a pivot has one cell around zero.
        return self.cells.setdefault(size, Cells(np.zeros((1, size))))

    def learn(self, data: DataFrame) -> None:
        wider = F.lit(1 + 1e-9)
        found = data.groupBy("size", "cell").agg(
            F.count(F.lit(1)).alias("n"),
            (F.min("along") - F.max("norm") * 1e-9).alias("low"),
            (F.max("along") + F.max("norm") * 1e-9).alias("high"),
            (F.max("beside") + F.max("norm") * 1e-9).alias("rest"),
            (F.max("apart") * wider).alias("radius"),
            (F.max("norm") * wider).alias("norm"),
        ).collect()
        for size in {row.size for row in found}:
            self.of(size).learn([row for row in found if row.size == size])


def assign(vectors: DataFrame, space: Space) -> DataFrame:
    """Adds vector length, cell and measures in it."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_length(batch, "v"):
                found = matrix(part["v"])
                cell, measures = space.of(found.shape[1]).nearest(found)
                part = part.append_column("size", pa.array(np.full(len(cell), found.shape[1], np.int64)))
                part = part.append_column("cell", pa.array(cell))
                for name, values in measures.items():
                    part = part.append_column(name, pa.array(values))
                yield from part.to_batches()

    return vectors.mapInArrow(run, f"{schema}, size long, cell long, " + ", ".join(f"{m} double" for m in MEASURES))


@dataclass
class Plan:
    """Which cells of queries (rows) need which cells of data (columns), with the places of both, for one vector length."""

    groups: Places
    blocks: Places
    need: np.ndarray

    def routes(self, size: int) -> list[tuple]:
        """For each data cell its place, and the groups its block is replicated to."""
        needed = self.need[self.groups.cells][:, self.blocks.cells]
        if not needed.size:
            return []
        between = np.logical_or.reduceat(np.logical_or.reduceat(needed, self.groups.starts(), 0), self.blocks.starts(), 1)
        asking = [(int(self.groups.first[i]), int(self.groups.parts[i])) for i in self.groups.starts()]
        block = np.cumsum(np.isin(np.arange(len(self.blocks.cells)), self.blocks.starts())) - 1
        return [
            (size, cell, int(self.blocks.first[i]), int(self.blocks.parts[i]), [asking[g] for g in np.flatnonzero(between[:, block[i]])])
            for i, cell in enumerate(self.blocks.cells)
        ]


ROUTES = "size long, cell long, first long, parts long, asking array<struct<first: long, parts: long>>"
KEYS = ("size", "group", "block")


def route_data(data: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """The rows of each block, once for each group that needs it."""
    rows = [row for size, plan in plans.items() for row in plan.routes(size)]
    routes = data.sparkSession.createDataFrame(rows, ROUTES)
    groups = F.flatten(F.transform("asking", lambda a: F.sequence(a["first"], a["first"] + a["parts"] - 1)))
    return data.join(F.broadcast(routes), ["size", "cell"]).select(
        "v", "ids", "size", "cell", (F.col("first") + F.pmod(F.xxhash64("v"), "parts")).alias("block"), F.explode(groups).alias("group")
    )


def route_queries(asked: DataFrame, space: Space, plans: dict[int, Plan], first: bool) -> DataFrame:
    """A row per query and block that it has to visit; at first one part of the block is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_length(batch, "v"):
                vectors, own = matrix(part["v"]).astype(np.float64), part["cell"].to_numpy()
                size = vectors.shape[1]
                plan = plans.get(size)
                if plan is None or not plan.blocks.cells:
                    continue
                opened = plan.need[own]
                if not first:
                    opened &= space.of(size).bounds(vectors) >= part["least"].to_numpy().astype(np.float64)[:, None]
                starts = plan.blocks.starts()
                row, place = np.nonzero(np.logical_or.reduceat(opened[:, plan.blocks.cells], starts, 1))
                begun, parts = plan.blocks.first[starts][place], plan.blocks.parts[starts][place]
                salt = part["salt"].to_numpy()
                if first:
                    block = begun + salt[row] % parts
                else:
                    block = np.repeat(begun, parts) + np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                    row = np.repeat(row, parts)
                at = np.zeros(len(plan.need), np.int64)
                at[plan.groups.cells] = np.arange(len(plan.groups.cells))
                group = plan.groups.first[at[own]] + salt % plan.groups.parts[at[own]]
                # Many rows may come of a few queries: hand them on by and by.
                for begin in range(0, len(row), 4096):
                    some = row[begin : begin + 4096]
                    out = part.select(["query_id", "v", "least"]).take(pa.array(some))
                    for name, values in (("size", np.full(len(some), size)), ("group", group[some]), ("block", block[begin : begin + 4096])):
                        out = out.append_column(name, pa.array(values.astype(np.int64)))
                    yield from out.combine_chunks().to_batches()

    salted = asked.withColumn("salt", F.xxhash64("query_id", "v").bitwiseAND((1 << 62) - 1))
    return salted.mapInArrow(run, "query_id long, v array<bigint>, least long, size long, group long, block long")


def best(scores: np.ndarray, ids: list[list[int]], own: int, k: int, least: int) -> list[tuple[int, int]]:
    """The k best (score, id) of one query in a block, no worse than ``least``."""
    if len(scores) > k + 1:
        # The query's own vector may be one of the k + 1 best, and ties all count.
        least = max(least, int(np.partition(scores, -(k + 1))[-(k + 1)]))
    chosen = np.arange(len(scores)) if least <= LOWEST else np.flatnonzero(scores >= least)
    found = [(int(scores[i]), x) for i in chosen.tolist() for x in ids[i] if x != own]
    found.sort(key=lambda f: (-f[0], f[1]))
    return found[:k]


def solve(routed: DataFrame, data: DataFrame, space: Space, k: int, first: bool) -> DataFrame:
    """Scores within each block: at first each query's k-th, then all of its best ones."""
    names = [("query_id", pa.int64()), ("v", pa.list_(pa.int64())), ("least", pa.int64())] if first else [
        (n, pa.int64()) for n in ("query_id", "vec_id", "score")
    ]
    schema = pa.schema(names)

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        slices = [schema.empty_table()]
        if queries.num_rows and block.num_rows:
            vectors, asked, cell = matrix(block["v"]), matrix(queries["v"]), block["cell"].to_numpy()
            known = space.of(vectors.shape[1])
            ids, own, least = block["ids"].to_pylist(), queries["query_id"].to_pylist(), queries["least"].to_pylist()
            for begin in range(0, len(asked), 128):
                some = slice(begin, begin + 128)
                reach = known.bounds(asked[some].astype(np.float64)) >= np.array(least[some], np.float64)[:, None]
                rows = np.flatnonzero(reach.any(0)[cell])
                near = [ids[i] for i in rows.tolist()]
                out: list[tuple] = []
                for i, row in enumerate(products(asked[some], vectors[rows]), begin):
                    found = best(row, near, own[i], k, least[i])
                    if not first:
                        out += [(own[i], x, max(LOWEST, min(HIGHEST, s))) for s, x in found]
                    elif len(found) == k:
                        out.append((own[i], asked[i].tolist(), max(LOWEST, min(HIGHEST, found[-1][0]))))
                if out:
                    slices.append(pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), names, strict=True)], schema=schema))
        return pa.concat_tables(slices)

    types = "query_id long, v array<bigint>, least long" if first else "query_id long, vec_id long, score long"
    return routed.groupBy(*KEYS).cogroup(data.groupBy(*KEYS)).applyInArrow(run, types)


def near_plans(asked: DataFrame, space: Space, k: int, group_rows: int) -> dict[int, Plan]:
    """Each cell of queries needs the block of one cell: of those with more than k rows, the nearest to its pivot."""
    plans = {}
    found = asked.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    for size in {row.size for row in found}:
        known = space.of(size)
        blocks = Places.pack(known.order, known.rows, BLOCK_ROWS)
        groups = Places.pack(known.order, {row.cell: row.n for row in found if row.size == size}, group_rows)
        need = np.zeros((len(known.pivots), len(known.pivots)), bool)
        begun, rows = np.unique(blocks.first), np.array([known.rows[c] for c in blocks.cells], np.int64)
        held = np.array([rows[blocks.first == b].sum() for b in begun], np.int64)
        held = held[np.searchsorted(begun, blocks.first)] // blocks.parts if len(begun) else held
        full = [c for c, n in zip(blocks.cells, held.tolist(), strict=True) if n > k]
        for cell in groups.cells if full else []:
            need[cell, full[int(((known.pivots[full] - known.pivots[cell]) ** 2).sum(1).argmin())]] = True
        plans[size] = Plan(groups, blocks, need)
    return plans


def bounded_plans(asked: DataFrame, space: Space, plans: dict[int, Plan]) -> dict[int, Plan]:
    """Each cell of queries needs the cells whose bound reaches the least score of its queries."""
    found = asked.groupBy("size", "cell").agg(F.max("apart").alias("radius"), F.min("least").alias("least")).collect()
    result = {}
    for size, plan in plans.items():
        radius, least = np.zeros(len(plan.need)), np.full(len(plan.need), np.inf)
        for row in found:
            if row.size == size:
                radius[row.cell], least[row.cell] = row.radius * (1 + 1e-9), row.least
        result[size] = Plan(plan.groups, plan.blocks, space.of(size).group_bounds(radius) >= least[:, None])
    return result


def top_k(vectors: DataFrame, queries: DataFrame, k: int, chunk_rows: int = 50_000) -> DataFrame:
    """query_id, rank, vec_id, score for ``queries`` against ``vectors`` (both: id, v as whole numbers).

    A group has about ``chunk_rows`` queries.
    """
    folded = materialize(fold(vectors.where("id is not null and v is not null"), k), "vectors")
    wanted = min(MAX_PIVOTS, max(1, int(folded.count() ** 0.5 / 2)))
    sample = folded.select("v", F.xxhash64("v").alias("at")).orderBy("at", "v").limit(wanted)
    space = Space([row.v for row in sample.collect()])
    data = materialize(assign(folded, space), "cells")
    space.learn(data)
    asked = queries.where("id is not null and v is not null").select(F.col("id").alias("query_id"), "v").distinct()
    asked = materialize(assign(asked.withColumn("least", F.lit(LOWEST)), space), "queries")
    near = near_plans(asked, space, k, chunk_rows)
    bounded = solve(route_queries(asked, space, near, True), route_data(data, near), space, k, True)
    least = materialize(asked.drop("least").join(bounded, ["query_id", "v"], "left").select(
        "query_id", "v", F.coalesce("least", F.lit(LOWEST)).alias("least"), "size", "cell", "apart"
    ), "bounds")
    plans = bounded_plans(least, space, near)
    found = solve(route_queries(least, space, plans, False), route_data(data, plans), space, k, False).distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score"
    )
