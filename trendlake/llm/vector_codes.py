"""Product-quantisation codes, the nearest codebook entry looked up by memoised grid cells.

Vectors of whole numbers are cut into equal consecutive parts. A part's coarse cell is its components divided by a step. For each cell that
a task meets, the least and greatest distance between the cell's box and every entry are summed up from tables per component; an
entry whose least distance is above another's greatest is nearest to no point of the box. The others are remembered under
the cell, and parts in it are compared exactly with these alone. Ties stay among them, so that the lower index wins.

The step is half of the spread of the codebook's components. What a task remembers is bounded: two generations of ``CELLS`` cells a part,
the older one is dropped. Codebooks are trained by rounds over the stored vectors; tasks send sums per entry, and codebooks, all that the
driver sees, have ``entries`` times the vector's length numbers.

Defined cases: a vector that is null takes no part. Shorter vectors, also those whose length the parts don't divide, are filled up with zeros;
an empty one is zero. The first codebook is the vectors of the smallest ids, null ids last, equal ids by vector; repeated rows
count each. With fewer vectors than entries there are as many entries as vectors. An empty table gives an empty result. Where squares could pass a long,
parts are compared with all entries in Python's own numbers, and a distance beyond a long is given as the largest one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import ragged
from trendlake.shared import materialize

#: Cells remembered per part and generation.
CELLS = 1 << 14
#: Numbers of a temporary array.
NUMBERS = 1 << 21
LONG = 2**63 - 1


def small(largest: int, width: int) -> bool:
    """Whether squared distances of numbers up to ``largest`` stay below a long."""
    return 4 * largest * largest * max(width, 1) < LONG


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


class Cells:
    """The entries of one part's codebook, and which of them can be nearest in the cells met so far."""

    def __init__(self, entries: np.ndarray, limit: int = CELLS):
        self.entries, self.limit = entries, limit
        self.largest = largest(entries)
        self.step = max(1, round(float(entries.astype(float).std()) / 2)) if entries.size else 1
        self.new: dict[bytes, np.ndarray] = {}
        self.old: dict[bytes, np.ndarray] = {}

    def bounds(self, cells: np.ndarray) -> np.ndarray:
        """Which entries aren't dominated, a row per cell."""
        least = np.zeros((len(cells), len(self.entries)), np.int64)
        greatest = np.zeros_like(least)
        for k in range(cells.shape[1]):
            coarse, at = np.unique(cells[:, k], return_inverse=True)
            low = (coarse * self.step)[:, None] - self.entries[:, k]
            high = low + self.step - 1
            least += (np.maximum(np.maximum(low, -high), 0) ** 2)[at]
            greatest += (np.maximum(np.abs(low), np.abs(high)) ** 2)[at]
        return least <= greatest.min(axis=1)[:, None]

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """Numbers of the entries to compare with, per cell."""
        keys = [cell.tobytes() for cell in cells]
        found = [self.new.get(key) for key in keys]
        missing = []
        for i, key in enumerate(keys):
            if found[i] is None:
                found[i] = self.old.get(key)
                if found[i] is None:
                    missing.append(i)
                else:
                    self.remember(key, found[i])
        block = max(1, NUMBERS // (4 * len(self.entries)))
        for begin in range(0, len(missing), block):
            these = missing[begin : begin + block]
            kept = self.bounds(cells[these])
            entry = np.flatnonzero(kept.ravel()) % len(self.entries)
            for i, some in zip(these, np.split(entry.astype(np.int32), np.cumsum(kept.sum(axis=1))[:-1]), strict=True):
                found[i] = some.copy()
                self.remember(keys[i], found[i])
        return found

    def remember(self, key: bytes, entries: np.ndarray) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = entries

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of every row."""
        if not small(max(self.largest, largest(parts)) + self.step, parts.shape[1]):
            return self.nearest_of_all(parts)
        cell = np.ascontiguousarray(parts // self.step)
        row = cell.view(np.dtype((np.void, cell.dtype.itemsize * cell.shape[1]))).ravel()
        _, one, at = np.unique(row, return_index=True, return_inverse=True)
        listed = self.candidates(cell[one])
        size = np.fromiter(map(len, listed), np.int64, len(listed))
        first, flat = np.cumsum(size) - size, np.concatenate(listed)
        best, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        piece = np.cumsum(size[at] * parts.shape[1]) // NUMBERS
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(parts)]
        for begin, end in zip(cuts, cuts[1:]):
            n = size[at[begin:end]]
            entry = flat[ragged(first[at[begin:end]], n)]
            apart = ((np.repeat(parts[begin:end], n, axis=0) - self.entries[entry]) ** 2).sum(axis=1)
            starts = np.cumsum(n) - n
            distance[begin:end] = np.minimum.reduceat(apart, starts)
            hit = np.flatnonzero(apart == np.repeat(distance[begin:end], n))
            best[begin:end] = entry[hit[np.searchsorted(hit, starts)]]
        return best, distance

    def nearest_of_all(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entries = self.entries.astype(object)
        apart = [((entries - row) ** 2).sum(axis=1) for row in parts.astype(object)]
        best = np.fromiter((a.argmin() for a in apart), np.int64, len(apart))
        return best, np.array([a[i] for a, i in zip(apart, best, strict=True)], object)


def filled(vectors: DataFrame, parts: int, vector: str = "v") -> tuple[DataFrame, int]:
    """Stored vectors of one length that the parts divide, and that length."""
    vectors = vectors.where(F.col(vector).isNotNull())
    longest = vectors.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]
    length = parts * max(1, -(-longest // parts))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size(vector))
    return materialize(vectors.withColumn(vector, F.concat(vector, zeros)), "whole-vectors"), length


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64, copy=False)


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """part, entry, n, sums: what each task adds up for every entry that is nearest to some part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book) for book in books]
        n = np.zeros(books.shape[:2], np.int64)
        sums = np.zeros(books.shape, np.int64)
        most = 0
        for batch in batches:
            rows = _matrix(batch.column(0))
            most += largest(rows) * len(rows)
            if most > LONG and sums.dtype != object:
                sums = sums.astype(object)
            for p, part in enumerate(np.split(rows, len(books), axis=1)):
                best, _ = cells[p].nearest(np.ascontiguousarray(part))
                n[p] += np.bincount(best, minlength=n.shape[1])
                np.add.at(sums[p], best, part.astype(sums.dtype))
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    pa.array(entry, pa.int32()),
                    pa.array(n[part, entry], pa.int64()),
                    pa.array([[Decimal(int(x)) for x in row] for row in sums[part, entry]], pa.list_(pa.decimal128(38, 0))),
                ],
                names=["part", "entry", "n", "sums"],
            )

    return vectors.select("v").mapInArrow(run, "part int, entry int, n long, sums array<decimal(38,0)>")


def train(vectors: DataFrame, length: int, parts: int = 4, entries: int = 256, rounds: int = 4) -> np.ndarray:
    """Codebooks as parts x entries x components, of stored vectors (id, v) of one length."""
    first = vectors.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    start = np.array([r.v for r in first], np.int64).reshape(len(first), parts, length // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if len(first) else 0):
        places = _sums(vectors, books).select("part", "entry", "n", F.posexplode("sums").alias("place", "x"))
        total = places.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        for row in total.collect():
            books[row.part, row.entry, row.place] = int(row.x) // row.n
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """Adds code (the entries' numbers in part order) and error to the vectors."""
    from pyspark.sql import types as T

    schema = T.StructType([f for f in vectors.schema if f.name != "v"])
    schema = schema.add("code", T.ArrayType(T.IntegerType())).add("error", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book) for book in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [cells[p].nearest(np.ascontiguousarray(x)) for p, x in enumerate(np.split(_matrix(batch.column("v")), len(books), axis=1))]
            code = np.stack([best for best, _ in found], axis=1).astype(np.int32)
            error = sum(distance.astype(object) for _, distance in found)
            codes = pa.FixedSizeListArray.from_arrays(pa.array(code.ravel()), len(books)).cast(pa.list_(pa.int32()))
            columns = [batch.column(f.name) for f in schema[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*columns, codes, pa.array([min(e, LONG) for e in error], pa.int64())], names=[f.name for f in schema]
            )

    return vectors.mapInArrow(run, schema)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def group_errors(coded: DataFrame, group: str, out: str) -> DataFrame:
    """Adds the sum of ``error`` over the rows of an equal ``group`` (nulls are equal).

    Summed up in two phases and joined back: Spark broadcasts the sums while they are few, and splits a hot group of the
    sort-merge join otherwise.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = materialize(coded.groupBy(F.col(group).alias("__of")).agg(total.alias(out)), "group-errors")
    return coded.join(sums, F.col(group).eqNullSafe(F.col("__of"))).drop("__of")
