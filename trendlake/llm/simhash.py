"""SimHash near-duplicates with BK-trees.

Fingerprints of all documents are reduced to distinct ones. Of six blocks of bits, two fingerprints within
two bits agree in four at least, so each fingerprint goes to the 15 shards named by four of its blocks; any two
that link meet in one of them. A shard differs in 21 or 22 bits only, so it holds at most 2**22 fingerprints, however many
documents there are. Each shard builds a BK-tree, whose children are keyed by their distance to the parent, and looks up
every fingerprint along edges within the radius. Only a spanning forest of the links leaves a shard. The trees stay in
the task that owns the shard and aren't broadcast, because their total has no bound.

Defined cases: a text without words, empty or null, has fingerprint zero, which links like any other. A component is
named by its least doc_id; null ids name it only if there is no other (then null). Equal rows get equal results. An
empty table gives an empty result. Columns other than doc_id and text aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import own_name, slices, small_batches
from trendlake.llm.components import components
from trendlake.shared import materialize

SHINGLE = 3
SEED = 42
RADIUS = 2
BITS = 64
BLOCKS = 6
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 17


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of a text; of the whole sequence if it has fewer words, none without words."""
    from xxhash import xxh64_intdigest as digest

    words = (text or "").encode().lower().split()  # on bytes, both are about ASCII alone
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
    end = start + size
    spans = zip(start[: 1 - width].tolist(), end[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[b:e], SEED) for b, e in spans), np.uint64, len(words) - width + 1)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    total = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), CHUNK):
        part = hashes[begin : begin + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None) -> int:
    hashes = shingle_hashes(text)
    bits = (2 * bit_counts(hashes) > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns and ``fp``, the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    source = docs.select(*carry, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, len(carry)):
                found = np.array([fingerprint(t) for t in batch.column(len(carry)).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(found.view(np.int64))], names=[*carry, "fp"]
                )

    return source.mapInArrow(run, source.drop("text").schema.add("fp", "long"))


class BKTree:
    """Distinct fingerprints; the children of a node are keyed by their distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int, radius: int) -> list[int]:
        """Inserts a value; returns the numbers of all earlier ones within the radius."""
        hits: list[int] = []
        number = len(self.values)
        if self.values:
            waiting = [0]
            while waiting:
                node = waiting.pop()
                apart = (self.values[node] ^ value).bit_count()
                if apart <= radius:
                    hits.append(node)
                edges = self.children[node]
                for step in range(max(1, apart - radius), apart + radius + 1):
                    if step in edges:
                        waiting.append(edges[step])
            node = 0
            while True:
                apart = (self.values[node] ^ value).bit_count()
                if apart not in self.children[node]:
                    self.children[node][apart] = number
                    break
                node = self.children[node][apart]
        self.values.append(value)
        self.children.append({})
        return hits


def spanning_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by links of at most ``radius`` bits."""
    tree, parent, links = BKTree(), [], []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for number, value in enumerate(values):
        parent.append(number)
        for hit in tree.add(value, radius):
            one, other = find(hit), find(number)
            if one != other:
                parent[one] = other
                links.append((values[hit], value))
    return links


def shard_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """A mask for every choice of ``blocks - radius`` blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    each = [((1 << (e - b)) - 1) << b for b, e in zip(edges, edges[1:], strict=False)]
    return [sum(picked) for picked in combinations(each, blocks - radius)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: spanning links of the distinct fingerprints ``fp``."""
    keys = F.array(
        *(
            F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("bits"))
            for n, mask in enumerate(shard_masks(radius))
        )
    )
    shards = (
        distinct.select("fp", F.explode(keys).alias("shard"))
        .groupBy("shard")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select("fps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                link
                for fps in batch.column(0).to_pylist()
                for link in spanning_links(sorted(f % (1 << 64) for f in fps), radius)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([signed(link[side]) for link in found], pa.int64()) for side in (0, 1)], names=["a", "b"]
            )

    return shards.mapInArrow(run, "a long, b long")


def component_ids(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, root, component_id of every distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(links(distinct, radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted, "roots")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs``."""
    prints = materialize(fingerprints(docs, "doc_id"), "document-fingerprints")
    found = component_ids(prints, radius).withColumnRenamed("fp", "of")
    return prints.join(found, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def one_per_component(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id, null last, then of the least row hash.

    Who stays is decided on hashes of rows; texts are joined to the decision once. Of equal rows one stays.
    """
    row = own_name("row")
    marked = docs.withColumn(row, F.xxhash64(*docs.columns))
    prints = materialize(fingerprints(marked, "doc_id", row), "document-fingerprints")
    return first_rows(docs, marked, row, prints, component_ids(prints, radius))


def first_rows(docs: DataFrame, marked: DataFrame, row: str, prints: DataFrame, roots: DataFrame) -> DataFrame:
    """The row of ``docs`` that stays of each root.

    ``marked`` has the hash ``row`` besides; ``prints`` has doc_id, this hash and fp, ``roots`` fp and root.
    """
    rep_doc, rep_row, equal = (own_name(n) for n in ("doc", "rep", "equal"))
    found = roots.select(F.col("fp").alias("of"), "root")
    rows = prints.join(found, F.col("fp") == F.col("of")).groupBy("root", "doc_id", row).agg(F.count(F.lit(1)).alias("n"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    chosen = rows.groupBy("root").agg(F.min(F.struct(first.alias("first"), F.col("n").alias("n"))).alias("one"))
    chosen = chosen.select(
        F.col("one.first.id").alias(rep_doc), F.col("one.first.row").alias(rep_row), F.col("one.n").alias(equal)
    )
    chosen = materialize(chosen, "representatives")
    same = (F.col(row) == F.col(rep_row)) & F.col("doc_id").eqNullSafe(F.col(rep_doc))

    def kept(representatives: DataFrame) -> DataFrame:
        return marked.join(representatives, same).select(*docs.columns)

    single = kept(chosen.where(F.col(equal) == 1))
    repeated = chosen.where(F.col(equal) > 1)
    return single if repeated.isEmpty() else single.union(kept(repeated).dropDuplicates())


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
