"""Packing of tokenized documents into training sequences.

What is longer than a sequence is cut into full pieces and a rest. A full piece is a sequence by itself and isn't shuffled.
Rests are dealt at random, by a hash of the piece's own number, into groups of about ``group_rows``, and each group is
packed for itself by first-fit decreasing: longest first into the first bin with room. A tournament tree over the bins' room
finds that bin in logarithmic time. A group holds rests below a sequence's length only, so a task has a bound in bytes as well
as rows, whatever the length of the documents and however many rows are equal.

Defined cases: a null text is empty; an empty text still has its end id. Equal rows are all packed, and a null doc_id is
kept. An empty table gives no piece. Of the input only doc_id and text are read, so extra columns with any names don't
matter. A text of any length is cut.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import slices, small_batches
from trendlake.shared import materialize

GROUP_ROWS = 2048
PIECES = (
    "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


#: A word of Latin letters and ASCII marks after them, which tokenizers that split between the two read apart.
#: The apostrophe is left out, as it starts tokens of its own with letters.
STEM = "^(?P<stem>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"
#: Longer words are encoded anew each time, so that the memory is bounded in bytes too.
LONGEST = 64


class Memory:
    """Encoded words in two generations of ``limit`` / 2: the older one is dropped, what is still in use moves on."""

    def __init__(self, limit: int):
        self.half = max(1, limit // 2)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, word: str, ids: bytes) -> None:
        if len(word) > LONGEST:
            return
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[word] = ids

    def find(self, words: list[str]) -> list[bytes | None]:
        found = list(map(self.new.get, words))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            ids = found[i] = self.old.get(words[i])
            if ids is not None:
                self.put(words[i], ids)
        return found


#: Of this process by tokenizer and bound: a Python worker keeps it between tasks.
MEMORIES: dict[tuple[str, int], Memory] = {}


class WordTokenizer:
    """Ids of texts by a tokenizer whose tokens never span an ASCII blank, each word encoded once.

    With ``split_marks``, tokens must not span letters and following marks either, so that both are remembered
    by themselves, letters without case if the tokenizer drops it; tests hold that against plain encoding. About ``limit``
    encoded words are remembered as long as the worker lives.
    """

    def __init__(self, path: str, split_marks: bool = True, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.encode = tokenizers.Tokenizer.from_file(path).encode_batch_fast
        self.split_marks = split_marks
        upper, lower = self.encode(["ZÉÀ", "zéà"], add_special_tokens=False)
        self.no_case = upper.ids == lower.ids
        self.memory = MEMORIES.setdefault((path, limit), Memory(limit))

    def _encoded(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words."""
        names = words.to_pylist()
        found = self.memory.find(names)
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, coded in zip(new, self.encode([names[i] for i in new], add_special_tokens=False), strict=True):
            found[i] = np.array(coded.ids, "<u4").tobytes()
            self.memory.put(names[i], found[i])
        return pa.array(found, pa.large_binary())

    def _table(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, put together from their stems and marks."""
        if not self.split_marks:
            return self._encoded(words)
        parts = pc.extract_regex(words, STEM)
        stem, marks = pc.struct_field(parts, "stem"), pc.struct_field(parts, "marks")
        first = pc.coalesce(pc.utf8_lower(stem) if self.no_case else stem, words)
        both = pa.concat_arrays([first, pc.fill_null(marks, "")]).dictionary_encode()
        ids = self._encoded(both.dictionary)
        index = both.indices
        return pc.binary_join_element_wise(
            ids.take(index[: len(words)]), ids.take(index[len(words) :]), pa.scalar(b"", pa.large_binary())
        )

    def rows(self, texts: pa.Array, end_id: int | None = None) -> pa.LargeBinaryArray:
        """The ids of each text, little-endian unsigned 32-bit, ``end_id`` behind them."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        table = self._table(coded.dictionary)
        index = coded.indices.to_numpy(zero_copy_only=False)
        edges = (words.offsets.to_numpy() - words.offsets[0].as_py()).astype(np.int64)
        if end_id is not None:
            end = pa.array([np.uint32(end_id).astype("<u4").tobytes()], pa.large_binary())
            index = np.insert(index, edges[1:], len(table))
            edges += np.arange(len(edges))
            table = pa.concat_arrays([table, end])
        taken = table.take(pa.array(index))
        if not len(taken):
            return pa.array([b""] * len(texts), pa.large_binary())
        _, offsets, data = taken.buffers()
        bounds = np.frombuffer(offsets, np.int64)[taken.offset + edges]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds), data])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text by text, and the number of each text."""
        rows = self.rows(texts)
        count = pc.binary_length(rows).to_numpy(zero_copy_only=False) // 4
        return np.frombuffer(b"".join(rows.to_pylist()), "<u4"), count


def tokenize(docs: DataFrame, path: str, end_id: int, *carry: str) -> DataFrame:
    """``carry`` columns and ids (little-endian unsigned 32-bit, with the end id) of each document."""
    small_batches(docs.sparkSession)
    kept = docs.select(*carry, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(path)
        for whole in batches:
            for batch in slices(whole, len(carry)):
                ids = tokenizer.rows(batch.column(len(carry)), end_id).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*carry, "ids"])

    schema = kept.drop("text").schema.add("ids", "binary")
    return kept.mapInArrow(run, schema)


class Room:
    """Tournament tree of the bins' room: each node holds the most of its two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """The first bin with room for ``size``, which it takes."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        chosen = node - self.leaves
        most[node] -= size
        while node > 1:
            node //= 2
            left, right = most[2 * node], most[2 * node + 1]
            most[node] = left if left > right else right
        return chosen


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; equal sizes go in the order given."""
    order = np.argsort(-sizes, kind="stable")
    room = Room(len(sizes), capacity)
    bins, offsets, used = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), {}
    for item in order.tolist():
        size = int(sizes[item])
        chosen = room.first_fit(size)
        bins[item], offsets[item] = chosen, used.get(chosen, 0)
        used[chosen] = used.get(chosen, 0) + size
    return bins, offsets


def group_count(docs: DataFrame, group_rows: int = GROUP_ROWS) -> int:
    return max(1, -(-docs.count() // group_rows))


def cut(tokens: DataFrame, capacity: int) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens of the pieces of ``tokens`` (doc_id, ids): full ones, and a rest per document."""
    size = F.floor(F.coalesce(F.length("ids"), F.lit(0)) / 4).cast("long")
    counted = tokens.select("doc_id", "ids", size.alias("doc_tokens")).where(F.col("doc_tokens") > 0)
    starts = F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.lit(capacity).cast("long"))
    return counted.withColumn("start", F.explode(starts)).select(
        "doc_id",
        "start",
        F.least(F.lit(capacity).cast("long"), F.col("doc_tokens") - F.col("start")).alias("length"),
        F.substring("ids", (4 * F.col("start") + 1).cast("int"), F.lit(4 * capacity)).alias("ids"),
        "doc_tokens",
    )


def pack(tokens: DataFrame, groups: int, capacity: int = 2048) -> DataFrame:
    """Pieces of the documents of ``tokens`` (doc_id, ids), placed in sequences of ``capacity`` tokens.

    ``groups`` is what ``group_count`` gives for the documents.
    """
    # Stored, so that texts are read once for both kinds of pieces and a piece's number stays the same when a task runs again.
    numbered = cut(tokens, capacity).withColumn("piece", F.monotonically_increasing_id())
    stored = materialize(numbered, "packing-pieces")
    columns = ["doc_id", "start", "length", "ids", "doc_tokens"]
    # A full piece is a sequence by itself, numbered behind those of the groups.
    own = (F.lit(groups << 31) + F.col("piece")).alias("sequence_id")
    full = stored.where(F.col("length") == capacity).select(*columns, own, F.lit(0).cast("long").alias("offset"))

    # Dealt by the piece's own number, which equal rows don't share.
    rests = stored.where(F.col("length") < capacity).withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("piece")
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        first = group["group"][0].as_py() << 31
        placed = group.select(columns).append_column("sequence_id", pa.array(bins + first))
        return placed.append_column("offset", pa.array(offsets))

    id_type = tokens.schema["doc_id"].dataType
    return full.unionByName(rests.groupBy("group").applyInArrow(run, PIECES.format(id=id_type.simpleString())))
