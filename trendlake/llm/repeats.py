"""Repeated passages of at least ``length`` bytes, by enhanced suffix arrays over anchored suffixes.

A suffix array over every byte of a corpus is far larger than the corpus. Here only suffixes at anchors are sorted:
of the ``GRAM``-byte strings inside every ``length``-byte string, the one with the least hash. Equal strings have their
anchor at the same place, so whatever repeats meets at an anchor that repeats, and all other text is left out early.

1. Anchors of all texts; a hash that occurs once in the corpus is dropped.
2. Around each anchor that is left, the context is cut out: as far as a ``length``-byte string with this anchor can reach.
3. Contexts are dealt by anchor. Each task sorts its contexts by what follows the anchor, which gives a suffix array with the
   lengths of common prefixes, and a scan with a stack walks its intervals. Within an interval of common prefix r, all members
   are ordered by what precedes the anchor, backwards; neighbours that differ within this left context end the repeat
   (left diversity), and those that agree on l bytes with ``l + r >= length`` form a repeat with all its occurrences.
4. Anchors that occur more than ``CROWD`` times are counted instead, so that no task gathers them: each
   ``length``-byte string around them is hashed and grouped. This is exact as well and linear in the number of contexts.

All strings around one anchor overlap there, so a context's part of the removal is one interval; a text's intervals are merged.

Defined cases: a null text is empty. Texts below ``length`` bytes have no repeats. Equal texts repeat each other.
Repeats never cross texts. Overlapping occurrences within a text count. Texts of any length are read whole; positions are
bytes of UTF-8. Extra columns with any names are passed on. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import own_name, slices, small_batches, text_or_empty
from trendlake.shared import materialize

GRAM = 40
#: An anchor's contexts, 360 bytes each at most for strings of 200, that one task may hold: some 20 MB.
CROWD = 50_000
#: Contexts a task sorts at once, about.
GROUP_CONTEXTS = 20_000
#: A side of a join is broadcast up to this size, and shuffled beyond.
BROADCAST_BYTES = 64 << 20
#: Positions in a stretch of text take so many low bits when the least hash is sought; the hash has the rest.
POSITION_BITS = 28
STRETCH = 1 << 26
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each position, by doubling; as many as there are whole ones."""
    count = len(raw) - GRAM + 1
    power, size, known = MULTIPLIER, 1, raw.astype(np.uint64) + np.uint64(1)
    out, out_size, rest = None, 0, GRAM
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if out is None:
                    out, out_size = known, size
                else:
                    length = len(known) - out_size
                    out = out[:length] * power + known[out_size : out_size + length]
                    out_size += size
            rest >>= 1
            if rest:
                known = known[:-size] * power + known[size:]
                power, size = power * power, size * 2
        out = out[:count]
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    size = 1
    low = values
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(values) - width + 1], low[width - size : len(values) - size + 1])


def anchors(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors in joined texts, which start at ``starts`` (with the end), and their hashes."""
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found, hashes = [], []
    for begin in range(0, len(raw) - length + 1, STRETCH):
        part = raw[begin : begin + STRETCH + length - 1]
        grams = gram_hashes(part)
        mask = np.uint64((1 << POSITION_BITS) - 1)
        keyed = grams & ~mask | np.arange(len(grams), dtype=np.uint64)
        low = least_in_windows(keyed, length - GRAM + 1)
        inside = np.ones(len(low), bool)
        for edge in (starts[1:-1] - begin).tolist():
            # Strings over the end of a text don't count.
            inside[max(0, edge - length + 1) : max(0, edge)] = False
        at = (low[inside] & mask).astype(np.int64)
        if len(at):
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        found.append(at + begin)
        hashes.append(grams[at])
    at, value = np.concatenate(found), np.concatenate(hashes)
    fresh = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
    return at[fresh], value[fresh]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), starts


def anchor_counts(texts: DataFrame, length: int) -> DataFrame:
    """h, t, n: how often each anchor hash occurs in each text of ``texts`` (t, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, 1 << 18):
                raw, starts = joined(batch.column(1).to_pylist())
                at, value = anchors(raw, starts, length)
                owner = np.searchsorted(starts, at, "right") - 1
                pairs, n = np.unique(np.stack([owner.astype(np.uint64), value]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pairs[1].view(np.int64)),
                        batch.column(0).take(pa.array(pairs[0].astype(np.int64))),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["h", "t", "n"],
                )

    return texts.select("t", "raw").mapInArrow(run, "h long, t long, n long")


def contexts(texts: DataFrame, length: int, crowded: bool, places: bool) -> DataFrame:
    """The contexts of repeated anchors in ``texts`` (raw, doc, few, crowd: low halves of their hashes).

    Either their bytes, each once per task with its number (h, c, before, after, n), of anchors that are
    crowded or not; or the places of all (doc, h, c, at). Half a hash may let an anchor through that doesn't
    repeat; its context then agrees with no other.
    """
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest

        seen: dict[tuple[int, int], int] = {}
        for whole in batches:
            for batch in slices(whole, 0, 1 << 18):
                texts = batch.column(0).to_pylist()
                raw, starts = joined(texts)
                at, value = anchors(raw, starts, length)
                owner = np.searchsorted(starts, at, "right") - 1
                wanted = batch.column(2)
                rows = []
                for i in np.unique(owner).tolist():
                    own = np.arange(*np.searchsorted(owner, [i, i + 1]))
                    known = wanted[i].values.to_numpy(zero_copy_only=False).view(np.uint32)
                    text = texts[i]
                    signed = value[own].view(np.int64)
                    for j in np.flatnonzero(np.isin(value[own].astype(np.uint32), known)).tolist():
                        p = int(at[own[j]] - starts[i])
                        before, after = text[max(0, p - reach) : p], text[p : p + length]
                        c = digest(before + after, len(before))
                        rows.append((i, int(signed[j]), c - (1 << 64) if c >> 63 else c, p, before, after))
                if places:
                    column = list(zip(*rows, strict=True)) or [()] * 6
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(1).take(pa.array(column[0], pa.int64())),
                            *(pa.array(column[k], pa.int64()) for k in (1, 2, 3)),
                        ],
                        names=["doc", "h", "c", "at"],
                    )
                    continue
                new = []
                for row in rows:
                    key = row[1:3]
                    if key not in seen:
                        new.append(row)
                    seen[key] = seen.get(key, 0) + 1
                column = list(zip(*new, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(column[k], pa.int64()) for k in (1, 2)),
                        *(pa.array(column[k], pa.binary()) for k in (4, 5)),
                        pa.array([1] * len(new), pa.int64()),
                    ],
                    names=["h", "c", "before", "after", "n"],
                )
        if not places:
            # What came again within the task: numbers without bytes.
            again = [(h, c, n - 1) for (h, c), n in seen.items() if n > 1]
            h, c, n = zip(*again, strict=True) if again else ((), (), ())
            empty = pa.array([None] * len(again), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(c, pa.int64()), empty, empty, pa.array(n, pa.int64())],
                names=["h", "c", "before", "after", "n"],
            )

    wanted = F.concat("few", "crowd") if places else F.col("crowd" if crowded else "few")
    source = texts.select("raw", "doc", wanted.alias("wanted")).where(F.size("wanted") > 0)
    if places:
        schema = "doc binary, h long, c long, at long"
    else:
        schema = "h long, c long, before binary, after binary, n long"
    return source.mapInArrow(run, schema)


def padded(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix, filled up with zeros, and their lengths."""
    size = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(-1, width), size


def common(matrix: np.ndarray, size: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of rows ``one`` and rows ``other``."""
    differ = matrix[one] != matrix[other]
    first = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
    return np.minimum(first, np.minimum(size[one], size[other]))


def intervals(prefix: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of a suffix array, inner ones first.

    ``prefix[i]`` is what suffix i has in common with the one before; intervals without any are left out.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(prefix) + 1):
        now = prefix[i] if i < len(prefix) else 0
        first = i - 1
        while stack and stack[-1][0] > now:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def extents(h: np.ndarray, before: list[bytes], after: list[bytes], n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """How far repeats of at least ``length`` bytes reach left and right of each context's anchor; zeros for none."""
    right, right_size = padded(after, length)
    left, left_size = padded([b[::-1] for b in before], length - GRAM)
    out_left, out_right = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)

    def take(rows: np.ndarray, lefts: np.ndarray, rights) -> None:
        hit = lefts + rights >= length
        np.maximum.at(out_left, rows[hit], lefts[hit])
        np.maximum.at(out_right, rows[hit], (rights[hit] if isinstance(rights, np.ndarray) else rights))

    several = np.flatnonzero(n > 1)
    take(several, left_size[several], right_size[several])
    # The suffix array: by anchor, then by what follows it.
    order = np.lexsort((np.ascontiguousarray(right).view(f"S{length}").ravel(), h))
    ordered = h[order]
    same = np.concatenate([[False], ordered[1:] == ordered[:-1]])
    prefix = np.zeros(len(h), np.int64)
    inner = np.flatnonzero(same)
    prefix[inner] = common(right, right_size, order[inner - 1], order[inner])
    left_rank = np.empty(len(h), np.int64)
    left_rank[np.argsort(np.ascontiguousarray(left).view(f"S{length - GRAM}").ravel(), kind="stable")] = np.arange(len(h))
    # Anchors with two contexts, the most common case, are intervals of two: all at once.
    edge = np.flatnonzero(np.concatenate([~same, [True]]))
    count = np.diff(edge)
    first = edge[:-1][count == 2]
    one, other = order[first], order[first + 1]
    both = common(left, left_size, one, other)
    take(one, both, prefix[first + 1])
    take(other, both, prefix[first + 1])
    for begin, end in zip(edge[:-1][count > 2].tolist(), edge[1:][count > 2].tolist(), strict=True):
        for depth, low, high in intervals(prefix[begin:end].tolist()):
            members = order[begin + low : begin + high + 1]
            members = members[np.argsort(left_rank[members])]
            agree = common(left, left_size, members[:-1], members[1:])
            # The longest left context that a member shares with any other is one of its neighbours'.
            most = np.maximum(np.concatenate([[0], agree]), np.concatenate([agree, [0]]))
            take(members, most, np.full(len(members), depth))
    return out_left, out_right


def sorted_extents(found: DataFrame, groups: int, length: int) -> DataFrame:
    """h, c, left, right of the contexts of anchors that aren't crowded."""

    def run(group: pa.Table) -> pa.Table:
        h, c, n = (group[name].to_numpy() for name in ("h", "c", "n"))
        filled = group["after"].is_valid().to_numpy()
        order = np.lexsort((~filled, c, h))
        h, c, n = h[order], c[order], n[order]
        start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
        total = np.add.reduceat(n, start)
        rows = pa.array(order[start])
        before, after = (group[name].take(rows).to_pylist() for name in ("before", "after"))
        left, right = extents(h[start], before, after, total, length)
        hit = left + right >= length
        return pa.table({"h": h[start][hit], "c": c[start][hit], "left": left[hit], "right": right[hit]})

    dealt = found.withColumn("group", F.pmod(F.xxhash64("h"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(run, "h long, c long, left long, right long")


def counted_extents(found: DataFrame, length: int) -> DataFrame:
    """h, c, left, right of the contexts of crowded anchors, by counting every string around them."""
    merged = found.groupBy("h", "c").agg(F.max("before").alias("before"), F.max("after").alias("after"), F.sum("n").alias("n"))
    merged = materialize(merged, "crowded-contexts")
    low = F.greatest(F.lit(0), length - F.length("after"))
    high = F.length("before")
    taken = F.col("offset")
    string = F.concat(
        F.substring(F.col("before"), F.length("before") - taken + 1, taken),
        F.substring(F.col("after"), F.lit(1), length - taken),
    )
    each = (
        merged.where(low <= high)
        .withColumn("offset", F.explode(F.sequence(low, high)))
        .select("h", "c", "n", "offset", F.xxhash64(string).alias("s"))
    )
    again = each.groupBy("h", "offset", "s").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    return (
        # Stored contexts are small and these rows many, which a size estimate from files doesn't see.
        each.join(again.hint("merge"), ["h", "offset", "s"])
        .groupBy("h", "c")
        .agg(F.max("offset").cast("long").alias("left"), (length - F.min("offset")).cast("long").alias("right"))
    )


def small_side(df: DataFrame, bytes_of_row: Column) -> DataFrame:
    """A stored table, marked for broadcast if its measured size allows."""
    size = df.agg(F.sum(bytes_of_row + 64)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def repeated_spans(docs: DataFrame, text: str, length: int) -> DataFrame:
    """doc (MD5 of a text's bytes), spans: merged runs of bytes that repeats cover, for texts that have some."""
    small_batches(docs.sparkSession)
    plain = text_or_empty(text)
    raw = F.encode(plain, "UTF-8")
    texts = docs.select(raw.alias("raw"), F.xxhash64(plain).alias("t"), F.unhex(F.md5(raw)).alias("doc")).where(
        F.length("raw") >= length
    )
    counts = materialize(anchor_counts(texts, length), "anchors")
    repeated = counts.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    repeated = materialize(repeated, "repeated-anchors")
    few = repeated.where(F.col("n") <= CROWD).agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-few // GROUP_CONTEXTS))
    half = F.shiftright(F.shiftleft("h", 32), 32).cast("int")
    held = counts.select("h", "t").join(repeated, "h").groupBy("t").agg(
        F.collect_set(F.when(F.col("n") <= CROWD, half)).alias("few"),
        F.collect_set(F.when(F.col("n") > CROWD, half)).alias("crowd"),
    )
    held = materialize(held.withColumnRenamed("t", "held"), "repeated-by-text")
    held = small_side(held, 4 * (F.size("few") + F.size("crowd")) + 32)
    marked = texts.join(held, F.col("t") == F.col("held"))
    # One after the other, so that one broadcast at a time is in memory.
    alone = materialize(sorted_extents(contexts(marked, length, False, False), groups, length), "repeat-extents")
    crowd = materialize(counted_extents(contexts(marked, length, True, False), length), "crowded-extents")
    found = alone.union(crowd)
    places = contexts(marked, length, False, True).join(found, ["h", "c"])
    cover = F.struct((F.col("at") - F.col("left")).alias("begin"), (F.col("at") + F.col("right")).alias("end"))
    by_doc = places.groupBy("doc").agg(F.sort_array(F.collect_set(cover)).alias("covers"))
    empty = F.array().cast("array<struct<begin:bigint,end:bigint>>")

    def add(state: Column, x: Column) -> Column:
        grown = F.struct(state["last"]["begin"].alias("begin"), F.greatest(state["last"]["end"], x["end"]).alias("end"))
        apart = x["begin"] > state["last"]["end"]
        return F.struct(
            F.when(apart, F.concat(state["done"], F.array(state["last"]))).otherwise(state["done"]).alias("done"),
            F.when(apart, x).otherwise(grown).alias("last"),
        )

    start = F.struct(empty.alias("done"), F.get("covers", F.lit(0)).alias("last"))
    merged = F.aggregate("covers", start, add, lambda s: F.concat(s["done"], F.array(s["last"])))
    return materialize(by_doc.select("doc", merged.alias("spans")), "repeat-spans")


def remove_repeats(docs: DataFrame, names: tuple[str, str, str, str] = ("n_bytes", "n_removed", "spans", "kept"), text: str = "text", length: int = 200) -> DataFrame:
    """``docs`` with a text's bytes in number, the number removed, their spans, and the bytes that are kept."""
    plain = F.encode(text_or_empty(text), "UTF-8")
    spans = repeated_spans(docs, text, length)
    side, own = own_name("doc"), own_name("spans")
    spans = small_side(spans.select(F.col("doc").alias(side), F.col("spans").alias(own)), 16 * F.size(own) + 16)
    joined_docs = docs.join(spans, F.unhex(F.md5(plain)) == F.col(side), "left")
    empty = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    runs = F.coalesce(F.col(own), empty)
    removed = F.aggregate(runs, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    # What lies before each span, and after the last.
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(runs, lambda x: x["end"]))
    begins = F.concat(F.transform(runs, lambda x: x["begin"]), F.array(F.length(plain).cast("long")))
    gaps = F.zip_with(
        ends, begins, lambda e, b: F.hex(F.substring(plain, (e + 1).cast("int"), (b - e).cast("int")))
    )
    kept = F.when(F.col(own).isNull(), plain).otherwise(F.unhex(F.array_join(gaps, "")))
    return joined_docs.select(
        *(F.col(c) for c in docs.columns if c not in names),
        F.length(plain).cast("long").alias(names[0]),
        removed.alias(names[1]),
        runs.alias(names[2]),
        kept.alias(names[3]),
    )
