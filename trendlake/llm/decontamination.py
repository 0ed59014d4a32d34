"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` writes the postings of all training tokens once, in shards of whole documents of about a megabyte of text (a
longer document is a shard of its own). A row of the index is a shard: its documents, its terms in order, how often each
occurs, and their positions one list after the other, as differences. Positions run through the shard, with a gap after each
document, so that no phrase crosses documents. Searches read the shards where they lie and shuffle no postings.

``phrase_matches`` looks for word sequences. Within a shard, a sequence one of whose words is missing drops out; of the others
the list of the rarest word gives the starts, and the offset-adjusted lists of the next rarer words thin them out, one after
the other, for all sequences at once and in pieces of bounded size. ``proximity_matches`` takes the same lists around the
rarest word for the shortest spans that hold all words of a phrase in any order.

Phrases are sent to the tasks in chunks of about ``CHUNK_WORDS`` words by hash, so what is broadcast has a bound however large
the benchmark is; each chunk is one pass over the index.

Defined cases: a null or empty text has no words; an item without words matches nothing. A null item_id's words hit, but it
is no item of the lists. Rows of one item_id are one item. Equal documents, null doc_ids and repeated rows are told apart by
shard and place, and each gets its row. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import own_name, ragged, slices, small_batches, text_or_empty
from trendlake.shared import materialize

#: What parts words, once A-Z are lower-cased: every ASCII character but digits and letters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHARD_BYTES = 1 << 20
CHUNK_WORDS = 1 << 20
#: Starts that are tested at once.
STARTS = 1 << 20
#: A shard's row holds about a megabyte, so Parquet's writer has to look at sizes after few rows.
ROW_CHECK = {"parquet.page.size.row.check.min": "8", "parquet.block.size": str(32 << 20)}
INDEX = (
    "shard long, docs array<{id}>, n_words array<long>, terms array<string>, counts array<int>, steps binary"
)

_folded = bytearray(range(256))
for _byte in range(128):
    _folded[_byte] = _byte + 32 if chr(_byte).isupper() else _byte if chr(_byte).isalnum() else 32
FOLDED = np.frombuffer(bytes(_folded), np.uint8)


def words_of(text: str | Column) -> Column:
    """The words of a text as an array, as the index reads them."""
    lower = F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, NO_WORD), lambda w: w != "")


def word_lists(texts: pa.Array) -> pa.ListArray:
    """The words of every text."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    _, offsets, data = texts.buffers()
    if data is None:
        return pc.ascii_split_whitespace(texts)
    folded = FOLDED[np.frombuffer(data, np.uint8)]
    plain = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(folded), None, 0, texts.offset)
    split = pc.ascii_split_whitespace(plain)
    # Blanks at either end leave an empty word there.
    kept = pc.not_equal(split.flatten(), "")
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    edges = split.offsets.to_numpy() - split.offsets[0].as_py()
    return pa.ListArray.from_arrays(pa.array(before[edges], pa.int32()), split.flatten().filter(kept))


def shard_rows(number: int, docs: pa.Array, texts: pa.Array) -> list:
    """One row of the index, see ``INDEX``."""
    lists = word_lists(texts)
    size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    terms = coded.dictionary
    rank = np.empty(len(terms), np.int64)
    order = pc.sort_indices(terms).to_numpy()
    rank[order] = np.arange(len(terms))
    term = rank[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
    first = np.cumsum(size + 1) - (size + 1)
    position = ragged(first, size).astype(np.uint32)
    by_term = position[np.argsort(term, kind="stable")]
    steps = np.diff(by_term, prepend=np.uint32(0))
    counts = np.bincount(term, minlength=len(terms)).astype(np.int32)
    return [number, docs, size, terms.take(pa.array(order)), counts, steps.astype("<u4").tobytes()]


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The stored index of ``docs``, a row per shard."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    schema = INDEX.format(id=docs.schema[doc_id].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting, held = [], 0

        def shard():
            # Lists as offsets and values, as Arrow is slow in building them from rows.
            ids = pa.concat_arrays([b.column(0) for b in waiting])
            row = shard_rows(number, ids, pa.concat_arrays([b.column(1) for b in waiting]))
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([row[0]], pa.int64()),
                    one(row[1]),
                    one(pa.array(row[2], pa.int64())),
                    one(row[3]),
                    one(pa.array(row[4], pa.int32())),
                    pa.array([row[5]], pa.binary()),
                ],
                names=["shard", "docs", "n_words", "terms", "counts", "steps"],
            )

        for whole in batches:
            for batch in slices(whole, 1, shard_bytes):
                size = pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
                if waiting and held + size > shard_bytes:
                    yield shard()
                    number, waiting, held = number + 1, [], 0
                waiting.append(batch)
                held += size
        if waiting:
            yield shard()

    return materialize(source.mapInArrow(run, schema), "positional-index", ROW_CHECK)


def phrases_of(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """words, items: the distinct sequences of ``window`` words of the items, and the ids that have them.

    An item of fewer words is one sequence.
    """
    listed = items.select(F.col(item_id).alias("item"), words_of(text).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return (
        listed.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("words"))
        .groupBy("words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


class Phrases:
    """A chunk of phrases: their distinct terms, and per phrase the numbers of its terms and of the items that have it."""

    def __init__(self, words: list[list[str]], items: list[list], id_type: pa.DataType):
        self.id_type = id_type
        size = np.fromiter(map(len, words), np.int64, len(words))
        coded = pa.array([w for phrase in words for w in phrase], pa.string()).dictionary_encode()
        self.terms = coded.dictionary
        self.size = size
        self.first = np.cumsum(size) - size
        self.term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.names = sorted({i for ids in items for i in ids})
        place = {name: n for n, name in enumerate(self.names)}
        self.n_items = np.fromiter(map(len, items), np.int64, len(items))
        self.first_item = np.cumsum(self.n_items) - self.n_items
        self.item = np.fromiter((place[i] for ids in items for i in ids), np.int64, int(self.n_items.sum()))

    def by_length(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers and term matrix of the phrases of each length."""
        for length in np.unique(self.size):
            number = np.flatnonzero(self.size == length)
            yield number, self.term[self.first[number][:, None] + np.arange(length)]


class Shard:
    """The postings that a shard has of a chunk's terms; term numbers are the chunk's."""

    def __init__(self, terms: pa.Array, counts: np.ndarray, steps: bytes, phrases: Phrases):
        position = np.cumsum(np.frombuffer(steps, "<u4"), dtype=np.uint32).astype(np.int64)
        counts = counts.astype(np.int64)
        found = pc.index_in(terms, value_set=phrases.terms)
        here = pc.is_valid(found).to_numpy(zero_copy_only=False)
        number = pc.fill_null(found, 0).to_numpy(zero_copy_only=False)[here].astype(np.int64)
        first = (np.cumsum(counts) - counts)[here]
        order = np.argsort(number)
        number, first, count = number[order], first[order], counts[here][order]
        self.count = np.zeros(len(phrases.terms), np.int64)
        self.count[number] = count
        self.first = np.cumsum(self.count) - self.count
        self.position = position[ragged(first, count)]
        # All lists as one sorted list, for looking up many (term, position) at once.
        self.entry = (np.repeat(number, count) << 33) + self.position

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        wanted = (term << 33) + position
        at = np.searchsorted(self.entry, wanted)
        return (at < len(self.entry)) & (self.entry[np.minimum(at, len(self.entry) - 1)] == wanted)

    def starts(self, number: np.ndarray, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Phrase numbers and start positions of every occurrence; ``terms`` has a row of equal length per phrase."""
        count = self.count[terms]
        alive = (count > 0).all(axis=1)
        number, terms, count = number[alive], terms[alive], count[alive]
        if not len(number):
            return
        rarest = np.argsort(count, axis=1, kind="stable")
        row = np.arange(len(number))
        listed = count[row, rarest[:, 0]]
        piece = (np.cumsum(listed) - listed) // STARTS
        for begin, end in zip(*_runs(piece), strict=True):
            at = np.repeat(row[begin:end], listed[begin:end])
            lead = rarest[begin:end, 0]
            first = self.first[terms[row[begin:end], lead]]
            start = self.position[ragged(first, listed[begin:end])] - rarest[at, 0]
            at, start = at[start >= 0], start[start >= 0]
            for k in range(1, terms.shape[1]):
                offset = rarest[at, k]
                held = self.has(terms[at, offset], start + offset)
                at, start = at[held], start[held]
                if not len(at):
                    break
            if len(at):
                yield number[at], start


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Begins and ends of the runs of equal values."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    return [0, *cuts.tolist()], [*cuts.tolist(), len(values)]


def _chunks(phrases: DataFrame, chunk_words: int) -> Iterator[Phrases]:
    """The phrases in chunks that hold about ``chunk_words`` words each."""
    words = phrases.agg(F.coalesce(F.sum(F.size("words") + F.size("items")), F.lit(0)).cast("long")).first()[0]
    n = -(-words // chunk_words)
    for i in range(n):
        part = phrases.where(F.pmod(F.xxhash64("words"), F.lit(n)) == i).toArrow()
        if part.num_rows:
            yield Phrases(part["words"].to_pylist(), part["items"].to_pylist(), part["items"].type.value_type)


def _search(index: DataFrame, chunk: Phrases, find, schema: str) -> DataFrame:
    """Rows of ``find(shard number, words per document, Shard, chunk)`` over all shards."""
    sent = index.sparkSession.sparkContext.broadcast(chunk)
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                number, n_words, terms, counts, steps = (batch.column(c)[i] for c in range(5))
                shard = Shard(terms.values, counts.values.to_numpy(), steps.as_py(), phrases)
                for columns in find(number.as_py(), n_words.values.to_numpy().astype(np.int64), shard, phrases):
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return index.select("shard", "n_words", "terms", "counts", "steps").mapInArrow(run, schema)


def _hits(number: int, n_words: np.ndarray, shard: Shard, phrases: Phrases) -> Iterator[list]:
    """Per document with an occurrence: runs of hit words and the items, as offsets into both lists."""
    first = np.cumsum(n_words + 1) - (n_words + 1)
    edge = np.zeros(int((n_words + 1).sum()) + 1, np.int64)
    pairs = np.zeros(0, np.int64)
    for which, start in (f for group in phrases.by_length() for f in shard.starts(*group)):
        np.add.at(edge, start, 1)
        np.add.at(edge, start + phrases.size[which], -1)
        doc = np.searchsorted(first, start, side="right") - 1
        n = phrases.n_items[which]
        item = phrases.item[ragged(phrases.first_item[which], n)]
        pairs = np.union1d(pairs, (np.repeat(doc, n) << 32) + item)
    hit = np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
    if not len(begin):
        return
    doc = np.searchsorted(first, begin, side="right") - 1
    docs = np.unique(doc)
    cut = np.searchsorted(doc, [*docs, len(n_words)]).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(begin - first[doc], pa.int64()), pa.array(end - first[doc], pa.int64())], names=["begin", "end"]
    )
    item_cut = np.searchsorted(pairs >> 32, [*docs, len(n_words)]).astype(np.int32)
    names = pa.array([phrases.names[i] for i in (pairs & 0xFFFFFFFF).tolist()], phrases.id_type)
    yield [
        pa.array([number] * len(docs), pa.int64()),
        pa.array(docs, pa.int32()),
        pa.ListArray.from_arrays(pa.array(cut), spans),
        pa.ListArray.from_arrays(pa.array(item_cut), names),
    ]


def _documents(index: DataFrame) -> DataFrame:
    """shard, place, doc_id, n_words of every document."""
    both = F.posexplode(F.arrays_zip(F.col("docs").alias("doc"), F.col("n_words").alias("n")))
    return index.select("shard", both.alias("place", "one")).select(
        "shard", "place", F.col("one.doc").alias("doc_id"), F.col("one.n").alias("n_words")
    )


def _joined(spans: Column) -> Column:
    """Sorted runs without overlaps: those that meet become one."""
    none = F.lit([]).cast("array<struct<begin:bigint,end:bigint>>")

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], run["end"]).alias("end"))
        apart = F.concat(done, F.array(run))
        head = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when((F.size(done) > 0) & (run["begin"] <= F.get(done, F.size(done) - 1)["end"]), F.concat(head, F.array(longer))).otherwise(apart)

    return F.aggregate(F.array_sort(spans), none, add)


def phrase_matches(index: DataFrame, phrases: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """shard, place, doc_id, n_words, spans, items of every document of the index.

    ``spans`` are the maximal runs of words inside of any occurrence (begin, and end behind it), ``items`` the sorted ids whose
    phrases occur; both are empty where nothing occurs.
    """
    id_type = phrases.schema["items"].dataType.elementType.simpleString()
    schema = f"shard long, place int, spans array<struct<begin:bigint,end:bigint>>, items array<{id_type}>"
    parts = [_search(index, chunk, _hits, schema) for chunk in _chunks(phrases, chunk_words)]
    found = index.sparkSession.createDataFrame([], schema)
    if len(parts) == 1:
        found = parts[0]
    elif parts:
        for part in parts:
            found = found.union(part)
        # A document's runs and items of all chunks, at most its words and the items.
        found = found.groupBy("shard", "place").agg(
            _joined(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    empty = {name: F.coalesce(name, F.lit([]).cast(found.schema[name].dataType)) for name in ("spans", "items")}
    return _documents(index).join(materialize(found, "phrase-matches"), ["shard", "place"], "left").withColumns(empty)


def contamination(index: DataFrame, phrases: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """The figures of :func:`phrase_matches`: hit words, items, a digest of their ids, verdict."""
    spans = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return phrase_matches(index, phrases, chunk_words).select(
        "doc_id",
        "n_words",
        spans.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (spans > 0).alias("contaminated"),
    )


def least_spans(places: list[np.ndarray], within: int) -> list[tuple[int, int]]:
    """Spans of at most ``within`` words that hold one of each list of places and no smaller such span."""
    merged = sorted((p, k) for k, listed in enumerate(places) for p in listed.tolist())
    last, out = {}, []
    for i, (p, k) in enumerate(merged):
        last[k] = p
        if len(last) < len(places):
            continue
        begin = min(last.values())
        if p - begin < within:
            if out and out[-1][0] == begin:
                continue  # the earlier end is the smaller span
            out.append((begin, p))
    return out


def _near(within: int):
    def find(number: int, n_words: np.ndarray, shard: Shard, phrases: Phrases) -> Iterator[list]:
        first = np.cumsum(n_words + 1) - (n_words + 1)
        rows = set()
        for which in range(len(phrases.size)):
            terms = np.unique(phrases.term[phrases.first[which] :][: phrases.size[which]])
            count = shard.count[terms]
            if not count.all():
                continue
            lists = [shard.position[shard.first[t] : shard.first[t] + shard.count[t]] for t in terms[np.argsort(count, kind="stable")]]
            lead = lists[0]
            for other in lists[1:]:
                near = np.searchsorted(other, lead + within) > np.searchsorted(other, lead - within, side="right")
                lead = lead[near]
            # Places around the rarest word; ranges that overlap are looked at together.
            for begin, end in zip(*_runs(np.cumsum(np.diff(lead, prepend=lead[:1]) >= 2 * within)), strict=True) if len(lead) else ():
                low, high = lead[begin] - within, lead[end - 1] + within
                around = [x[np.searchsorted(x, low, side="right") : np.searchsorted(x, high)] for x in lists]
                for b, e in least_spans(around, within):
                    doc = int(np.searchsorted(first, b, side="right") - 1)
                    if e < first[doc] + n_words[doc]:
                        owners = phrases.item[phrases.first_item[which] :][: phrases.n_items[which]].tolist()
                        rows.update((doc, phrases.names[i], int(b - first[doc]), int(e + 1 - first[doc])) for i in owners)
        if rows:
            place, item, begin, end = zip(*sorted(rows), strict=True)
            yield [
                pa.array([number] * len(place), pa.int64()),
                pa.array(place, pa.int32()),
                pa.array(item, phrases.id_type),
                pa.array(begin, pa.int64()),
                pa.array(end, pa.int64()),
            ]

    return find


def proximity_matches(index: DataFrame, phrases: DataFrame, within: int, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, item_id, begin, end: spans of at most ``within`` words that hold all distinct words of a phrase in any order
    and no smaller such span, per item that has the phrase; an item without an id has no rows."""
    id_type = phrases.schema["items"].dataType.elementType.simpleString()
    schema = f"shard long, place int, item_id {id_type}, begin long, end long"
    found = index.sparkSession.createDataFrame([], schema)
    for chunk in _chunks(phrases, chunk_words):
        found = found.union(_search(index, chunk, _near(within), schema))
    return _documents(index).join(found.distinct(), ["shard", "place"]).select("doc_id", "item_id", "begin", "end")
