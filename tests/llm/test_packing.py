from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SF_DIR
from trendlake.llm import packing, queries

PATH = queries.tokenizer_path("word_bpe_49k.json")


def plain_ids(texts):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(PATH).encode
    return [encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_alone_give_the_ids_of_whole_texts(messy_rows):
    odd = [
        "It's we'll 'tis rock'n'roll o'clock's", "x<|endoftext|>y <|endoftext|> a<|endoftext|>", "ÉCOLE école Straße İstanbul ΑΣ ΑΣ.",
        "a b c\u0085d", "é e ́ ﬁ ½ ² ٣ 12345 a1b2", "don't!? (yes)...[no]{}~`^", "​zero ﻿", "x'", "co-op's,'s",
        "日本語 テキスト 한국어", "ß ẞ ſ K Å",
    ]
    texts = [r[1] for r in messy_rows] + odd
    tokenizer = packing.WordTokenizer(PATH)
    for _ in range(2):
        ids, count = tokenizer(pa.array(texts, pa.string()))
        got = [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
        assert got == plain_ids(texts)


def test_tokenizer_forgets(messy_rows):
    texts = [r[1] for r in messy_rows]
    tokenizer = packing.WordTokenizer(PATH, limit=10)
    tokenizer(pa.array(texts, pa.string()))
    ids, _ = tokenizer(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for x in plain_ids(texts) for i in x]


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_decreasing(seed):
    rng = random.Random(seed)
    sizes = np.array([rng.randint(1, 100) for _ in range(rng.randint(1, 200))])
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room, placed = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if at == len(room):
            room.append(100)
        placed[i] = (at, 100 - room[at])
        room[at] -= sizes[i]
    assert [placed[i] for i in range(len(sizes))] == list(zip(bins.tolist(), offsets.tolist(), strict=True))


def check(pieces, texts_by_id, end_id=1, capacity=2048):
    ids = {d: np.array([*x, end_id], "<u4") for d, x in zip(texts_by_id, plain_ids(texts_by_id.values()), strict=True)}
    places, cover = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        places[p.sequence_id].append((p.offset, p.length))
        cover[p.doc_id].append((p.start, p.length))
    assert set(cover) == set(ids)
    for spans, whole in [*((s, None) for s in places.values()), *((cover[d], len(ids[d])) for d in cover)]:
        at = 0
        for begin, length in sorted(spans):
            assert begin == at and length > 0
            at += length
        assert at <= capacity if whole is None else at == whole
    return places


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    places = check(queries.op2_packing(spark, SF_DIR).collect(), texts)
    used = [sum(length for _, length in p) for p in places.values()]
    assert sum(2048 - u for u in used) < 0.05 * sum(used)


def test_messy(spark, messy, messy_rows):
    tokens = packing.tokenize(messy, PATH, 1, "doc_id")
    pieces = packing.pack(tokens, 3, 64).collect()
    assert sum(p.length for p in pieces) == sum(len(x) + 1 for x in plain_ids([r[1] for r in messy_rows]))
    places = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        places[p.sequence_id].append((p.offset, p.length))
    for spans in places.values():
        at = 0
        for begin, length in sorted(spans):
            assert begin == at
            at += length
        assert at <= 64


def test_equal_rows_spread_over_groups(spark):
    same = spark.range(2000).selectExpr("cast(null as long) AS doc_id", "'a b c d e' AS text")
    docs = same.union(spark.range(2000).selectExpr("id AS doc_id", "concat('word ', id) AS text"))
    pieces = packing.pack(packing.tokenize(docs, PATH, 1, "doc_id"), 8, 64).collect()
    assert len(pieces) == 4000
    groups = Counter(p.sequence_id >> 31 for p in pieces)
    assert set(groups) == set(range(8)) and max(groups.values()) < 2 * 500


def test_full_pieces_are_not_shuffled(spark):
    docs = spark.createDataFrame([(1, "a " * 1000), (None, "b " * 127), (3, "")], "doc_id long, text string")
    pieces = packing.pack(packing.tokenize(docs, PATH, 1, "doc_id"), 4, 64)
    rows = pieces.collect()
    full = [p for p in rows if p.length == 64]
    assert len(full) == 1001 // 64 + 2 and all(p.offset == 0 and p.sequence_id >> 31 >= 4 for p in full)
    assert len({p.sequence_id for p in full}) == len(full)
    assert sorted((p.doc_id, p.start, p.length) for p in rows if p.length < 64) == [(1, 960, 41), (3, 0, 1)]
    plan = pieces._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "MapInArrow" not in plan


def test_empty(no_documents):
    assert packing.group_count(no_documents) == 1
    assert packing.pack(packing.tokenize(no_documents, PATH, 1, "doc_id"), 1).isEmpty()
