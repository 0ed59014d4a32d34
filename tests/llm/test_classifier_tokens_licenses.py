from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import zstandard

from tests.llm import brute
from tests.llm.conftest import SF_DIR
from trendlake.llm import license_scan, queries, token_counts
from trendlake.llm import quality_classifier as C


def test_classifier_on_held_out_rows(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    got = queries.op6_quality_classifier(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    held = [(rows[d].predicted, q, rows[d].score) for d, q in quality.items() if rows[d].held_out]
    assert np.mean([p == q for p, q, _ in held]) > 0.9
    good, bad = ([s for _, q, s in held if q == label] for label in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9


def test_classifier_without_labels(spark, messy, labels):
    for none in (labels.limit(0), labels.where("quality = 1"), labels):
        model = C.fit(messy, none)
        scores = {r.score for r in C.score(messy, model, "doc_id").collect()}
        assert len(scores) >= 1 and all(0 <= s <= 1 for s in scores)
    assert C.fit(messy, labels.limit(0)).scores(np.zeros(1))[0] == 0.5


def plain_sizes(content, texts):
    """Bytes of each text's pieces of 1024 bytes, compressed one by one with a dictionary."""
    made = zstandard.ZstdCompressionDict(content)
    out = []
    for text in texts:
        raw, total = (text or "").encode(), 0
        while raw:
            packer = zstandard.ZstdCompressor(
                dict_data=made, level=3, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            total, raw = total + len(packer.compress(raw[:1024])), raw[1024:]
        out.append(total)
    return out


def test_classifier_against_plain_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    model = C.fit(docs, labels)
    assert model.good and model.bad
    rows = docs.select("doc_id", "text").collect()
    good, bad = (plain_sizes(content, [r.text for r in rows]) for content in (model.good, model.bad))
    wanted = {}
    for r, g, b in zip(rows, good, bad, strict=True):
        x = (b - g) / (b + g) if b + g else 0.0
        wanted[r.doc_id] = 1 / (1 + math.exp(-max(-500, min(500, model.slope * x + model.offset))))
    got = {r.doc_id: r.score for r in C.score(docs, model, "doc_id").collect()}
    assert got == pytest.approx(wanted, abs=1e-12)


def test_classifier_learns_from_whole_texts(spark):
    """What tells the labels apart stands behind 30,000 characters that all texts share."""
    rng = random.Random(5)
    shared = " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=6000))
    words = [["tidy", "clear", "careful", "reasoned"], ["spam", "click", "casino", "winner"]]
    rows = [(i, shared + " " + " ".join(rng.choices(words[i % 2], k=4000))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    model = C.fit(docs, labels)
    scores = {r.doc_id: r.score for r in C.score(docs, model, "doc_id").collect()}
    assert all((s > 0.5) == (i % 2 == 0) for i, s in scores.items())
    positions = [bytes(r.piece) for r in C.chosen_pieces(docs.join(labels, "doc_id"), 10)]
    assert len(positions) == 20 and any(b"casino" in p for p in positions) and any(b"tidy" in p for p in positions)


def test_logistic_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(1.5 * x - 0.5)))).astype(float)
    slope, offset = C.logistic(x, y)
    assert slope == pytest.approx(1.5, abs=0.1) and offset == pytest.approx(-0.5, abs=0.1)


@pytest.mark.parametrize("seed", range(20))
def test_automaton_equals_greedy_matching(seed):
    rng = random.Random(seed)
    letters = b"abc"
    vocabulary = {bytes(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(12)}
    if seed % 2:
        vocabulary |= {b"a", b"b", b"c"}
    automaton = token_counts.Automaton(sorted(vocabulary))
    for _ in range(300):
        word = bytes(rng.choices(letters, k=rng.randint(1, 14)))
        greedy = brute.greedy_pieces(word, vocabulary)
        assert automaton.count(word) == (1 if greedy is None else greedy)


def test_token_counts_of_messy_texts(messy, messy_rows):
    vocabulary = token_counts.ranked_vocabulary(queries.tokenizer_path("byte_bpe_50k.tiktoken"))
    known = set(vocabulary)
    got = token_counts.token_counts(messy, vocabulary, limit=5)
    want = []
    for row in messy_rows:
        words = brute.words(row[1])
        want.append((row[0], len(words), sum(brute.greedy_pieces(b" " + w.encode(), known) for w in words)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def brute_licenses(text, texts, least):
    words, out = license_scan.tokens(text), {}
    for name, template in texts.items():
        own = license_scan.tokens(template)
        shingles = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        length = license_scan.span(len(own))
        step = length // 4
        for begin in range(0, max(0, len(words) - 4), step):
            part = words[begin : begin + length]
            share = len({tuple(part[i : i + 5]) for i in range(len(part) - 4)} & shingles) / len(shingles)
            if share >= least:
                best = out.setdefault(name, [0.0, 0, 0])
                best[2] += 1
                if share > best[0]:
                    best[:2] = [share, begin]
    return {name: tuple(v) for name, v in out.items()}


def test_licenses_equal_containment_of_all_windows(spark):
    rng = random.Random(2)
    filler = ["alpha", "beta", "gamma", "the", "of", "license"]
    rows = []
    for i, (_, template) in enumerate(list(license_scan.TEMPLATES.items()) * 4):
        words = template.split()
        if i % 3 == 1 and len(words) > 12:
            words[len(words) // 2] = "changed"
        rows.append((i, " ".join(rng.choices(filler, k=rng.randint(0, 90)) + words + rng.choices(filler, k=rng.randint(0, 60)))))
    rows += [(100, None), (None, license_scan.TEMPLATES["mit-line"].upper()), (101, ""), (102, "four words only here"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in license_scan.license_matches(docs).collect():
        got.setdefault((r.doc_id, r.template), []).append((r.containment, r.first_word, r.windows))
    want = {}
    for doc, text in rows:
        for name, found in brute_licenses(text, license_scan.TEMPLATES, 0.8).items():
            want.setdefault((doc, name), []).append(found)
    assert set(got) == set(want)
    # Each window is caught with high probability, so a count may be short by one.
    for key, found in want.items():
        assert len(got[key]) == len(found)
        for g, w in zip(sorted(got[key]), sorted(found), strict=True):
            assert g[0] == pytest.approx(w[0]) and w[2] - 1 <= g[2] <= w[2]


def test_band_settings_catch_the_similarity():
    for jaccard in (0.2, 0.4, 0.6, 0.9):
        bands, rows = license_scan.band_settings(jaccard)
        assert 1 - (1 - jaccard**rows) ** bands >= 0.999


def test_short_template():
    with pytest.raises(ValueError, match="fewer"):
        license_scan.Templates({"x": "three words only"}, 0.8)


def test_empty(no_documents):
    assert license_scan.license_matches(no_documents).isEmpty()
    assert token_counts.token_counts(no_documents, [b"a"]).isEmpty()
    assert C.score(no_documents, C.Model(), "doc_id").isEmpty()


def test_every_given_license_is_found_in_a_text_of_several_slices(spark):
    """Texts longer than a slice, a column that clashes with the result's, and each template once, far behind."""
    rng = random.Random(8)
    filler = " ".join(f"word{rng.randrange(5000)}" for _ in range(5000))
    names = sorted(license_scan.TEMPLATES)
    rows = [(i, filler + " " + license_scan.TEMPLATES[n] + " " + filler, "clash") for i, n in enumerate(names)]
    rows += [(100, filler * 120, "clash"), (101, filler * 120 + " " + license_scan.TEMPLATES["mit-text"], "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, template string").repartition(3)
    found = {}
    for r in license_scan.license_matches(docs).collect():
        found.setdefault(r.doc_id, {})[r.template] = r
    assert all(found[i][n].containment == 1.0 for i, n in enumerate(names))
    assert 100 not in found and {"mit-text", "mit-grant"} <= set(found[101])
