"""Quality scores from compressed sizes.

Two zstandard dictionaries are trained, on good and on bad labelled text. A text is compressed piece by piece with
each; pieces are short, so that the dictionary and not the text itself decides. The difference of the sizes by their sum says
which kind of text it resembles, and a logistic curve, fitted on labelled rows that the dictionaries haven't seen,
turns it into a probability of label 1.

Fitting uses a bounded sample: the ``sample`` labelled rows of each label with the least hash. Every other one of them is for
the dictionaries: its whole text is cut to pieces in tasks, and the ``sample_pieces`` pieces of a label with the least hash, from all over
the texts, are what a dictionary is trained on. The rest are for the curve: their whole texts are compressed in tasks, and
only their differences reach the driver. Scoring reads every text whole.

Defined cases: a null or empty text differs by zero and gets the score of that. With one label only, or too few rows for
dictionaries, the score is the share of label 1 in the sample (0.5 without labels). Rows with null ids or labels
aren't learned from. Equal texts get equal scores. Extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from trendlake.llm.common import one_label, slices, small_batches
from trendlake.shared import materialize

PIECE = 1024
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: A hundred times a dictionary's size, at most, is what training it makes use of.
SAMPLE_PIECES = 6400


def pieces(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


@dataclass
class Model:
    """Two dictionaries and a logistic curve, or a constant score if ``good`` is empty."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0

    def differences(self, texts: list[str | None]) -> np.ndarray:
        """(size by bad - size by good) / (sum of both) of each text; above zero is good."""
        if not self.good:
            return np.zeros(len(texts))
        import zstandard

        def sizer(content: bytes):
            dictionary = zstandard.ZstdCompressionDict(content)
            dictionary.precompute_compress(level=LEVEL)
            packer = zstandard.ZstdCompressor(
                dict_data=dictionary, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            return lambda parts: sum(len(packer.compress(p)) for p in parts)

        by_good, by_bad = sizer(self.good), sizer(self.bad)
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            parts = pieces(text)
            if parts:
                good, bad = by_good(parts), by_bad(parts)
                out[i] = (bad - good) / (bad + good)
        return out

    def scores(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * differences + self.offset, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, slightly damped, by Newton's method."""
    scale = float(np.abs(x).max()) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], 1)
    weights, damping = np.zeros(2), np.array([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (y - p) - damping * weights
        curvature = (design * (p * (1 - p))[:, None]).T @ design + np.diag(damping)
        step = np.linalg.solve(curvature, gradient)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 2000, sample_pieces: int = SAMPLE_PIECES) -> Model:
    """A model from ``labels`` (doc_id, quality) and the texts of ``docs``. At most 2 * ``sample`` ids and differences and
    2 * ``sample_pieces`` pieces of 1024 bytes reach the driver, whatever the length of the texts."""
    picked = sampled(labels, sample)
    # At most two samples of ids: small enough to send to every task.
    found = (
        docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "quality", "place").agg(F.min("text").alias("text"))
    )
    rows = materialize(found, "labelled-texts")
    shown = {r.quality: r["count"] for r in rows.groupBy("quality").count().collect()}
    share = (shown.get(1, 0) + 1) / (sum(shown.values()) + 2)
    constant = Model(offset=float(np.log(share / (1 - share))))
    teaches = F.col("place") % 2 == 1
    drawn = chosen_pieces(rows.where(teaches), sample_pieces)
    good, bad = (dictionary([bytes(r.piece) for r in drawn if r.quality == label]) for label in (1, 0))
    if not good or not bad:
        return constant
    model = Model(good, bad)
    held = differences_of(rows.where(~teaches), model, "doc_id", "quality").orderBy("doc_id").collect()
    if len({r.quality for r in held}) < 2:
        return constant
    model.slope, model.offset = logistic(
        np.array([r.difference for r in held]), np.array([r.quality for r in held], float)
    )
    return model


def sampled(labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, quality and place (from 1, by hash within the label) of the ``sample`` rows of each label."""
    known = one_label(labels, "quality").withColumn("at", F.xxhash64(F.col("doc_id").cast("string")))
    picked = None
    for label in (0, 1):
        part = known.where(F.col("quality") == label).orderBy("at", "doc_id").limit(sample)
        picked = part if picked is None else picked.union(part)
    # The window sees the sample only.
    order = Window.partitionBy("quality").orderBy("at", "doc_id")
    return picked.select("doc_id", "quality", F.row_number().over(order).alias("place"))


def chosen_pieces(rows: DataFrame, limit: int) -> list[Row]:
    """quality and piece: the ``limit`` pieces of each label with the least hash of document and position, in that order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                for name, quality, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    parts = pieces(text)
                    if parts:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(parts)), pa.array([quality] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())],
                            names=["name", "quality", "position", "piece"],
                        )

    source = rows.select(F.col("doc_id").cast("string").alias("name"), F.col("quality").cast("int").alias("quality"), "text")
    small_batches(rows.sparkSession)
    cut = source.mapInArrow(run, "name string, quality int, position long, piece binary")
    cut = cut.withColumn("at", F.xxhash64("name", "position"))
    order = ("at", "name", "position")
    return [
        r for label in (0, 1) for r in cut.where(F.col("quality") == label).orderBy(*order).limit(limit).select("quality", "piece").collect()
    ]


def dictionary(parts: list[bytes]) -> bytes:
    """A dictionary trained on the pieces; empty if they are too few for one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def differences_of(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """``carry`` columns and ``difference`` of every row's whole text."""
    small_batches(docs.sparkSession)
    source = docs.select(*carry, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, len(carry)):
                found = model.differences(batch.column(len(carry)).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*carry, "difference"])

    return source.mapInArrow(run, source.drop("text").schema.add("difference", "double"))


def score(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """``carry`` columns and ``score`` of every row."""
    margin = F.lit(model.slope) * F.col("difference") + F.lit(model.offset)
    bounded = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), margin))
    return differences_of(docs, model, *carry).select(*carry, (1 / (1 + F.exp(-bounded))).alias("score"))


def fold(doc_id: Column, folds: int = 3) -> Column:
    """A document's fold by the CRC-32 of its id as text; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds
