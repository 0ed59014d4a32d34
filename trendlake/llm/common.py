"""What several text operators share: names, word patterns, expressions that bind a value once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_name(label: str) -> str:
    """A column name that no input table has."""
    return f"__{label}_{uuid.uuid4().hex[:12]}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside of lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def one_label(labels: DataFrame, value: str) -> DataFrame:
    """doc_id and ``value``, one row per labelled document; the lowest of several labels counts."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(value).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(value).alias(value))
    )


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that a piece holds about ``limit`` bytes of ``column``, and one row at least."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = (np.cumsum(size, dtype=np.int64) - size) // limit
    cuts = np.flatnonzero(np.diff(piece)) + 1
    for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(int(begin), int(end - begin))


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bounds what an Arrow batch of whole texts holds in the session's tasks, by bytes and not by rows alone."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
