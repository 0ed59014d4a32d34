"""Both raw formats to the canonical statistics columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.functions.columns import find, pick
from trendlake.schemas import INGESTED_AT

API, BULK = "api", "bulk"
CARRIED = (INGESTED_AT,)


def detect_format(schema: T.StructType) -> str:
    """API rows have a snippet title, flattened in some spelling or still nested."""
    return API if find(schema, schemas.API_PATHS["title"]) else BULK


def normalize_api(
    df: DataFrame, run_time: Column | None = None, carry: Sequence[str] = CARRIED
) -> DataFrame:
    """API videos. Their trending date is the day they were fetched: the envelope's time if
    the rows carry it, else ``run_time`` (now)."""
    fetched = F.current_timestamp() if run_time is None else run_time
    if INGESTED_AT in df.columns:
        fetched = F.coalesce(F.col(INGESTED_AT), fetched)
    built = {
        name: pick(df, schemas.API_PATHS.get(name, name), kind, schemas.API_DEFAULTS.get(name))
        for name, kind in schemas.STATISTICS.items()
    }
    built["trending_date"] = F.date_format(fetched, schemas.RUN_DATE_FORMAT)
    return _select(df, built, carry)


def normalize_bulk(df: DataFrame, carry: Sequence[str] = CARRIED) -> DataFrame:
    """Bulk rows, which have the canonical names already."""
    built = {name: pick(df, name, kind) for name, kind in schemas.STATISTICS.items()}
    return _select(df, built, carry)


def _select(df: DataFrame, built: dict[str, Column], carry: Sequence[str]) -> DataFrame:
    carried = [name for name in carry if name in df.columns]
    return df.select(*(column.alias(name) for name, column in built.items()), *carried)


def normalize(
    df: DataFrame, run_time: Column | None = None, carry: Sequence[str] = CARRIED
) -> DataFrame:
    """Whichever of the two formats ``df`` has. ``carry`` names columns to keep besides."""
    if detect_format(df.schema) == API:
        return normalize_api(df, run_time, carry)
    return normalize_bulk(df, carry)


def unify(
    *frames: DataFrame, run_time: Column | None = None, carry: Sequence[str] = CARRIED
) -> DataFrame:
    """Several raw frames, of either format, as one canonical frame."""
    first, *rest = (normalize(df, run_time, carry) for df in frames)
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first
