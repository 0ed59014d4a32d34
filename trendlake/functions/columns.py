"""Finding, checking and flattening columns by schema alone; none of these runs a job."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.values import convert

# Separators that flattened column names come with.
SEPARATORS = (".", "__", "_")


def quoted(*parts: str) -> Column:
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in parts))


def find(schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    """Look up ``a.b.c`` as a flattened column (any separator) or as nested structs."""
    parts = path.split(".")
    for separator in SEPARATORS:
        name = separator.join(parts)
        if name in schema.names:
            return quoted(name), schema[name].dataType
    level: T.DataType = schema
    for part in parts:
        if not isinstance(level, T.StructType) or part not in level.names:
            return None
        level = level[part].dataType
    return quoted(*parts), level


def pick(df: DataFrame, path: str, to_type: str, default: Any = None) -> Column:
    """The column found for ``path`` as ``to_type``, or the default if there is none."""
    hit = find(df.schema, path)
    if hit is None:
        return F.lit(default).cast(to_type)
    column, found_type = hit
    return convert(column, found_type.simpleString(), to_type)


def missing_columns(schema: T.StructType, paths: Iterable[str]) -> list[str]:
    return sorted(path for path in set(paths) if find(schema, path) is None)


def require_columns(
    schema: T.StructType, paths: Iterable[str], on_missing: str = "raise"
) -> list[str]:
    """Report missing columns; ``on_missing='warn'`` goes on without them."""
    missing = missing_columns(schema, paths)
    if missing:
        text = f"missing columns {missing}; found {schema.names}"
        if on_missing == "raise":
            raise ValueError(text)
        warnings.warn(text, stacklevel=2)
    return missing


def _leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, path)
        else:
            yield path


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every nested struct field as a column of its own, named by its path."""
    return df.select(*(quoted(*path).alias(sep.join(path)) for path in _leaves(df.schema)))
