"""Numbers of a load, taken from the write itself and not by scans of their own."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendlake.functions.values import region_of_path
from trendlake.operators.documents import COUNTS, count_columns
from trendlake.schemas import RUN_COUNTS, UNKNOWN_REGION, WARNING_COLUMNS
from trendlake.sources.documents import FILE_SIZE, SOURCE_FILE, document_files, unreadable
from trendlake.sources.tables import only_regions


class LoadCounts:
    """Rows of a load as read, cleansed and kept, counted while the load is written once.

    As with any observation, a stage that is run again after an executor loss may be counted twice:
    :func:`~trendlake.sinks.tables.stored_rows` is exact.
    """

    def __init__(self) -> None:
        self._read, self._cleansed, self._written = Observation(), Observation(), Observation()

    @staticmethod
    def _nulls(prefix: str):
        return [F.count_if(F.col(name).isNull()).alias(f"{prefix}_null_{name}") for name in WARNING_COLUMNS]

    def read(self, df: DataFrame) -> DataFrame:
        return df.observe(self._read, F.count(F.lit(1)).alias("rows"), *self._nulls("read"))

    def cleansed(self, df: DataFrame) -> DataFrame:
        return df.observe(self._cleansed, F.count(F.lit(1)).alias("rows"))

    def written(self, df: DataFrame) -> DataFrame:
        negative = F.count_if(F.col("views") < 0).alias("written_negative_views")
        return df.observe(self._written, F.count(F.lit(1)).alias("rows"), *self._nulls("written"), negative)

    def values(self) -> dict[str, int]:
        """After the write: rows read, dropped as corrupt, dropped as duplicates, written, and what the warnings count."""
        read, cleansed, written = dict(self._read.get), self._cleansed.get["rows"], dict(self._written.get)
        rows_read, rows_written = read.pop("rows"), written.pop("rows")
        return {
            "loads": 1,
            "rows_read": rows_read,
            "rows_dropped": rows_read - cleansed,
            "rows_deduplicated": cleansed - rows_written,
            "rows_written": rows_written,
            **read,
            **written,
        }


class DocumentCounts:
    """Documents of the expected regions, counted while silver is built from them, so that they aren't parsed for that alone.

    Any file is one row of one task, and files are counted in the stage that counts documents. If as many were seen as there are,
    none was read twice, after the loss of an executor say, and the counts are exact; :meth:`values` gives none otherwise.
    ``regions`` limits what is read, in any spelling.
    """

    #: Each expected region takes three sums of every task.
    MOST_REGIONS = 50

    def __init__(self, expected: Sequence[str], regions: Sequence[str] | None = None) -> None:
        self._expected, self._regions = list(dict.fromkeys(expected)), regions
        self._files, self._documents = Observation(), Observation()
        self._watched = False

    def files(self, df: DataFrame) -> DataFrame:
        """A row per file. Other regions are left out here, as a filter doesn't pass what is observed."""
        self._watched = True
        return only_regions(df, self._regions).observe(self._files, F.count_if(F.col(FILE_SIZE) > 0).alias("files"))

    def documents(self, df: DataFrame) -> DataFrame:
        """The documents of these files, which must be read and written in full."""
        if not self._watched or len(self._expected) > self.MOST_REGIONS:
            self._watched = False
            return df
        bad = unreadable(df)
        sums = [
            column.alias(f"{name}_{i}")
            for i, region in enumerate(self._expected)
            for name, column in count_columns(bad, F.col("region") == region).items()
        ]
        return df.observe(self._documents, *sums) if sums else df

    def values(self, spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame | None:
        """After the write: the counts of each expected region that was read, or None if they aren't known to be exact."""
        if not self._watched or not self._expected:
            return None
        listed = document_files(spark, path, folders).filter(F.col(FILE_SIZE) > 0)
        placed = listed.select(region_of_path(F.col(SOURCE_FILE), UNKNOWN_REGION).alias("region"))
        if only_regions(placed, self._regions).count() != self._files.get["files"]:
            return None
        seen = self._documents.get
        rows = [(region, *(seen[f"{name}_{i}"] for name in COUNTS)) for i, region in enumerate(self._expected)]
        found = spark.createDataFrame(rows, ", ".join(["region string", *(f"{name} long" for name in COUNTS)]))
        return only_regions(found, self._regions)


def total_counts(spark: SparkSession, loads: Iterable[Mapping[str, int]]) -> DataFrame:
    """One row: the numbers of all loads of a run together."""
    loads = list(loads)
    row = tuple(sum(load.get(name, 0) for load in loads) for name in RUN_COUNTS.fieldNames())
    return spark.createDataFrame([row], RUN_COUNTS)
