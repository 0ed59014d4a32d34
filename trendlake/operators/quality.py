"""Quality checks. All checks of a table come from one aggregate over the whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.functions.columns import missing_columns
from trendlake.operators.cleanse import clock
from trendlake.schemas import CHECK_RESULT

# Result messages and the time columns to look for, in this order.
ROW_COUNT_TEXT = "Row count: %d (min: %d)"
NULL_PCT_TEXT = "%s null%%: %.2f%% (max: %s%%)"
NO_COLUMN_TEXT = "Column '%s' missing from table"
SCHEMA_OK_TEXT = "All expected columns present"
SCHEMA_BAD_TEXT = "Missing columns: %s"
RANGE_TEXT = "Views: %d negative, %d extreme (>%d)"
FRESH_TEXT = "Latest: %s, Cutoff: %s"
NO_TIME_TEXT = "No timestamp column found — skipping freshness check (backfill data)"
BAD_TIME_TEXT = "Could not parse timestamps: %d values — skipping"
NO_TABLE_TEXT = "Table %s not found"
TIME_COLUMNS = ("_processed_at", "_ingestion_timestamp")
RANGE_TABLE = "clean_statistics"
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
FRACTION_FORMAT = ".SSSSSS"
ZONE_FORMAT = "xxx"


class QualityGateError(RuntimeError):
    """Raised instead of building reports from tables that failed a check."""

    def __init__(self, failed: str):
        super().__init__(f"quality checks failed: {failed}")
        self.failed = failed


@dataclass(frozen=True)
class QualityRules:
    min_rows: int = schemas.MIN_ROWS
    max_null_pct: float = schemas.MAX_NULL_PCT
    max_views: int = schemas.MAX_VIEWS
    freshness_hours: int = schemas.FRESHNESS_HOURS
    critical: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: schemas.CRITICAL_COLUMNS
    )


DEFAULT_RULES = QualityRules()


def _row(check: str, table: str, passed: Column, message: Column, **given) -> Column:
    """One result as a struct with all result columns; what isn't given is NULL."""
    known = {"check": F.lit(check), "table": F.lit(table), "passed": passed, "message": message}
    known.update(given)
    return F.struct(
        *(
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CHECK_RESULT.fields
        )
    )


def _is_missing(df: DataFrame, name: str) -> Column:
    """NULL or, for floating point, not a number."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def check_table(
    df: DataFrame,
    table: str,
    rules: QualityRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    sample_rows: int | None = None,
) -> DataFrame:
    """One row per check of one table, see ``schemas.CHECK_RESULT``.

    ``sample_rows`` checks a bounded, unordered sample only.
    """
    if sample_rows is not None:
        df = df.limit(sample_rows)
    critical = list(rules.critical.get(table, ()))
    present = [name for name in critical if name in df.columns]
    has_range = table == RANGE_TABLE and "views" in df.columns
    time_column = next((name for name in TIME_COLUMNS if name in df.columns), None)

    measures = {"_rows": F.count(F.lit(1))}
    for name in present:
        measures[f"_null_{name}"] = F.count_if(_is_missing(df, name))
    if has_range:
        measures["_negative"] = F.count_if(F.col("views") < 0)
        measures["_extreme"] = F.count_if(F.col("views") > rules.max_views)
    if time_column:
        moment = F.col(time_column).try_cast("timestamp")
        measures["_latest"] = F.max(moment)
        measures["_unparsed"] = F.count_if(F.col(time_column).isNotNull() & moment.isNull())
    measured = df.agg(*(column.alias(name) for name, column in measures.items()))

    results = [_row_count(table, rules)]
    results += [
        _null_pct(table, name, rules) if name in present else _no_column(table, name)
        for name in critical
    ]
    results.append(_schema(table, missing_columns(df.schema, critical)))
    if has_range:
        results.append(_value_range(table, rules))
    results.append(
        _freshness(table, rules, as_of)
        if time_column
        else _row("freshness", table, F.lit(True), F.lit(NO_TIME_TEXT))
    )
    return measured.select(F.inline(F.array(*results)))


def _row_count(table: str, rules: QualityRules) -> Column:
    rows = F.col("_rows")
    return _row(
        "row_count",
        table,
        rows >= rules.min_rows,
        F.format_string(ROW_COUNT_TEXT, rows, F.lit(rules.min_rows)),
        value=rows,
        threshold=F.lit(rules.min_rows),
    )


def _null_pct(table: str, name: str, rules: QualityRules) -> Column:
    """Compared unrounded, reported to two places; an empty table has none missing."""
    pct = F.coalesce(
        F.try_divide(F.col(f"_null_{name}") * F.lit(100.0), F.col("_rows")), F.lit(0.0)
    )
    limit = F.lit(str(rules.max_null_pct))
    return _row(
        "null_pct",
        table,
        pct <= rules.max_null_pct,
        F.format_string(NULL_PCT_TEXT, F.lit(name), pct, limit),
        column=F.lit(name),
        value=F.round(pct, 2),
        threshold=F.lit(rules.max_null_pct),
    )


def _no_column(table: str, name: str) -> Column:
    return _row(
        "null_pct", table, F.lit(False), F.lit(NO_COLUMN_TEXT % name), column=F.lit(name)
    )


def _schema(table: str, missing: list[str]) -> Column:
    text = SCHEMA_BAD_TEXT % ", ".join(missing) if missing else SCHEMA_OK_TEXT
    return _row(
        "schema",
        table,
        F.lit(not missing),
        F.lit(text),
        missing_columns=F.array(*(F.lit(name) for name in missing)),
    )


def _value_range(table: str, rules: QualityRules) -> Column:
    negative, extreme = F.col("_negative"), F.col("_extreme")
    return _row(
        "value_range",
        table,
        (negative == 0) & (extreme == 0),
        F.format_string(RANGE_TEXT, negative, extreme, F.lit(rules.max_views)),
        column=F.lit("views"),
        negative_count=negative,
        extreme_count=extreme,
    )


def _freshness(table: str, rules: QualityRules, as_of: datetime | None) -> Column:
    """Unreadable times are skipped (passed); no time at all is stale (failed)."""
    cutoff = clock(as_of) - F.make_dt_interval(hours=F.lit(rules.freshness_hours))
    latest, unparsed = F.col("_latest"), F.col("_unparsed")
    readable = unparsed == 0

    return _row(
        "freshness",
        table,
        ~readable | F.coalesce(latest >= cutoff, F.lit(False)),
        F.when(readable, F.format_string(FRESH_TEXT, _time_text(latest), _time_text(cutoff))).otherwise(
            F.format_string(BAD_TIME_TEXT, unparsed)
        ),
        latest_record=F.when(readable, latest),
        cutoff=F.when(readable, cutoff),
    )


def _time_text(moment: Column) -> Column:
    """Time with zone, and with microseconds if there are any."""
    fraction = F.date_format(moment, FRACTION_FORMAT)
    text = F.concat(
        F.date_format(moment, TIME_TEXT_FORMAT),
        F.when(fraction == ".000000", "").otherwise(fraction),
        F.date_format(moment, ZONE_FORMAT),
    )
    return F.coalesce(text, F.lit("NaT"))


def unreadable_table(spark: SparkSession, table: str, message: str) -> DataFrame:
    result = _row("read_table", table, F.lit(False), F.lit(message))
    return spark.range(1).select(F.inline(F.array(result)))


def all_results(*per_table: DataFrame) -> DataFrame:
    """Results of several tables in one frame."""
    first, *rest = per_table
    for results in rest:
        first = first.unionByName(results, allowMissingColumns=True)
    return first


def check_catalog(
    spark: SparkSession,
    tables: Sequence[str],
    database: str | None = None,
    rules: QualityRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    sample_rows: int | None = None,
) -> DataFrame:
    """Check catalog tables by name; a table that doesn't exist is a failed result."""
    frames = {}
    for table in tables:
        name = f"{database}.{table}" if database else table
        frames[table] = spark.table(name) if spark.catalog.tableExists(name) else None
    return check_frames(spark, frames, rules, as_of, sample_rows)


def check_frames(
    spark: SparkSession,
    frames: Mapping[str, DataFrame | None],
    rules: QualityRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    sample_rows: int | None = None,
) -> DataFrame:
    """Check named frames in one lazy query; None stands for a table that isn't there."""
    return all_results(
        *(
            unreadable_table(spark, table, NO_TABLE_TEXT % table)
            if df is None
            else check_table(df, table, rules, as_of, sample_rows)
            for table, df in frames.items()
        )
    )


def run_checks(
    spark: SparkSession,
    frames: Mapping[str, DataFrame | None],
    rules: QualityRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    sample_rows: int | None = None,
) -> DataFrame:
    """As :func:`check_frames`, but run now, table by table: a table that fails to read
    becomes a failed result and the others are still checked. Only the handful of result
    rows per table reaches the driver."""
    rows = []
    for table, df in frames.items():
        try:
            rows += check_frames(spark, {table: df}, rules, as_of, sample_rows).collect()
        except (PySparkException, Py4JJavaError) as error:
            text = str(error).splitlines()[0]
            rows += unreadable_table(spark, table, text).collect()
    return spark.createDataFrame(rows, CHECK_RESULT)


def of_run(results: DataFrame, run_id: str, as_of: datetime | None = None) -> DataFrame:
    """Results as rows of the history: with the run they belong to and its time."""
    return results.select(F.lit(run_id).alias("run_id"), clock(as_of).alias("checked_at"), "*")


def compare_runs(history: DataFrame) -> DataFrame:
    """Each result of each run beside the same check's result in the run before.

    ``change`` is first, same, mended or broken. ``advanced`` says for freshness whether there is any newer record than in the run
    before: a table may be fresh by its cutoff and yet stand still, or go back. A window's group is one check, a row per run.
    """
    before = Window.partitionBy("check", "table", "column").orderBy("checked_at", "run_id")
    earlier = F.lag("passed").over(before)
    change = (
        F.when(earlier.isNull(), "first").when(earlier == F.col("passed"), "same").when(F.col("passed"), "mended").otherwise("broken")
    )
    return history.withColumns(
        {
            "change": change,
            "previous_value": F.lag("value").over(before),
            "advanced": F.col("latest_record") > F.lag("latest_record").over(before),
        }
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row: did everything pass, how many checks passed, how many there were."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def failed_checks(results: DataFrame) -> DataFrame:
    """Failed results with their JSON form, for an alert."""
    return results.filter(~F.col("passed")).withColumn(
        "payload", F.to_json(F.struct(*results.columns))
    )


def require_quality(results: DataFrame) -> None:
    """The gate: raise :class:`QualityGateError` unless every check passed."""
    if not verdict(results).first()["quality_passed"]:
        failed = failed_checks(results).select("payload").collect()
        raise QualityGateError("[" + ", ".join(row["payload"] for row in failed) + "]")
