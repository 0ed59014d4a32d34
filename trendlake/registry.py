"""The registered queries: every operator over the shared test tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake import adapters, schemas
from trendlake.adapters import NEWEST_FIRST, SOURCE_ROW
from trendlake.functions.columns import flatten
from trendlake.functions.values import clean_region, trending_day
from trendlake.operators import categories, cleanse, dedup, documents, quality, ranking
from trendlake.operators.normalize import unify
from trendlake.plans import gold, reports
from trendlake.plans.run import Lake, run_lake
from trendlake.plans.silver import build_silver_reference, build_silver_statistics
from trendlake.schemas import COUNT_COLUMNS, INGESTED_AT, VIDEO_DAY_KEY
from trendlake.shared import materialize, new_folder
from trendlake.sinks.tables import land_raw, switch_table, write_partitions, write_table
from trendlake.sources.categories import LANDED_AT, POSITION, read_categories
from trendlake.sources.documents import FILE_TIME, SOURCE_FILE
from trendlake.sources.statistics import read_stats_csv, read_stats_json, read_video_documents
from trendlake.sources.tables import only_regions, optional_table, scan_table
from trendlake.streaming.incremental import (
    first_of_video_day,
    load_new_reference,
    load_new_statistics,
    run_batches,
    statistics_upsert,
)

Query = Callable[[SparkSession, str], DataFrame]

# Events cover every hour of a month; filed by day they make fewer, larger files.
FOLDERS = ("region", "date")
AS_OF = datetime(2024, 1, 31, 12, tzinfo=timezone.utc)
LATER = datetime(2024, 2, 15, tzinfo=timezone.utc)
DERIVED = ("trending_date_parsed", "like_ratio", "engagement_rate")
PRUNED_REGIONS = ("asia", "europe")
SAMPLE_ROWS = 20
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Inputs -------------------------------------------------------------------------------


def raw_rows(spark, sf):
    """Bulk rows with canonical types, before cleansing."""
    return unify(adapters.event_statistics(spark, sf), carry=NEWEST_FIRST)


def silver(spark, sf):
    return build_silver_statistics(
        adapters.event_statistics(spark, sf), as_of=AS_OF, newest_first=NEWEST_FIRST
    )


def stored_silver(spark, sf):
    """The cleansed table as reports find it: written once, then read by column."""
    return materialize(silver(spark, sf), "silver")


def facts(spark, sf):
    """The larger frame, cleansed. Rows of a part, region and day all count, so that reports
    see every row."""
    return cleanse.cleanse(unify(adapters.lineitem_statistics(spark, sf)))


def stored_facts(spark, sf):
    return materialize(facts(spark, sf).select(*gold.COLUMNS_READ), "facts")


def lookup(spark, sf):
    return adapters.nation_lookup(spark, sf)


def documents_of(spark, sf):
    """Enveloped API documents, dated by their event."""
    return documents.envelope(
        adapters.event_documents(spark, sf), "events", F.col(INGESTED_AT)
    ).drop(INGESTED_AT)


def one_of(column, *values):
    """A condition that is false, not NULL, for a NULL, so that it and its opposite split all rows."""
    return F.coalesce(F.col(column).isin(*values), F.lit(False))


def own_table(spark, label):
    """A name in the session's catalog that no other call uses."""
    return f"{label}_{new_folder(spark, label).rsplit('-', 1)[-1]}"


def part_files(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    try:
        return [row.path for row in files.load(path).select("path").collect()]
    except AnalysisException:
        return []


def set_age(spark, files, seconds):
    """Dates files back, through whatever file system they are in."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = int((time.time() - seconds) * 1000)
    for name in sorted(files):
        path = hadoop.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(path, at, -1)


def shown(df: DataFrame) -> DataFrame:
    """Without run times, and lists as text, to compare results."""
    lists = {"categories", "missing_columns"} & set(df.columns)
    kept = df.drop("_aggregated_at", "_processed_at", "_job_name", *NEWEST_FIRST)
    return kept.withColumns({name: F.array_join(name, "|") for name in lists})


# --- Silver -------------------------------------------------------------------------------


@query
def silver_statistics(spark, sf):
    return shown(silver(spark, sf))


@query
def normalize_two_formats(spark, sf):
    bulk, nested = adapters.event_statistics(spark, sf), adapters.event_videos(spark, sf)
    from_api = ("click", "view")
    return unify(
        bulk.filter(~one_of("title", *from_api)),
        nested.filter(one_of("snippet.title", *from_api)),
        carry=(SOURCE_ROW,),
    )


@query
def region_clean(spark, sf):
    people = adapters.customer_regions(spark, sf)
    padded = F.concat(F.lit("  "), F.initcap("r_name"), F.lit(" "))
    return people.select("c_custkey", clean_region(padded).alias("region"))


@query
def date_parse(spark, sf):
    events = adapters.table(spark, sf, "events")
    spellings = {
        "short_day": "yy.dd.MM",
        "iso_day": "yyyy-MM-dd",
        "swapped_day": "yy.MM.dd",
        "bad_day": "dd/MM/yyyy",
    }
    return events.select(
        "event_id",
        *(trending_day(F.date_format("ts", f)).alias(name) for name, f in spellings.items()),
    )


@query
def null_fill(spark, sf):
    return cleanse.fill_counts(raw_rows(spark, sf)).select(SOURCE_ROW, *COUNT_COLUMNS)


@query
def like_ratio(spark, sf):
    return cleanse.derive_ratios(raw_rows(spark, sf)).select(SOURCE_ROW, "like_ratio")


@query
def engagement_rate(spark, sf):
    return cleanse.cleanse(raw_rows(spark, sf)).select(SOURCE_ROW, "engagement_rate")


@query
def latest_per_key(spark, sf):
    """The last order of each customer and priority."""
    orders = adapters.table(spark, sf, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    )
    return dedup.latest_per_key(
        orders, ("o_custkey", "o_orderpriority"), ("o_orderdate", "o_orderkey")
    )


@query
def dedup_lookup(spark, sf):
    parts = adapters.table(spark, sf, "part")
    return categories.unique_names(
        parts.select(
            F.col("p_size").cast("bigint").alias("category_id"),
            F.col("p_name").alias("category_name"),
        )
    )


@query
def dedup_keep_last(spark, sf):
    """The last line of each order and part, by position in the order."""
    lines = adapters.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey", "l_linenumber")
    prices = lines.agg(F.max("l_extendedprice").alias("price"))
    return dedup.keep_last(prices, ("l_orderkey", "l_partkey"), "l_linenumber")


@query
def dedup_removed_count(spark, sf):
    rows = cleanse.cleanse(raw_rows(spark, sf))
    return dedup.removed_by_dedup(rows, VIDEO_DAY_KEY)


@query
def silver_warnings(spark, sf):
    """Before and after cleansing, side by side."""
    before = cleanse.row_warnings(raw_rows(spark, sf))
    after = cleanse.row_warnings(silver(spark, sf))
    return before.withColumn("stage", F.lit("before")).unionByName(
        after.withColumn("stage", F.lit("after"))
    )


# --- Categories and reports ---------------------------------------------------------------


@query
def enrich_category(spark, sf):
    rows = categories.enrich_category(raw_rows(spark, sf), lookup(spark, sf))
    return rows.select(SOURCE_ROW, "category_id", "category_name")


@query
def trending_analytics(spark, sf):
    return shown(gold.trending_analytics(stored_silver(spark, sf)))


@query
def channel_analytics(spark, sf):
    return shown(gold.channel_analytics(stored_silver(spark, sf), lookup(spark, sf)))


@query
def category_analytics(spark, sf):
    return shown(gold.category_analytics(silver(spark, sf), lookup(spark, sf)))


@query
def trending_analytics_facts(spark, sf):
    return shown(gold.trending_analytics(stored_facts(spark, sf)))


@query
def channel_analytics_facts(spark, sf):
    return shown(gold.channel_analytics(stored_facts(spark, sf), lookup(spark, sf)))


@query
def category_analytics_facts(spark, sf):
    return shown(gold.category_analytics(facts(spark, sf), lookup(spark, sf)))


@query
def channel_rank(spark, sf):
    """Customers of each region numbered by what they ordered."""
    people = adapters.customer_regions(spark, sf)
    spent = adapters.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total")
    )
    rows = people.join(spent, F.col("c_custkey") == F.col("o_custkey")).select(
        "r_name", "c_custkey", "total"
    )
    order = [F.col("total").desc(), F.col("c_custkey").asc()]
    return ranking.number_rows(rows, ["r_name"], order, "rank_in_region")


@query
def category_share(spark, sf):
    """Part types' share of quantity per return flag."""
    lines = adapters.table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_quantity")
    parts = adapters.table(spark, sf, "part").select("p_partkey", "p_type")
    totals = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_returnflag", "p_type")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )
    return ranking.share_of_group(totals, "quantity", ["l_returnflag"], "share_pct")


@query
def videos_per_region(spark, sf):
    return reports.videos_per_region(cleanse.cleanse(raw_rows(spark, sf)))


@query
def region_filter(spark, sf):
    return reports.region_videos(cleanse.cleanse(raw_rows(spark, sf)), "asia")


@query
def region_top_videos(spark, sf):
    return reports.top_videos(cleanse.cleanse(raw_rows(spark, sf)), "asia")


@query
def top_category_days(spark, sf):
    return reports.top_category_days(category_analytics(spark, sf))


@query
def top_categories(spark, sf):
    return reports.top_categories(category_analytics(spark, sf))


@query
def regions_by_days(spark, sf):
    return reports.regions_by_days(trending_analytics(spark, sf))


@query
def regions_by_videos(spark, sf):
    return reports.regions_by_videos(trending_analytics(spark, sf))


@query
def table_counts(spark, sf):
    tables = gold.build_gold(stored_silver(spark, sf), lookup(spark, sf)).tables()
    return reports.row_counts(tables)


@query
def report_sql(spark, sf):
    """The category report as SQL text on registered views."""
    reports.register_views({"category_analytics": category_analytics(spark, sf)})
    return spark.sql(
        "SELECT category_name, total_views, region FROM category_analytics"
        " ORDER BY total_views DESC, category_name, region LIMIT 10"
    )


# --- Quality ------------------------------------------------------------------------------


def checks_shown(df: DataFrame) -> DataFrame:
    times = {
        name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in ("latest_record", "cutoff")
    }
    return shown(df.withColumns(times))


def quality_frames(spark, sf):
    """A table that passes, one with gaps and odd values, the reference, and a missing one."""
    rows = raw_rows(spark, sf)
    odd = rows.withColumn("views", F.col("views") - 1000).drop("title")
    stamped = odd.withColumn("_processed_at", F.col(INGESTED_AT))
    named = lookup(spark, sf).select(
        F.col("category_id").cast("string").alias("id"),
        F.lower("category_name").alias("region"),
    )
    return {
        "clean_statistics": stamped,
        "clean_reference_data": named,
        "missing_table": optional_table(spark, "table_never_written"),
    }


def checks_of(spark, sf, *names: str):
    results = quality.check_frames(spark, quality_frames(spark, sf), as_of=AS_OF)
    return checks_shown(results.filter(F.col("check").isin(*names)) if names else results)


@query
def dq_row_count(spark, sf):
    return checks_of(spark, sf, "row_count").select("table", "value", "threshold", "passed", "message")


@query
def dq_null_pct(spark, sf):
    return checks_of(spark, sf, "null_pct").select(
        "table", "column", "value", "threshold", "passed", "message"
    )


@query
def dq_schema(spark, sf):
    return checks_of(spark, sf, "schema").select("table", "missing_columns", "passed", "message")


@query
def dq_value_range(spark, sf):
    return checks_of(spark, sf, "value_range").select(
        "table", "column", "negative_count", "extreme_count", "passed", "message"
    )


@query
def dq_freshness(spark, sf):
    """On time at one moment, stale two weeks later."""
    frames = quality_frames(spark, sf)
    late = quality.check_frames(spark, frames, as_of=LATER).filter("check = 'freshness'")
    return (
        checks_of(spark, sf, "freshness")
        .unionByName(checks_shown(late))
        .select("table", "latest_record", "cutoff", "passed", "message")
    )


@query
def dq_missing_table(spark, sf):
    return checks_of(spark, sf, "read_table", "row_count").select("check", "table", "passed", "message")


@query
def dq_results(spark, sf):
    return checks_of(spark, sf).select("check", "table", "column", "passed")


@query
def dq_verdict(spark, sf):
    return quality.verdict(quality.check_frames(spark, quality_frames(spark, sf), as_of=AS_OF))


@query
def dq_failed(spark, sf):
    """Run table by table, as before a gate."""
    results = quality.run_checks(spark, quality_frames(spark, sf), as_of=AS_OF)
    return quality.failed_checks(results).select(
        "check", "table", "message", F.get_json_object("payload", "$.check").alias("in_payload")
    )


@query
def dq_history(spark, sf):
    """Results of two runs, two weeks apart, appended to a stored history and compared."""
    path = new_folder(spark, "quality-history")
    for run_id, moment in (("first", AS_OF), ("second", LATER)):
        results = quality.run_checks(spark, quality_frames(spark, sf), as_of=moment)
        quality.of_run(results, run_id, moment).write.mode("append").parquet(path)
    compared = quality.compare_runs(spark.read.parquet(path))
    return compared.select("run_id", "check", "table", "column", "passed", "change", "previous_value", "advanced")


@query
def dq_sampled(spark, sf):
    """Checks of a bounded sample: as many rows as it has, and never more than the table."""
    frames = quality_frames(spark, sf)
    sampled = quality.check_frames(spark, frames, as_of=AS_OF, sample_rows=SAMPLE_ROWS)
    return sampled.filter("check = 'row_count'").select("table", "value", "threshold", "passed", "message")


# --- Raw documents and tables on files ------------------------------------------------------


def reference_items(spark, sf):
    return (
        adapters.supplier_categories(spark, sf)
        .select("region", SOURCE_FILE, F.col(FILE_TIME).alias(LANDED_AT), F.posexplode("items").alias(POSITION, "item"))
        .select("item.*", "region", SOURCE_FILE, LANDED_AT, POSITION)
    )


@query
def flatten_reference(spark, sf):
    return flatten(reference_items(spark, sf)).drop(LANDED_AT).withColumn(
        POSITION, F.col(POSITION).cast("bigint")
    )


@query
def silver_reference(spark, sf):
    return build_silver_reference(reference_items(spark, sf), AS_OF).drop("_ingestion_timestamp", LANDED_AT)


@query
def reference_metadata(spark, sf):
    """Category documents landed as files and read back, with the region of their path."""
    path = new_folder(spark, "reference")
    docs = adapters.supplier_categories(spark, sf).withColumn("region", F.trim("region"))
    named = documents.envelope(docs, "supplier", F.col(FILE_TIME), count_items=False)
    land_raw(named.drop(FILE_TIME, SOURCE_FILE), path, FOLDERS)
    read = read_categories(spark, path)
    last = dedup.keep_last(read, (SOURCE_FILE, "id"), POSITION)
    return flatten(last).select("id", "snippet_title", "snippet_assignable", "region")


@query
def envelope(spark, sf):
    return documents_of(spark, sf).select(
        "region",
        F.col("_pipeline_metadata.ingestion_id").alias("ingestion_id"),
        F.col("_pipeline_metadata.ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("_pipeline_metadata.video_count").alias("video_count"),
        F.col("_pipeline_metadata.source").alias("source"),
    )


@query
def region_parameter(spark, sf):
    """Region lists as text, split and cleaned."""
    regions = adapters.nation_regions(spark, sf)
    listed = F.concat_ws(" , ", "r_name", "nation", F.lit(" Us"))
    return regions.select("nation", F.explode(documents.region_list(listed)).alias("region"))


@query
def ingest_summary(spark, sf):
    """Regions of the region table, of which none is landed for one that has no events."""
    docs = documents_of(spark, sf)
    expected = adapters.table(spark, sf, "region").select(F.lower("r_name").alias("region"))
    extra = adapters.table(spark, sf, "nation").select(F.lower("n_name").alias("region"))
    return documents.ingest_summary(docs, expected.unionByName(extra))


@query
def file_summary(spark, sf):
    docs = adapters.supplier_categories(spark, sf).withColumn("region", F.trim("region"))
    return documents.file_summary(docs)


@query
def region_outcomes(spark, sf):
    """Videos of regions and, for want of any, of nations; categories of regions only."""
    return documents.region_outcomes(ingest_summary(spark, sf), file_summary(spark, sf))


@query
def partition_pruned_scan(spark, sf):
    name = own_table(spark, "pruned")
    write_table(silver(spark, sf), name, path=new_folder(spark, "pruned"))
    stored = scan_table(spark, name, (" ASIA", "europe"))
    return stored.select("region", "video_id", "trending_date_parsed", "views")


@query
def partition_overwrite_roundtrip(spark, sf):
    """Write all regions, then replace two of them by rows with doubled views."""
    path = new_folder(spark, "overwritten")
    rows = silver(spark, sf).select(*VIDEO_DAY_KEY, "views")
    write_partitions(rows, path)
    doubled = only_regions(rows, PRUNED_REGIONS).withColumn("views", F.col("views") * 2)
    write_partitions(doubled, path)
    return spark.read.parquet(path)


@query
def table_gains_columns(spark, sf):
    """A catalog table written twice, the second time with a column more, read by name in SQL."""
    name = own_table(spark, "evolved")
    rows = silver(spark, sf).select(*VIDEO_DAY_KEY, "views")
    write_table(rows, name, path=new_folder(spark, "evolved"))
    more = only_regions(rows, PRUNED_REGIONS).withColumn("doubled", F.col("views") * 2)
    write_table(more, name)
    return spark.sql(f"SELECT video_id, region, trending_date_parsed, views, doubled FROM {name}")


@query
def bulk_csv_roundtrip(spark, sf):
    """Bulk CSV with quotes, commas and line breaks inside of texts, read back as text."""
    path = new_folder(spark, "bulk")
    odd = F.concat("description", F.lit('\n"said", he'))
    rows = adapters.event_statistics(spark, sf).withColumns(
        {"description": odd, "region": F.trim("region"), "video_id": F.col(SOURCE_ROW).cast("string")}
    )
    columns = [name for name in schemas.STATISTICS if name != "region"]
    rows.select(*columns, "region").write.partitionBy("region").option("header", True).option(
        "escape", '"'
    ).csv(path)
    return read_stats_csv(spark, path).select("video_id", "title", "views", "likes", "description", "region")


@query
def silver_audit(spark, sf):
    return silver(spark, sf).select(*VIDEO_DAY_KEY, "_processed_at", "_job_name")


@query
def gold_audit(spark, sf):
    table = gold.trending_analytics(stored_silver(spark, sf), AS_OF)
    return table.select("region", "trending_date_parsed", "total_videos", "_aggregated_at")


@query
def category_documents_without_items(spark, sf):
    """Documents that are themselves one category, beside lists, in files of foreign names."""
    path = new_folder(spark, "single-categories")
    nations = adapters.nation_documents(spark, sf)
    single = nations.select("region", "kind", F.col("items")[0]["id"].alias("id"), F.col("items")[0]["snippet"].alias("snippet"))
    for df in (single.filter("region < 'i'"), nations.filter("region >= 'i'")):
        df.write.mode("append").partitionBy("region").json(path)
    return flatten(read_categories(spark, path)).select("id", "snippet_title", "region")

@query
def raw_landing_roundtrip(spark, sf):
    """Documents landed per region and day, read back as canonical rows."""
    path = new_folder(spark, "landed")
    land_raw(documents_of(spark, sf), path, FOLDERS)
    return unify(read_stats_json(spark, path, FOLDERS), carry=())


@query
def landed_summary(spark, sf):
    path = new_folder(spark, "landed")
    land_raw(documents_of(spark, sf), path, FOLDERS)
    expected = adapters.table(spark, sf, "region").select(F.lower("r_name").alias("region"))
    return documents.ingest_summary(read_video_documents(spark, path, FOLDERS), expected)


# --- Incremental ----------------------------------------------------------------------------


@query
def incremental_available_now(spark, sf):
    """Landed documents taken in by a file stream in two runs, the newer half first; the files of the
    other half, with times of two months before, all count. A third run finds nothing new."""
    path = new_folder(spark, "incremental")
    newer = F.to_timestamp("_pipeline_metadata.ingestion_timestamp") >= "2024-01-16"
    docs = documents_of(spark, sf)
    for part in (docs.filter(newer), docs.filter(~newer), None):
        if part is not None:
            before = set(part_files(spark, f"{path}/raw"))
            land_raw(part, f"{path}/raw", FOLDERS)
            if before:
                set_age(spark, set(part_files(spark, f"{path}/raw")) - before, 60 * 86_400)
        load_new_statistics(
            spark,
            f"{path}/raw",
            f"{path}/clean",
            f"{path}/progress",
            as_of=AS_OF,
            bulk=False,
            folders=FOLDERS,
        )
    return shown(spark.read.schema(schemas.CLEAN_STATISTICS).parquet(f"{path}/clean"))


@query
def incremental_bulk(spark, sf):
    """Bulk CSV taken in by a file stream in two runs: all days with doubled views, then two regions again, compressed."""
    path = new_folder(spark, "incremental-bulk")
    rows = silver(spark, sf).select(*schemas.STATISTICS)
    again = only_regions(rows, PRUNED_REGIONS)
    for part, packed in ((rows.withColumn("views", F.col("views") * 2), "none"), (again, "gzip")):
        part.select([F.col(name).cast("string") for name in schemas.STATISTICS]).write.mode("append").partitionBy(
            "region"
        ).options(header=True, escape='"', compression=packed).csv(f"{path}/raw")
        load_new_statistics(spark, f"{path}/raw", f"{path}/clean", f"{path}/progress", as_of=AS_OF, folders=FOLDERS)
    stored = spark.read.schema(schemas.CLEAN_STATISTICS).parquet(f"{path}/clean")
    return stored.select(*VIDEO_DAY_KEY, "title", "views", "likes", "like_ratio")


@query
def first_of_day_stream(spark, sf):
    """First rows of video-days passed on by a stream in two runs with one state: the second brings all rows once more, of which
    those before the first run's watermark are late and those of known video-days duplicates."""
    path = new_folder(spark, "first-of-day")
    rows = facts_of_events(spark, sf)
    clicks = one_of("title", "click")
    for part in (rows.filter(clicks), rows):
        part.write.mode("append").parquet(f"{path}/raw")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/raw")
        first = first_of_video_day(stream).select(*VIDEO_DAY_KEY)
        written = first.writeStream.format("parquet").option("checkpointLocation", f"{path}/progress")
        written.trigger(availableNow=True).start(f"{path}/passed-on").awaitTermination()
    return spark.read.parquet(f"{path}/passed-on")


def facts_of_events(spark, sf):
    """Cleansed rows of ``events`` with their time, before one per video-day is chosen."""
    return cleanse.cleanse(raw_rows(spark, sf)).select(*VIDEO_DAY_KEY, "title", INGESTED_AT)


@query
def upsert_latest(spark, sf):
    """A stream that brings newer rows before older ones still ends with the newest."""
    path = new_folder(spark, "upsert")
    rows = adapters.event_statistics(spark, sf)
    late = one_of("title", "click", "view")
    for part, condition in (("first", ~late), ("second", late)):
        rows.filter(condition).write.parquet(f"{path}/raw/{part}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/raw/{part}")
        progress = f"{path}/progress/{part}"
        handle = statistics_upsert(
            f"{path}/clean", progress, as_of=AS_OF, newest_first=NEWEST_FIRST
        )
        run_batches(stream, handle, progress)
    return shown(spark.read.parquet(f"{path}/clean"))


@query
def reference_stream(spark, sf):
    """Category documents taken in by a file stream in two runs, the older ones last."""
    path = new_folder(spark, "reference-stream")
    docs = adapters.supplier_categories(spark, sf).withColumn("region", F.trim("region"))
    named = documents.envelope(docs, "supplier", F.col(FILE_TIME), count_items=False)
    recent = F.col(FILE_TIME) >= F.timestamp_seconds(F.lit(adapters.FIRST_FILE_SECOND + 12 * 86_400))
    for part in (named.filter(recent), named.filter(~recent)):
        land_raw(part.drop(FILE_TIME, SOURCE_FILE).coalesce(1), f"{path}/raw", FOLDERS)
        load_new_reference(spark, f"{path}/raw", f"{path}/clean", f"{path}/progress", as_of=AS_OF)
    stored = spark.read.schema(schemas.CLEAN_REFERENCE).parquet(f"{path}/clean")
    return stored.drop("_ingestion_timestamp", LANDED_AT, SOURCE_FILE)


@query
def reference_gains_fields(spark, sf):
    """The same with newer files whose items have fields that the schema doesn't name."""
    path = new_folder(spark, "reference-fields")
    docs = adapters.supplier_categories(spark, sf).withColumn("region", F.trim("region"))
    named = documents.envelope(docs, "supplier", F.col(FILE_TIME), count_items=False)
    recent = F.col(FILE_TIME) >= F.timestamp_seconds(F.lit(adapters.FIRST_FILE_SECOND + 21 * 86_400))

    def with_fields(item):
        about = item["snippet"].withField("description", F.concat(F.lit("about "), item["snippet"]["title"]))
        return item.withField("snippet", about).withField("position", F.length(item["id"])).withField(
            "localized", F.struct(F.upper(item["snippet"]["title"]).alias("title"))
        )

    more = named.filter(recent).withColumn("items", F.transform("items", with_fields))
    for part in (named.filter(~recent), more):
        land_raw(part.drop(FILE_TIME, SOURCE_FILE).coalesce(1), f"{path}/raw", FOLDERS)
        load_new_reference(spark, f"{path}/raw", f"{path}/clean", f"{path}/progress", as_of=AS_OF)
    stored = spark.read.option("mergeSchema", True).parquet(f"{path}/clean")
    return stored.select("id", "region", "snippet_title", "snippet_description", "position", "localized_title")


@query
def gold_rebuilt_with_less(spark, sf):
    """The whole run twice; before the second one, the raw documents of a region are taken away."""
    lake = Lake(new_folder(spark, "rebuilt"), FOLDERS)
    names = documents.envelope(
        adapters.nation_documents(spark, sf), "nation", AS_OF, count_items=False
    )
    docs = documents_of(spark, sf)
    run_lake(spark, lake, documents=[docs], category_documents=[names], as_of=AS_OF)
    land_raw(docs.filter("region <> 'asia'"), lake.raw_statistics, FOLDERS, mode="overwrite")
    run_lake(spark, lake, as_of=AS_OF)
    return shown(spark.read.parquet(lake.path("category_analytics")))


def gold_rows(spark, lake):
    """Rows of all three report tables in one shape."""

    def part(table, day, key, *values):
        df = spark.read.parquet(lake.path(table))
        names = ("rows", "total_views", "distinct_count", "mean", "place")
        return df.select(
            F.lit(table).alias("table_name"), "region", day.alias("day"), key.alias("key"),
            *(value.alias(name) for name, value in zip(names, values, strict=True)),
        )

    trending = part(
        "trending_analytics", F.col("trending_date_parsed"), F.col("unique_categories").cast("string"),
        F.col("total_videos"), F.col("total_views"), F.col("unique_channels"), F.col("avg_like_ratio"), F.lit(None).cast("double"),
    )
    channel = part(
        "channel_analytics", F.col("first_trending"), F.concat_ws(":", "channel_title", F.concat_ws("|", "categories")),
        F.col("times_trending"), F.col("total_views"), F.col("total_videos"), F.col("avg_engagement_rate"),
        F.col("rank_in_region").cast("double"),
    )
    category = part(
        "category_analytics", F.col("trending_date_parsed"), F.col("category_name"),
        F.col("video_count"), F.col("total_views"), F.col("unique_channels"), F.col("avg_engagement_rate"), F.col("view_share_pct"),
    )
    return trending.union(channel).union(category)


def lake_with_names(spark, sf, label):
    """A lake with category documents landed, and the event documents to land."""
    lake = Lake(new_folder(spark, label), FOLDERS)
    names = documents.envelope(adapters.nation_documents(spark, sf), "nation", AS_OF, count_items=False)
    land_raw(names, lake.raw_reference, partition_by=("region", "date"))
    return lake, documents_of(spark, sf)


@query
def gold_incremental(spark, sf):
    """Two incremental runs: the second builds the days of its own documents only, which are older, and the channels in them."""
    lake, docs = lake_with_names(spark, sf, "maintained")
    newer = F.to_timestamp("_pipeline_metadata.ingestion_timestamp") >= "2024-01-21"
    for part in (docs.filter(newer), docs.filter(~newer)):
        run_lake(spark, lake, documents=[part], checkpoint=lake.path("progress"), as_of=AS_OF)
    return gold_rows(spark, lake)


@query
def run_counts(spark, sf):
    """What a run counts while it writes: the documents of a region landed twice, those of another once more without ids."""
    lake, docs = lake_with_names(spark, sf, "counted")
    nameless = F.transform("items", lambda item: item.withField("id", F.lit(None).cast("string")))
    twice, broken = docs.filter("region = 'asia'"), docs.filter("region = 'africa'").withColumn("items", nameless)
    return run_lake(spark, lake, documents=[docs, twice, broken], as_of=AS_OF).counts


@query
def run_counts_incremental(spark, sf):
    """The counts of the second of two incremental runs, in which all documents of a region come again."""
    lake, docs = lake_with_names(spark, sf, "counted-batches")
    for part in (docs, docs.filter("region = 'asia'")):
        report = run_lake(spark, lake, documents=[part], checkpoint=lake.path("progress"), as_of=AS_OF)
    return report.counts


@query
def partial_rebuild(spark, sf):
    """A rebuild of one region from raw files that hold a part of their documents: other regions stay as they were."""
    lake, docs = lake_with_names(spark, sf, "partial")
    run_lake(spark, lake, documents=[docs], as_of=AS_OF)
    fewer = docs.filter(F.to_timestamp("_pipeline_metadata.ingestion_timestamp") >= "2024-01-16")
    land_raw(fewer, lake.raw_statistics, FOLDERS, mode="overwrite")
    run_lake(spark, lake, only_from=["asia"], as_of=AS_OF)
    return shown(spark.read.parquet(lake.path("category_analytics")))


@query
def table_switched(spark, sf):
    """A catalog table replaced as a whole by fewer partitions, read by name, beside what it held before."""
    name = own_table(spark, "switched")
    rows = silver(spark, sf).select(*VIDEO_DAY_KEY, "views")
    write_table(rows, name, path=f"{new_folder(spark, 'switched')}/first")
    switch_table(only_regions(rows, PRUNED_REGIONS).withColumn("views", F.col("views") * 3), name)
    return spark.sql(
        f"SELECT 'now' AS state, region, count(*) AS row_count, sum(views) AS views FROM {name} GROUP BY region"
        f" UNION ALL SELECT 'before', region, count(*), sum(views) FROM {name}__before GROUP BY region"
    )


@query
def gold_after_gate(spark, sf):
    """The whole run on files: landing, both silver tables, checks, gate, reports."""
    lake = Lake(new_folder(spark, "lake"), FOLDERS)
    names = documents.envelope(
        adapters.nation_documents(spark, sf), "nation", AS_OF, count_items=False
    )
    run_lake(
        spark,
        lake,
        documents=[documents_of(spark, sf)],
        category_documents=[names],
        as_of=AS_OF,
    )
    return shown(spark.read.parquet(lake.path("category_analytics")))
