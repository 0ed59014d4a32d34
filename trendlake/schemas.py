"""Fixed values and explicit schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, formats and limits that results depend on ---------------------

# Canonical statistics columns, in table order.
STATISTICS = {
    "video_id": "string",
    "trending_date": "string",
    "title": "string",
    "channel_title": "string",
    "category_id": "bigint",
    "publish_time": "string",
    "tags": "string",
    "views": "bigint",
    "likes": "bigint",
    "dislikes": "bigint",
    "comment_count": "bigint",
    "thumbnail_link": "string",
    "comments_disabled": "boolean",
    "ratings_disabled": "boolean",
    "video_error_or_removed": "boolean",
    "description": "string",
    "region": "string",
}

# Where each canonical column sits in an API video object. The run date and the three
# flags have no source there.
API_PATHS = {
    "video_id": "id",
    "title": "snippet.title",
    "channel_title": "snippet.channelTitle",
    "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt",
    "tags": "snippet.tags",
    "views": "statistics.viewCount",
    "likes": "statistics.likeCount",
    "dislikes": "statistics.dislikeCount",
    "comment_count": "statistics.commentCount",
    "thumbnail_link": "snippet.thumbnails.default.url",
    "description": "snippet.description",
    "region": "region",
}
API_DEFAULTS = {
    "dislikes": 0,
    "comments_disabled": False,
    "ratings_disabled": False,
    "video_error_or_removed": False,
}

COUNT_COLUMNS = ("views", "likes", "dislikes", "comment_count")
VIDEO_DAY_KEY = ("video_id", "region", "trending_date_parsed")
UNKNOWN_CATEGORY = "Unknown"
UNKNOWN_REGION = "unknown"
REGIONS = ("us", "gb", "ca", "de", "fr", "in", "jp", "kr", "mx", "ru")

RATIO_DIGITS = 4
SHARE_DIGITS = 2

RUN_DATE_FORMAT = "yy.dd.MM"
INGESTION_ID_FORMAT = "yyyyMMdd_HHmmss"

MIN_ROWS = 10
MAX_NULL_PCT = 5.0
MAX_VIEWS = 50_000_000_000
FRESHNESS_HOURS = 48
CRITICAL_COLUMNS = {
    "clean_statistics": ("video_id", "title", "channel_title", "views", "region"),
    "clean_reference_data": ("id", "region"),
}
WARNING_COLUMNS = ("video_id", "title", "channel_title", "views")

# --- Schemas ------------------------------------------------------------------------------

INGESTED_AT = "_ingested_at"  # what "latest" goes by; carried next to the canonical columns
CORRUPT = "_corrupt_record"

TEXT, LONG, FLAG = T.StringType(), T.LongType(), T.BooleanType()
DAY, TIME, DOUBLE = T.DateType(), T.TimestampType(), T.DoubleType()
_BY_NAME = {"string": TEXT, "bigint": LONG, "boolean": FLAG}


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, TEXT)


# Bulk files are read as text and cast afterwards, so a bad number is a NULL, not a lost row.
BULK_CSV = struct(**texts(*(name for name in STATISTICS if name != "region")))

CLEAN_STATISTICS = struct(
    **{name: _BY_NAME[kind] for name, kind in STATISTICS.items()},
    _ingested_at=TIME,
    trending_date_parsed=DAY,
    like_ratio=DOUBLE,
    engagement_rate=DOUBLE,
    _processed_at=TIME,
    _job_name=TEXT,
)

_VIDEO = struct(
    id=TEXT,
    snippet=struct(
        **texts("title", "channelTitle", "categoryId", "publishedAt"),
        tags=T.ArrayType(TEXT),
        description=TEXT,
        thumbnails=struct(default=struct(url=TEXT)),
    ),
    statistics=struct(**texts("viewCount", "likeCount", "dislikeCount", "commentCount")),
)
_ENVELOPE = struct(
    **texts("ingestion_id", "region", "ingestion_timestamp"), video_count=LONG, source=TEXT
)
VIDEO_DOCUMENT = struct(
    items=T.ArrayType(_VIDEO), _pipeline_metadata=_ENVELOPE, _corrupt_record=TEXT
)

_CATEGORY_SNIPPET = struct(**texts("channelId", "title"), assignable=FLAG)
_CATEGORY = struct(**texts("kind", "etag", "id"), snippet=_CATEGORY_SNIPPET)
# A document without an `items` list is itself one category, hence id and snippet on top.
CATEGORY_DOCUMENT = struct(
    **texts("kind", "etag"),
    items=T.ArrayType(_CATEGORY),
    id=TEXT,
    snippet=_CATEGORY_SNIPPET,
    _pipeline_metadata=_ENVELOPE,
    _corrupt_record=TEXT,
)

CLEAN_REFERENCE = struct(
    **texts("kind", "etag", "id", "snippet_channelId", "snippet_title"),
    snippet_assignable=FLAG,
    region=TEXT,
    _source_file=TEXT,
    _landed_at=TIME,
    _ingestion_timestamp=TIME,
)

REGION_PARTITION = struct(region=TEXT)
LANDING_PARTITIONS = struct(region=TEXT, date=DAY, hour=TEXT)

#: What a run counts while it writes silver, see operators.counts.
RUN_COUNTS = T.StructType(
    [
        T.StructField(name, LONG)
        for name in (
            "loads",
            "rows_read",
            "rows_dropped",
            "rows_deduplicated",
            "rows_written",
            *(f"read_null_{name}" for name in WARNING_COLUMNS),
            *(f"written_null_{name}" for name in WARNING_COLUMNS),
            "written_negative_views",
        )
    ]
)

CHECK_RESULT = struct(
    **texts("check", "table", "column"),
    value=DOUBLE,
    threshold=DOUBLE,
    negative_count=LONG,
    extreme_count=LONG,
    missing_columns=T.ArrayType(TEXT),
    latest_record=TIME,
    cutoff=TIME,
    passed=FLAG,
    message=TEXT,
)

# The kinds of raw statistics files, each with progress of its own.
RAW_KINDS = ("documents", "bulk")
