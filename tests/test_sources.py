from __future__ import annotations

import bz2
import gzip
import json
import re
from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.files import (
    HEADER,
    category,
    csv_line,
    put,
    put_categories,
    put_csv,
    put_document,
    video,
)
from trendlake import schemas
from trendlake.operators.documents import (
    envelope,
    expected_regions,
    file_summary,
    ingest_summary,
    parse_regions,
    region_outcomes,
)
from trendlake.operators.normalize import unify
from trendlake.plans.silver import build_silver_reference
from trendlake.sinks.tables import land_raw
from trendlake.sources.categories import read_categories, read_category_documents
from trendlake.sources.documents import TASKS_PER_CORE, misplaced_files, parse, parse_framed, trimmed, unreadable
from trendlake.sources.statistics import (
    read_document_sizes,
    read_stats_csv,
    read_stats_json,
    read_video_documents,
    silver_columns,
    video_rows,
)
from trendlake.sources.tables import only_regions, optional_table, sample_table, scan_table


def test_csv_keeps_quoted_text_and_bad_numbers(spark, tmp_path):
    put_csv(
        tmp_path,
        "us",
        csv_line("v1", title='say ""hi"", you', description="line one\nline two"),
        csv_line("v2", views="abc", category="x"),
    )
    got = unify(read_stats_csv(spark, str(tmp_path)))
    assert rows(got, "video_id", "title", "description", "views", "category_id", "region") == [
        ("v1", 'say "hi", you', "line one\nline two", 100, 10, "us"),
        ("v2", "t", "d", None, None, "us"),
    ]
    assert rows(got, "comments_disabled", "ratings_disabled") == [(False, True)] * 2


def test_csv_and_documents_share_a_folder(spark, tmp_path):
    put_csv(tmp_path, "us", csv_line("v1"))
    put_document(tmp_path, "us", video("v2"), video("v3"))
    root = str(tmp_path)
    both = unify(read_stats_csv(spark, root), read_stats_json(spark, root))
    assert rows(both, "video_id", "trending_date", "tags", "views", "dislikes") == [
        ("v1", "17.14.11", "a|b", 100, 1),
        ("v2", "24.01.03", "a|b", 100, None),
        ("v3", "24.01.03", "a|b", 100, None),
    ]


def test_region_filter_skips_folders(spark, tmp_path, plan):
    put_csv(tmp_path, "us", csv_line("v1"))
    put_csv(tmp_path, "GB", csv_line("v2"))
    put_csv(tmp_path, "gb", csv_line("v3"))
    got = only_regions(read_stats_csv(spark, str(tmp_path)), [" Gb"])
    assert rows(got, "video_id") == [("v2",), ("v3",)]
    assert re.search(r"PartitionFilters: \[[^\]]*lower\(trim\(region", plan(got))


def test_files_of_any_name_and_form(spark, tmp_path):
    """Lines and single documents under foreign names, compressed or not: all are read."""
    one = json.dumps({"items": [video("v1")]})
    lines = "\n".join(json.dumps({"items": [video(f"l{i}")]}) for i in range(5))
    folder = tmp_path / "region=us" / "date=2024-03-01" / "hour=09"
    put(folder / "batch.json", lines + "\n")
    put(folder / "part-7.json", json.dumps({"items": [video("v2")]}, indent=2))
    put(folder / "list.jsonl", f"[{one},\n{one}]")
    put(folder / "empty.json", "")
    put(folder / "bad.json", "{not json")
    (folder / "part-1.json.gz").write_bytes(gzip.compress(lines.encode()))
    docs = read_video_documents(spark, str(tmp_path))
    found = Counter(r.id for r in video_rows(docs).select("id").collect() if r.id)
    assert found == {"v1": 2, "v2": 1, **{f"l{i}": 2 for i in range(5)}}
    assert docs.filter(unreadable(docs)).count() == 1  # an empty file holds no document


def test_a_bad_line_costs_that_line_only(spark, tmp_path):
    lines = [json.dumps({"items": [video(f"l{i}")]}) for i in range(4)]
    files = {
        "us": "\n".join([*lines, lines[0][:40]]),
        "gb": "\r\n".join([lines[0], "INFO a log line", *lines[1:], f"[{lines[0]}]"]),
        "fr": "\n".join(["INFO a log line", *lines]),
        "de": lines[0] + " and more",
        "ca": json.dumps({"items": [video("v")]}, indent=2) + "\n}",
        "in": json.dumps({"items": [video("v")]}, indent=2),
    }
    for region, text in files.items():
        put(tmp_path / f"region={region}/date=2024-03-01/hour=09/x.json", text)
    expected = expected_regions(spark, list(files))
    assert rows(ingest_summary(read_video_documents(spark, str(tmp_path)), expected)) == [
        ("ca", 1, 0, 1, "failed"),
        ("de", 1, 0, 1, "failed"),
        ("fr", 5, 4, 1, "failed"),
        ("gb", 6, 5, 1, "failed"),
        ("in", 1, 1, 0, "success"),
        ("us", 5, 4, 1, "failed"),
    ]


def test_declared_lines_are_split(spark, tmp_path):
    lines = "\n".join(json.dumps({"items": [video(f"l{i}")]}) for i in range(500))
    put(tmp_path / "region=us" / "date=2024-03-01" / "hour=09" / "x.json", lines)
    docs = read_video_documents(spark, str(tmp_path), layout="lines")
    assert docs.count() == 500


def test_misplaced_files(spark, tmp_path):
    put(tmp_path / "region=us" / "date=2024-03-01" / "hour=09" / "x.json", "{}")
    put(tmp_path / "region=us" / "date=2024-03-01" / "y.json", "{}")
    found = [r.file for r in misplaced_files(spark, str(tmp_path), ("region", "date", "hour")).collect()]
    assert len(found) == 1 and found[0].endswith("date=2024-03-01/y.json")


def test_bulk_files_of_other_extensions_are_read_and_the_rest_reported(spark, tmp_path):
    text = "\n".join([HEADER, csv_line("v1")]) + "\n"
    for region, name in (("us", "a.csv"), ("gb", "a.CSV"), ("ca", "a.Csv")):
        put(tmp_path / f"region={region}" / name, text)
    for region, name, pack in (("de", "a.csv.gz", gzip), ("fr", "a.csv.bz2", bz2)):
        path = tmp_path / f"region={region}" / name
        path.parent.mkdir()
        path.write_bytes(pack.compress(text.encode()))
    unread = ["region=jp/date=2024-03-01/a.csv", "a.csv", "region=kr/notes.txt", "region=mx/a.csv.zip"]
    for name in unread:
        put(tmp_path / name, text)
    put(tmp_path / "region=us/date=2024-03-01/hour=09/x.JSON", '{"items": []}')
    read = read_stats_csv(spark, str(tmp_path))
    assert rows(read, "region", "video_id") == [(r, "v1") for r in ("ca", "de", "fr", "gb", "us")]
    found = misplaced_files(spark, str(tmp_path), ("region", "date", "hour")).collect()
    assert sorted(r.file.split(f"{tmp_path.name}/")[1] for r in found) == sorted(unread)
    assert read_video_documents(spark, str(tmp_path)).count() == 1


def test_hour_stays_text(spark, tmp_path):
    put_document(tmp_path, "us", video("v1"))
    docs = read_video_documents(spark, str(tmp_path))
    assert rows(docs, "region", "date", "hour") == [("us", date(2024, 3, 1), "09")]


def test_landed_lines_beside_single_documents(spark, tmp_path, noon):
    put_document(tmp_path, "us", video("v1"))
    docs = read_video_documents(spark, str(tmp_path)).drop("_pipeline_metadata")
    many = docs.select("region", "items").unionByName(
        docs.select("region", F.transform("items", lambda v: v.withField("id", F.lit("v2"))).alias("items"))
    )
    landed = tmp_path / "landed"
    land_raw(envelope(many.coalesce(1), "test", noon), str(landed))
    put_document(landed, "us", video("v3"), at="2024-03-01T12:00:00+00:00")
    assert rows(read_stats_json(spark, str(landed)), "id") == [("v1",), ("v2",), ("v3",)]
    assert rows(read_video_documents(spark, str(landed)), "_pipeline_metadata.ingestion_id") == [
        ("20240301_120000",), ("20240301_120000",), ("pull",)
    ]


def test_ingest_summary_reports_each_region(spark, tmp_path):
    put_document(tmp_path, "us", video("v1"), video("v2"))
    put_document(tmp_path, "gb")
    put(tmp_path / "region=fr/date=2024-03-01/hour=09/bad.json", '{"items": [')
    expected = expected_regions(spark, parse_regions(" US,gb , fr,de"))
    got = ingest_summary(read_video_documents(spark, str(tmp_path)), expected)
    assert rows(got) == [
        ("de", 0, 0, 0, "failed"),
        ("fr", 1, 0, 1, "failed"),
        ("gb", 1, 0, 0, "success"),
        ("us", 1, 2, 0, "success"),
    ]
    assert parse_regions(None)[0] == "us" and len(parse_regions(None)) == 10


def test_categories_of_all_kinds_of_file(spark, tmp_path, noon):
    put_categories(
        tmp_path, "US", category("1", "old"), category("2", "b"), category("1", "new"), newline="\r\n"
    )
    put(tmp_path / "loose file.json", '{"kind": "k", "etag": "e", "id": "7", "snippet": {"title": "alone"}}')
    put_categories(tmp_path, "gb")
    put(tmp_path / "region=fr/broken.json", '{"items": [')
    root = str(tmp_path)
    table = build_silver_reference(read_categories(spark, root), noon)
    assert rows(table, "region", "id", "snippet_title", "snippet_assignable") == [
        ("unknown", "7", "alone", None),
        ("us", "1", "new", True),
        ("us", "2", "b", True),
    ]
    assert set(table.columns) == {
        "kind", "etag", "id", "snippet_channelId", "snippet_title", "snippet_assignable",
        "region", "_source_file", "_landed_at", "_ingestion_timestamp",
    }
    summary = file_summary(read_category_documents(spark, root))
    assert rows(summary, "region", "rows", "error") == [
        ("US", 2, None),
        ("fr", 0, "unreadable document"),
        ("gb", 0, "no category items"),
        ("unknown", 1, None),
    ]


def test_fields_that_the_schema_does_not_name(spark, tmp_path, noon):
    first = category("1", "a")
    first["snippet"] |= {"description": "d", "Title": "other case", "lists": [1, {"x": 2}]}
    first |= {"localized": {"odd `name`": 5}, "snippet_title": "clash", "region": "clash", "empty": {}, "kept": 1, "items": 3}
    second = category("2", "b") | {"kept": "text"}
    put_categories(tmp_path, "us", first, second)
    put_categories(tmp_path, "gb", category("3", "c"))
    put_categories(tmp_path, "jp", category("4", "d"), "not an item", 5)
    put(tmp_path / "alone.json", '{"id": "7", "snippet": {"title": "alone", "description": "x", "channel": {"n": 1}}}')
    put(tmp_path / "region=fr/broken.json", '{"items": [')
    table = build_silver_reference(read_categories(spark, str(tmp_path)).where("region <> 'jp'"), noon)
    more = sorted(set(table.columns) - set(schemas.CLEAN_REFERENCE.names))
    assert more == ["kept", "localized_odd `name`", "snippet_channel_n", "snippet_description", "snippet_lists"]
    got = table.select("region", "id", "snippet_title", *(F.col("`" + name.replace("`", "``") + "`") for name in more))
    assert sorted(map(tuple, got.collect())) == [
        ("gb", "3", "c", None, None, None, None, None),
        ("unknown", "7", "alone", None, None, "1", "x", None),
        ("us", "1", "a", "1", "5", None, "d", '[1,{"x":2}]'),
        ("us", "2", "b", "text", None, None, None, None),
    ]


def test_one_odd_value_does_not_lose_a_document(spark, tmp_path):
    put_document(tmp_path, "us", video("v1"), video("v2", category={"odd": 1}, views=7))
    docs = read_video_documents(spark, str(tmp_path))
    got = unify(read_stats_json(spark, str(tmp_path)))
    assert rows(got, "video_id", "views", "category_id") == [("v1", 100, 10), ("v2", 7, None)]
    assert rows(ingest_summary(docs, expected_regions(spark, ["us"]))) == [("us", 1, 2, 0, "success")]


ODD_TEXTS = (
    json.dumps({"items": [video("v1")], "_pipeline_metadata": {"region": "us", "video_count": 1}}),
    json.dumps({"items": [video("v1"), video("v2", category={"odd": 1})]}),
    '{"items": [{"id": "v1"}, 5, {"id": "v2", "snippet": {"title": "t"}}]}',
    '{"items": [{"id": "v1", "snippet": "text"}, null]}',
    '{"items": {"id": "v1"}, "_pipeline_metadata": {"video_count": "x"}}',
    '{"items": null, "_pipeline_metadata": {"video_count": "x"}}',
    '{"items": null}',
    "{}",
    '[{"items": [{"id": "v1"}]}, {"items": 5}]',
    "[]",
    '{"items": [{"id": "v1"}]} {"items": []}',
    '{"items": [{"id": "v1"}]',
    '{"items": [{"id": "v1"}]}}',
    "null",
    "5",
    '"text"',
    " ",
    '\t{"items": [{"id": "v1"}]}\r',
    '{"_text_end": 2, "_value": {"items": []}, "items": [{"id": "\u00e9 \U0001F600"}]}',
)


def test_a_document_is_the_same_with_and_without_its_frame(spark):
    kind = schemas.VIDEO_DOCUMENT
    texts = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "n int, value string")
    framed = texts.withColumn("framed", parse_framed(F.col("value"), kind))
    nothing = F.lit(None).cast(framed.schema["framed"].dataType)
    got = framed.select("n", parse(F.col("value"), F.col("framed"), kind).alias("docs"))
    alone = framed.select("n", parse(F.col("value"), nothing, kind).alias("docs"))
    assert rows(got) == rows(alone)
    assert got.where("n = 0").first().docs[0]["items"][0].id == "v1"


def test_a_file_is_split_once_and_a_line_is_parsed_in_one_pass(spark, tmp_path):
    put_document(tmp_path, "us", video("v1"))
    docs = read_video_documents(spark, str(tmp_path))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    # With carriage returns or without; it was once for each use of the lines before.
    assert plan.count("split(") == 2
    assert plan.count("AS _framed") == 1


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path):
    """A folder per day, as landing leaves them: each file was a task before where Spark packs them so."""
    cores = spark.sparkContext.defaultParallelism
    days = [f"2024-{month:02}-{day:02}" for month in (1, 2) for day in range(1, 29)]
    for i, day in enumerate(days):
        put_document(tmp_path, "us", video(f"v{i}"), at=f"{day}T09:00:00+00:00")
        put_document(tmp_path, "gb", video(f"v{i}"), at=f"{day}T10:00:00+00:00")
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1k")
    try:
        docs = read_video_documents(spark, str(tmp_path))
        assert docs.rdd.getNumPartitions() == TASKS_PER_CORE * cores < 2 * len(days)
        assert docs.where("region = 'gb'").rdd.getNumPartitions() <= TASKS_PER_CORE * cores
    finally:
        spark.conf.set(limit, before)
    assert rows(docs, "region", "items.id") == sorted((r, [f"v{i}"]) for r in ("gb", "us") for i in range(len(days)))


def test_trimming_lines_is_trimming(spark):
    lines = spark.createDataFrame([(x,) for x in ("", " ", "a", " a", "a ", " a b ", "\ta", "a\r", " \u00e9 ", " \t ", None)], "x string")
    assert lines.where(~trimmed(F.col("x")).eqNullSafe(F.trim("x"))).isEmpty()


def test_what_is_counted_while_building_passes_no_other_column(spark, tmp_path):
    put_document(tmp_path, "us", video("v1"), video("v2"))
    docs = read_video_documents(spark, str(tmp_path))
    assert silver_columns(docs).columns == ["region", "items", "_pipeline_metadata", schemas.CORRUPT, "_file_time"]
    assert rows(video_rows(silver_columns(docs))) == rows(video_rows(docs))


def test_counting_documents_reads_ids_only(spark, tmp_path):
    for i, text in enumerate(ODD_TEXTS):
        put(tmp_path / f"region=r{i}/date=2024-03-01/hour=09/a.json", text)
    put(tmp_path / "region=all/date=2024-03-01/hour=09/a.jsonl", "\r\n".join(ODD_TEXTS))
    expected = expected_regions(spark, [*(f"r{i}" for i in range(len(ODD_TEXTS))), "all", "none"])
    sizes = read_document_sizes(spark, str(tmp_path))
    assert sizes.schema["items"].dataType.elementType.names == ["id"]
    got = rows(ingest_summary(sizes, expected))
    assert got == rows(ingest_summary(read_video_documents(spark, str(tmp_path)), expected))
    assert ("r0", 1, 1, 0, "success") in got


def test_outcome_of_each_region(spark, tmp_path):
    videos, names = tmp_path / "videos", tmp_path / "names"
    for region in ("us", "gb", "de"):
        put_document(videos, region, video("v1"))
    put(videos / "region=fr/date=2024-03-01/hour=09/bad.json", '{"items": [')
    put_categories(names, "US", category("1", "a"))
    put_categories(names, "fr", category("1", "a"))
    put_categories(names, "gb")
    got = region_outcomes(
        ingest_summary(
            read_video_documents(spark, str(videos)),
            expected_regions(spark, ["us", "gb", "de", "fr", "jp"]),
        ),
        file_summary(read_category_documents(spark, str(names))),
    )
    assert rows(got) == [
        ("de", "failed", "categories", "no document"),
        ("fr", "failed", "trending", "unreadable document"),
        ("gb", "failed", "categories", "no category items"),
        ("jp", "failed", "trending", "no document"),
        ("us", "success", None, None),
    ]


def test_newest_category_file_stands_for_its_region(spark, tmp_path, noon):
    import os

    old = put_categories(tmp_path, "us", category("1", "a"), category("2", "b"), name="old.json")
    new = put_categories(tmp_path, "us", category("1", "c"), name="new.json")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    os.utime(new, (1_100_000_000, 1_100_000_000))
    table = build_silver_reference(read_categories(spark, str(tmp_path)), noon)
    assert rows(table, "id", "snippet_title") == [("1", "c")]


def test_catalog_scans(spark, tmp_path):
    df = spark.createDataFrame([(1, "us"), (2, "gb")], "x int, region string")
    df.write.mode("overwrite").option("path", str(tmp_path / "t")).partitionBy("region").saveAsTable("scan_me")
    assert rows(scan_table(spark, "scan_me", ["us"]), "x") == [(1,)]
    assert scan_table(spark, "scan_me").count() == 2
    assert sample_table(spark, "scan_me", 1).count() == 1
    assert optional_table(spark, "scan_me") is not None
    assert optional_table(spark, "no_such_table") is None
