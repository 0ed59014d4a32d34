"""Raw files as the sources would leave them."""

from __future__ import annotations

import json
from pathlib import Path

HEADER = (
    "video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,"
    "dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,"
    "video_error_or_removed,description"
)


def csv_line(video, day="17.14.11", title="t", channel="ch", category="10", views="100",
             likes="10", dislikes="1", comments="2", description="d"):
    return (
        f'{video},{day},"{title}",{channel},{category},2017-11-13T17:13:01.000Z,"a|b",{views},'
        f'{likes},{dislikes},{comments},http://t/x.jpg,False,True,False,"{description}"'
    )


def put(path: Path, text: str) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return path


def put_csv(root: Path, region: str, *lines: str, name="videos.csv", newline="\n") -> Path:
    return put(root / f"region={region}" / name, newline.join([HEADER, *lines]) + newline)


def video(vid, views="100", likes="10", category="10", title="t", channel="ch", **statistics):
    counts = {"viewCount": views, "likeCount": likes, "commentCount": "2", **statistics}
    return {
        "id": vid,
        "snippet": {
            "title": title,
            "channelTitle": channel,
            "categoryId": category,
            "publishedAt": "2024-02-28T00:00:00Z",
            "tags": ["a", "b"],
            "description": "d",
            "thumbnails": {"default": {"url": "http://t/x.jpg"}},
        },
        "statistics": counts,
    }


def put_document(root: Path, region: str, *videos, at="2024-03-01T09:00:00.000000+00:00",
                 name="pull") -> Path:
    document = {
        "items": list(videos),
        "_pipeline_metadata": {
            "ingestion_id": name,
            "region": region,
            "ingestion_timestamp": at,
            "video_count": len(videos),
            "source": "test",
        },
    }
    folder = root / f"region={region}" / f"date={at[:10]}" / f"hour={at[11:13]}"
    return put(folder / f"{name}.json", json.dumps(document, indent=2))


def category(cid, title, **extra):
    return {
        "kind": "category",
        "etag": f"e{cid}",
        "id": cid,
        "snippet": {"channelId": "c", "title": title, "assignable": True},
        **extra,
    }


def put_categories(root: Path, region: str, *items, name="category_id.json", newline="\n") -> Path:
    text = json.dumps({"kind": "list", "etag": "e", "items": list(items)}, indent=1)
    path = root / f"region={region}" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.replace("\n", newline).encode())
    return path
