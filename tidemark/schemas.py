"""Declared schemas as DDL: stored tables, logical tables and the topic envelope."""

from __future__ import annotations

#: Parquet tables as they lie on disk. Timestamps there carry no zone.
TABLES = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
}

#: Records as they are landed by collectors or arrive on the topic.
POST = "id STRING, title STRING, selftext STRING, author STRING, num_comments INT, url STRING, created_utc DOUBLE"
COMMENT = ("_id STRING, author STRING, author_fullname STRING, body STRING, parent_id STRING, link_id STRING, "
    "created_utc DOUBLE")
STREAM_RECORD = ("comment_id STRING, raw_text STRING, created_at DOUBLE, permalink STRING, author_name STRING, "
    "author_id STRING, subreddit STRING, message STRING, created_utc STRING")
ENVELOPE = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
LABEL_MAP = "id INT, label STRING"
