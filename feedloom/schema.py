"""Explicit schemas. Ids are 64-bit and never pass through a double; missing is NULL."""

from __future__ import annotations

from pyspark.sql import types as T

POSTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user", T.LongType()),
        T.StructField("full_text", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("lang", T.StringType()),
        T.StructField("retweeted_status", T.LongType()),
        T.StructField("quoted_status", T.LongType()),
        T.StructField("is_quote_status", T.BooleanType()),
        T.StructField("in_reply_to_status_id", T.LongType()),
        T.StructField("favorite_count", T.LongType()),
    ]
)

LIKES = T.StructType([T.StructField("post_id", T.LongType()), T.StructField("user_id", T.LongType())])

DELIVERY_LOG = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("err_reason", T.StringType()),
    ]
)

SCORES = T.StructType([T.StructField("id", T.LongType()), T.StructField("predicted", T.DoubleType())])

LABEL_SET = T.StructType([*POSTS.fields, T.StructField("labels", T.DoubleType())])

MEMBER_PAGE = "struct<users: array<struct<id: bigint, screen_name: string, name: string>>>"

COLLECTION_PAGE = "struct<objects: struct<tweets: map<string, string>>>"

RUN_METRICS = ("precision", "recall", "f1", "precision_class1", "recall_class1", "f1_class1")

# Suite limits and the re-training cut-off: fixed values.
LABEL_SET_ROWS = (29285, 99999)
SCORE_RANGE = (0.0, 1.0)
RETRAIN_BELOW_F1 = 0.78
REJECTED_DUMP_ABOVE = 180
COLLECTION_MESSAGE_FROM = 100
