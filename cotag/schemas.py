"""Declared schemas of the raw, staging and mart layers."""

from __future__ import annotations

from pyspark.sql import types as T

UNKNOWN = "unknown"


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _struct(spec: str) -> T.StructType:
    """A schema from ``name type`` pairs; unlike DDL parsing this needs no running session."""
    fields = []
    for column in spec.split(", "):
        name, type_name, *rest = column.split(" ")
        fields.append(T.StructField(name, _TYPES[type_name], rest != ["not", "null"]))
    return T.StructType(fields)


#: One row per post; the key is ``post_id``.
POSTS = _struct(
    "post_id string not null, insta_id string, insta_name string, brand_name string, "
    "brand_id string, full_link string, img_src string, post_date date, "
    "first_seen_at timestamp, last_seen_at timestamp, active boolean, "
    "tagged_insta_id string, tagged_insta_id_cnt int"
)

#: What one collection run hands over; ``post_date`` is still text.
BATCH = _struct(
    "post_id string, insta_id string, insta_name string, brand_name string, brand_id string, "
    "full_link string, img_src string, post_date string, "
    "tagged_insta_id string, tagged_insta_id_cnt int"
)

#: Brand records as configured; ``pos`` is the order in the configuration.
BRANDS = _struct(
    "pos int, brand_key string, instagram_id string, dag_id string, schedule string, "
    "enabled boolean, schema string, table string"
)

#: One row per post and tag position.
STAGE = _struct(
    "pk_tagged_post string, tag_pos bigint, post_id string, insta_id string, "
    "insta_name string, brand_name string, brand_id string, post_date date, "
    "full_link string, tagged_account string"
)

ACCOUNT_TAGGED = _struct(
    "insta_id string, insta_name string, tagged_account string, first_tagged_date date, "
    "last_tagged_date date, tagged_post_count bigint"
)
CROSS_BRAND = _struct(
    "insta_id string, insta_name string, tagged_account_count bigint, brands_tagged string"
)
BRAND_MONTHLY = _struct(
    "tagged_account string, month date, unique_tagger_count bigint, post_count bigint"
)
CO_BRAND_STATS = _struct(
    "tagged_account string, tagger_count bigint, total_tag_count bigint, tagger_ratio double"
)

POST_COLUMNS = POSTS.fieldNames()
BATCH_COLUMNS = BATCH.fieldNames()
STAGE_COLUMNS = STAGE.fieldNames()
