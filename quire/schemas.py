"""Fixed table schemas (never inferred)."""

from pyspark.sql import types as T

LINK = T.StructType([
    T.StructField("link_type", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("item_id", T.StringType()),
])

ALIAS = T.StructType([T.StructField("context", T.StringType()), T.StructField("alias", T.StringType())])
NATIONAL_CODE = T.StructType([T.StructField("code", T.StringType()), T.StructField("description", T.StringType())])

META = T.StructType([
    T.StructField("format", T.StringType()),
    T.StructField("aliases", T.ArrayType(ALIAS)),
    T.StructField("national_codes", T.ArrayType(NATIONAL_CODE)),
    T.StructField("ds_spec", T.StringType()),
])

# Item feed (one frame for every kind; ``seq`` is arrival order).
ITEMS = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("retrieved_at", T.TimestampType()),
    T.StructField("modified_at", T.TimestampType()),
    T.StructField("text", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("links", T.ArrayType(LINK)),
    T.StructField("meta", META),
])

LEDGER = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("modified_at", T.TimestampType()),
])

DOCUMENT = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("meta", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("project_id", T.LongType()),
    T.StructField("filename", T.StringType()),
])

DICTIONARY_ITEM = T.StructType([
    T.StructField("item_type", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("meta", T.StringType()),
])

EDGE = T.StructType([
    T.StructField("link_type", T.StringType()),
    T.StructField("src_item_type", T.StringType()),
    T.StructField("src_item_id", T.StringType()),
    T.StructField("dst_item_type", T.StringType()),
    T.StructField("dst_item_id", T.StringType()),
])

ROUTES = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("project_id", T.LongType()),
    T.StructField("dataset_id", T.LongType()),
])

REJECTS = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("reason", T.StringType()),
])

RESPONSES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("retry_after", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("force_refresh", T.BooleanType()),
    T.StructField("dont_refresh", T.BooleanType()),
])

SPAN = T.StructType([
    T.StructField("start_offset", T.LongType()),
    T.StructField("end_offset", T.LongType()),
    T.StructField("label", T.StringType()),
    T.StructField("prob", T.DoubleType()),
])

# Stored column length limits.
MAX_SOURCE_ID = 32
MAX_URL = 255
MAX_ITEM_KEY = 256
MAX_ITEM_NAME = 1024
KNOWN_KINDS = ["text", "html", "dictionary"]
CORPUS_KINDS = ["text", "html"]
