"""Scalar functions F2-F21 on small literals."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quire.functions import dates, text


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_ids_and_patterns(spark):
    assert _one(spark, text.extract_item_id(F.lit("../data_elements/abc.html"))) == "abc"
    assert _one(spark, text.extract_item_id(F.lit("x/aXhtml"))) == "a"  # unescaped dot: 'X' stands for '.'
    assert _one(spark, text.extract_item_id(F.lit("abcXhtml"))) == "abc"
    assert _one(spark, text.extract_item_id(F.lit("x/a.htm"))) == ""
    assert _one(spark, text.index_item_id(F.lit("classes/c1.html"), F.lit("class"))) == "c1"
    assert _one(spark, text.index_item_id(F.lit("/data_sets/d1.html#t"), F.lit("dataSet"))) == "d1"
    assert _one(spark, text.index_item_id(F.lit("attributes/a.html"), F.lit("class"))) == ""
    assert _one(spark, text.type_in_id(F.lit("businessDefinition"))) == "business_definition"
    assert _one(spark, text.type_in_id(F.lit("element"))) == "element"
    assert _one(spark, text.comment_id(F.lit("/report?commentID=ab-12_x&y"))) == "ab-12_x"
    assert _one(spark, text.comment_id(F.lit(None).cast("string"))) == ""


def test_strings_and_json(spark):
    assert _one(spark, text.trim_ws(F.lit("\t x y \n"))) == "x y"
    assert _one(spark, text.doc_name(F.lit("a" * 200 + "END"))) == ("a" * 200 + "END")[-150:]
    assert _one(spark, text.doc_name(F.lit("short"))) == "short"
    meta = json.loads(_one(spark, text.doc_meta_json(F.lit("s"), F.lit("http://x/é?a=1"))))
    assert meta == {"source_id": "s", "source_url": "http://x/é?a=1"}
    assert _one(spark, text.retry_seconds(F.lit("12").try_cast("int"))) == 12
    assert _one(spark, text.retry_seconds(F.lit("soon").try_cast("int"))) == 30
    m = F.create_map(F.lit("class"), F.lit("x"), F.lit("id"), F.lit("y"))
    assert _one(spark, text.drop_class(m)) == {"id": "y"}
    assert _one(spark, text.link_type(F.lit(True))) == "key_attribute"
    assert _one(spark, text.nonblank(F.lit("  "))) is False
    name = _one(spark, text.export_file_name(F.lit("src"), F.lit("2024-01-02 03:04:05").cast("timestamp"), F.lit("t")))
    assert name.startswith("src_20240102030405_") and len(name.split("_")[-1]) == 12
    assert _one(spark, text.content_key(F.lit("u"), F.lit("t"))) == "u#e358efa489f58062f10dd7316b65649e"


def test_dates(spark):
    assert _one(spark, dates.parse_http_date(F.lit("Wed, 21 Oct 2015 07:28:00 GMT"))) == dt.datetime(2015, 10, 21, 7, 28)
    assert _one(spark, dates.parse_http_date(F.lit("garbage"))) is None
    assert _one(spark, dates.parse_iso(F.lit("2024-03-04T05:06:07+01:00"))) == dt.datetime(2024, 3, 4, 4, 6, 7)
    assert _one(spark, dates.if_modified_since(F.lit("2024-01-02 03:04:05").cast("timestamp"))) == \
        "Tue, 02 Jan 2024 03:04:05 +0000"
    assert _one(spark, dates.start_date(F.lit("2024-01-02 23:59:59").cast("timestamp"))) == "2024-01-02"
