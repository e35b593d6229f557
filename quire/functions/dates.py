"""Date expressions (F8-F10, T5 timing)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header formats.
# Conditional request header: "%a, %d %b %Y %H:%M:%S %z" (numeric zone).
IMS_FORMAT = "EEE, dd MMM yyyy HH:mm:ss Z"
# HTTP date after the weekday prefix is removed: "01 Jan 2024 10:00:00 GMT".
HTTP_DATE_FORMAT = "dd MMM yyyy HH:mm:ss z"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_iso(x: Column | str) -> Column:
    """F8: ISO-8601 ``dateModified``; null when absent or malformed."""
    return F.try_to_timestamp(_c(x))


def parse_http_date(x: Column | str) -> Column:
    """F8: ``Last-Modified`` header; null when missing or malformed."""
    body = F.regexp_replace(_c(x), r"^\s*[A-Za-z]{3},\s*", "")
    return F.try_to_timestamp(body, F.lit(HTTP_DATE_FORMAT))


def if_modified_since(ts: Column | str) -> Column:
    """conditional request header value of a stored time."""
    return F.date_format(_c(ts), IMS_FORMAT)


def start_date(hwm: Column | str) -> Column:
    """high-water mark cut to the day (the last day is read again)."""
    return F.date_format(_c(hwm), "yyyy-MM-dd")
