"""Scalar column helpers (F1-F12).  All are built-in Spark expressions, so
they stay inside whole-stage codegen; nothing here is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the JVM `\s` character class, spelled out so that Spark and
# DuckDB split on exactly the same characters.
JAVA_WHITESPACE = "[ \t\n\x0B\f\r]"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cols_of(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col_of(c) for c in cs]


def java_split(c: str | Column, sep: str) -> Column:
    """`String.split(sep)` of the JVM for a one-character literal separator:
    inner empty fields stay, trailing empty fields are dropped, and a string
    made only of separators gives no field at all ("" gives [""])."""
    c = col_of(c)
    rx = "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    # `rtrim` removes trailing spaces without a regular expression
    trimmed = F.rtrim(c) if sep == " " else F.regexp_replace(c, f"({rx})+$", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, rx)))


def ws_tokens(c: str | Column) -> Column:
    """Split on single whitespace characters (JVM `\\s`); empty tokens kept."""
    return F.split(col_of(c), JAVA_WHITESPACE)


def event_time(c: str | Column) -> Column:
    """Event-time column as TIMESTAMP (session zone UTC).  Accepts epoch
    seconds (numeric), TIMESTAMP or TIMESTAMP_NTZ."""
    return col_of(c).cast("timestamp")


def epoch_seconds(c: str | Column) -> Column:
    """Whole epoch seconds of a timestamp."""
    return F.unix_seconds(col_of(c).cast("timestamp"))


def seconds_to_ts(c: str | Column) -> Column:
    """epoch seconds -> TIMESTAMP (the reference's `* 1000L`)."""
    return F.timestamp_seconds(col_of(c))


def to_ntz(c: str | Column) -> Column:
    """Output form of times: naive timestamp, same wall clock as UTC."""
    return col_of(c).cast("timestamp_ntz")


def bucket_number(c: str | Column, seconds: int) -> Column:
    """Integer bucket number of a time column for a bucket width in seconds."""
    us = F.unix_micros(col_of(c).cast("timestamp"))
    return F.floor(us / F.lit(int(seconds) * 1_000_000)).cast("bigint")


def day_start(c: str | Column) -> Column:
    """UTC midnight at or before `c`."""
    return F.date_trunc("day", col_of(c).cast("timestamp"))


def json_item(props: str | Column, field: str = "k") -> Column:
    """Integer field of a small JSON object column (`{"k": 69}` -> 69)."""
    return F.get_json_object(col_of(props), f"$.{field}").cast("bigint")


def render_ts(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """timestamp rendering for reports."""
    return F.date_format(col_of(c), fmt)


def parse_access_time(c: str | Column) -> Column:
    """access-log time `dd/MM/yyyy:HH:mm:ss` (UTC)."""
    return F.to_timestamp(col_of(c), "dd/MM/yyyy:HH:mm:ss")
