"""Text sources and line decoders.

Lines are decoded with `split` + `cast` expressions, not the CSV reader: the
CSV reader turns an empty field into null and strips quote characters, the
reference keeps both (`"a,,b"` gives an empty string, `"\"ws_1\""` keeps its
quotes).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import JAVA_WHITESPACE, parse_access_time

# Record shapes of the reference's input files (fixed values).
SENSOR = "id string, timestamp bigint, temperature double"
WATER_SENSOR = "id string, timestamp bigint, vc double"
USER_BEHAVIOR = "user_id bigint, item_id bigint, category_id int, behavior string, timestamp bigint"
AD_CLICK = "user_id bigint, ad_id bigint, province string, city string, timestamp bigint"
LOGIN_EVENT = "user_id bigint, ip string, event_type string, event_time bigint"
ORDER_EVENT = "order_id bigint, event_type string, tx_id string, event_time bigint"
TX_EVENT = "tx_id string, pay_channel string, event_time bigint"


def from_rows(spark: SparkSession, rows, schema: str | T.StructType) -> DataFrame:
    """Bounded in-memory collection -> DataFrame (fixed schema)."""
    return spark.createDataFrame(rows, schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column `value`."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: the same lines as an unbounded file stream (a folder of files)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def _fields(schema: str | T.StructType) -> list[T.StructField]:
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return list(st.fields)


def _sep_regex(sep: str) -> str:
    return JAVA_WHITESPACE if sep == r"\s" else re.escape(sep)


def decode_lines(lines: DataFrame, schema: str | T.StructType, sep: str = ",",
                 col: str = "value", on_error: str = "fail",
                 keep: list[str] | None = None) -> DataFrame:
    """Decode delimited lines into typed columns.

    on_error="fail"   a bad number raises at run time (whatever the ANSI
                      setting), as the reference's `toLong` throws
    on_error="reject" rows get `_bad` = true when a non-empty field does not
                      convert; split them off with `filter` (side output)
    Columns in `keep` (e.g. an arrival number) are carried through.
    """
    parts = F.split(F.col(col), _sep_regex(sep), -1)
    out, bad = [], []
    for i, f in enumerate(_fields(schema)):
        tok = F.get(parts, i)                      # null past the end, never raises
        missing = F.size(parts) <= i
        if isinstance(f.dataType, T.StringType):
            v, wrong = tok, missing
        else:
            v = F.trim(tok).try_cast(f.dataType)
            wrong = missing | (v.isNull() & tok.isNotNull())
        if on_error == "fail":
            # raise whatever the session's ANSI setting is
            out.append(F.when(wrong, F.raise_error(F.concat(
                F.lit(f"cannot decode field {f.name} of: "), F.col(col)))).otherwise(v).alias(f.name))
        else:
            out.append(v.alias(f.name))
            bad.append(wrong)
    cols = [F.col(k) for k in (keep or [])] + out
    if on_error != "fail":
        flag = F.lit(False)
        for b in bad:
            flag = flag | b
        cols.append(flag.alias("_bad"))
    return lines.select(*cols)


def decode_access_log(lines: DataFrame, col: str = "value", on_error: str = "null",
                      keep: list[str] | None = None) -> DataFrame:
    """Space-separated web access log -> ip, user_id, event_time, method, url.

    Fields 0, 1, 3, 5, 6; field 3 is `dd/MM/yyyy:HH:mm:ss` in UTC (a leading
    `[` is tolerated).  The reference's pattern lacks the minutes field; we
    read the minutes (quirk Q6).

    A short line has null in the fields it lacks; on_error="reject" also adds
    `_bad` = true for a line without all seven fields, on_error="fail" raises
    for it."""
    p = F.split(F.col(col), " ", -1)
    short = F.size(p) < 7
    if on_error == "fail":
        p = F.when(short, F.raise_error(F.concat(F.lit("short access log line: "), F.col(col)))
                   .cast("array<string>")).otherwise(p)
    when = F.regexp_replace(F.get(p, 3), r"^\[", "")
    return lines.select(
        *[F.col(k) for k in (keep or [])],
        F.get(p, 0).alias("ip"),
        F.get(p, 1).alias("user_id"),
        parse_access_time(when).alias("event_time"),
        F.get(p, 5).alias("method"),
        F.get(p, 6).alias("url"),
        *([short.alias("_bad")] if on_error == "reject" else []),
    )


def to_table(df: DataFrame, name: str) -> DataFrame:
    """A stream or batch DataFrame is already the relational view;
    register it under a name for SQL."""
    df.createOrReplaceTempView(name)
    return df
