"""Projection, filter, flat-map and word-count operators (P1-P12, A1, A2,
U1, K1).  All built-in column expressions; Catalyst prunes and pushes down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cols_of, java_split, ws_tokens
from tidemark.operators import scan

LINE_BREAK = "\r\n|\r|\n"


def lines_of(df: DataFrame, text: str = "text", keep=()) -> DataFrame:
    """One row per line of a text column, with its 0-based line number."""
    return df.select(*cols_of(keep), F.posexplode(F.split(F.col(text), LINE_BREAK, -1))
                     .alias("line_no", "line"))


def words_split(df: DataFrame, text: str = "text", sep: str = " ", keep=()) -> DataFrame:
    """P2 + F1: tokens of each line by the JVM `split(sep)` rule."""
    lines = lines_of(df, text, keep)
    return lines.select(*[F.col(c) for c in lines.columns if c not in ("line",)],
                        F.posexplode(java_split("line", sep)).alias("pos", "word"))


def words_ws(df: DataFrame, text: str = "text", keep=(), nonempty: bool = True) -> DataFrame:
    """P2 + P4: tokens split on single whitespace characters; empty ones
    dropped (the streaming word count's `filter(_.nonEmpty)`)."""
    out = df.select(*cols_of(keep), F.posexplode(ws_tokens(F.col(text))).alias("pos", "word"))
    return out.filter(F.length("word") > 0) if nonempty else out


def word_count(words: DataFrame, word: str = "word", name: str = "cnt") -> DataFrame:
    """Total per word (one exchange, map-side combine)."""
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(name))


def running_word_count(words: DataFrame, order, word: str = "word", name: str = "cnt",
                       chunk: Column | None = None, chunk_rows: int | None = None) -> DataFrame:
    """A2: the total of each word after each of its occurrences, in `order`.
    A hot word is split into ordered chunks (see `scan.running`), with `chunk`
    into ranges of these whole numbers; only hot words have a carry."""
    return scan.row_number(words, [word], order, name=name, chunk=chunk, chunk_rows=chunk_rows, hot_only=chunk is not None)


def select_expr(df: DataFrame, *exprs: str) -> DataFrame:
    """Projection by expression strings."""
    return df.selectExpr(*exprs)


def filter_expr(df: DataFrame, cond: str) -> DataFrame:
    """Filter by an expression string."""
    return df.filter(cond)


def sql_on(spark: SparkSession, df: DataFrame, view: str, query: str) -> DataFrame:
    """SQL text over a DataFrame registered as a temporary view."""
    df.createOrReplaceTempView(view)
    return spark.sql(query)


def tag(df: DataFrame, rules: list[tuple[str, Column]], default: str, name: str = "tag") -> DataFrame:
    """P10: split by tag -- the first matching (tag, condition) wins."""
    expr = None
    for t, cond in rules:
        expr = F.when(cond, F.lit(t)) if expr is None else expr.when(cond, F.lit(t))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(name, expr)


def select_tags(tagged: DataFrame, *tags: str, name: str = "tag") -> DataFrame:
    """P10: select one or more tagged outputs."""
    return tagged.filter(F.col(name).isin(*tags))


def connect_map(left: DataFrame, right: DataFrame, left_map, right_map) -> DataFrame:
    """Map two differently shaped inputs and merge them into one
    output; missing columns become null."""
    return left_map(left).unionByName(right_map(right), allowMissingColumns=True)


def single_event_pattern(df: DataFrame, cond: Column, fields, state: str = "start") -> DataFrame:
    """One-state event rule = filter; each match rendered as the
    reference's map from state name to matched events, as JSON."""
    ev = F.struct(*cols_of(fields))
    return df.filter(cond).withColumn(
        "match", F.to_json(F.create_map(F.lit(state), F.array(ev))))
