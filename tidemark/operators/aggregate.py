"""User aggregates and whole-window functions.

`aggregate`        a user's mergeable aggregate class per key, combined on the
                   map side: every task folds its own rows into one state per
                   key, and only states are shuffled.
`whole_window`     a user's function over all rows of a (window, key) in
                   order, fed as a stream of Arrow batches.

Both read Arrow batches group by group.  After the shuffle a task's rows are
sorted by the key (Spark's external sort, which spills), so a group is a run
of neighbouring rows and no group is ever held as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.windows import seconds

# states that a task holds before it hands them on and starts anew
MAX_STATES = 50_000


class Aggregate:
    """A mergeable aggregate.  Subclasses set

      INPUTS   names of the input columns
      STATE    DDL of the state, a tuple
      OUT      DDL of the result columns

    and implement `create`, `add`, `merge` and `result`.  Rows reach `add`,
    and states `merge`, in any order.  `add_batch` may be replaced by a
    vectorised form."""

    INPUTS: tuple[str, ...] = ()
    STATE: str = ""
    OUT: str = ""

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, state: tuple, row: tuple) -> tuple:
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def result(self, state: tuple) -> tuple:
        raise NotImplementedError

    def add_batch(self, state: tuple, rows: pa.Table) -> tuple:
        for row in zip(*[c.to_pylist() for c in rows.columns]):
            state = self.add(state, row)
        return state


def _runs(table: pa.Table, keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each run of neighbouring rows with equal keys."""
    n = table.num_rows
    if not n:
        return
    change = np.zeros(n - 1, bool)
    for k in keys:
        col = table.column(k)
        a, b = col.slice(0, n - 1), col.slice(1)
        differs = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(col.type):      # NaN is one key, as in Spark's groups
            differs = pc.and_not(differs, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        nulls = pc.xor(pc.is_null(a), pc.is_null(b))
        change |= pc.or_(differs, nulls).to_numpy()
    starts = np.concatenate([[0], np.flatnonzero(change) + 1, [n]])
    firsts = [table.column(k).take(pa.array(starts[:-1])).to_pylist() for k in keys]
    for i, key in enumerate(zip(*firsts) if keys else [()]):
        yield key, table.slice(starts[i], starts[i + 1] - starts[i])


def _hashable(key: tuple) -> tuple:
    return tuple("\0nan" if isinstance(v, float) and v != v else v for v in key)


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _fields(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def _partial(agg: Aggregate, keys: list[str], schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = _arrow(schema), {}
        for b in batches:
            t = pa.Table.from_batches([b])
            if keys:
                t = t.take(pc.sort_indices(t, sort_keys=[(k, "ascending") for k in keys]))
            for key, rows in _runs(t, keys):
                name = _hashable(key)
                state = held[name][1] if name in held else agg.create()
                held[name] = (key, agg.add_batch(state, rows.select(list(agg.INPUTS))))
            if len(held) >= MAX_STATES:
                yield _batches([(*k, *s) for k, s in held.values()], out)
                held = {}
        if held:
            yield _batches([(*k, *s) for k, s in held.values()], out)
    return run


def _segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    for b in batches:
        yield from _runs(pa.Table.from_batches([b]), keys)


def _merge(agg: Aggregate, keys: list[str], states: list[str], schema: T.StructType, finish: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = _arrow(schema), []
        for _, parts in groupby(_segments(batches, keys), key=lambda p: _hashable(p[0])):
            state = None
            for key, part in parts:
                for s in zip(*[c.to_pylist() for c in part.select(states).columns]):
                    state = s if state is None else agg.merge(state, s)
            rows.append((*key, *(agg.result(state) if finish else state)))
            if len(rows) >= 1000:
                yield _batches(rows, out)
                rows = []
        if rows:
            yield _batches(rows, out)
    return run


def aggregate(df: DataFrame, keys: list[str], agg: Aggregate, salts: int = 1) -> DataFrame:
    """H5: keys..., result columns of `agg`, one row per key.

    Every task folds its rows into one state per key (at most `MAX_STATES`
    held; beyond that they are handed on and merged later), states are
    shuffled by key and merged as they stream by.  A key that is in every task
    has one state per task; `salts` > 1 merges those in that many groups
    first.  Null keys are a group; without keys an empty input gives no row."""
    key_fields = df.select(*keys).schema.fields
    state_fields, out_fields = _fields(agg.STATE).fields, _fields(agg.OUT).fields
    states = [f"__s{i}" for i in range(len(state_fields))]
    mid = T.StructType([*key_fields, *[T.StructField(n, f.dataType) for n, f in zip(states, state_fields)]])
    parts = df.select(*keys, *[c for c in agg.INPUTS if c not in keys]).mapInArrow(_partial(agg, keys, mid), mid)
    if salts > 1:
        # the salt is fixed by the task, so that a task that runs again deals its states alike
        salted = parts.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        by = [*keys, "__salt"]
        with_salt = T.StructType([*key_fields, T.StructField("__salt", T.IntegerType()), *mid.fields[len(keys):]])
        parts = (salted.repartition(*by).sortWithinPartitions(*by).select(*by, *states)
                 .mapInArrow(_merge(agg, by, states, with_salt, False), with_salt).drop("__salt"))
    dealt = parts.repartition(*keys).sortWithinPartitions(*keys) if keys else parts.repartition(1)
    out = T.StructType([*key_fields, *out_fields])
    return dealt.mapInArrow(_merge(agg, keys, states, out, True), out)


def window_columns(df: DataFrame, ts: str, size) -> DataFrame:
    """The rows with the tumbling window (window_start, window_end) of `ts`."""
    us = seconds(size) * 1_000_000
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    start = at - F.pmod(at, F.lit(us))
    return df.withColumns({"window_start": F.timestamp_micros(start), "window_end": F.timestamp_micros(start + F.lit(us))})


def window_aggregate(df: DataFrame, ts: str, size, keys: list[str], agg: Aggregate, salts: int = 1) -> DataFrame:
    """A user's aggregate per tumbling window and key."""
    by = ["window_start", "window_end", *keys]
    return aggregate(window_columns(df.where(F.col(ts).isNotNull()), ts, size), by, agg, salts)


def whole_window(df: DataFrame, ts: str, size, keys: list[str], fn: Callable, out: str,
                 columns: list[str], order: list[str]) -> DataFrame:
    """H6: window_start, window_end, keys..., columns of `out`: the rows that
    `fn(key, batches)` yields as tuples, for every tumbling window and key.
    `key` is (window_start, window_end, *keys); `batches` is an iterator of
    Arrow tables with `columns`, in the order of `order`, which `fn` may stop
    reading early.

    A window of any length passes through in bounded memory, but through one
    task: use `aggregate` where the function can be merged.  Rows without a
    time are in no window."""
    by = ["window_start", "window_end", *keys]
    rows = window_columns(df.where(F.col(ts).isNotNull()), ts, size)
    need = list(dict.fromkeys([*by, *columns, *order]))
    rows = rows.select(*need).repartition(*by).sortWithinPartitions(*by, *[o for o in order if o not in by])
    schema = T.StructType([*rows.select(*by).schema.fields, *_fields(out).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, held = _arrow(schema), []
        for _, parts in groupby(_segments(batches, by), key=lambda p: _hashable(p[0])):
            key, first = next(parts)
            for row in fn(key, (t.select(columns) for t in _after(first, parts))):
                held.append((*key, *row))
                if len(held) >= 1000:
                    yield _batches(held, arrow)
                    held = []
        if held:
            yield _batches(held, arrow)

    return rows.mapInArrow(run, schema)


def _after(first: pa.Table, parts) -> Iterator[pa.Table]:
    yield first
    for _, t in parts:
        yield t


class ValueProfile(Aggregate):
    """Rows, mean of the items that are not null, and the row of the largest
    value (the smallest `seq` among equals)."""

    INPUTS = ("seq", "item_id", "value")
    STATE = "n bigint, items bigint, total bigint, top double, top_seq bigint"
    OUT = "n bigint, mean_item double, top_value double, top_seq bigint"

    def create(self):
        return 0, 0, 0, None, None

    def add(self, state, row):
        seq, item, value = row
        best = (None, None) if value is None else (value, seq)
        return self.merge(state, (1, int(item is not None), item or 0, *best))

    def merge(self, a, b):
        x, y = a[3:], b[3:]
        best = x if y[0] is None or (x[0] is not None and (-x[0], x[1]) <= (-y[0], y[1])) else y
        return a[0] + b[0], a[1] + b[1], a[2] + b[2], *best

    def result(self, state):
        n, items, total, top, seq = state
        return n, (total / items if items else None), top, seq


def distinct_in_order(column: str):
    """A whole-window function: distinct non-null values of `column`, by which
    the window's rows are ordered, in constant memory."""
    def fn(key, batches):
        n, last = 0, None
        for t in batches:
            col = t.column(column)
            col = col.filter(pc.is_valid(col)).combine_chunks()
            if len(col):
                steps = pc.not_equal(col.slice(0, len(col) - 1), col.slice(1))
                n += int(col[0].as_py() != last) + (pc.sum(steps).as_py() or 0)
                last = col[-1].as_py()
        yield (n,)
    return fn
