"""Keyed stateful stream operators (W6, W8, H7; N1, K5, K7, K9) on
`transformWithState` (row API; or `transformWithStateInPandas`) with
event-time timers.

Rows of one key can reach a micro-batch in any order, and the reference's
operators depend on order.  `OrderedProcessor` therefore buffers a key's rows
in list state until the watermark has passed them, then handles them one by
one in (event time, arrival number) order.  One deadline per key (the
reference's event-time timer) fires between rows when a row comes later than
it, or when the watermark passes it.  Results are then the same whatever the
micro-batch boundaries, and equal to the batch operators.

State is typed and held apart: one value per key (the deadline and the
processor's own columns), a list of the rows that wait for the watermark, which
arrivals are appended to without reading it, and, where a processor asks for
it, a list of pending items.  A timer is armed at the earliest row of each
arrival; when it fires, the waiting rows are read once and the few behind the
watermark written back.  A processor that has nothing left to remember drops
its state (`forget`).  Times inside the processors are epoch microseconds.
"""

from __future__ import annotations

import datetime as dt
import heapq
import math
from itertools import chain as _chain
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.run import FLUSH_TS

FLUSH_US = int((FLUSH_TS - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
_DAY_US = 86_400_000_000


def _ms_ceil(us: int) -> int:
    return int(math.ceil(us / 1000))


def _py(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    return v.item() if hasattr(v, "item") else v


class OrderedProcessor(StatefulProcessor):
    """Base class.  Subclasses set

      KEYS        key column names (set in __init__)
      FIELDS      buffered input columns besides ts/seq, FIELD_TYPES their types
      STATE       DDL of the processor's own state row, INITIAL its start value
      ITEMS       DDL of a list of pending items, if any (`self.pending`)
      OUT         output column names after the key columns

    and implement `on_row(s, ts_us, seq, fields)` and `on_deadline(s, when_us)`
    working on `s`, a mutable list holding the state row; both return a list
    of output tuples.  `set_deadline` / `clear_deadline` manage the single
    event-time deadline of the key; `forget` drops the key's state after the
    callback, unless rows still wait."""

    KEYS: tuple[str, ...] = ()
    FIELDS: tuple[str, ...] = ()
    FIELD_TYPES: tuple[str, ...] = ()
    STATE: str = "x bigint"
    INITIAL: tuple = (None,)
    ITEMS: str = ""
    OUT: tuple[str, ...] = ()
    # True: rows in and out as Row objects (`transformWithState`); False:
    # pandas frames (`transformWithStateInPandas`).  Set by `apply`.
    ROWS: bool = True
    # True: rows wait for the watermark and are handled in event-time order.
    # False (results independent of row order): rows are handled on arrival.
    ORDERED: bool = True

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.own = handle.getValueState("own", f"deadline bigint, {self.STATE}")
        if self.ORDERED:
            self.waiting = handle.getListState("waiting", ", ".join(
                ["ts_us bigint", "seq bigint", *[f"f{i} {t}" for i, t in enumerate(self.FIELD_TYPES)]]))
        if self.ITEMS:
            self.items = handle.getListState("items", self.ITEMS)
        self._dl, self._forget, self._pending, self._kept = None, False, None, 0

    def _load(self):
        self._forget, self._pending = False, None
        v = self.own.get()
        return (None, list(self.INITIAL)) if v is None else (v[0], list(v[1:]))

    def _save(self, old: tuple, s: list, waits: bool) -> None:
        if self._pending is not None:
            if not self._pending:
                if self._kept:
                    self.items.clear()
            elif self._kept < 0:
                self.items.put(self._pending)
            elif len(self._pending) > self._kept:
                self.items.appendList(self._pending[self._kept:])
        if self._forget and not waits and self._dl is None:
            if self.own.exists():
                self.own.clear()
        elif (self._dl, *s) != old:
            self.own.update((self._dl, *s))

    @property
    def pending(self) -> list[tuple]:
        """The list of pending items, read when first asked for; append to
        it, or take some off with `keep_pending`."""
        if self._pending is None:
            self._pending = [tuple(x) for x in self.items.get()]
            self._kept = len(self._pending)
        return self._pending

    def keep_pending(self, rest: list[tuple]) -> None:
        if len(rest) != len(self.pending):
            self._pending = rest
            self._kept = -1 if self._kept else 0

    def forget(self) -> None:
        self._forget = True

    # hooks for subclasses -------------------------------------------------
    def on_row(self, s: list, ts_us: int, seq: int, fields: tuple) -> list[tuple]:
        return []

    def on_deadline(self, s: list, when_us: int) -> list[tuple]:
        return []

    def set_deadline(self, when_us: int) -> None:
        self._dl = int(when_us)

    def clear_deadline(self) -> None:
        self._dl = None

    # engine callbacks ------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        new = []
        if self.ROWS:
            new = [(r["ts_us"], r["seq"], *[r[f] for f in self.FIELDS]) for r in rows
                   if r["ts_us"] < FLUSH_US]   # the flush row only moves the watermark
        else:
            for pdf in rows:
                pdf = pdf[pdf["ts_us"] < FLUSH_US]
                if pdf.empty:
                    continue
                cols = [pdf["ts_us"].tolist(), pdf["seq"].tolist()] + \
                    [[_py(v) for v in pdf[f].tolist()] for f in self.FIELDS]
                new.extend(zip(*cols))
        if not new:
            return iter(())
        if self.ORDERED:
            self.waiting.appendList(new)
            self.handle.registerTimer(_ms_ceil(min(r[0] for r in new)))
            return iter(())
        # order-insensitive processors handle rows as they come; only their
        # deadline waits for the watermark
        self._dl, s = self._load()
        old = (self._dl, *s)
        out: list[tuple] = []
        for r in sorted(new, key=lambda r: (r[0], r[1])):
            out += self.on_row(s, r[0], r[1], tuple(r[2:]))
        self._move_timer(old[0], None)
        self._save(old, s, False)
        return iter(self._emit(key, out))

    def _move_timer(self, old: int | None, fired_up_to: int | None) -> None:
        """Re-register the deadline timer if the deadline changed."""
        if self._dl == old:
            return
        if old is not None and (fired_up_to is None or old > fired_up_to):
            self.handle.deleteTimer(_ms_ceil(old))
        if self._dl is not None:
            self.handle.registerTimer(_ms_ceil(self._dl))

    def _emit(self, key, out: list[tuple]) -> list:
        if not out:
            return []
        k = tuple(_py(v) for v in key)
        if self.ROWS:
            make = Row(*self.KEYS, *self.OUT)
            return [make(*(k + o)) for o in out]
        return [pd.DataFrame([k + o for o in out], columns=list(self.KEYS) + list(self.OUT))]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Eager on purpose (not a generator): all state access happens while
        # the engine has this key selected.
        return iter(self._advance(key, timerValues.getCurrentWatermarkInMs() * 1000))

    def _advance(self, key, wm_us: int) -> list[pd.DataFrame]:
        waiting = [tuple(r) for r in self.waiting.get()] if self.ORDERED else []
        ready = sorted((r for r in waiting if r[0] <= wm_us), key=lambda r: (r[0], r[1]))
        self._dl, s = self._load()
        if not ready and (self._dl is None or self._dl > wm_us):
            return []
        old = (self._dl, *s)
        out = self._run(s, ready, wm_us)
        self._move_timer(old[0], wm_us)
        rest = [r for r in waiting if r[0] > wm_us]
        if ready and rest:
            self.waiting.put(rest)
            self.handle.registerTimer(_ms_ceil(min(r[0] for r in rest)))
        elif ready:
            self.waiting.clear()
        self._save(old, s, bool(rest))
        return self._emit(key, out)

    def _run(self, s: list, ready: list[tuple], wm_us: int) -> list[tuple]:
        """Outputs of the sorted rows and of the deadlines between them and up
        to the watermark."""
        out: list[tuple] = []
        for r in ready:
            while self._dl is not None and self._dl < r[0]:
                d, self._dl = self._dl, None
                out += self.on_deadline(s, d)
            out += self.on_row(s, r[0], r[1], r[2:])
        while self._dl is not None and self._dl <= wm_us:
            d, self._dl = self._dl, None
            out += self.on_deadline(s, d)
        return out

    def close(self) -> None:
        pass


class Bucketed(StatefulProcessor):
    """Runs an ordered processor for all keys of a bucket, so that very many
    small keys do not cost calls of the state API, timers and output batches
    each.  Rows wait for the watermark in lists of up to `PACK` rows, packed by
    column; a key's own state and deadline are an entry of a map, read and
    written when rows of the key are due.  The bucket's earliest deadline is
    kept apart; only when the watermark passes it is the whole map read, so
    this suits processors whose deadlines fall together.  A key whose state is
    the initial one has no entry."""

    PACK = 1000

    def __init__(self, inner: OrderedProcessor, key_types: list[str]):
        if not inner.ORDERED or inner.ITEMS:
            raise ValueError("only ordered processors without pending items run in buckets")
        self.inner, self.key_types = inner, key_types

    def init(self, handle: StatefulProcessorHandle) -> None:
        p, self.handle = self.inner, handle
        keys = [(f"k{i}", t) for i, t in enumerate(self.key_types)]
        cols = [*keys, ("ts_us", "bigint"), ("seq", "bigint"), *[(f"f{i}", t) for i, t in enumerate(p.FIELD_TYPES)]]
        self.own = handle.getMapState("own", ", ".join(f"{n} {t}" for n, t in keys), f"deadline bigint, {p.STATE}")
        self.due = handle.getValueState("due", "due bigint")
        self.waiting = handle.getListState("waiting", ", ".join(f"{n} array<{t}>" for n, t in cols))
        self.make = Row(*p.KEYS, *p.OUT)

    def _packed(self, rows: list[tuple]) -> list[tuple]:
        return [tuple(map(list, zip(*rows[i:i + self.PACK]))) for i in range(0, len(rows), self.PACK)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        names = [*self.inner.KEYS, "ts_us", "seq", *self.inner.FIELDS]
        at, first, new = len(self.key_types), None, []

        def put():
            nonlocal first, new
            if new:
                first = min(r[at] for r in new) if first is None else min(first, *[r[at] for r in new])
                self.waiting.appendList(self._packed(new))
                new = []
        for r in rows:
            row = tuple(r[n] for n in names)
            if row[at] < FLUSH_US:      # the flush row only moves the watermark
                new.append(row)
                if len(new) == self.PACK:
                    put()
        put()
        if first is not None:
            self.handle.registerTimer(_ms_ceil(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        # eager, as in `OrderedProcessor`
        return iter(self._advance(timerValues.getCurrentWatermarkInMs() * 1000))

    def _advance(self, wm_us: int) -> list[Row]:
        p, at = self.inner, len(self.key_types)
        ready, rest = {}, []
        for pack in self.waiting.get():
            for r in zip(*pack):
                if r[at] <= wm_us:
                    ready.setdefault(r[:at], []).append(r[at:])
                else:
                    rest.append(r)
        due = (self.due.get() or (None,))[0]
        passed = due is not None and due <= wm_us
        if not ready and not passed:
            return []
        held = {tuple(k): tuple(v) for k, v in self.own.iterator()} if passed else None
        empty = not passed and not self.own.exists()
        waits = {r[:at] for r in rest}
        left = [] if passed or due is None else [due]
        out, todo = [], list(ready)
        for k, v in (held or {}).items():
            if k not in ready and v[0] is not None:
                todo.append(k) if v[0] <= wm_us else left.append(v[0])
        for k in todo:
            old = held.get(k) if passed else None if empty or not self.own.containsKey(k) else tuple(self.own.getValue(k))
            p._dl, s = (None, list(p.INITIAL)) if old is None else (old[0], list(old[1:]))
            p._forget = False
            done = p._run(s, sorted(ready.get(k, ()), key=lambda r: r[:2]), wm_us)
            names = tuple(_py(x) for x in k)
            out += [self.make(*names, *o) for o in done]
            now = (p._dl, *s)
            if p._dl is None and (tuple(s) == tuple(p.INITIAL) or (p._forget and k not in waits)):
                if old is not None:
                    self.own.removeKey(k)
            elif now != old:
                self.own.updateValue(k, now)
            if p._dl is not None:
                left.append(p._dl)
        low = min(left, default=None)
        if low != due:
            self.due.update((low,))
            if low is not None:
                self.handle.registerTimer(_ms_ceil(low))
        if ready and rest:
            self.waiting.put(self._packed(rest))
            self.handle.registerTimer(_ms_ceil(min(r[at] for r in rest)))
        elif ready:
            self.waiting.clear()
        return out

    def close(self) -> None:
        pass


# ---------------------------------------------------------------------------
class ChangeAlert(OrderedProcessor):
    """Compare each reading with the key's previous one (initially
    `initial`); |diff| > threshold -> (last, cur), else (0.0, 0.0)."""

    FIELDS = ("value",)
    FIELD_TYPES = ("double",)
    STATE = "last double"
    OUT = ("seq", "ts_us", "last_value", "cur_value")

    def __init__(self, keys, threshold: float, initial: float = 0.0):
        self.KEYS = tuple(keys)
        self.threshold = threshold
        self.INITIAL = (initial,)

    def on_row(self, s, ts_us, seq, fields):
        cur, last = fields[0], s[0]
        s[0] = cur
        if cur is not None and last is not None and abs(cur - last) > self.threshold:
            return [(seq, ts_us, float(last), float(cur))]
        return [(seq, ts_us, 0.0, 0.0)]


class DailyCap(OrderedProcessor):
    """K7: the first `cap` rows of a key per UTC day pass (output "pass");
    the first row over the cap raises one alarm (output "alarm"), once per
    key for ever (scope "lifetime") or once per day (scope "day").  A
    deadline at the next midnight resets the day counter."""

    STATE = "day bigint, n bigint, alarm_day bigint"
    INITIAL = (None, 0, None)
    OUT = ("output", "seq", "ts_us")

    def __init__(self, keys, cap: int, alarm_scope: str = "lifetime"):
        self.KEYS = tuple(keys)
        self.cap, self.scope = cap, alarm_scope

    def on_row(self, s, ts_us, seq, fields):
        day = ts_us // _DAY_US
        if s[0] != day:
            s[0], s[1] = day, 0
        if s[1] < self.cap:
            s[1] += 1
            if s[1] == 1:
                self.set_deadline((day + 1) * _DAY_US)
            return [("pass", seq, ts_us)]
        if s[2] is not None and (self.scope == "lifetime" or s[2] == day):
            return []
        s[2] = day
        return [("alarm", seq, ts_us)]

    def on_deadline(self, s, when_us):
        s[0], s[1] = None, 0
        return []


class OrderStatus(OrderedProcessor):
    """K9: per order, the first create and the first pay.  A verdict is
    emitted when both are known (ok / paid_late); if the partner has not come
    `limit_s` after the first event, `unpaid` or `pay_without_create` is
    emitted at that deadline and corrected if the partner comes later.  Each
    verdict carries a running number `n`; the last one per order equals the
    batch `order_status`.  Every event of another type gives a `bad_type` row
    (n = 0) of its own.

    `retention_s` after its last verdict an order is forgotten (None: never);
    a partner that comes later than that starts a new order."""

    FIELDS = ("event_type",)
    FIELD_TYPES = ("string",)
    ORDERED = False     # the verdict depends on the earliest create and pay only
    STATE = "create_us bigint, pay_us bigint, n bigint, settled bigint"
    INITIAL = (None, None, 0, 0)
    OUT = ("status", "create_us", "pay_us", "delay_s", "n")

    def __init__(self, keys, limit_s: int, retention_s: int | None = None):
        self.KEYS = tuple(keys)
        self.limit_s, self.retention_s = limit_s, retention_s

    def _verdict(self, s, when_us):
        c, p = s[0], s[1]
        if c is not None and p is not None:
            delay = p // 1_000_000 - c // 1_000_000
            status = "paid_late" if delay > self.limit_s else "ok"
        else:
            delay = None
            status = "unpaid" if c is not None else "pay_without_create"
        s[2], s[3] = s[2] + 1, 1
        if self.retention_s is None:
            self.clear_deadline()
        else:
            self.set_deadline(when_us + self.retention_s * 1_000_000)
        return [(status, c, p, delay, s[2])]

    def on_row(self, s, ts_us, seq, fields):
        side = {"create": 0, "pay": 1}.get(fields[0])
        if side is None:
            if s[0] is None and s[1] is None:
                self.forget()
            return [("bad_type", None, None, None, 0)]
        if s[side] is not None and s[side] <= ts_us:
            return []          # later repeats do not change the verdict
        s[side] = ts_us        # the earliest create / pay counts
        self._forget = False
        if s[0] is not None and s[1] is not None:
            return self._verdict(s, max(s[0], s[1]))
        s[3] = 0
        self.set_deadline(ts_us + self.limit_s * 1_000_000)
        return []

    def on_deadline(self, s, when_us):
        if not s[3]:
            return self._verdict(s, when_us)
        self.forget()
        return []


class RiseTimer(OrderedProcessor):
    """K5: a reading above the previous one (the first is compared with
    `initial`) starts a timer when none is pending; a reading below cancels
    it; equal readings do nothing.  When the timer fires (`interval_s` after
    the rise) an alert is emitted and the timer cleared, so one run of rises
    can alert again."""

    FIELDS = ("value",)
    FIELD_TYPES = ("double",)
    STATE = "last double"
    OUT = ("start_us", "alert_us")

    def __init__(self, keys, interval_s: int, initial: float = 0.0):
        self.KEYS = tuple(keys)
        self.interval_us = interval_s * 1_000_000
        self.INITIAL = (initial,)

    def on_row(self, s, ts_us, seq, fields):
        cur, last = fields[0], s[0]
        s[0] = cur
        if cur is None or last is None:
            return []          # a null reading is neither a rise nor a fall, nor is the one after it
        if cur > last and self._dl is None:
            self.set_deadline(ts_us + self.interval_us)
        elif cur < last:
            self.clear_deadline()
        return []

    def on_deadline(self, s, when_us):
        return [(when_us - self.interval_us, when_us)]


class FollowedBy(OrderedProcessor):
    """K3/K4: `begin(first).followedBy(second).within(within_s)` per key.
    Pending `first` events wait for the first later `second` event; it
    matches every pending one whose age is below `within_s` (output "match");
    a pending event whose deadline passes first times out (output
    "timeout", at start + within).  State: the pending starts, bounded by the
    time limit."""

    FIELDS = ("kind",)
    FIELD_TYPES = ("string",)
    ITEMS = "a_us bigint, a_seq bigint"
    OUT = ("output", "a_seq", "a_us", "b_seq", "b_us")

    def __init__(self, keys, within_s: int):
        self.KEYS = tuple(keys)
        self.within_us = within_s * 1_000_000

    def _timeouts(self, items):
        return [("timeout", a_seq, a_us, None, a_us + self.within_us) for a_us, a_seq in items]

    def on_row(self, s, ts_us, seq, fields):
        if fields[0] == "a":
            self.pending.append((ts_us, seq))
            if len(self.pending) == 1:
                self.set_deadline(ts_us + self.within_us)
            return []
        if fields[0] != "b" or not self.pending:
            return []
        late = [p for p in self.pending if ts_us - p[0] >= self.within_us]
        out = self._timeouts(late) + [("match", a_seq, a_us, seq, ts_us) for a_us, a_seq in self.pending[len(late):]]
        self.keep_pending([])
        self.clear_deadline()
        self.forget()
        return out

    def on_deadline(self, s, when_us):
        due = [p for p in self.pending if p[0] + self.within_us <= when_us]
        self.keep_pending(self.pending[len(due):])
        if self.pending:
            self.set_deadline(self.pending[0][0] + self.within_us)
        else:
            self.forget()
        return self._timeouts(due)


class NextPattern(OrderedProcessor):
    """K2: `begin(first).next(second).within(within_s)` per key: the very next
    event of the key.  The last event is carried across micro-batches."""

    FIELDS = ("is_first", "is_second")
    FIELD_TYPES = ("boolean", "boolean")
    STATE = "last_us bigint, last_seq bigint, last_first boolean"
    INITIAL = (None, None, None)
    OUT = ("a_seq", "a_us", "b_seq", "b_us")

    def __init__(self, keys, within_s: int):
        self.KEYS = tuple(keys)
        self.within_us = within_s * 1_000_000

    def on_row(self, s, ts_us, seq, fields):
        out = []
        if fields[1] and s[2] and ts_us - s[0] < self.within_us:
            out.append((s[1], s[0], seq, ts_us))
        s[:] = [ts_us, seq, bool(fields[0])]
        return out


class RepeatedFailure(OrderedProcessor):
    """K6: a failure within `max_gap_s` of the key's first failure
    (mode="first", never replaced, as in the reference) or of its previous
    failure (mode="previous") raises an alert."""

    STATE = "ref_us bigint, ref_seq bigint"
    INITIAL = (None, None)
    OUT = ("seq", "ts_us", "ref_seq", "ref_us")

    def __init__(self, keys, max_gap_s: int, mode: str = "first"):
        self.KEYS = tuple(keys)
        self.gap_us = max_gap_s * 1_000_000
        self.mode = mode

    def on_row(self, s, ts_us, seq, fields):
        out = []
        if s[0] is not None and abs(ts_us - s[0]) <= self.gap_us:
            out.append((seq, ts_us, s[1], s[0]))
        if s[0] is None or self.mode == "previous":
            s[0], s[1] = ts_us, seq
        return out


class TopOfWindow(StatefulProcessor):
    """The `n` best (score, keys) rows of a window, score descending,
    then keys ascending, kept as a heap of at most `n` typed state rows and
    emitted, ranked, when the watermark passes the window's end.  The grouping
    key is (window_end, salt)."""

    def __init__(self, n: int, keys: list[str], types: list[str]):
        self.n, self.keys, self.types = n, keys, types

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", ", ".join(["neg bigint", *[f"k{i} {t}" for i, t in enumerate(self.types)]]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.best.get()]
        # nulls sort first, as in the batch form
        order = lambda r: (r[0], *[(v is not None, v) for v in r[1:]])
        best = heapq.nsmallest(self.n, _chain(held, ((-r["score"], *[r[k] for k in self.keys]) for r in rows)), key=order)
        self.best.put(best)
        if not held:
            self.handle.registerTimer(int(key[0].timestamp() * 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        make = Row("window_end", "score", *self.keys)
        out = [make(key[0], -r[0], *r[1:]) for r in self.best.get()]
        self.best.clear()
        return iter(out)

    def close(self) -> None:
        pass


class CountWithLate(StatefulProcessor):
    """Rows per window that came before the watermark reached the
    window's end ("count", given when it does) and, one by one, the rows that
    came after ("late").  A window closes as soon as the watermark reaches its
    end, and each row is in exactly one of the two outputs.  The grouping key
    is (start_us, salt)."""

    OUT = ("output", "start_us", "n", "seq", "ts_us")

    def __init__(self, size_us: int):
        self.size_us = size_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end_us = key[0] + self.size_us
        make = Row(*self.OUT)
        if end_us <= timerValues.getCurrentWatermarkInMs() * 1000:
            return iter([make("late", key[0], None, r["seq"], r["ts_us"]) for r in rows if r["ts_us"] < FLUSH_US])
        n = sum(1 for r in rows if r["ts_us"] < FLUSH_US)
        if n:
            held = self.count.get()
            if held is None:
                self.handle.registerTimer(_ms_ceil(end_us))
            self.count.update((n + (held[0] if held else 0),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n = self.count.get()[0]
        self.count.clear()
        return iter([Row(*self.OUT)("count", key[0], n, None, None)])

    def close(self) -> None:
        pass


def count_with_late(stream: DataFrame, size_s: int, salts: int = 4) -> DataFrame:
    """(output, start_us, n, seq, ts_us) of a watermarked stream with `ts`
    and `seq`: "count" rows hold a part of a window's count each (a window is
    spread over `salts` groups; add them up), "late" rows one late row each.
    Rows without a time are in no window."""
    us = F.unix_micros("ts")
    rows = stream.where(F.col("ts").isNotNull()).select(
        (us - F.pmod(us, F.lit(size_s * 1_000_000))).alias("start_us"), F.pmod(F.xxhash64("seq"), F.lit(salts)).cast("int").alias("salt"),
        us.alias("ts_us"), "seq")
    return rows.groupBy("start_us", "salt").transformWithState(
        statefulProcessor=CountWithLate(size_s * 1_000_000),
        outputStructType="output string, start_us bigint, n bigint, seq bigint, ts_us bigint",
        outputMode="Append", timeMode="EventTime")


class RiseClock(StatefulProcessor):
    """Alert when a key's value has not fallen for `hold_ms` of the
    clock after a rise.  A rise arms a processing-time timer, a fall takes it
    back, an equal value leaves it; it fires without further input.  The first
    value is no rise (nothing to compare it with), nor is a null, which is
    passed over.  Rows of a micro-batch are taken in (ts, seq) order."""

    def __init__(self, keys: list[str], hold_ms: int):
        self.keys, self.hold_ms = keys, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.own = handle.getValueState("own", "last double, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, armed = self.own.get() or (None, None)
        due = armed
        for _, _, v in sorted((r["ts_us"], r["seq"], r["value"]) for r in rows if r["value"] is not None):
            if last is not None and v > last and due is None:
                due = timerValues.getCurrentProcessingTimeInMs() + self.hold_ms
            elif last is not None and v < last:
                due = None
            last = v
        if due != armed:
            if armed is not None:
                self.handle.deleteTimer(armed)
            if due is not None:
                self.handle.registerTimer(due)
        self.own.update((last, due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        when = expiredTimerInfo.getExpiryTimeInMs()
        last, due = self.own.get()
        if due != when:
            return iter(())
        self.own.update((last, None))
        return iter([Row(*self.keys, "alert_ms")(*key, when)])

    def close(self) -> None:
        pass


def rise_by_clock(stream: DataFrame, keys: list[str], hold_ms: int) -> DataFrame:
    """Keys..., alert_ms of `RiseClock` over a stream with `ts`, `seq`,
    `value`.  It needs no watermark; results follow the clock, so they are not
    repeatable (`RiseTimer` is the event-time form)."""
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    rows = stream.select(*keys, F.unix_micros("ts").alias("ts_us"), "seq", F.col("value").cast("double").alias("value"))
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=RiseClock(keys, hold_ms), outputStructType=f"{', '.join(f'{k} {types[k]}' for k in keys)}, alert_ms bigint",
        outputMode="Append", timeMode="ProcessingTime")


# ---------------------------------------------------------------------------
# Stand-in for a null key (the flush row has null keys).  A null in an integer
# key column would turn the whole Arrow batch of keys into floats on the
# Python side, and float keys do not address the right state.
_NULL_KEY = {"bigint": -(2 ** 63), "int": -(2 ** 31), "string": "\u0000null"}


def apply(stream: DataFrame, keys: list[str], processor: OrderedProcessor, out_schema: str,
          fields: tuple[str, ...] = (), rows: bool = True, buckets: int | None = None) -> DataFrame:
    """Run a processor per key over a watermarked stream with `ts` and `seq`.
    Null keys are grouped under a stand-in value and come out as null.
    `buckets`: deal the keys by hash to so many groups, each worked by one
    `Bucketed` processor (fixed for the life of a checkpoint; a task holds the
    rows of a bucket that one advance of the watermark makes due).
    rows=True uses the row-based `transformWithState` (cheaper for many small
    keys); rows=False the pandas-based `transformWithStateInPandas`."""
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    for k in keys:
        if types[k] not in _NULL_KEY:
            raise TypeError(f"key {k} must be bigint, int or string, not {types[k]}")
    cols = [F.coalesce(F.col(k), F.lit(_NULL_KEY[types[k]]).cast(types[k])).alias(k)
            for k in keys]
    cols += [F.unix_micros("ts").alias("ts_us"), "seq"] + list(fields or processor.FIELDS)
    key_schema = ", ".join(f"{k} {types[k]}" for k in keys)
    processor.ROWS = rows or bool(buckets)
    if buckets:
        rows, processor = True, Bucketed(processor, [types[k] for k in keys])
        g = stream.select(*cols).withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).groupBy("__bucket")
    else:
        g = stream.select(*cols).groupBy(*keys)
    run = g.transformWithState if rows else g.transformWithStateInPandas
    out = run(statefulProcessor=processor, outputStructType=f"{key_schema}, {out_schema}",
              outputMode="Append", timeMode="EventTime")
    return out.select(*[F.when(F.col(k) != F.lit(_NULL_KEY[types[k]]).cast(types[k]), F.col(k))
                        .alias(k) for k in keys],
                      *[c for c in out.columns if c not in keys])

