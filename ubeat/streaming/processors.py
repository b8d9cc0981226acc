"""Keyed processors on Spark's state API v2 (``transformWithState``).

A call of the state API from Python costs more than the work on a row, so a processor
is called per bucket of keys (``BUCKETS`` hash buckets, ``stateful.bucketed``) and holds
the states of all keys of its bucket: named list states of columnar chunks, appended to
at each batch (``Waiting``, ``Table``), and event-time timers of the bucket. The calls
grow with the buckets, the rows cost plain Python. The rows of a bucket reach Python as
an iterator, not as a frame.

Event-time processors put rows into a list state until the watermark passes them
(``Waiting``) and take them in event-time order when a timer fires, so the outcome
does not depend on how the input is cut into micro-batches. Rows behind the
watermark are dropped by Spark before they reach a processor.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Hash buckets of keys that share a call; a bucket's rows of a micro-batch and its open states are in memory at once.
BUCKETS = 1024
#: Rows of a state's chunk.
CHUNK = 10_000
LONG, BOOLEAN = T.LongType(), T.BooleanType()


def _ms(us: int) -> int:
    """The first whole millisecond at which a watermark has passed ``us``."""
    return -(-us // 1000)


def _arrays(columns: dict[str, T.DataType]) -> T.StructType:
    """A chunk: an array per column."""
    return T.StructType([T.StructField(name, T.ArrayType(kind)) for name, kind in columns.items()])


def _chunks(rows: Iterable[tuple]) -> Iterator[tuple]:
    it = iter(rows)
    while some := list(islice(it, CHUNK)):
        yield tuple(list(c) for c in zip(*some, strict=True))


def _by_key(rows: Iterable[tuple]) -> dict:
    """Key (first column) -> its rows without it, in order."""
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r[1:])
    for own in out.values():
        own.sort()
    return out


class Waiting:
    """Rows of a bucket that the watermark has not passed: a list state of chunks and a
    timer at the earliest row of every batch that added to it. A row is its key, its event
    time in microseconds and the other columns."""

    def __init__(self, handle: StatefulProcessorHandle, key: T.DataType, **columns: T.DataType):
        self.handle = handle
        self.rows = handle.getListState("waiting", _arrays({"key": key, "us": LONG} | columns))

    def add(self, rows: Iterable[tuple]) -> None:
        chunks = list(_chunks(rows))
        self.rows.appendList(chunks)
        self.handle.registerTimer(_ms(min(min(c[1]) for c in chunks)))

    def take(self, watermark_us: int) -> dict:
        """Key -> rows up to the watermark, in order; a timer stands at what is left."""
        ready, left = [], []
        for chunk in self.rows.get():
            for row in zip(*chunk, strict=True):
                (ready if row[1] <= watermark_us else left).append(row)
        if not ready:
            return {}
        if left:
            self.rows.put(list(_chunks(left)))
            self.handle.registerTimer(_ms(min(r[1] for r in left)))
        else:
            self.rows.clear()
        return _by_key(ready)


class Table:
    """The values of a bucket's keys: a list state of chunks of changes, later ones in
    force. A batch appends what it changed; the state is written anew once it holds twice
    as many changes as keys. The first ``n_keys`` columns are the key."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: dict[str, T.DataType], n_keys: int = 1):
        self.n_keys, self.width = n_keys, len(columns)
        self.log = handle.getListState(name, _arrays(columns | {"live": BOOLEAN}))

    def load(self) -> dict[tuple, tuple]:
        self.logged, self.rows = 0, {}
        for chunk in self.log.get():
            for row in zip(*chunk, strict=True):
                self.logged += 1
                if row[-1]:
                    self.rows[row[:self.n_keys]] = row[self.n_keys:-1]
                else:
                    self.rows.pop(row[:self.n_keys], None)
        return self.rows

    def save(self, changes: dict[tuple, tuple | None]) -> dict[tuple, tuple]:
        """Values (none: the key goes) by key -> the rows now in force."""
        gone = (None,) * (self.width - self.n_keys)
        changes = {k: v for k, v in changes.items() if self.rows.get(k) != v}
        for k, v in changes.items():
            if v is None:
                del self.rows[k]
            else:
                self.rows[k] = v
        if not changes:
            return self.rows
        if not self.rows:
            self.log.clear()
        elif self.logged + len(changes) > 2 * len(self.rows):
            self.log.put(list(_chunks((*k, *v, True) for k, v in self.rows.items())))
        else:
            self.log.appendList(list(_chunks((*k, *(v or gone), v is not None) for k, v in changes.items())))
        return self.rows


class FraudFilter(StatefulProcessor):
    """Number of rows that passed and whether the key was warned. With
    ``day_end_ms`` the last grouping column is a local day, whose end clears the state."""

    def __init__(self, columns: Sequence[str], keys: Sequence[T.StructField], order: Sequence[str], limit: int, text: str,
                 day_end_ms=None):
        self.columns, self.keys, self.order, self.limit = list(columns), list(keys), list(order), limit
        self.text, self.day_end_ms = text, day_end_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        keys = {f"key_{i}": f.dataType for i, f in enumerate(self.keys)}
        self.seen = Table(handle, "seen", keys | {"passed": LONG, "warned": BOOLEAN}, len(keys))

    def _first(self, rows, seen) -> dict[tuple, list]:
        """The first rows of every key in arrival order that can matter, however many there are."""
        names, first = [f.name for f in self.keys], {}

        def cut(key, own):
            return heapq.nsmallest(self.limit - seen.get(key, (0,))[0] + 1, own, key=lambda r: tuple(r[c] for c in self.order))
        for r in rows:
            key = tuple(r[c] for c in names)
            if key in seen and seen[key][1]:
                continue
            own = first.setdefault(key, [])
            own.append(r)
            if len(own) > 2 * self.limit + 100:
                first[key] = cut(key, own)
        return {key: cut(key, own) for key, own in first.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.seen.load()
        if not seen and self.day_end_ms is not None:
            self.handle.registerTimer(self.day_end_ms(key[-1]))
        first, changes = self._first(rows, seen), {}
        for k, own in first.items():
            passed, _ = seen.get(k, (0, False))
            room = self.limit - passed
            changes[k] = (passed + min(room, len(own)), len(own) > room)
            for i, r in enumerate(own):
                tag, text = ("pass", None) if i < room else ("warning", self.text)
                yield Row(**{c: r[c] for c in self.columns}, tag=tag, msg=text)
        self.seen.save(changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.log.clear()
        return iter(())


class LoginFailPair(StatefulProcessor):
    """Time of each user's last fail (cleared by a success)."""

    def __init__(self, key: T.DataType, within_us: int, order: Sequence[str], text: str):
        self.key, self.within_us, self.order, self.text = key, within_us, list(order), text

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = Table(handle, "last", {"key": self.key, "us": LONG})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lasts = self.last.load()
        now = {}
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            k = (r.user_id,)
            last = now[k] if k in now else lasts.get(k)
            if not r.fail:
                now[k] = None
                continue
            if last is not None and r.us < last[0] + self.within_us:
                yield Row(user_id=r.user_id, first_us=last[0], last_us=r.us, msg=self.text)
            now[k] = (r.us,)
        self.last.save(now)


class LoginFailTimer(StatefulProcessor):
    """Each user's open span and a timer at the earliest end of a bucket's spans; a
    success or a later fail ends a span first."""

    def __init__(self, key: T.DataType, n: int, wait_us: int, order: Sequence[str], head: str, tail: str):
        self.key, self.n, self.wait_us, self.order, self.head, self.tail = key, n, wait_us, list(order), head, tail

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = Table(handle, "spans", {"key": self.key, "anchor": LONG, "first": LONG, "last": LONG, "fails": LONG})

    def _alarm(self, user, span) -> list[Row]:
        if span is None or span[3] < self.n:
            return []
        return [Row(user_id=user, first_us=span[1], last_us=span[2], msg=f"{self.head}{span[3]}{self.tail}")]

    def _expire(self, now: dict, spans: dict, watermark_ms: int) -> Iterator[Row]:
        """Alarms of the spans that the watermark has ended; a timer at the next end."""
        for k, span in (spans | now).items():
            if span is not None and _ms(span[0] + self.wait_us) <= watermark_ms:
                yield from self._alarm(k[0], span)
                now[k] = None
        left = self.spans.save(now)
        if left:
            self.handle.registerTimer(min(_ms(s[0] + self.wait_us) for s in left.values()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spans, now = self.spans.load(), {}
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            k = (r.user_id,)
            span = now[k] if k in now else spans.get(k)
            over = span is not None and r.us >= span[0] + self.wait_us
            if over:
                yield from self._alarm(r.user_id, span)
            if not r.fail:
                now[k] = None
            elif span is None or over:
                now[k] = (r.us, r.us, r.us, 1)
            else:
                now[k] = (span[0], span[1], r.us, span[3] + 1)
        yield from self._expire(now, spans, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._expire({}, self.spans.load(), timerValues.getCurrentWatermarkInMs())


class FailSequence(StatefulProcessor):
    """The last ``times - 1`` rows of each user that the watermark has passed,
    dropped once no later row can be within their reach."""

    def __init__(self, key: T.DataType, times: int, within_us: int, text: str):
        self.key, self.times, self.within_us, self.text = key, times, within_us, text

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Waiting(handle, self.key, seq=LONG, fail=BOOLEAN)
        self.tails = Table(handle, "tails", {"key": self.key, "us": T.ArrayType(LONG), "fail": T.ArrayType(BOOLEAN)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.waiting.add((r.user_id, r.us, r.seq, r.fail) for r in rows)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        ready, tails = self.waiting.take(watermark_us), self.tails.load()
        now = {k: None for k, (us, _) in tails.items() if us[-1] + self.within_us <= watermark_us}
        for user, own in ready.items():
            tail = list(zip(*tails.get((user,), ((), ())), strict=True))
            for us, _, fail in own:
                tail = [*tail, (us, fail)][-self.times:]
                if len(tail) == self.times and all(f for _, f in tail) and us - tail[0][0] < self.within_us:
                    yield Row(user_id=user, first_us=tail[0][0], last_us=us, msg=self.text)
            tail = tail[1 - self.times:] if self.times > 1 else []
            open_ = tail and tail[-1][0] + self.within_us > watermark_us
            now[(user,)] = tuple(list(c) for c in zip(*tail, strict=True)) if open_ else None
        left = self.tails.save(now)
        if left and now:
            # One timer, when the last of them is out of reach; others go whenever the bucket is called.
            self.handle.registerTimer(_ms(max(us[-1] for us, _ in left.values()) + self.within_us))


class OrderTimeout(StatefulProcessor):
    """P5: the open create of each order, waiting events, and a timer at the earliest
    end of a bucket's open creates."""

    def __init__(self, key: T.DataType, within_us: int, paid: str, lonely: str, timeout: str):
        self.key, self.within_us, self.paid, self.lonely, self.timeout = key, within_us, paid, lonely, timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.opened = Table(handle, "opened", {"key": self.key, "us": LONG})
        self.waiting = Waiting(handle, self.key, pay=BOOLEAN, seq=LONG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.waiting.add((r.order_id, r.us, r.pay, r.seq) for r in rows)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        ready, stored = self.waiting.take(watermark_us), self.opened.load()
        now = {}
        for order in [*ready, *(k[0] for k, (us,) in stored.items() if k[0] not in ready and us + self.within_us <= watermark_us)]:
            opened = stored.get((order,), (None,))[0]
            out = []
            for us, pay, _ in [*ready.get(order, ()), (watermark_us, None, 0)]:
                if opened is not None and us >= opened + self.within_us:
                    out.append((opened, None, self.timeout))
                    opened = None
                if pay:
                    out.append((opened, us, self.lonely if opened is None else self.paid))
                    opened = None
                elif pay is not None:
                    if opened is not None:
                        out.append((opened, None, self.timeout))
                    opened = us
            now[(order,)] = None if opened is None else (opened,)
            for create, pay, result in out:
                yield Row(order_id=order, create_us=create, pay_us=pay, result=result)
        left = self.opened.save(now)
        if left and now:
            self.handle.registerTimer(_ms(min(us for us, in left.values()) + self.within_us))


class FollowedBy(StatefulProcessor):
    """Pending creates of each key (time -> how many), waiting events, and a timer
    at the earliest end of a bucket's pending creates."""

    def __init__(self, key: T.DataType, within_us: int):
        self.key, self.within_us = key, within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = Table(handle, "pending", {"key": self.key, "us": LONG, "n": LONG}, 2)
        self.waiting = Waiting(handle, self.key, seq=LONG, create=BOOLEAN, pay=BOOLEAN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.waiting.add((r.order_id, r.us, r.seq, r.create, r.pay) for r in rows)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        ready, stored = self.waiting.take(watermark_us), self.pending.load()
        keys, now = {}, {}
        for (order, us), (n,) in stored.items():
            keys.setdefault(order, {})[us] = n
        for order in [*keys, *(k for k in ready if k not in keys)]:
            pending, out = dict(keys.get(order, ())), []

            def expire(at, pending=pending, out=out):
                for us in [c for c in pending if c + self.within_us <= at]:
                    out.extend([(us, None)] * pending.pop(us))

            for us, _, create, pay in ready.get(order, ()):
                expire(us)
                if pay:
                    for c in sorted(pending):
                        out.extend([(c, us)] * pending.pop(c))
                if create:
                    pending[us] = pending.get(us, 0) + 1
            expire(watermark_us)
            now |= {(order, us): None for us in keys.get(order, ())} | {(order, us): (n,) for us, n in pending.items()}
            for create, pay in out:
                yield Row(order_id=order, create_us=create, pay_us=pay)
        left = self.pending.save(now)
        if left and now:
            self.handle.registerTimer(_ms(min(us for _, us in left) + self.within_us))


class NewVisitors(StatefulProcessor):
    """A12, first level: one bucket of a window's visitor bitmap (value state, cleared by a
    timer at the window's end) and the number of bits that a micro-batch sets anew."""

    def __init__(self, bucket_bits: int):
        self.bytes = -(-bucket_bits // 8)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bitmap = handle.getValueState("bitmap", "bits BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.bitmap.get()
        bits = bytearray(found[0]) if found is not None else bytearray(self.bytes)
        new, latest = 0, None
        for r in rows:
            latest = r.ts if latest is None else max(latest, r.ts)
            byte, bit = r.position >> 3, 1 << (r.position & 7)
            if not bits[byte] & bit:
                bits[byte] |= bit
                new += 1
        if found is None:
            self.handle.registerTimer(key[0])
        if new:
            self.bitmap.update((bytes(bits),))
            yield Row(end_ms=key[0], ts=latest, new=new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.bitmap.clear()
        return iter(())


class VisitorCount(StatefulProcessor):
    """A12, second level: the number of visitors of a window so far (value state), given
    out whenever a micro-batch brings new ones. A window gets one row per bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.count.get()
        n = (found[0] if found is not None else 0) + sum(r.new for r in rows)
        if found is None:
            self.handle.registerTimer(key[0])
        self.count.update((n,))
        yield Row(end_ms=key[0], uv=n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.count.clear()
        return iter(())
