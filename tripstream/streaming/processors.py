"""Stateful processors for ``transformWithState`` (keyed state + event-time timers).

Each processor keeps per-key state in the state store (RocksDB provider), so
state is checkpointed with the query and survives executor loss and restarts.
Rows are Row objects; timestamps are Python datetimes (UTC).
"""

from __future__ import annotations

import bisect
import datetime as _dt
from typing import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

_EPOCH = _dt.datetime(1970, 1, 1)


def to_us(t) -> int:
    """Microseconds since the epoch (state keeps full timestamp precision)."""
    if t is None:
        return None
    if t.tzinfo is not None:
        t = t.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return (t - _EPOCH) // _dt.timedelta(microseconds=1)


def from_us(us: int) -> _dt.datetime:
    return _EPOCH + _dt.timedelta(microseconds=us)


def timer_ms(us: int) -> int:
    """Timer time (ms) at which the watermark has certainly reached ``us``."""
    return -((-us) // 1000)


class _OneTimer:
    """Keeps one pending event-time timer per key, at the earliest time that still
    has work, instead of one timer per row: far fewer state-store calls. When it
    fires, everything up to the current watermark is handled at once."""

    def _init_timer(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self._next = handle.getValueState("nextTimer", "ms long")

    def _arm(self, us: int) -> None:
        ms = timer_ms(us)
        cur = self._next.get()
        if cur is None or ms < cur[0]:
            if cur is not None:
                self.handle.deleteTimer(cur[0])
            self.handle.registerTimer(ms)
            self._next.update((ms,))

    def _fired(self, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> int:
        """Forget the fired timer; return the time (us) up to which work is due."""
        self._next.clear()
        return max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000


RIDE_STATE = ("rideId long, taxiId long, driverId long, isStart boolean, startTime timestamp, "
              "endTime timestamp, eventTime timestamp, startLon float, startLat float, endLon float, "
              "endLat float, passengerCnt smallint")
RIDE_FIELDS = [f.split()[0] for f in RIDE_STATE.split(", ")]


class LongRidesProcessor(StatefulProcessor):
    """T8/T10 keyed by rideId: a START is emitted when the watermark reaches
    start + limit unless an END with event time <= start + limit (< if strict)
    was seen. Deciding on END *event time* makes the result independent of how
    the input is cut into micro-batches."""

    def __init__(self, limit_minutes: int = 120, strict: bool = False):
        self.limit_us = int(limit_minutes) * 60_000_000
        self.strict = strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.start = handle.getValueState("start", RIDE_STATE)
        self.end = handle.getValueState("endUs", "endUs long")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        for r in rows:
            t = to_us(r.eventTime)
            if r.isStart:
                if not self.start.exists():
                    self.start.update(tuple(r[f] for f in RIDE_FIELDS))
                    self.handle.registerTimer(timer_ms(t + self.limit_us))
            else:
                prev = self.end.get()
                if prev is None or t < prev[0]:
                    self.end.update((t,))
                if not self.start.exists():
                    self.handle.registerTimer(timer_ms(t + self.limit_us))  # clean-up without START
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        s = self.start.get()
        if s is None:
            self.end.clear()
            return iter([])
        deadline = to_us(s[RIDE_FIELDS.index("eventTime")]) + self.limit_us
        if expiredTimerInfo.getExpiryTimeInMs() < timer_ms(deadline):
            return iter([])
        e = self.end.get()
        ended = e is not None and (e[0] < deadline if self.strict else e[0] <= deadline)
        self.start.clear()
        self.end.clear()
        for ts in self.handle.listTimers():
            self.handle.deleteTimer(ts)
        if ended:
            return iter([])
        return iter([Row(**dict(zip(RIDE_FIELDS, s)))])

    def close(self) -> None:
        pass


class AsOfJoinProcessor(_OneTimer, StatefulProcessor):
    """J3 keyed by customerId over the union of trades (side 1) and customer
    rows (side 0). A trade waits until the watermark reaches its time, then is
    emitted with the newest customer row at or before it; late trades are
    dropped; customer rows older than the newest one below the watermark are
    pruned."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._init_timer(handle)
        self.customers = handle.getListState("customers", "t long, info string")  # t in us
        self.trades = handle.getListState("trades", "t long, info string")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        new_c, new_t = [], []
        for r in rows:
            t = to_us(r.eventTime)
            if r.side == 0:
                new_c.append((t, r.info))
            elif t >= wm:
                new_t.append((t, r.info))
        if new_c:
            self.customers.appendList(new_c)
        if new_t:
            self.trades.appendList(new_t)
        if new_c or new_t:
            # a customer without trades is pruned too
            self._arm(max(min(t for t, _ in new_c + new_t), wm + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = self._fired(timerValues, expiredTimerInfo)
        cust = sorted(self.customers.get() or [])
        pending = sorted(self.trades.get() or [])
        due = bisect.bisect_right(pending, now, key=lambda x: x[0])
        out, at = [], 0
        for t, info in pending[:due]:          # both in time order: one pass
            while at < len(cust) and cust[at][0] <= t:
                at += 1
            match = cust[at - 1] if at else None
            out.append(Row(eventTime=from_us(t), customerId=key[0], tradeInfo=info,
                           customerTime=from_us(match[0]) if match else None,
                           customerInfo=match[1] if match else None))
        keep = pending[due:]
        self.trades.clear()
        if keep:
            self.trades.put(keep)
        # of the customers up to the oldest pending time only the newest can match
        horizon = min([now, *(t for t, _ in keep[:1])])
        older = bisect.bisect_right(cust, horizon, key=lambda x: x[0])
        kept = cust[max(older - 1, 0):]
        self.customers.clear()
        if kept:
            self.customers.put(kept)
        # the next trade, or the next customer that makes an older one useless
        ahead = [x[0][0] for x in (keep, kept[1:]) if x]
        if ahead:
            self._arm(max(min(ahead), now + 1))
        return iter(out)

    def close(self) -> None:
        pass


class LatestJoinProcessor(_OneTimer, StatefulProcessor):
    """J4 keyed by customerId: a trade is joined at once with the last customer
    row received before it (arrival order); without one it waits until the
    watermark reaches its time and then takes the last customer row that had
    arrived by its time plus the watermark delay (possibly none)."""

    def __init__(self, delay_us: int = 0):
        self.delay_us = delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._init_timer(handle)
        # (arrival us, customer time us, info), pruned to what pending trades can still see
        self.customers = handle.getListState("customers", "a long, t long, info string")
        self.waiting = handle.getListState("waiting", "t long, info string")

    def _row(self, key, t, info, c):
        return Row(eventTime=from_us(t), customerId=key[0], tradeInfo=info,
                   customerTime=from_us(c[1]) if c else None, customerInfo=c[2] if c else None)

    @staticmethod
    def _last_by(cust, limit):
        k = bisect.bisect_right(cust, limit, key=lambda c: c[0])
        return cust[k - 1] if k else None

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        cust = sorted(self.customers.get() or [])
        out, wait = [], []
        for r in sorted(rows, key=lambda r: (r.arrival, r.side)):
            a, t = to_us(r.arrival), to_us(r.eventTime)
            if r.side == 0:
                bisect.insort(cust, (a, t, r.info))
                continue
            c = self._last_by(cust, a)
            if c is not None:
                out.append(self._row(key, t, r.info, c))
            elif t >= wm:
                wait.append((t, r.info))
        if wait:
            self.waiting.appendList(wait)
            self._arm(min(t for t, _ in wait))
        # only the last row before the watermark and before the oldest waiting
        # trade can still be asked for, and the rows after it
        horizon = min([wm, *(t for t, _ in self.waiting.get() or [])])
        older = [c for c in cust if c[0] <= horizon]
        kept = older[-1:] + cust[len(older):]
        self.customers.clear()
        if kept:
            self.customers.put(kept)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._fired(timerValues, expiredTimerInfo)
        cust = sorted(self.customers.get() or [])
        out, keep = [], []
        for t, info in list(self.waiting.get() or []):
            if t <= now:
                out.append(self._row(key, t, info, self._last_by(cust, t + self.delay_us)))
            else:
                keep.append((t, info))
        self.waiting.clear()
        if keep:
            self.waiting.put(keep)
            self._arm(min(t for t, _ in keep))
        horizon = min([t for t, _ in keep] + [now])
        older = [c for c in cust if c[0] <= horizon]
        kept = older[-1:] + [c for c in cust if c[0] > horizon]
        self.customers.clear()
        if kept:
            self.customers.put(kept)
        return iter(out)

    def close(self) -> None:
        pass


class EventSortProcessor(_OneTimer, StatefulProcessor):
    """O1 keyed by carId: buffer events, emit them in event-time order once the
    watermark passes them; events already behind the watermark are dropped."""

    def __init__(self, fields: list[str], schema: str):
        self.fields = fields
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._init_timer(handle)
        self.buffer = handle.getListState("buffer", self.schema)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        new, first = [], None
        for r in rows:
            t = to_us(r.eventTime)
            if t < wm:
                continue
            new.append(tuple(r[f] for f in self.fields))
            first = t if first is None else min(first, t)
        if new:
            self.buffer.appendList(new)
            self._arm(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._fired(timerValues, expiredTimerInfo)
        ti = self.fields.index("eventTime")
        ii = self.fields.index("id")
        items = list(self.buffer.get() or [])
        due = sorted((x for x in items if to_us(x[ti]) <= now), key=lambda x: (x[ti], x[ii]))
        rest = [x for x in items if to_us(x[ti]) > now]
        self.buffer.clear()
        if rest:
            self.buffer.put(rest)
            self._arm(min(to_us(x[ti]) for x in rest))
        return iter([Row(**dict(zip(self.fields, x))) for x in due])

    def close(self) -> None:
        pass


class RunningMinProcessor(StatefulProcessor):
    """W2 keyed by query id: pass a report only if it is strictly below every
    earlier report of its key (arrival order; rows of one micro-batch are taken
    in event-time order)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "km float")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        b = self.best.get()
        cur = b[0] if b else None
        out = []
        for r in sorted(rows, key=lambda r: (r.eventTime, r.rideId)):
            if cur is None or r.km < cur:
                cur = r.km
                out.append(r)
        if cur is not None:
            self.best.update((cur,))
        return iter(out)

    def close(self) -> None:
        pass


class ResettingMinProcessor(StatefulProcessor):
    """B3 keyed by query id: W2 with a reset. A query's minimum is forgotten when
    it has not improved for ``reset`` (event-time timers)."""

    def __init__(self, reset_ms: int):
        self.reset_us = reset_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "km float, at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        b = self.best.get()
        out = []
        for r in sorted(rows, key=lambda r: (r.eventTime, r.rideId)):
            t = to_us(r.eventTime)
            if b is not None and t - b[1] > self.reset_us:
                b = None
            if b is None or r.km < b[0]:
                b = (r.km, t)
                out.append(Row(queryId=r.queryId, eventTime=r.eventTime, rideId=r.rideId,
                               taxiId=r.taxiId, km=r.km))
                self.handle.registerTimer(timer_ms(t + self.reset_us))
        if b is not None:
            self.best.update(b)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        b = self.best.get()
        if b is not None and expiredTimerInfo.getExpiryTimeInMs() >= timer_ms(b[1] + self.reset_us):
            self.best.clear()
        return iter([])

    def close(self) -> None:
        pass


class ChangingSumProcessor(StatefulProcessor):
    """T15/T20 keyed by (key, window end): the sum of the window, first when the
    watermark shows that the window has ended, then again with every batch that
    brings late rows, as a change: the row shown before (``added`` false) and the
    new one (true). The query's watermark stays ``lateness`` behind the one that
    ends windows, so a window has ended ``lateness`` before its end by it, and is
    forgotten at its end."""

    def __init__(self, lateness_ms: int, digits: int):
        self.lateness_ms, self.digits = lateness_ms, digits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "total double, shown double")

    def _row(self, key, tips, added: bool) -> Row:
        return Row(windowEnd=key[1], driverId=key[0], tips=tips, added=added)

    def _show(self, key, total, shown):
        """(changes, what is shown now)."""
        new = round(total, self.digits)
        if shown is None:
            return [self._row(key, new, True)], new
        if shown == new:
            return [], shown
        return [self._row(key, shown, False), self._row(key, new, True)], new

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end, now = timer_ms(to_us(key[1])), timerValues.getCurrentWatermarkInMs()
        if now >= end:                       # too late; what is left to show comes with the timer
            return iter([])
        total, shown = self.sums.get() or (None, None)
        out = []
        if total is None:
            total = 0.0
            for at in {end - self.lateness_ms, end}:
                self.handle.registerTimer(at)
        elif now >= end - self.lateness_ms and shown is None:
            out, shown = self._show(key, total, shown)      # had ended before these rows
        for r in rows:
            total += r.value or 0.0
        if now >= end - self.lateness_ms:
            changes, shown = self._show(key, total, shown)
            out += changes
        self.sums.update((total, shown))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        total, shown = self.sums.get() or (None, None)
        out = []
        if total is not None and shown is None:
            out, shown = self._show(key, total, shown)
            self.sums.update((total, shown))
        if expiredTimerInfo.getExpiryTimeInMs() >= timer_ms(to_us(key[1])):
            self.sums.clear()
        return iter(out)

    def close(self) -> None:
        pass


class RunningCountProcessor(StatefulProcessor):
    """T20 keyed by driver: the number of rows so far as changes, one per batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "cnt long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.count.get()
        new = (old[0] if old else 0) + sum(1 for _ in rows)
        self.count.update((new,))
        out = [Row(driverId=key[0], cnt=old[0], added=False)] if old else []
        return iter([*out, Row(driverId=key[0], cnt=new, added=True)])

    def close(self) -> None:
        pass


class TravelTimeProcessor(StatefulProcessor):
    """B6 keyed by (cell, direction): regression sums learned from END events;
    each START gets int(slope * distance), or -1 with fewer than two points."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.model = handle.getValueState("model", "sxy double, sxx double, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        m = self.model.get()
        sxy, sxx, n = m if m else (0.0, 0.0, 0)
        out = []
        for r in sorted(rows, key=lambda r: (r.eventTime, not r.isStart, r.rideId)):
            if r.isStart:
                ok = n >= 2 and abs(sxx) >= 10 * 4.9e-324
                # saturates at the int range, as the batch form does
                pred = int(min(max(sxy / sxx * r.distance, -2147483648.0), 2147483647.0)) if ok else -1
                out.append(Row(rideId=r.rideId, eventTime=r.eventTime, cell=key[0],
                               direction=key[1], predictedMinutes=pred))
            else:
                sxy += r.distance * r.minutes
                sxx += r.distance * r.distance
                n += 1
        self.model.update((sxy, sxx, n))
        return iter(out)

    def close(self) -> None:
        pass


class RuleMatchProcessor(StatefulProcessor):
    """B5 keyed by color. Two indexes lead from an item's shape to the rules it
    completes and to those it opens, so only these rules' waiting lists are read,
    changed and written back, once per batch."""

    def __init__(self, rules):
        self.completes, self.opens = {}, {}
        for i, (first, second) in enumerate(rules):
            self.completes.setdefault(second, []).append(f"Rule_{i}")
            self.opens.setdefault(first, []).append(f"Rule_{i}")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getMapState("waiting", "rule string", "seqs array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lists: dict[str, list[int]] = {}

        def pending(rule):
            if rule not in lists:
                lists[rule] = list(self.waiting.getValue((rule,))[0]) if self.waiting.containsKey((rule,)) else []
            return lists[rule]

        out = []
        for item in sorted(rows, key=lambda r: r.seq):
            for rule in self.completes.get(item.shape, ()):
                out += [Row(rule=rule, color=key[0], firstSeq=s, secondSeq=item.seq) for s in pending(rule)]
                lists[rule] = []
            for rule in self.opens.get(item.shape, ()):
                pending(rule).append(item.seq)
        for rule, seqs in lists.items():
            if seqs:
                self.waiting.updateValue((rule,), (seqs,))
            elif self.waiting.containsKey((rule,)):
                self.waiting.removeKey((rule,))
        return iter(out)

    def close(self) -> None:
        pass


class StopSegmentsProcessor(_OneTimer, StatefulProcessor):
    """T6 keyed by carId: buffer events; once the watermark passes a stop event,
    emit the statistics of the buffered events strictly before that stop, then
    evict everything up to it (stops are handled in time order). T7 with
    ``need_previous_stop``: only runs that have a stop before them."""

    def __init__(self, digits: int = 6, need_previous_stop: bool = False):
        self.digits = digits
        self.need_previous_stop = need_previous_stop

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._init_timer(handle)
        self.buffer = handle.getListState("buffer", "t long, speed double, throttle double, isStop boolean")  # t in us
        self.had_stop = handle.getValueState("hadStop", "hadStop boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(to_us(r.eventTime), float(r.speed), float(r.throttle), r.speed == 0.0) for r in rows]
        if new:
            self.buffer.appendList(new)
            stops = [x[0] for x in new if x[3]]
            if stops:
                self._arm(min(stops))
        return iter([])

    def _stats(self, key, stop, seg):
        n = len(seg)
        mean = sum(x[2] for x in seg) / n
        err = (sum((x[2] - mean) ** 2 for x in seg) / n) ** 0.5
        k = int(err / 2.5)                     # the exact value decides, as in the batch form
        desc = "calm" if k == 0 else "busy" if k == 1 else "crazy"
        return Row(carId=key[0], stopTime=from_us(stop), length=n,
                   startTime=from_us(min(x[0] for x in seg)),
                   maxSpeed=int(max(x[1] for x in seg)), erraticness=round(err, self.digits), erraticnessDesc=desc)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._fired(timerValues, expiredTimerInfo)
        items = list(self.buffer.get() or [])
        previous = self.had_stop.exists()
        out = []
        for stop in sorted({x[0] for x in items if x[3] and x[0] <= now}):
            seg = [x for x in items if x[0] < stop]
            items = [x for x in items if x[0] > stop]
            if seg and (previous or not self.need_previous_stop):
                out.append(self._stats(key, stop, seg))
            previous = True
        if previous:
            self.had_stop.update((True,))
        self.buffer.clear()
        if items:
            self.buffer.put(items)
            stops = [x[0] for x in items if x[3]]
            if stops:
                self._arm(min(stops))
        return iter(out)

    def close(self) -> None:
        pass


class RangeCountProcessor(_OneTimer, StatefulProcessor):
    """W1 keyed by cell: for each event, the number of events of its key in
    [t - range, t] (peers included), emitted once the watermark reaches t."""

    def __init__(self, range_us: int):
        self.range_us = range_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._init_timer(handle)
        self.events = handle.getListState("events", "t long, done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        new = [(t, False) for t in (to_us(r.eventTime) for r in rows) if t >= wm]
        if new:
            self.events.appendList(new)
            self._arm(min(t for t, _ in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._fired(timerValues, expiredTimerInfo)
        ev = sorted(self.events.get() or [])
        times = [t for t, _ in ev]
        out, keep = [], []
        for t, done in ev:
            if not done and t <= now:
                lo = bisect.bisect_left(times, t - self.range_us)
                hi = bisect.bisect_right(times, t)
                out.append(Row(cell=str(key[0]), eventTime=from_us(t), cnt=hi - lo))
                done = True
            if not done or t >= now - self.range_us:
                keep.append((t, done))
        self.events.clear()
        if keep:
            self.events.put(keep)
            pending = [t for t, d in keep if not d]
            if pending:
                self._arm(min(pending))
        return iter(out)

    def close(self) -> None:
        pass
