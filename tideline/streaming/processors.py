"""Keyed stateful operators over streams.

Within a micro-batch the rows of a key are put in arrival order first; across batches the state
carries on. State is bounded per key: a count, the last value, a ring of rows or the open windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tideline.operators.detect import SMALLEST_POSITIVE


def keyed(
    df: DataFrame, key: Sequence[str], processor: StatefulProcessor, schema: str,
    time_mode: str = "none",
) -> DataFrame:
    """Run a processor over the rows of each key. Keyed state without a key is an error."""
    if not key:
        raise ValueError("keyed state needs at least one key column")
    # output rows carry the names of the schema
    processor.out = Row(*StructType.fromDDL(schema).names)
    return df.groupBy(*key).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append",
        timeMode=time_mode,
    )


class InOrder(StatefulProcessor):
    """Takes a key's rows in the order of the column `order`, with one value of state.

    The state is read and written once per key and micro-batch. `step` is given the state (None
    at first), yields output rows and returns the new state.
    """

    order: str
    state: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.held.get()
        for row in sorted(rows, key=lambda r: r[self.order]):
            state = yield from self.step(key, row, state)
        if state is not None:
            self.held.update(state)

    def step(self, key, row, state):
        raise NotImplementedError

    def close(self) -> None:
        pass


class RunningCount(InOrder):
    """(*key, order, n): the number of rows of the key so far."""

    state = "n bigint"

    def __init__(self, order: str):
        self.order = order

    def step(self, key, row, state):
        n = state[0] + 1 if state else 1
        yield self.out(*key, row[self.order], n)
        return (n,)


class Fold(InOrder):
    """(*key, order, folded): a value folded row by row with `combine`, as reducing state does."""

    def __init__(self, order: str, value: str, kind: str, combine):
        self.order, self.value, self.combine = order, value, combine
        self.state = f"value {kind}"

    def step(self, key, row, state):
        value = row[self.value]
        if value is None:  # a null changes nothing
            folded = state[0] if state else None
        else:
            folded = self.combine(state[0], value) if state and state[0] is not None else value
        yield self.out(*key, row[self.order], folded)
        return (folded,)


class Jump(InOrder):
    """(*key, order, last, current) where a value is `threshold` or more away from the last."""

    state = "last double"

    def __init__(self, order: str, value: str, threshold: float):
        self.order, self.value, self.threshold = order, value, threshold

    def step(self, key, row, state):
        current = row[self.value]
        last = state[0] if state else None
        if last is not None and current is not None and abs(current - last) >= self.threshold:
            yield self.out(*key, row[self.order], last, current)
        return (current,)


class Previous(InOrder):
    """(*key, order, last, current): each row's value with the key's value before it."""

    state = "last string"

    def __init__(self, order: str, value: str):
        self.order, self.value = order, value

    def step(self, key, row, state):
        current = row[self.value]
        if current is None:
            return state
        if state:
            yield self.out(*key, row[self.order], state[0], current)
        return (current,)


class DedupTtl(InOrder):
    """(*key, value, order): rows at `ttl` or more of event time after the key's last output."""

    state = "emitted bigint"

    def __init__(self, order: str, at: str, value: str, ttl: int):
        self.order, self.at, self.value, self.ttl = order, at, value, ttl

    def step(self, key, row, state):
        if state and row[self.at] < state[0] + self.ttl:
            return state
        yield self.out(*key, row[self.value], row[self.order])
        return (row[self.at],)


class Changelog(InOrder):
    """(*key, order, op, cnt, total): takes back the key's last result and adds the new one."""

    state = "cnt bigint, total bigint"

    def __init__(self, order: str, value: str):
        self.order, self.value = order, value

    def step(self, key, row, state):
        cnt, total = state or (0, None)
        if cnt:
            yield self.out(*key, row[self.order], False, cnt, total)
        if row[self.value] is not None:
            total = (total or 0) + row[self.value]
        yield self.out(*key, row[self.order], True, cnt + 1, total)
        return (cnt + 1, total)


class DedupClock(StatefulProcessor):
    """(line): `key$$value` of the first row per key and `ttl_ms` of wall-clock time.

    Suppressed rows do not prolong the time to live, and an expired entry is never seen.
    """

    def __init__(self, order: str, value: str, ttl_ms: int):
        self.order, self.value, self.ttl_ms = order, value, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "key string", "mark int", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        name = "$$".join(str(k) for k in key)
        for row in sorted(rows, key=lambda r: r[self.order]):
            if not self.seen.containsKey((name,)):
                self.seen.updateValue((name,), (1,))
                yield self.out(f"{name}$${row[self.value]}")

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """(*key, order, total, n): every `slide`-th row of a key fires over the last `size` rows."""

    def __init__(self, order: str, value: str, size: int, slide: int):
        self.order, self.value, self.size, self.slide = order, value, size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "value bigint")
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ring = [r[0] for r in self.ring.get()]
        held = self.count.get()
        n = held[0] if held else 0
        for row in sorted(rows, key=lambda r: r[self.order]):
            ring = [*ring, row[self.value]][-self.size :]
            n += 1
            if n % self.slide == 0:
                filled = [v for v in ring if v is not None]
                yield self.out(*key, row[self.order], sum(filled) if filled else None, len(ring))
        self.ring.put([(v,) for v in ring])
        self.count.update((n,))

    def close(self) -> None:
        pass


class ControlFilter(StatefulProcessor):
    """(word, order): rows of input 2, until the same word has come from input 1."""

    def __init__(self, order: str, marker: str = "input"):
        self.order, self.marker = order, marker

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocked = handle.getValueState("blocked", "yes boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = blocked = self.blocked.exists()
        # a word that arrives together with its control row still passes
        for row in sorted(rows, key=lambda r: (r[self.order], -r[self.marker])):
            if row[self.marker] == 1:
                blocked = True
            elif not blocked:
                yield self.out(*key, row[self.order])
        if blocked and not before:
            self.blocked.update((True,))

    def close(self) -> None:
        pass


class RiseClock(StatefulProcessor):
    """(*key, message): wall-clock alert for a key whose value did not fall for `seconds`."""

    def __init__(self, order: str, value: str, seconds: int):
        self.order, self.value, self.seconds = order, value, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle_ = handle
        self.last = handle.getValueState("last", "value double")
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        last = self.last.get()[0] if self.last.exists() else SMALLEST_POSITIVE
        armed = self.timer.get()[0] if self.timer.exists() else None
        for row in sorted(rows, key=lambda r: r[self.order]):
            value = row[self.value]
            if value is None:
                continue
            if value > last and armed is None:
                armed = now + self.seconds * 1000
                self.handle_.registerTimer(armed)
                self.timer.update((armed,))
            elif value < last and armed is not None:
                self.handle_.deleteTimer(armed)
                self.timer.clear()
                armed = None
            last = value
        self.last.update((last,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.timer.clear()
        yield self.out(*key, f"values of {key[0]} did not fall for {self.seconds} s")

    def close(self) -> None:
        pass


class RiseAlert(StatefulProcessor):
    """(*key, armed_at, alert_at): event-time alert for a key whose value did not fall for
    `interval` microseconds. An alert is given when a later row or the watermark passes it."""

    def __init__(self, at: str, order: str, value: str, interval: int):
        self.at, self.order, self.value, self.interval = at, order, value, interval

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle_ = handle
        self.last = handle.getValueState("last", "value double")
        self.armed = handle.getValueState("armed", "at bigint")

    def _timer(self, armed: int) -> int:
        return -(-(armed + self.interval) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else SMALLEST_POSITIVE
        before = armed = self.armed.get()[0] if self.armed.exists() else None
        for row in sorted(rows, key=lambda r: (r[self.at], r[self.order])):
            at, value = row[self.at], row[self.value]
            if value is None:
                continue
            if armed is not None and armed + self.interval < at:
                yield self.out(*key, armed, armed + self.interval)
                armed = None
            if value > last and armed is None:
                armed = at
            elif value < last:
                armed = None
            last = value
        self.last.update((last,))
        if armed != before:
            if before is not None:
                self.handle_.deleteTimer(self._timer(before))
                self.armed.clear()
            if armed is not None:
                self.handle_.registerTimer(self._timer(armed))
                self.armed.update((armed,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.armed.exists():
            armed = self.armed.get()[0]
            self.armed.clear()
            yield self.out(*key, armed, armed + self.interval)

    def close(self) -> None:
        pass


class EchoLength(StatefulProcessor):
    """(*key, kind, value): the length of the key per row, and a row when the wall-clock timer
    set `seconds` after a row fires."""

    def __init__(self, order: str, seconds: int):
        self.order, self.seconds = order, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle_ = handle
        self.deadline = handle.getValueState("deadline", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for _ in rows:
            yield self.out(*key, "length", len(str(key[0])))
        self.handle_.registerTimer(now + self.seconds * 1000)
        self.deadline.update((now + 1000,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self.out(*key, "timer", expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


class LowestWindows(StatefulProcessor):
    """Tumbling windows with allowed lateness, keeping the record with the lowest value.

    (*key, start_ms, end_ms, firing, order, value, watermark_ms), where `firing` is "first",
    "update" or "late", the last being the side output of rows that change nothing any more.
    Needs the time mode "processingTime" and a watermark on the input: in that mode late rows are
    handed over instead of dropped. The watermark is that of the batch before. Open windows are
    looked at again in every batch through a timer.
    """

    def __init__(self, at_ms: str, order: str, value: str, size_ms: int, lateness_ms: int = 0):
        self.at_ms, self.order, self.value = at_ms, order, value
        self.size, self.lateness = size_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle_ = handle
        self.windows = handle.getMapState(
            "windows", "end bigint", "fired boolean, ord bigint, value double"
        )
        self.polling = handle.getValueState("polling", "at bigint")

    def _poll(self, key, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        ends = sorted(end[0] for end in self.windows.keys())
        for end in ends:
            fired, order, value = self.windows.getValue((end,))
            if not fired and mark >= end:
                self.windows.updateValue((end,), (True, order, value))
                yield self.out(*key, end - self.size, end, "first", order, value, mark - 1)
            if mark >= end + self.lateness:
                self.windows.removeKey((end,))
        if any(True for _ in self.windows.keys()):
            at = timerValues.getCurrentProcessingTimeInMs() + 1
            self.handle_.registerTimer(at)
            self.polling.update((at,))
        else:
            self.polling.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        for row in sorted(rows, key=lambda r: r[self.order]):
            at, value, order = row[self.at_ms], row[self.value], row[self.order]
            end = at - at % self.size + self.size
            if mark >= end + self.lateness:
                yield self.out(*key, end - self.size, end, "late", order, value, mark - 1)
                continue
            if value is None:  # moves the watermark but takes no part in a window
                continue
            held = self.windows.getValue((end,)) if self.windows.containsKey((end,)) else None
            best = (order, value)
            if held is not None and held[2] <= value:
                best = (held[1], held[2])
            late = mark >= end
            if late and held is not None and not held[0]:
                # its rows on time fire before the late row is counted
                yield self.out(*key, end - self.size, end, "first", held[1], held[2], mark - 1)
            self.windows.updateValue((end,), (late, *best))
            if late:
                yield self.out(*key, end - self.size, end, "update", *best, mark - 1)
        if self.polling.exists():
            self.handle_.deleteTimer(self.polling.get()[0])
        yield from self._poll(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._poll(key, timerValues)

    def close(self) -> None:
        pass
