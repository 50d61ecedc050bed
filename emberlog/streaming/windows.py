"""Exact processing-time windows for each key, where the micro-batch itself isn't window enough."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class KeyWindow(StatefulProcessor):
    """Buffers a key's events from its first one for `seconds`, or until `most` are there, then lets them go.

    A full window fires at the next micro-batch; timers fire at batch boundaries.
    """

    def __init__(self, seconds: int = 30, most: int = 20_000):
        self.seconds, self.most = seconds, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "value string")
        self.count = handle.getValueState("count", "n long")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        values = [(r.value,) for r in rows]
        self.events.appendList(values)
        n = (self.count.get()[0] if self.count.exists() else 0) + len(values)
        self.count.update((n,))
        now = timerValues.getCurrentProcessingTimeInMs()
        if not self.timer.exists():
            self._set(now + 1 if n >= self.most else now + self.seconds * 1000)
        elif n >= self.most and self.timer.get()[0] > now + 1:
            self.handle.deleteTimer(self.timer.get()[0])
            self._set(now + 1)
        return iter(())

    def _set(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        fired = expiredTimerInfo.getExpiryTimeInMs()
        for (value,) in self.events.get():
            yield Row(k=key[0], window_end=fired, value=value)
        self.events.clear()
        self.count.clear()
        self.timer.clear()

    def close(self) -> None:
        pass


def windowed(events: DataFrame, key: str = "k", seconds: int = 30, most: int = 20_000) -> DataFrame:
    """(k, window_end, value) once the window of an event's key fires. Needs the RocksDB state store."""
    return events.select(F.col(key).alias("k"), "value").groupBy("k").transformWithState(
        statefulProcessor=KeyWindow(seconds, most), outputStructType="k string, window_end long, value string", outputMode="Append", timeMode="ProcessingTime"
    )
