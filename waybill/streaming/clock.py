"""Windows that are closed by the clock instead of by later events.

A watermark of event time stands still when the stream does, and its last windows stay
open. Here processing-time timers in the query's own state close them, so an idle stream
closes them too. Needs the RocksDB state store provider.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Consecutive windows of a key whose counts are one entry of state with one timer, so that a batch costs a call into
#: Python for each such block, not for each window. It bounds the entry, not the windows.
BLOCK_WINDOWS = 256


class _WindowCounts(StatefulProcessor):
    """The counts of a block of windows of one key, each until its time is up; after that, for a while, marks that they are closed."""

    def __init__(self, width_ms: int, delay_ms: int, remember_ms: int):
        self.width_ms, self.delay_ms, self.remember_ms = width_ms, delay_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "timer bigint, starts array<bigint>, ns array<bigint>, dues array<bigint>")
        self.closed = handle.getValueState("closed", "starts array<bigint>, untils array<bigint>", ttlDurationMs=self.remember_ms)

    def _open(self) -> tuple[int | None, dict[int, tuple[int, int]]]:
        """The block's timer and the count and end of waiting of each open window."""
        if not self.open.exists():
            return None, {}
        timer, starts, ns, dues = self.open.get()
        return timer, {s: (n, due) for s, n, due in zip(starts, ns, dues, strict=True)}

    def _closed(self, now: int) -> dict[int, int]:
        if not self.closed.exists():
            return {}
        return {s: until for s, until in zip(*self.closed.get(), strict=True) if until > now}

    def _keep(self, before: int | None, windows: dict[int, tuple[int, int]]) -> None:
        """Store the open windows; the timer is that of the first to close."""
        timer = min((due for _, due in windows.values()), default=None)
        if before is not None and before != timer:
            self.handle.deleteTimer(before)
        if timer is None:
            self.open.clear()
            return
        if before != timer:
            self.handle.registerTimer(timer)
        self.open.update((timer, list(windows), [n for n, _ in windows.values()], [due for _, due in windows.values()]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        timer, windows = self._open()
        closed = self._closed(now)
        for part in rows:
            for start, n in zip(part["start"].tolist(), part["n"].tolist(), strict=True):
                if start in windows or start not in closed:
                    due = max(now, start * 1000 + self.width_ms) + self.delay_ms
                    windows[start] = (windows[start][0] + n if start in windows else n, due)
        self._keep(timer, windows)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        _, windows = self._open()
        over = {start: n for start, (n, due) in windows.items() if due <= now}
        closed = self._closed(now) | dict.fromkeys(over, now + self.remember_ms)
        self.closed.update((list(closed), list(closed.values())))
        # The timer that fired is gone already.
        self._keep(None, {start: window for start, window in windows.items() if start not in over})
        yield pd.DataFrame({"key": [key[0]] * len(over), "start": list(over), "n": list(over.values())})

    def close(self) -> None:
        pass


def stream_counts_by_clock(
    activity: DataFrame, width_seconds: int = 60, key: str = "location", delay_seconds: float = 5, remember_seconds: float = 3600
) -> DataFrame:
    """Counts per key and window; a window is emitted once, ``delay_seconds`` after the clock has passed its end.

    A window that is over when its rows come, as in a replayed log, closes when it has had no row for
    that long. Rows for a window closed within ``remember_seconds`` are dropped; later
    ones would open it anew. Windows start at multiples of the width in UTC.

    Rows are counted per Arrow batch before the shuffle, so a busy key sends a few rows a task. State is
    kept for ``BLOCK_WINDOWS`` windows of a key at a time.
    Run it with a ``processingTime`` trigger: timers fire in the batches that it starts.
    """
    start = F.floor(F.unix_seconds("event_time") / width_seconds) * width_seconds
    kind = dict(activity.dtypes)[key]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby(["key", "start"], dropna=False).size().reset_index(name="n")

    counted = activity.select(F.col(key).alias("key"), start.cast("bigint").alias("start")).mapInPandas(partial, f"key {kind}, start bigint, n bigint")
    blocks = counted.withColumn("block", F.floor(F.col("start") / (width_seconds * BLOCK_WINDOWS)).cast("bigint"))
    processor = _WindowCounts(int(width_seconds * 1000), int(delay_seconds * 1000), int(remember_seconds * 1000))
    closed = blocks.groupBy("key", "block").transformWithStateInPandas(processor, f"key {kind}, start bigint, n bigint", "append", "processingTime")
    return closed.select(F.col("key").alias(key), F.timestamp_seconds("start").alias("window_start"), "n")


def stop_when_idle(query: StreamingQuery, seconds: float) -> None:
    """Stop a query once a batch without input has started at least ``seconds`` after the last one with input (or the first).

    With ``seconds`` no less than the delay of ``stream_counts_by_clock`` all windows of a replayed log
    are closed by then. A failure of the query is raised.
    """

    def started(progress: dict) -> float:
        return datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).timestamp()

    last = None
    while query.isActive:
        for progress in query.recentProgress:
            # Before any input the first batch counts: a restarted query may begin with one for its timers.
            if progress["numInputRows"] or last is None:
                last = max(last or 0, started(progress))
            elif started(progress) >= last + seconds:
                query.stop()
                break
        time.sleep(0.2)
    if query.exception():
        raise query.exception()
