"""Monitors of append-only logs. Each works on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from storyloom.operators.quality import todo, work_state


def _marked(log: DataFrame, late: str, ts: str) -> DataFrame:
    log = log.withColumn(ts, F.col(ts).cast("timestamp"))
    return log.withWatermark(ts, late) if log.isStreaming else log


def call_health(log: DataFrame, width: str = "1 day", slide: str | None = None, late: str = "1 hour", ts: str = "ts") -> DataFrame:
    """start, calls, errors, retries, elapsed by window of event time. log: ts, is_error, attempt, elapsed."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = _marked(log, late, ts).groupBy(window.alias("w")).agg(F.count("*").alias("calls"), F.count_if("is_error").alias("errors"), F.count_if(F.col("attempt") > 1).alias("retries"), F.round(F.avg("elapsed"), 6).alias("elapsed"))
    return out.select(F.col("w.start").alias("start"), "calls", "errors", "retries", "elapsed")


def stalls(log: DataFrame, gap: str = "20 seconds", late: str = "1 hour", ts: str = "ts", *keys: str) -> DataFrame:
    """Sessions parted by gaps without an event: the end of each is a stall. start, stop, events."""
    out = _marked(log, late, ts).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("events"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "events")


def progress(log: DataFrame, width: str = "1 day", late: str = "1 hour", ts: str = "ts") -> DataFrame:
    """start, done, ok, failed by window. log: ts, passed."""
    out = _marked(log, late, ts).groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("done"), F.count_if("passed").alias("ok"), F.count_if(~F.col("passed")).alias("failed"))
    return out.select(F.col("w.start").alias("start"), "done", "ok", "failed")


def headline(done: DataFrame, expected: int, ts: str = "ts") -> DataFrame:
    """done, ok, failed, percent, elapsed and left (seconds at the mean rate so far) of a run log."""
    rows = done.agg(F.count("*").alias("done"), F.count_if("passed").alias("ok"), F.count_if(~F.col("passed")).alias("failed"), (F.max(F.col(ts).cast("timestamp")).cast("double") - F.min(F.col(ts).cast("timestamp")).cast("double")).alias("elapsed"))
    return rows.withColumn("percent", F.round(F.col("done") * 100 / expected, 1)).withColumn("left", F.round(F.col("elapsed") / F.greatest(F.col("done"), F.lit(1)) * (expected - F.col("done")), 1))


def incremental(units: DataFrame, done: Callable[[], DataFrame], work: Callable[[DataFrame], None], checkpoint: str, late: str | None = None, ts: str = "ts") -> StreamingQuery:
    """Pass only new and unfinished units of a stream to ``work``, batch by batch; what is there now is taken, then the query ends."""
    if late:
        units = units.withWatermark(ts, late).dropDuplicatesWithinWatermark(["seq"])

    def run(batch: DataFrame, _: int) -> None:
        rows = batch.dropDuplicates(["seq"])
        work(rows.join(todo(work_state(rows, done())), "seq", "left_semi"))

    return units.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _Silence(StatefulProcessor):
    """A timer for each key at its last event and the gap: if nothing has come by then, that is a stall."""

    def __init__(self, gap_ms: int, key: str):
        self.gap, self.key = gap_ms, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last long, events long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, events = self.last.get() if self.last.exists() else (0, 0)
        for frame in rows:
            last, events = max(last, int(frame["event_ms"].max())), events + len(frame)
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(last + self.gap)
        self.last.update((last, events))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, events = self.last.get()
        self.last.clear()
        yield pd.DataFrame({self.key: [key[0]], "last": [pd.Timestamp(last, unit="ms")], "silent_since": [pd.Timestamp(last + self.gap, unit="ms")], "events": [events]})

    def close(self) -> None:
        pass


def stall_alerts(log: DataFrame, key: str, gap_seconds: float = 20.0, late: str = "0 seconds", ts: str = "ts") -> DataFrame:
    """key, last, silent_since, events of every key of a stream that has been silent for the gap, once the watermark has passed it.

    An alert does not wait for the key's next event: the clock is the watermark, which any key's events move. State is one row
    a key and goes with the alert, so keys that have ended cost nothing. Events of null keys or times are passed over.
    """
    rows = _marked(log, late, ts).where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("event_ms", F.unix_millis(F.col(ts)))
    kind = dict(log.dtypes)[key]
    out = rows.select(key, ts, "event_ms").groupBy(key)
    return out.transformWithStateInPandas(_Silence(round(gap_seconds * 1000), key), f"{key} {kind}, last timestamp, silent_since timestamp, events long", "Append", "eventTime")


def progress_stream(log: DataFrame, expected: DataFrame, width: str = "10 minutes", late: str = "1 hour", ts: str = "ts", key: str = "job") -> DataFrame:
    """key, start, done, ok, failed, expected, percent, rate, left by window of event time, each revised as events come in, late ones within ``late`` too.

    expected: key and its total number of units, a table of any size, joined to the stream after its windows are counted. ``rate`` is
    units a second in the window, ``left`` the seconds that the whole of ``expected`` would take at that rate. Write it in update mode.
    """
    out = _marked(log, late, ts).groupBy(F.window(ts, width).alias("w"), key).agg(F.count("*").alias("done"), F.count_if("passed").alias("ok"), F.count_if(~F.col("passed")).alias("failed"))
    seconds = F.col("w.end").cast("double") - F.col("w.start").cast("double")
    rows = out.select(key, F.col("w.start").alias("start"), "done", "ok", "failed", (F.col("done") / seconds).alias("rate")).join(expected.select(key, "expected"), key, "left")
    return rows.select(key, "start", "done", "ok", "failed", "expected", F.round(F.col("done") * 100 / F.col("expected"), 1).alias("percent"), F.round("rate", 6).alias("rate"), F.round(F.col("expected") / F.col("rate"), 1).alias("left"))
