"""Rolling counts and state changes of arriving events, with keyed state.

Events of a key wait until the watermark has passed their second, then count in order of time, so the results are those of
the batch operators whatever the order of arrival within the delay. What comes later than that is dropped, as the watermark
says. A key keeps the events that wait, a count per second of the window, and its last state; timers wake it when
the watermark passes. Rows of a hot key meet in one task per trigger, so the files per trigger bound what a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: The state store that keyed state needs; set on the session before a stream starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_OUT = "kind string, second long, n long, previous string, current string"


class History(StatefulProcessor):
    """Counts and changes of one key."""

    def __init__(self, key: str, window: int):
        self.key, self.window = key, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "micros long, tie long, state string")
        self.recent = handle.getListState("recent", "second long, n long")
        self.last = handle.getValueState("last", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [r for part in rows for r in zip(part["micros"], part["tie"], part["state"])]
        if new and not pd.isna(key[0]):  # rows without a key only move the watermark
            self.waiting.appendList([(int(m), int(t), s) for m, t, s in new])
            self._wake(min(m for m, _, _ in new))
        return iter(())

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer((int(micros) // 1_000_000 + 1) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        past = timerValues.getCurrentWatermarkInMs() // 1000  # seconds before this one are whole
        waiting = [tuple(r) for r in self.waiting.get()]
        due = sorted((r for r in waiting if r[0] // 1_000_000 < past), key=lambda r: r[:2])
        later = [r for r in waiting if r[0] // 1_000_000 >= past]
        if later:
            self.waiting.put(later)
            self._wake(min(r[0] for r in later))
        else:
            self.waiting.clear()
        if not due:
            return
        last = self.last.get()[0] if self.last.exists() else None
        begun = self.last.exists()
        moves: dict[tuple, int] = {}
        per_second: dict[int, int] = {}
        for micros, _, state in due:
            per_second[micros // 1_000_000] = per_second.get(micros // 1_000_000, 0) + 1
            if begun and last is not None:
                moves[last, state] = moves.get((last, state), 0) + 1
            last, begun = state, True
        self.last.update((last,))
        recent = [tuple(r) for r in self.recent.get()]
        rows, first, total = [], 0, sum(n for _, n in recent)
        for second, n in per_second.items():  # rising, as the events are
            recent.append((second, n))
            total += n
            while recent[first][0] < second - self.window:
                total -= recent[first][1]
                first += 1
            rows.append(("count", second, total, None, None))
        self.recent.put(recent[first:])
        rows += [("move", None, n, a, b) for (a, b), n in moves.items()]
        out = pd.DataFrame(rows, columns=["kind", "second", "n", "previous", "current"]).astype({"second": "Int64"})
        out.insert(0, self.key, [key[0]] * len(out))
        yield out

    def close(self) -> None:
        pass


def follow(events: DataFrame, key: str, time: str, tie: str, state: str, window: int, out: str, checkpoint: str, delay: str = "1 hour") -> StreamingQuery:
    """Follow everything that has arrived and stop; results go to ``out``, the checkpoint keeps the state for the next run.

    ``delay`` is how much later than others an event may come. Rows without a key only say how far time has come.
    """
    kind = events.schema[key].dataType.simpleString()
    rows = events.withWatermark(time, delay).select(
        key, time, F.unix_micros(time).alias("micros"), F.col(tie).cast("long").alias("tie"), F.col(state).cast("string").alias("state"))
    followed = rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=History(key, window), outputStructType=f"`{key}` {kind}, {_OUT}", outputMode="Append", timeMode="EventTime")
    return followed.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def counts_of(found: DataFrame, key: str, name: str = "n_recent") -> DataFrame:
    """Per key and second: events of the key in the window up to it."""
    return found.where("kind = 'count'").select(key, "second", F.col("n").alias(name))


def transitions_of(found: DataFrame) -> DataFrame:
    """Counts and row shares of state changes: ``previous, current, n, share``."""
    pairs = found.where("kind = 'move'").groupBy("previous", "current").agg(F.sum("n").alias("n"))
    totals = pairs.groupBy("previous").agg(F.sum("n").alias("total"))  # a row per state
    return pairs.join(totals, "previous").select("previous", "current", "n", (F.col("n") / F.col("total")).alias("share"))
