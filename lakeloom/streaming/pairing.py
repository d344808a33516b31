"""Open sessions on a stream: starts wait for their stop, in event-time order, and time out."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

COLUMNS = ["start_id", "start_us", "stop_id", "stop_us", "outcome"]
OUT = "start_id long, start_us long, stop_id long, stop_us long, outcome string"
OWNER = "keyed boolean, key long, part int"
IDLE = -1


class SessionPairing(StatefulProcessor):
    """Keeps, per slot of keys, the events that the watermark has not passed and the sessions that are open, and nothing once both are gone.

    Events are looked at in event-time order when the watermark passes them, so micro-batches may bring them in any order. A stop closes every
    session of its owner (a key's part) that began at most ``timeout_us`` before it; a session without such a stop times out when the watermark
    has passed its end. One timer stands for the earliest of these moments in the slot; its time is the value state. A slot has many
    owners, since calls of the state cost more than the rows they carry.
    """

    def __init__(self, timeout_us: int):
        self.timeout_us = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"{OWNER}, us long, id long, stop boolean")
        self.open = handle.getListState("open", f"{OWNER}, us long, id long")
        self.due = handle.getValueState("due", "ms long")

    def _remind(self, moments: list[int], timer: int) -> None:
        """Set the one timer to the next moment something can happen, or leave no state; ``timer`` is the one that stands."""
        if timer != IDLE:
            self.handle.deleteTimer(timer)
        if moments:
            next_ms = -(-min(moments) // 1000)
            self.handle.registerTimer(next_ms)
            self.due.update((next_ms,))
        else:
            self.due.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = [t for frame in rows for t in zip(*[frame[c].tolist() for c in ("keyed", "key", "part", "us", "id", "stop")])]
        self.waiting.appendList(fresh)
        timer = self.due.get()[0] if self.due.exists() else IDLE
        moments = [e[3] for e in fresh]
        if timer == IDLE or -(-min(moments) // 1000) < timer:
            self._remind(moments, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        opened = defaultdict(list)
        for *owner, us, number in self.open.get() if self.open.exists() else ():
            opened[tuple(owner)].append((us, number))
        out, later = [], []
        for *owner, us, number, stop in waiting:
            owner = tuple(owner)
            if us > mark:
                later.append((*owner, us, number, stop))
            elif not stop:
                opened[owner].append((us, number))
            else:
                out += [(*owner, n, s, number, us, "closed") if us - s <= self.timeout_us else (*owner, n, s, None, None, "timed out")
                        for s, n in opened.pop(owner, ())]
        still = [(*owner, s, n) for owner, sessions in opened.items() for s, n in sessions]
        out += [(*owner, n, s, None, None, "timed out") for *owner, s, n in still if s + self.timeout_us <= mark]
        still = [e for e in still if e[3] + self.timeout_us > mark]
        for state, rows in ((self.waiting, later), (self.open, still)):
            state.put(rows) if rows else state.clear()
        # the timer that fired is gone already
        self._remind([e[3] for e in later] + [e[3] + self.timeout_us for e in still], IDLE)
        if out:
            found = pd.DataFrame(out, columns=["keyed", "key", "part", *COLUMNS]).astype({"key": "Int64", "stop_id": "Int64", "stop_us": "Int64"})
            found["key"] = found["key"].where(found["keyed"])
            yield found[["key", *COLUMNS]]

    def close(self) -> None:
        pass


def pair_sessions(events: DataFrame, key: str, number: str, time: str, start: Column, stop: Column, minutes: int, parts: int = 4,
                  slots: int = 4096) -> DataFrame:
    """Stream of (key, start_id, start_us, stop_id, stop_us, outcome): each start with the first stop after it within ``minutes``, or timed out.

    Equal times are taken in the order of ``number``. A key's starts are dealt over ``parts`` and its stops go to all of them; the parts of all
    keys are dealt over ``slots`` states, so a hot key is not one state and many small keys are not one each. The stream needs a watermark
    on ``time``; what it has not passed yet is not decided. Needs the RocksDB state store.
    """
    mine = F.pmod(F.xxhash64(number), F.lit(parts)).cast("int")
    part = F.explode(F.when(stop, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(mine)))
    rows = events.filter(start | stop).select(
        F.col(key).isNotNull().alias("keyed"), F.coalesce(F.col(key), F.lit(0)).cast("long").alias("key"), part.alias("part"), F.col(time),
        F.unix_micros(F.col(time).cast("timestamp")).alias("us"), F.col(number).alias("id"), stop.alias("stop"))
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("keyed", "key", "part"), F.lit(slots)).cast("int"))
    return rows.groupBy("slot").transformWithStateInPandas(
        SessionPairing(minutes * 60_000_000), f"key long, {OUT}", "append", "EventTime").withColumnRenamed("key", key)
