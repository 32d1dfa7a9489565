"""The held queue as a stateful stream: days land as rows of names, the queue is state, windows end by timers.

It gives what `state.settle_held` gives day after day, but a day reads its own rows and the state of their names only,
never the whole queue. Names without a row on a day cost nothing until their timer fires.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: What lands: one row a name and day; flags as in `state.settle_held`, `new` for its candidates.
OBSERVED = "name string, day date, new boolean, registered boolean, enriched boolean, survived boolean, complete boolean"
SETTLED = "name string, day date, action string, first_held_date date, checks int"
_STATE = "first_held_date date, checks int, last_day date"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY = datetime.timedelta(days=1)
_EPOCH = datetime.date(1970, 1, 1)
_FLAGS = ("new", "registered", "enriched", "survived", "complete")

Held = tuple[datetime.date, int, datetime.date]


def settle(held: Held | None, day: datetime.date, flags: dict[str, bool], window_days: int) -> tuple[Held | None, list[tuple]]:
    """The queue's entry of a name after one day, and what happened: (day, action, first_held_date, checks).

    held is (first day, checks, last day); days between the last one and this had no row, and count as checks.
    """
    said: list[tuple] = []
    if held and held[0] + window_days * _DAY < day:  # it ended on a day between
        said.append(_expired(held, window_days))
        held = None
    good = flags["survived"] and flags["complete"]
    bad = flags["enriched"] and not flags["survived"]
    if held:
        first, checks, last = held
        before = checks + (day - last).days - 1
        action = "reregistered" if flags["registered"] else "released" if good else "rejected" if bad else "expired" if first + window_days * _DAY <= day else "held"
        now = (first, before + 1, day) if action == "held" else None
        return now, [*said, (day, action, first, before + 1 if now else before)]
    if not flags["new"]:
        return None, said
    action = "publish" if good else "gone" if bad else "expired" if window_days <= 0 else "new_held"
    now = (day, 0, day) if action == "new_held" else None
    return now, [*said, (day, action, day if now else None, 0 if now else None)]


def _expired(held: Held, window_days: int) -> tuple:
    first, checks, last = held
    end = max(first + window_days * _DAY, last + _DAY)  # a queue that was taken over may be past its window already
    return end, "expired", first, checks + (end - last).days - 1


class HeldQueue(StatefulProcessor):
    """State of one name: its entry in the queue; a timer ends its window once a later day has been seen."""

    def __init__(self, window_days: int):
        self.window_days = window_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _STATE)

    def _keep(self, was: Held | None, now: Held | None) -> None:
        if was and (not now or was[0] != now[0]):
            self.handle.deleteTimer(self._end(was))
        if now:
            if not was or was[0] != now[0]:
                self.handle.registerTimer(self._end(now))
            self.held.update(now)
        elif was:
            self.held.clear()

    def _end(self, held: Held) -> int:
        """The first millisecond after the start of the window's last day: past it, that day is over."""
        return ((held[0] + self.window_days * _DAY) - _EPOCH).days * 86_400_000 + 1

    def _entry(self) -> Held | None:
        found = self.held.get()
        return tuple(found) if found else None

    def handleInitialState(self, key, initialState, timerValues) -> None:
        last = initialState["last_day"]
        self._keep(None, (initialState["first_held_date"] or last + _DAY, initialState["checks"] or 0, last))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        days: dict[datetime.date, dict[str, bool]] = {}
        for r in rows:
            number, bits = divmod(r["seen"], 1 << len(_FLAGS))
            flags = days.setdefault(_EPOCH + number * _DAY, dict.fromkeys(_FLAGS, False))
            for i, f in enumerate(_FLAGS):
                flags[f] = flags[f] or bool(bits >> i & 1)
        was = now = self._entry()
        for day in sorted(days):
            if now and day <= now[2]:
                continue  # that day is settled
            now, said = settle(now, day, days[day], self.window_days)
            for s in said:
                yield Row(name=key[0], day=s[0], action=s[1], first_held_date=s[2], checks=s[3])
        self._keep(was, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._entry()
        if held:
            day, action, first, checks = _expired(held, self.window_days)
            self.held.clear()
            yield Row(name=key[0], day=day, action=action, first_held_date=first, checks=checks)

    def close(self) -> None:
        pass


def settled(observed: DataFrame, window_days: int, queue: DataFrame | None = None) -> DataFrame:
    """SETTLED rows from a stream of OBSERVED rows; queue: (name, first_held_date, checks, last_day) to begin with.

    Null flags are false; rows without name or day are left out; rows of a name and day in one batch are read as one (a
    flag holds if it holds in any). A batch may hold many days, but a day is to land as a whole, and days in their order: what
    comes more than an hour after a later day is late and dropped. A window ends when a later day than its last is seen.
    """
    stamped = observed.filter("name is not null and day is not null").withColumn("ts", F.timestamp_millis(F.unix_date("day").cast("long") * 86_400_000))
    # a row crosses to Python as its name, its time and one number: the day and a bit a flag
    bits = sum((F.coalesce(F.col(f), F.lit(False)).cast("long") * (1 << i) for i, f in enumerate(_FLAGS)), F.lit(0))
    stamped = stamped.select("name", "ts", (F.unix_date("day").cast("long") * (1 << len(_FLAGS)) + bits).alias("seen"))
    # a day's files may come in several batches: the watermark stays behind its start
    names = stamped.withWatermark("ts", "1 hour").groupBy("name")
    begin = None if queue is None else queue.select("name", "first_held_date", "checks", "last_day").groupBy("name")
    return names.transformWithState(HeldQueue(window_days), SETTLED, "Append", "EventTime", begin)


def settle_landed(spark: SparkSession, landing: str, out: str, checkpoint: str, window_days: int, queue: DataFrame | None = None) -> StreamingQuery:
    """Settle what has landed (Parquet, OBSERVED) since the last run, append it to out once, and stop.

    A run that dies goes on from the checkpoint: entries and timers are kept there with the files that were read.
    """
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)  # the store that timers need; a query keeps what it was started with
    try:
        rows = settled(spark.readStream.schema(OBSERVED).parquet(landing), window_days, queue)
        return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def queue_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The queue as it is now, read from the state: name, first_held_date, checks, last_day."""
    found = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "held").load()
    return found.select("key.name", "value.first_held_date", "value.checks", "value.last_day")
