"""The held queue as a stream, against the same days settled one by one as tables."""

import datetime
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from zonewright.operators import state
from zonewright.streaming import held

DAY = datetime.date(2026, 1, 1)
WINDOW = 4
FLAGS = ("new", "registered", "enriched", "survived", "complete")
QUEUE = "name string, first_held_date date, checks int"


def day(k):
    return DAY + datetime.timedelta(days=k)


def made_days(n, seed=5):
    """Rows of n days: names that come back, stay away, are filtered out, are registered."""
    draw = random.Random(seed)
    return [[(f"n{i}", day(k), *(draw.random() < p for p in (0.6, 0.15, 0.7, 0.55, 0.25))) for i in range(40) if draw.random() < 0.45] for k in range(n)]


def by_tables(spark, days, queue):
    """settle_held for each day over the whole queue."""
    out = []
    for k, rows in enumerate(days):
        seen = spark.createDataFrame(rows, held.OBSERVED)
        survivors = seen.filter("survived").select("name", "complete", F.array().cast("array<string>").alias("reasons"))
        enriched = seen.filter("enriched or survived")
        done = state.settle_held(spark.createDataFrame(queue, QUEUE), seen.filter("new"), enriched, survivors, seen.filter("registered"), F.lit(day(k)), WINDOW).collect()
        queue = [(r["name"], r["first_held_date"], r["checks"]) for r in done if r["action"] in ("held", "new_held")]
        shown = {r[0] for r in rows}
        # a stream says nothing of names that were held on without a row
        out += [(r["name"], day(k), r["action"], r["first_held_date"], r["checks"]) for r in done if r["action"] != "held" or r["name"] in shown]
    return out, queue


def run(spark, folder, days, queue=None):
    for n, rows in enumerate(days):
        spark.createDataFrame(rows, held.OBSERVED).write.mode("append").parquet(f"{folder}/landed")
        held.settle_landed(spark, f"{folder}/landed", f"{folder}/out", f"{folder}/state", WINDOW, queue).awaitTermination()
    return sorted(tuple(r) for r in spark.read.schema(held.SETTLED).parquet(f"{folder}/out").collect())


def dated(rows, last):
    """New entries and what ended up to a day; tables know the first day of a candidate that is only new in no row."""
    return sorted((r for r in rows if r[1] <= last), key=lambda r: (r[0], r[1], r[2]))


def test_days_as_batches_equal_settling_tables(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    days = made_days(10)
    queue = [("n1", day(-2), 1), ("n2", None, 0), ("n3", day(-9), 3), ("away", day(-1), 0)]
    wanted, left = by_tables(spark, days, queue)
    begin = spark.createDataFrame([(*q, day(-1)) for q in queue], f"{QUEUE}, last_day date")
    closing = [("zz", day(10), False, False, False, False, False)]
    # each day is a run of its own that goes on from the checkpoint
    got = run(spark, str(tmp_path), [*days, closing], begin)
    assert dated(got, day(9)) == dated(wanted, day(9))
    assert {"reregistered", "released", "rejected", "expired", "held", "publish", "gone", "new_held"} == {r[2] for r in got}
    now = held.queue_of(spark, f"{tmp_path}/state").collect()
    assert sorted((r["name"], r["first_held_date"]) for r in now) == sorted((n, f) for n, f, _ in left)
    assert all(r["checks"] + (day(9) - r["last_day"]).days == {n: c for n, _, c in left}[r["name"]] for r in now)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_batches_of_many_days_give_the_same(spark, tmp_path):
    days = made_days(9, seed=8)
    wanted, _ = by_tables(spark, days, [])
    closing = [("zz", day(9), False, False, False, False, False)]
    got = run(spark, str(tmp_path), [sum(days[:4], []), sum(days[4:], []) + closing])
    assert dated(got, day(8)) == dated(wanted, day(8))


def test_nulls_repeats_and_late_days(spark, tmp_path):
    none = [None] * 5
    first = [("a", day(0), True, *none[1:]), ("a", day(0), True, *none[1:]), (None, day(0), True, *none[1:]), ("b", None, True, *none[1:]), ("c", day(0), *none)]
    late = [("d", day(-3), True, *none[1:]), ("e", day(1), True, False, False, False, False)]
    assert run(spark, str(tmp_path), [first, late]) == [("a", day(0), "new_held", day(0), 0), ("e", day(1), "new_held", day(1), 0)]


@pytest.mark.parametrize("window,wanted", [(0, "expired"), (1, "new_held")])
def test_no_window_holds_nothing(window, wanted):
    _, said = held.settle(None, DAY, dict.fromkeys(FLAGS, False) | {"new": True}, window)
    assert [s[1] for s in said] == [wanted]


def test_a_row_crosses_as_a_day_and_bits_in_one_number():
    kept, timers = [], []
    queue = held.HeldQueue(3)
    queue.held = SimpleNamespace(get=lambda: None, update=kept.append, clear=None)
    queue.handle = SimpleNamespace(registerTimer=timers.append, deleteTimer=None)
    number = (DAY - datetime.date(1970, 1, 1)).days * 32
    seen = [Row(name="a", seen=number), Row(name="a", seen=number + 0b00001), Row(name="a", seen=number + 32 + 0b00100)]
    said = [tuple(r) for r in queue.handleInputRows(("a",), iter(seen), None)]
    assert said == [("a", DAY, "new_held", DAY, 0), ("a", day(1), "rejected", DAY, 0)] and not kept and not timers
    said = [tuple(r) for r in queue.handleInputRows(("a",), iter(seen[:2]), None)]
    assert said == [("a", DAY, "new_held", DAY, 0)] and kept == [(DAY, 0, DAY)] and len(timers) == 1
