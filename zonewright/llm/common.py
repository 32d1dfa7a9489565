"""What the operators of this subpackage share: table access, distributed ranks, state of Python workers."""

from __future__ import annotations

import ctypes
import math
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonewright.sources.staging import discard, staged as materialize

__all__ = ["Remembered", "bounded_broadcast", "buckets_for", "discard", "hash_bucket", "in_order", "lean", "let_go", "materialize", "per_process", "small_batches", "spread_rank", "table", "told_apart", "unused"]
#: Rows of one id from which on they are told apart, and ids of that kind up to which their list is broadcast.
MANY_ROWS = 1000
BROADCAST_IDS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, most: int = 1000) -> Iterator[None]:
    """Let Arrow batches of what is written inside hold at most so many rows: rows here are texts or sets of kilobytes, and
    the default of 10,000 rows a batch costs each Python worker and its executor tens of megabytes several times over.
    The session has its own setting again afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    if not 0 < int(before or 10000) <= most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def bounded_broadcast(df: DataFrame, most_rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most most_rows rows (it should be materialized), else as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def unused(df_columns: list[str], wanted: str) -> str:
    """wanted, with underscores before it until no column has that name (names differ regardless of case)."""
    taken = {c.lower() for c in df_columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def hash_bucket(n: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def spread_rank(df: DataFrame, group: list[str], buckets: list[tuple[str, Column]], order: list[Column], name: str, weight: str | None = None) -> DataFrame:
    """Gapless long ranks from 0 in each group, ordered by the bucket columns, then by order; with a weight column: the
    sum of the weights before the row in that order.

    No task sees a whole group: rows are ranked inside (group, buckets), and the offsets come from the sums of these.
    Buckets are ints that the caller makes from hashes, so that each holds a bounded share of the rows.
    """
    for n, c in buckets:
        df = df.withColumn(n, c)
    keys = group + [n for n, _ in buckets]
    each = F.lit(1) if weight is None else F.col(weight)
    counts = df.groupBy(*keys).agg(F.sum(each).alias("_n"))
    w = Window.partitionBy(*group).orderBy(*[n for n, _ in buckets]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys).orderBy(*order)
    before = F.row_number().over(inside) - 1 if weight is None else F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = df.withColumn("_in", before).join(offsets, keys)
    return joined.withColumn(name, (F.col("_offset") + F.col("_in")).cast("long")).drop("_in", "_offset", *[n for n, _ in buckets])


def buckets_for(rows: int) -> int:
    """Buckets of hashes for so many rows: as many as rows in each, so that neither a bucket nor a list of all of them grows
    faster than the root of the input."""
    return max(1, math.isqrt(max(0, rows - 1)) + 1)


def in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows, written in the whole order with a long that ascends in it and counts each written range without gaps: the
    range is `name >> 33`. Ranges are cut by a sample of the rows, which are numbered first, so that equal rows spread too;
    which of some equal rows comes first depends on the input's layout. rows are read twice, so they should be cheap."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    return materialize(dealt.withColumn(name, F.monotonically_increasing_id()), "in-order")


def told_apart(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with a long that differs among the rows of one key where these are more than MANY_ROWS, and is 0
    for others: hashes of key and name then spread a hot or null key over many buckets. Which of them gets which number
    depends on how the rows are partitioned, so the result is to be used once or written."""
    many = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_times")).filter(F.col("_times") > MANY_ROWS).select(F.col(key).alias("_key"), F.lit(True).alias("_many")), "repeated-keys")
    if many.isEmpty():
        return rows.withColumn(name, F.lit(0).cast("long"))
    marked = rows.join(bounded_broadcast(many, BROADCAST_IDS), F.col(key).eqNullSafe(F.col("_key")), "left")
    return marked.withColumn(name, F.when(F.col("_many"), F.monotonically_increasing_id()).otherwise(0)).drop("_key", "_many")


def per_process(name: str, make: Callable[[], Any]) -> Any:
    """make(), once in each Python process: what a worker has loaded serves all its tasks, until it loads something else."""
    let_go(but=name)
    held = _worker_state()
    if name not in held:
        held[name] = make()
    return held[name]


def _worker_state() -> dict[str, Any]:
    module = sys.modules.setdefault("zonewright_worker_state", types.ModuleType("zonewright_worker_state"))
    return vars(module).setdefault("held", {})


def let_go(but: str | None = None) -> None:
    """Drop what this Python process has loaded for other steps."""
    held = _worker_state()
    if others := [k for k in held if k != but]:
        for k in others:
            del held[k]
        give_back()


def give_back() -> None:
    """Return what this Python process has freed to the system; Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # not every C library has it
        trim(0)


def lean(step: Callable[[Iterator], Iterator], keeps: str | None = None) -> Callable[[Iterator], Iterator]:
    """step, a function of a task's batches, in a worker that holds nothing else: what was loaded for other steps (but not
    what per_process has under the name `keeps`) goes before it, what the task freed goes after it. Spark lets idle workers
    live for a minute, so what they hold stands beside the full heap of stages that have no Python at all."""

    def run(batches: Iterator) -> Iterator:
        let_go(but=keeps)
        try:
            yield from step(batches)
        finally:
            give_back()

    return run


class Remembered(dict):
    """A dict that computes what it lacks. When it is full the newer half goes: words seen first are the frequent ones."""

    def __init__(self, compute: Callable[[str], Any], most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key: str) -> Any:
        value = self[key] = self.compute(key)
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            for key in list(self)[self.most // 2 :]:
                del self[key]
