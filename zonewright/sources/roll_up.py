"""The archive's roll-up, kept by domain and month: a day's events change the months that they touch and nothing else."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.operators import observations
from zonewright.sources.staging import staged

PARTS = "domain string, days int, first_seen date, last_seen date, ever_published boolean, events long, batch string, month string"
LEDGER = "month string, batch string, place int"


def _ledger(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(f"{root}/ledger/*")
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def parts(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """The kept parts, of some months or all: each month's newest version that the ledger names."""
    ledger = _ledger(spark, root)
    if months is not None:
        ledger = ledger.filter(F.col("month").isin(months))
    newest = ledger.groupBy("month").agg(F.max_by("batch", "place").alias("batch")).orderBy("month").collect()  # one row a month
    if not newest:
        return spark.createDataFrame([], PARTS).drop("batch")
    folders = [f"{root}/parts/batch={r['batch']}/month={r['month']}" for r in newest]
    return spark.read.schema(PARTS).option("basePath", f"{root}/parts").parquet(*folders).drop("batch")


def add(spark: SparkSession, root: str, events: DataFrame, batch: str) -> bool:
    """Add a batch of events (domain, drop_date, was_published), such as a day's; whether it was new. Only the batch and the
    parts of its months are read. Months are written beside their old versions, and the ledger last: a batch that failed on
    the way is written again, one that is in the ledger adds nothing."""
    ledger = _ledger(spark, root)
    if not ledger.filter(F.col("batch") == batch).isEmpty():
        return False
    new = staged(observations.roll_up_parts(events), "roll-up")
    months = [r["month"] for r in new.select("month").distinct().orderBy("month").collect()]  # one row a month
    both = new.unionByName(parts(spark, root, months).select(new.columns))
    observations.merged_parts(both).repartition("month", F.pmod(F.xxhash64("domain"), F.lit(32))).write.mode("overwrite").partitionBy("month").parquet(f"{root}/parts/batch={batch}")
    place = (ledger.agg(F.max("place")).first()[0] or 0) + 1
    rows = spark.createDataFrame([(m, batch, place) for m in months], LEDGER)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/{batch}")
    return True


def roll_up(spark: SparkSession, root: str) -> DataFrame:
    """One row a domain, as observations.roll_up makes it of all events."""
    return observations.roll_up_of(parts(spark, root))
