"""Releases stored for look-ups: sorted files with a map of what each holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.sources.staging import staged

#: Candidates up to which they are sent to every task; beyond, both sides are shuffled.
BROADCAST_CANDIDATES = 200_000


def write_indexed(counts: DataFrame, path: str, files: int | None = None) -> None:
    """Write (apex_domain, source_domain_count) sorted over files of disjoint ranges, and beside them a map of the first and
    last name of each file. A file with a Bloom filter of its names."""
    order = F.col("apex_domain")
    dealt = counts.repartitionByRange(files, order) if files else counts.repartitionByRange(order)
    rows = dealt.sortWithinPartitions(order).select("apex_domain", "source_domain_count")
    rows.write.mode("overwrite").option("parquet.bloom.filter.enabled#apex_domain", "true").parquet(f"{path}/rows")
    written = counts.sparkSession.read.parquet(f"{path}/rows")
    # one row a file; min and max come from the footers
    zones = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("apex_domain").alias("first"), F.max("apex_domain").alias("last"), F.count(F.lit(1)).alias("rows"))
    zones.coalesce(1).write.mode("overwrite").parquet(f"{path}/zones")


def files_for(spark: SparkSession, candidates: DataFrame, path: str) -> list[str]:
    """The files whose range holds a candidate (column name)."""
    zones = spark.read.parquet(f"{path}/zones").orderBy("first").collect()  # one row a file
    if not zones:
        return []
    step = max(1, int(len(zones) ** 0.5))
    firsts = [z["first"] for z in zones]
    below = lambda x: x <= F.col("name")
    # the last file that begins at or before a name: first among every step-th file, then among those between
    coarse = F.size(F.filter(F.array(*[F.lit(x) for x in firsts[::step]]), below))
    blocks = F.array(*[F.array(*[F.lit(x) for x in firsts[i : i + step]]) for i in range(0, len(firsts), step)])
    at = F.when(coarse > 0, (coarse - 1) * step + F.size(F.filter(F.get(blocks, coarse - 1), below)) - 1)
    last = F.get(F.array(*[F.lit(z["last"]) for z in zones]), at)
    hit = candidates.select("name", at.alias("at")).filter(F.col("at").isNotNull() & (F.col("name") <= last))
    return [f"{path}/rows/{zones[r['at']]['file']}" for r in hit.select("at").distinct().orderBy("at").collect()]  # one row a file


def look_up(spark: SparkSession, candidates: DataFrame, path: str) -> DataFrame:
    """candidates with source_domain_count, null where the release has no such name. Only files that may hold one are read,
    and they are not shuffled while the candidates are few enough to go to every task."""
    wanted = staged(candidates.select("name").distinct(), "candidates")
    found = files_for(spark, wanted, path)
    schema = "apex_domain string, source_domain_count long"
    release = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    release = release.select(F.col("apex_domain").alias("name"), "source_domain_count")
    few = wanted.limit(BROADCAST_CANDIDATES + 1).count() <= BROADCAST_CANDIDATES
    hits = release.join(F.broadcast(wanted) if few else wanted, "name")
    return candidates.join(hits, "name", "left")
