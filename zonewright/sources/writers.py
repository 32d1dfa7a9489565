"""Sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.operators import state


def commit_snapshot(names: DataFrame, path: str, day: str) -> None:
    """Write the day's names, sorted in each file; only the partitions (tld, day) at hand are replaced."""
    rows = names.select("tld", F.lit(day).cast("date").alias("snapshot_date"), "name").repartition("tld", F.pmod(F.xxhash64("name"), F.lit(16))).sortWithinPartitions("tld", "snapshot_date", "name")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tld", "snapshot_date").parquet(path)


def payload(rows: DataFrame, header: DataFrame) -> DataFrame:
    """One row of JSON: header counts (absent where null) and the published rows, best first. A payload is one document: the
    caller decides how many rows are published, and makes the header from the same."""
    order = F.struct((-F.coalesce("score", F.lit(-1))).alias("k"), "name", F.struct(*rows.columns).alias("row"))
    listed = rows.agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["row"]).alias("domains"))
    return header.crossJoin(F.broadcast(listed)).select(F.to_json(F.struct(*header.columns, "domains"), {"ignoreNullFields": "true"}).alias("value"))


def append_events(events: DataFrame, existing: DataFrame, path: str) -> int:
    """Append the events that the archive lacks; a second run appends nothing. Returns how many were new."""
    from zonewright.sources.staging import staged

    new = staged(state.new_events(existing, events), "new-events")
    new.write.mode("append").partitionBy("month").parquet(path)
    return new.count()


def stage_tables(drops: DataFrame, survivors: DataFrame, published: DataFrame) -> dict[str, DataFrame]:
    """The stages of a day for dump_stages: rejects with their reason, survivors, those of them that were not published, and
    those that were."""
    return {"rejects": drops.filter("reject_reason is not null"), "survivors": survivors, "discards": survivors.join(published.select("name"), "name", "left_anti"), "published": published}


def hand_off(rows: DataFrame, path: str, day: str) -> None:
    """A day's full list (drops, or the set of free names) for the jobs after it; a second run of the day replaces it."""
    rows.withColumn("day", F.lit(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").json(path)


def dump_stages(stages: dict[str, DataFrame], path: str, order: str = "name") -> None:
    for name, rows in stages.items():
        rows.orderBy(order).select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(f"{path}/{name}")


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_release(counts: DataFrame, path: str, release: str, built_at: Column) -> DataFrame:
    """Write a link-count release clustered by name, so that a lookup skips most row groups; returns its meta rows."""
    rows = counts.select("apex_domain", "source_domain_count", F.lit(release).alias("release"))
    rows.repartitionByRange("apex_domain").sortWithinPartitions("apex_domain").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release").parquet(path)
    return rows.agg(F.count(F.lit(1)).cast("string").alias("n")).select(F.inline(F.array(F.struct(F.lit("release").alias("key"), F.lit(release).alias("value")), F.struct(F.lit("rows").alias("key"), F.col("n").alias("value")), F.struct(F.lit("built_at").alias("key"), built_at.cast("string").alias("value")))))
