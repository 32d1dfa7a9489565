"""Snapshots stored with digests of their hash buckets: two days are compared by digests, and only buckets that differ are
read and joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "tld string, bucket int, name string"
DIGEST = "tld string, bucket int, names long, low long, high decimal(38,0)"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("tld", "name"), F.lit(buckets)).cast("int")


def bucket_digests(rows: DataFrame) -> DataFrame:
    """One row a bucket: its number of names and two digests of them in any order."""
    return rows.groupBy("tld", "bucket").agg(F.count(F.lit(1)).alias("names"), F.bit_xor(F.xxhash64("name")).alias("low"), F.sum(F.xxhash64("name", F.lit(1)).cast("decimal(38,0)")).alias("high"))


def tld_digests(digests: DataFrame) -> DataFrame:
    """The level above: one row a tld, from its buckets."""
    each = F.xxhash64("bucket", "names", "low", "high")
    return digests.groupBy("tld").agg(F.sum("names").alias("names"), F.bit_xor(each).alias("low"), F.sum(each.cast("decimal(38,0)")).alias("high"))


def commit(names: DataFrame, root: str, day: str, buckets: int = 256) -> None:
    """Write the distinct names (tld, name) of a day by tld and bucket, then their digests; a second run of the day replaces
    both. Days that are compared must have the same number of buckets."""
    spark = names.sparkSession
    rows = names.select("tld", "name").distinct().withColumn("bucket", _bucket(buckets))
    rows.repartition("tld", "bucket").sortWithinPartitions("tld", "bucket", "name").write.mode("overwrite").partitionBy("tld", "bucket").parquet(f"{root}/names/{day}")
    bucket_digests(_names(spark, root, day)).withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(f"{root}/digests/{day}")


def _names(spark: SparkSession, root: str, day: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).parquet(f"{root}/names/{day}")


def differing(spark: SparkSession, root: str, yesterday: str, today: str) -> list[tuple[str, int]]:
    """The buckets of yesterday that today has otherwise, of tlds that today has; tlds with equal roots are passed over."""
    old, new = (spark.read.parquet(f"{root}/digests/{d}") for d in (yesterday, today))
    sizes = {r["buckets"] for d in (old, new) for r in d.select("buckets").distinct().collect()}  # one row a size
    if len(sizes) > 1:
        raise ValueError(f"snapshots have different numbers of buckets: {sorted(sizes)}")
    same = ["names", "low", "high"]
    tops = tld_digests(new)
    loaded = old.join(tops, "tld", "left_semi")
    tlds = tld_digests(loaded).join(tops, ["tld", *same], "left_anti").select("tld")
    buckets = loaded.join(tlds, "tld", "left_semi").join(new, ["tld", "bucket", *same], "left_anti")
    return [(r["tld"], r["bucket"]) for r in buckets.select("tld", "bucket").orderBy("tld", "bucket").collect()]  # one row a bucket


def drops(spark: SparkSession, root: str, yesterday: str, today: str) -> DataFrame:
    """Names (tld, name) of yesterday that today has not, of tlds that were loaded today. The names of a bucket stand in
    files of their own, so what did not change is not read."""
    changed = differing(spark, root, yesterday, today)
    if not changed:
        return spark.createDataFrame([], "tld string, name string")
    system = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def of(day: str) -> DataFrame:
        base = f"{root}/names/{day}"
        folders = [f"{base}/tld={t}/bucket={b}" for t, b in changed]
        there = [f for f in folders if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f))]
        return spark.read.schema(SNAPSHOT).option("basePath", base).parquet(*there) if there else spark.createDataFrame([], SNAPSHOT)

    return of(yesterday).join(of(today), ["tld", "bucket", "name"], "left_anti").select("tld", "name")
