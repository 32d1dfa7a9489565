"""Dated name snapshots: what dropped, what came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drops(yesterday: DataFrame, today: DataFrame) -> DataFrame:
    """Names (tld, name) of yesterday that today has not. A tld without any name today was not loaded: no drops."""
    loaded = today.select("tld").distinct()
    return yesterday.select("tld", "name").distinct().join(loaded, "tld", "left_semi").join(today.select("tld", "name"), ["tld", "name"], "left_anti")


def revalidate(carried: DataFrame, today: DataFrame, day: Column) -> DataFrame:
    """Carried rows whose name is not back. Rows of a loaded tld get last_validated_date; the others pass unchanged."""
    loaded = today.select("tld").distinct().withColumn("_loaded", F.lit(True))
    gone = carried.join(today.select("tld", "name").distinct(), ["tld", "name"], "left_anti").join(loaded, "tld", "left")
    old = F.col("last_validated_date") if "last_validated_date" in carried.columns else F.lit(None).cast("date")
    return gone.withColumn("last_validated_date", F.when(F.col("_loaded"), day).otherwise(old)).drop("_loaded")


def replace_by(new: DataFrame, old: DataFrame, key: str = "name") -> DataFrame:
    """All of new, and of old what new does not name; rows are not merged."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"), allowMissingColumns=True)


def difference(rows: DataFrame, taken: DataFrame, key: str = "name") -> DataFrame:
    return rows.join(taken.select(key), key, "left_anti")


def concat_ahead(first: DataFrame, then: DataFrame, key: str = "name") -> DataFrame:
    """first, then what it does not name of the other, with `place` 0 and 1 to order by."""
    rest = then.join(first.select(key), key, "left_anti")
    return first.withColumn("place", F.lit(0)).unionByName(rest.withColumn("place", F.lit(1)), allowMissingColumns=True)
