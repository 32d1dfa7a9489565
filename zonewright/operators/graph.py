"""The link graph: distinct inbound counts, releases of them, joins to candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.functions import names


#: Pairs that one task makes distinct: its hash table is that large, however many edges there are.
PAIRS_AT_ONCE = 1_000_000


def inbound_counts(edges: DataFrame, *by: str, rows: int | None = None) -> DataFrame:
    """(.. by, to_id, source_domain_count): distinct sources by target, and by more columns such as a release.

    Pairs are made distinct first: that spreads the edges of a hub by (to, from), and each task counts what is left. With the
    number of rows they are dealt over so many tasks that none holds more than PAIRS_AT_ONCE or so.
    """
    pairs = edges.select(*by, "from_id", "to_id")
    if rows is not None:
        pairs = pairs.repartition(-(-rows // PAIRS_AT_ONCE) or 1, *by, "from_id", "to_id")
    return pairs.distinct().groupBy(*by, "to_id").agg(F.count(F.lit(1)).alias("source_domain_count"))


def link_release(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Every vertex (id, reversed_domain) with its count, 0 where nothing links to it."""
    counts = inbound_counts(edges)
    joined = vertices.join(counts, vertices["id"] == counts["to_id"], "left")
    return joined.select(names.unreverse(F.col("reversed_domain")).alias("apex_domain"), F.coalesce("source_domain_count", F.lit(0)).alias("source_domain_count"))


def with_link_count(candidates: DataFrame, release: DataFrame) -> DataFrame:
    """candidates with source_domain_count: null where the graph has no such name, 0 where it has no links.

    The release is the large side: only its rows for the candidates are kept before the join back.
    """
    wanted = candidates.select(F.col("name").alias("apex_domain")).distinct()
    hits = release.join(wanted, "apex_domain", "left_semi")
    return candidates.join(hits.select(F.col("apex_domain").alias("name"), "source_domain_count"), "name", "left")


def with_link_history(candidates: DataFrame, counts: DataFrame, window: DataFrame) -> DataFrame:
    """candidates with cc_backlink_history: one entry a release of the window (release, place), newest first; null if no
    release knows the name."""
    slots = candidates.select("name").distinct().crossJoin(F.broadcast(window.select("release", "place")))  # names times a few releases
    known = slots.join(counts.select(F.col("apex_domain").alias("name"), "release", "source_domain_count"), ["name", "release"], "left")
    listed = known.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "release", "source_domain_count"))).alias("all"), F.count("source_domain_count").alias("n"))
    history = F.when(F.col("n") > 0, F.transform("all", lambda x: F.struct(x["release"].alias("release"), x["source_domain_count"].alias("source_domain_count"))))
    return candidates.join(listed.select("name", history.alias("cc_backlink_history")), "name", "left")


def release_window(releases: DataFrame, dimension: DataFrame, current: str, n: int) -> DataFrame:
    """(release, place): the current release first, then the newest others in time, n in all; unparseable names fall out."""
    known = releases.select("release").distinct().join(F.broadcast(dimension), "release")
    order = [(F.col("release") == current).desc(), F.col("year").desc(), F.col("end_month").desc()]
    return known.orderBy(*order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(*order)) - 1).select("release", "place")


def count_bucket(n: Column) -> Column:
    return F.when(n == 0, "0").when(n < 10, "1-9").when(n < 100, "10-99").when(n < 1000, "100-999").otherwise(">=1000")


def bucket_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("release", count_bucket(F.col("source_domain_count")).alias("bucket")).agg(F.count(F.lit(1)).alias("names"))


def bucket_ratios(counts: DataFrame, dimension: DataFrame) -> DataFrame:
    """(release, previous, bucket, names, ratio): the names of a bucket against those of the release before it in time."""
    table = bucket_counts(counts)
    order = Window.orderBy("year", "end_month")
    releases = table.select("release").distinct().join(F.broadcast(dimension), "release").withColumn("previous", F.lag("release").over(order)).select("release", "previous")  # one row a release
    before = table.select(F.col("release").alias("previous"), "bucket", F.col("names").alias("_before"))
    joined = table.join(releases, "release").join(before, ["previous", "bucket"], "left")
    return joined.select("release", "previous", "bucket", "names", (F.col("names") / F.col("_before")).alias("ratio"))


def current_release(pointer: DataFrame, release: str, checks: DataFrame) -> DataFrame:
    """The pointer table (current, previous) after a refresh: moved on if every check holds, else as it was."""
    passed = checks.agg(F.bool_and("ok").alias("ok"))
    return passed.join(pointer, F.lit(True), "left").select(F.when(F.col("ok"), release).otherwise(F.col("current")).alias("current"), F.when(F.col("ok") & ~F.col("current").eqNullSafe(F.lit(release)), F.col("current")).otherwise(F.col("previous")).alias("previous"))


def release_checks(counts: DataFrame, expected: str, *, least_rows: int, present: dict[str, int], absent: list[str]) -> DataFrame:
    """(place, check, ok): release id, row count, canaries present above their floor, canaries absent."""
    parts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("release") != expected).alias("foreign")]
    parts += [F.max(F.when(F.col("apex_domain") == k, F.col("source_domain_count"))).alias(f"p{i}") for i, k in enumerate(present)]
    parts += [F.count_if(F.col("apex_domain") == k).alias(f"a{i}") for i, k in enumerate(absent)]
    one = counts.agg(*parts)
    tests = [("release", (F.col("foreign") == 0) & (F.col("rows") > 0)), ("rows", F.col("rows") >= least_rows)]
    tests += [(f"present:{k}", F.coalesce(F.col(f"p{i}") >= v, F.lit(False))) for i, (k, v) in enumerate(present.items())]
    tests += [(f"absent:{k}", F.col(f"a{i}") == 0) for i, k in enumerate(absent)]
    return one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(n).alias("check"), t.alias("ok")) for i, (n, t) in enumerate(tests)])))


def retention_plan(releases: DataFrame, dimension: DataFrame, newest: int, protected: list[str]) -> DataFrame:
    """(release, action): keep the newest and the protected, skip names that are none, delete the rest; 0 keeps all."""
    known = releases.select("release").distinct().join(F.broadcast(dimension), "release", "left")
    rank = F.row_number().over(Window.orderBy(F.col("year").desc_nulls_last(), F.col("end_month").desc_nulls_last()))
    keep = F.lit(newest <= 0) | (F.col("rank") <= newest) | F.col("release").isin(*protected)
    return known.withColumn("rank", rank).select("release", F.when(F.col("year").isNull(), "skip").when(keep, "keep").otherwise("delete").alias("action"))
