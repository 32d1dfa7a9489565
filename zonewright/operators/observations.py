"""Archive events as observations, documents and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.functions import names, scoring, text
from zonewright.operators import ranking

_OBSERVATION = ("observed_at", "kind", "name", "value_num", "value_bool", "value_str", "status", "source")


def _observed(at: Column, kind: str, name: str, status: Column, source: Column, num=None, flag=None, string=None) -> Column:
    null = F.lit(None)
    return F.struct(
        at.cast("timestamp").alias("observed_at"), F.lit(kind).alias("kind"), F.lit(name).alias("name"),
        (num if num is not None else null).cast("double").alias("value_num"), (flag if flag is not None else null).cast("boolean").alias("value_bool"),
        (string if string is not None else null).cast("string").alias("value_str"), status.alias("status"), source.alias("source"),
    )


def observations(events: DataFrame, checked_since: Column) -> DataFrame:
    """Seven observations an event, and one left_zone for each distinct drop day of a domain."""
    at, source = F.coalesce(F.col("availability_confirmed_date"), F.col("drop_date")), F.col("source")
    known = lambda c: F.when(F.col(c).isNull(), "not_checked").otherwise("ok")
    available = F.when((source == "live") | (F.col("drop_date") >= checked_since), "available").otherwise("dropped")
    capture = scoring.capture_status(F.col("wayback_snapshots").isNotNull() | F.col("wayback_unknown"), F.col("wayback_unknown"), F.col("wayback_snapshots"))
    rows = F.array(
        _observed(at, "availability", "availability", F.lit("ok"), source, string=available),
        _observed(at, "metric", "open_page_rank", known("open_page_rank"), source, num=F.col("open_page_rank")),
        _observed(at, "metric", "source_domain_count", known("cc_source_domain_count"), source, num=F.col("cc_source_domain_count")),
        _observed(at, "metric", "cert_history", known("cert_history"), source, flag=F.col("cert_history")),
        _observed(at, "captures", "captures", capture, source, num=F.col("wayback_snapshots")),
        _observed(at, "analysis", "category", known("snapshot_category"), source, string=F.col("snapshot_category")),
        _observed(at, "analysis", "name_quality", known("phase2_score"), source, num=F.col("phase2_score")),
    )
    seen = events.select("domain", F.inline(rows))
    left = events.filter("drop_date is not null").select("domain", "drop_date").distinct()
    return seen.unionByName(left.select("domain", F.inline(F.array(_observed(F.col("drop_date"), "zone", "left_zone", F.lit("ok"), F.lit("zone"), flag=F.lit(True))))))


def latest(rows: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The newest observation that answered for each key, else the newest of any."""
    key = key or ["domain", "kind", "name"]
    order = [(F.col("status") == "ok").desc(), F.col("observed_at").desc(), F.coalesce(F.col("value_num").cast("string"), F.col("value_str"), F.lit(""))]
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rank = 1").drop("_rank")


def grouped_events(events: DataFrame) -> DataFrame:
    """events with domain normalised; those that are no names with a dot are gone."""
    low = F.regexp_replace(F.lower(text.stripped(F.col("domain"))), r"\.$", "")
    return events.withColumn("domain", low).filter(F.contains("domain", F.lit(".")))


def roll_up(events: DataFrame) -> DataFrame:
    """One row a domain: first and last day, distinct drop days, ever published, events."""
    return events.groupBy("domain").agg(
        F.min("drop_date").alias("first_seen"), F.max("drop_date").alias("last_seen"), F.count_distinct("drop_date").alias("drop_days"),
        F.max(F.coalesce("was_published", F.lit(False))).alias("ever_published"), F.count(F.lit(1)).alias("events"),
    )


def newest_answer(events: DataFrame, answered: Column) -> DataFrame:
    """The newest event of a domain for which answered holds, else the newest."""
    order = [F.coalesce(answered, F.lit(False)).desc(), F.col("drop_date").desc(), F.col("ingest_order")]
    return events.withColumn("_rank", F.row_number().over(Window.partitionBy("domain").orderBy(*order))).filter("_rank = 1").drop("_rank")


def documents(events: DataFrame, checked_since: Column, excerpts: DataFrame | None = None) -> DataFrame:
    """One nested document a domain: zone, availability, metrics, captures, analysis, publication, number of observations.
    excerpts: name, excerpt with a title."""
    events = grouped_events(events)
    if "wayback_last_snapshot" not in events.columns:
        events = events.withColumn("wayback_last_snapshot", F.lit(None).cast("date"))
    seen = F.col("wayback_snapshots").isNotNull() & ~F.coalesce(F.col("wayback_unknown"), F.lit(False))
    answered = newest_answer(events.filter("drop_date is not null"), seen)
    status = scoring.capture_status(F.col("wayback_snapshots").isNotNull() | F.col("wayback_unknown"), F.col("wayback_unknown"), F.col("wayback_snapshots"))
    captures = answered.select("domain", F.struct(F.col("wayback_snapshots").cast("double").alias("value_num"), status.alias("status"), F.coalesce("availability_confirmed_date", "drop_date").cast("timestamp").alias("observed_at"), F.year("wayback_last_snapshot").alias("last_year")).alias("captures"))
    title = F.lit(None).cast("string")
    if excerpts is not None:
        known = excerpts.select(F.lower("name").alias("domain"), F.col("excerpt.title").alias("_title")).groupBy("domain").agg(F.max("_title").alias("_title"))
        captures, title = captures.join(known, "domain", "left"), F.when(text.stripped(F.col("_title")) != "", F.col("_title"))
    captures = captures.select("domain", F.col("captures").withField("sample_title", title).alias("captures"))
    newest = latest(observations(events, checked_since))
    pick = lambda kind, what: F.max(F.when(F.col("kind") == kind, what))
    one = F.struct("name", "value_num", "value_bool", "observed_at", "status", "source")
    wide = newest.groupBy("domain").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "metric", one))).alias("metrics"),
        pick("availability", F.struct("value_str", "observed_at", "source")).alias("availability"),
        F.max(F.when(F.col("name") == "category", F.col("value_str"))).alias("category"),
        F.max(F.when(F.col("name") == "name_quality", F.col("value_num"))).alias("name_quality"),
    )
    analysis = F.when(F.col("category").isNotNull() | F.col("name_quality").isNotNull(), F.struct("category", "name_quality"))
    zone = F.struct("first_seen", "last_seen", "drop_days", F.col("last_seen").cast("timestamp").alias("left_zone_at"))
    # seven an event, and one for each day on which the name left its zone
    number = (7 * F.col("events") + F.col("drop_days")).alias("observations")
    return roll_up(events).join(wide, "domain").join(captures, "domain", "left").select("domain", zone.alias("zone"), F.col("availability").withField("drop_date", F.col("last_seen")).alias("availability"), "metrics", "captures", analysis.alias("analysis"), "ever_published", "events", number)


def lookup(docs: DataFrame, domain: str) -> DataFrame:
    """The document of a domain as anyone may write it: no row if there is none."""
    return docs.filter(F.col("domain") == names.normalize_domain(F.lit(domain), idna=False))


def of_domain(rows: DataFrame, domain: str) -> DataFrame:
    """The observations of a domain, oldest first."""
    return rows.filter(F.col("domain") == names.normalize_domain(F.lit(domain), idna=False)).orderBy("observed_at", "kind", "name", "source")


def compact(docs: DataFrame) -> DataFrame:
    """The flat rows that candidate lists show and filter: domain, tld, status, links, rank, captures, first_seen, last_seen,
    first_year, verdict."""
    metric = lambda n: F.get(F.filter("metrics", lambda m: m["name"] == n), F.lit(0))["value_num"]
    return docs.select(
        "domain", names.tld(F.col("domain")).alias("tld"), F.col("availability.value_str").alias("status"), metric("source_domain_count").alias("links"), metric("open_page_rank").alias("rank"),
        F.col("captures.value_num").alias("captures"), F.col("zone.first_seen").alias("first_seen"), F.col("zone.last_seen").alias("last_seen"), F.lit(None).cast("int").alias("first_year"), F.col("analysis.category").alias("verdict"),
    )


#: The orders of candidate lists and of the change feed: columns, and whether they descend; nulls come last.
ORDERS = {"first_seen": [("first_seen", True), ("domain", False)], "links": [("links", True), ("domain", False)], "first_year": [("first_year", False), ("domain", False)], "changes": [("last_seen", False), ("domain", False)]}


def candidates(docs: DataFrame, *, tld: str | None = None, status: str | None = None, least_links: int | None = None, has_captures: bool | None = None, first_after: str | None = None, updated_after: str | None = None, sort: str = "first_seen") -> DataFrame:
    """Flat rows (domain, status, links, captures, first_seen, last_seen, first_year) filtered and sorted; unknown links
    never reach a minimum, dates are strict."""
    if tld is not None:
        docs = docs.filter(names.tld(F.col("domain")) == tld)
    if status is not None:
        docs = docs.filter(F.col("status") == status)
    if least_links is not None:
        docs = docs.filter(F.col("links") >= least_links)
    if has_captures is not None:
        docs = docs.filter((F.coalesce("captures", F.lit(0)) > 0) == F.lit(has_captures))
    if first_after is not None:
        docs = docs.filter(F.col("first_seen") > F.lit(first_after).cast("date"))
    if updated_after is not None:
        docs = docs.filter(F.col("last_seen") > F.lit(updated_after).cast("date"))
    return docs.orderBy(*ranking.sort_order(ORDERS[sort]))


def changes(docs: DataFrame, since: Column) -> DataFrame:
    """What changed after a day, oldest first: added or updated."""
    return docs.filter(F.col("last_seen") > since).select("domain", F.when(F.col("first_seen") > since, "added").otherwise("updated").alias("change"), "last_seen").orderBy("last_seen", "domain")


def source_health(rows: DataFrame, drops: DataFrame) -> DataFrame:
    """The newest observation of each source, the zones' drop dates among them."""
    both = rows.select("source", "observed_at").unionByName(drops.select(F.lit("zone").alias("source"), F.col("drop_date").cast("timestamp").alias("observed_at")))
    return both.groupBy("source").agg(F.max("observed_at").alias("latest"))


def roll_up_parts(events: DataFrame) -> DataFrame:
    """What a domain's events of a month come to, small enough to be kept and merged: the drop days as a bitmap of one int,
    first and last day, ever published, events. Undated ones are of month `unknown`."""
    month = F.coalesce(F.date_format("drop_date", "yyyy-MM"), F.lit("unknown"))
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth("drop_date") - 1)
    return events.groupBy("domain", month.alias("month")).agg(
        F.coalesce(F.bit_or(bit), F.lit(0)).alias("days"), F.min("drop_date").alias("first_seen"), F.max("drop_date").alias("last_seen"),
        F.max(F.coalesce("was_published", F.lit(False))).alias("ever_published"), F.count(F.lit(1)).alias("events"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("domain", "month").agg(F.bit_or("days").alias("days"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max("ever_published").alias("ever_published"), F.sum("events").alias("events"))


def roll_up_of(parts: DataFrame) -> DataFrame:
    """roll_up()'s rows from parts, at most one a domain and month."""
    return parts.groupBy("domain").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum(F.bit_count("days")).alias("drop_days"), F.max("ever_published").alias("ever_published"), F.sum("events").alias("events"))
