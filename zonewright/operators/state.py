"""State between daily runs: tables in, tables out; nothing is overwritten while it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.functions import text
from zonewright.operators import snapshot


def age_out(rows: DataFrame, today: Column, most_days: int, seen: str = "first_seen_date") -> DataFrame:
    """Rows first seen at most so many days ago; undated ones count as new."""
    return rows.filter(F.datediff(today, F.coalesce(F.col(seen), today)) <= most_days)


def age_out_unknown(rows: DataFrame, most: int) -> DataFrame:
    """Rows with unknown captures get one more attempt, and go after too many; others are untouched."""
    unknown = F.coalesce(F.col("wayback_unknown"), F.lit(False))
    tried = F.coalesce(F.col("wayback_unknown_attempts"), F.lit(0)) + 1
    counted = rows.withColumn("wayback_unknown_attempts", F.when(unknown, tried).otherwise(F.col("wayback_unknown_attempts")))
    return counted.filter(~unknown | (F.col("wayback_unknown_attempts") <= most))


def rolling_list(previous: DataFrame, today_names: DataFrame, new: DataFrame, today: Column, *, most_days: int = 14, most_attempts: int = 3) -> DataFrame:
    """The list of the day: the previous one aged, without names that are back, then the new rows over it."""
    aged = age_out_unknown(age_out(previous, today, most_days), most_attempts)
    carried = snapshot.revalidate(aged, today_names, today).withColumn("days_listed", F.datediff(today, F.coalesce("first_seen_date", today)))
    fresh = new.withColumn("days_listed", F.lit(0)).withColumn("first_seen_date", today)
    return snapshot.replace_by(fresh, carried)


def denylist_additions(denylist: DataFrame, found: DataFrame, today: Column, version: str) -> DataFrame:
    """Rows to append: names not yet on the list, lower-case, each once. Entries never age and keep their first date."""
    fresh = found.select(F.lower(text.stripped(F.col("name"))).alias("name")).filter("name <> ''").distinct()
    return fresh.join(denylist.select(F.lower(text.stripped(F.col("name"))).alias("name")), "name", "left_anti").select("name", today.alias("classified_date"), F.lit(version).alias("classifier_version"))


def split_toxic(rows: DataFrame, denylist: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, evicted): toxic now or remembered."""
    known = denylist.select(F.lower("name").alias("_low")).distinct().withColumn("_remembered", F.lit(True))
    marked = rows.withColumn("_low", F.lower("name")).join(known, "_low", "left")
    toxic = F.coalesce(F.col("snapshot_category") == "toxic", F.lit(False)) | F.col("_remembered").isNotNull()
    return marked.filter(~toxic).drop("_low", "_remembered"), marked.filter(toxic).drop("_low", "_remembered")


def incomplete_reasons(required: tuple[str, ...] = ("wayback_snapshots", "open_page_rank")) -> Column:
    """Why a row is not fully screened, as an array: empty if it is. Rows have snapshot_category and wayback_unknown."""
    unscreened = F.coalesce(F.col("snapshot_category"), F.lit("unknown")) == "unknown"
    reasons = [F.when(unscreened, "content_unscreened"), F.when(F.col("wayback_unknown"), "wayback_unknown"), *[F.when(F.col(c).isNull(), f"missing:{c}") for c in required]]
    return F.array_compact(F.array(*reasons))


def settle_held(held: DataFrame, candidates: DataFrame, enriched: DataFrame, survivors: DataFrame, registered: DataFrame, today: Column, window_days: int, confirmed: DataFrame | None = None) -> DataFrame:
    """One row a name with its action. All tables have name; held: first_held_date, checks; candidates are the new rows;
    survivors: complete, reasons; confirmed: names known to be free (without it all that are not registered).

    Held: reregistered; released (survived, complete); rejected (enriched, filtered out); expired; held. New: publish;
    gone; new_held, or expired where nothing is held at all. A held row without a date begins its window today.
    """
    flag = lambda df, c: df.select("name").distinct().withColumn(c, F.lit(True))
    old = held.select("name", "first_held_date", "checks").withColumn("_held", F.lit(True))
    new = flag(candidates, "_new")
    every = old.join(new, "name", "full")
    every = every.join(flag(registered, "_registered"), "name", "left").join(flag(enriched, "_enriched"), "name", "left")
    every = every.join(flag(confirmed, "_free"), "name", "left") if confirmed is not None else every.withColumn("_free", F.lit(True))
    every = every.join(survivors.select("name", F.coalesce("complete", F.lit(False)).alias("complete"), "reasons").withColumn("_survived", F.lit(True)), "name", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    expired = F.datediff(today, F.coalesce("first_held_date", today)) >= window_days
    action = (
        F.when(yes("_held") & yes("_registered"), "reregistered")
        .when(yes("_held") & yes("_survived") & yes("complete"), "released")
        .when(yes("_held") & yes("_enriched") & ~yes("_survived"), "rejected")
        .when(yes("_held") & expired, "expired")
        .when(yes("_held"), "held")
        .when(yes("_survived") & yes("complete"), "publish")
        .when(yes("_enriched") & ~yes("_survived"), "gone")
        .when(F.lit(window_days <= 0), "expired")
        .otherwise("new_held")
    )
    reasons = F.when(yes("_survived"), F.coalesce("reasons", F.array().cast("array<string>"))).when(yes("_enriched"), F.array().cast("array<string>")).when(yes("_new") | yes("_free"), F.array(F.lit("not_enriched"))).otherwise(F.array(F.lit("rdap_unknown")))
    out = every.withColumn("action", action)
    return out.select(
        "name", "action", F.coalesce("first_held_date", F.when(F.col("action").isin("new_held", "held"), today)).alias("first_held_date"),
        F.when(F.col("action") == "held", F.coalesce("checks", F.lit(0)) + 1).when(F.col("action") == "new_held", 0).otherwise(F.col("checks")).cast("int").alias("checks"),
        F.when(F.col("action").isin("held", "new_held"), reasons).alias("reasons"),
    )


def overflow(previous: DataFrame, above_gate: DataFrame, selected: DataFrame, today: Column, most_days: int = 14) -> DataFrame:
    """The overflow table of the day: what is not too old (undated rows stay), and today's rows that were not selected."""
    kept = previous.filter(F.coalesce(F.datediff(today, F.col("first_seen_date")) <= most_days, F.lit(True)))
    new = snapshot.difference(above_gate, selected).withColumn("first_seen_date", today)
    return kept.unionByName(new, allowMissingColumns=True)


def merge_cache(cache: DataFrame, updates: DataFrame) -> DataFrame:
    """(name, excerpt): a usable update wins, an unusable one never replaces a usable entry and else is remembered."""
    both = cache.select("name", F.col("excerpt").alias("old")).join(updates.select("name", F.col("excerpt").alias("new"), F.lit(True).alias("_touched")), "name", "full")
    keeps = F.col("_touched").isNull() | (~text.usable_excerpt(F.col("new")) & text.usable_excerpt(F.col("old")))
    return both.select("name", F.when(keeps, F.col("old")).otherwise(F.col("new")).alias("excerpt"))


def cached_excerpts(rows: DataFrame, cache: DataFrame, today: Column, most_age_days: int) -> DataFrame:
    """rows with cached_excerpt and excerpt_source: reused, refetch (stale, kept as a fallback), missing."""
    joined = rows.join(cache.select("name", F.col("excerpt").alias("cached_excerpt")), "name", "left")
    usable = text.usable_excerpt(F.col("cached_excerpt"))
    old = text.stale(F.col("cached_excerpt")["snapshot_timestamp"], today, most_age_days)
    return joined.withColumn("excerpt_source", F.when(usable & ~old, "reused").when(usable, "refetch").otherwise("missing"))


def apply_category(rows: DataFrame, labels: DataFrame, shadow: bool) -> DataFrame:
    """rows with the new categories: in shadow mode beside the live label, which stays."""
    joined = rows.join(labels.select("name", F.col("category").alias("_category")), "name", "left")
    target = "shadow_category" if shadow else "snapshot_category"
    old = F.col(target) if target in rows.columns else F.lit(None).cast("string")
    return joined.withColumn(target, F.coalesce(F.col("_category"), old)).drop("_category")


def new_entries(index: DataFrame, rows: DataFrame, key: str = "name") -> DataFrame:
    """Rows to append to an index whose entries are never made anew."""
    return rows.dropDuplicates([key]).join(index.select(key), key, "left_anti")


def new_events(archive: DataFrame, events: DataFrame) -> DataFrame:
    """Events to append, by (domain, drop_date, source), with their month; undated ones go to `unknown`.

    Only the months that the events touch are read of the archive.
    """
    dated = events.withColumn("month", F.coalesce(F.date_format("drop_date", "yyyy-MM"), F.lit("unknown"))).withColumn("_day", F.coalesce(F.col("drop_date").cast("string"), F.lit("")))
    months = [r["month"] for r in dated.select("month").distinct().collect()]  # one row a month
    before = archive.filter(F.col("month").isin(months)).select("domain", F.coalesce(F.col("drop_date").cast("string"), F.lit("")).alias("_day"), "source")
    return dated.dropDuplicates(["domain", "_day", "source"]).join(before, ["domain", "_day", "source"], "left_anti").drop("_day")


def first_occurrences(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rank = 1").drop("_rank")


def events_by_day(events: DataFrame) -> DataFrame:
    """One dated event a domain and day: live ones first, then by ingest_order."""
    return first_occurrences(events.filter("drop_date is not null"), ["domain", "drop_date"], [(F.col("source") == "live").desc(), F.col("ingest_order")])


def targets(rows: DataFrame, mode: str = "default", top: int | None = None) -> DataFrame:
    """Rows to classify again: default: unlabelled; unknown: labelled unknown, with a capture; force: all."""
    if mode == "default":
        rows = rows.filter("snapshot_category is null")
    elif mode == "unknown":
        rows = rows.filter((F.col("snapshot_category") == "unknown") & (F.coalesce("wayback_snapshots", F.lit(0)) > 0))
    elif mode != "force":
        raise ValueError(f"no such mode: {mode}")
    return rows if top is None else rows.orderBy(F.desc_nulls_last("score"), "name").limit(top)


def qualifying(rows: DataFrame, index: DataFrame, denylist: DataFrame) -> DataFrame:
    """Rows that get a page: a good verdict, not in the index, not remembered as toxic."""
    low = denylist.select(F.lower("name").alias("_low"))
    good = rows.filter(F.col("verdict").isin("Clean", "Promising")).join(index.select("name"), "name", "left_anti")
    return good.withColumn("_low", F.lower("name")).join(low, "_low", "left_anti").drop("_low")
