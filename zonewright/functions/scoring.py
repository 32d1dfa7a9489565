"""Null-aware scores, evidence counts, verdicts and the published row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import names
from zonewright.functions.text import stripped


@dataclass(frozen=True)
class Scoring:
    """Weights and thresholds; a source is a name with the columns that witness it. Link counts are no source: a name that
    the graph lacks is not one that was looked up in vain. Without sources each of `fields` is one."""

    weights: dict[str, float] = field(default_factory=lambda: {"captures": 0.3, "rank": 0.4, "cert": 0.2, "length": 0.1, "links": 0.3})
    shortest: int = 2
    longest: int = 30
    sources: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"captures": ("wayback_snapshots", "wayback_last_snapshot"), "rank": ("open_page_rank",), "cert": ("cert_history",), "blocklists": ("surbl_listed", "spamhaus_listed"), "spam": ("spam_flagged",)}
    )
    fields: tuple[str, ...] = ("wayback_snapshots", "wayback_last_snapshot", "open_page_rank", "cert_history", "previous_registrar")
    clean_from: int = 70
    promising_from: int = 40
    least_evidence: int = 3
    promising_captures: int = 1000
    promising_rank: float = 1.5
    promising_links: int = 10
    floor_score: int = 40
    floor_evidence: int = 3


DEFAULT = Scoring()


def log_share(n: Column, scale: float) -> Column:
    """log10(n + 1) / scale, at most 1; null stays null, negative counts are 0."""
    return F.when(n.isNotNull(), F.least(F.lit(1.0), F.log10(F.greatest(n, F.lit(0)) + 1) / scale))


def components(c: Scoring = DEFAULT) -> dict[str, Column]:
    length = F.length(names.label(F.col("name")))
    span = max(1, c.longest - c.shortest)
    return {
        "captures": log_share(F.col("wayback_snapshots"), 3.0),
        "rank": F.when(F.col("open_page_rank").isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("open_page_rank") / 10))),
        "cert": F.col("cert_history").cast("double"),
        "length": F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.lit(c.longest) - length) / F.lit(span))),
        "links": log_share(F.col("cc_source_domain_count"), 4.0),
    }


def weighted_score(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    """The weighted mean of what is known, times 100, rounded half to even, 0 to 100; null if nothing is known, 0 if the
    known weights sum to nothing. The sum is taken in the order of the weights."""
    known = [(parts[k], w) for k, w in weights.items() if k in parts]
    total = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in known), F.lit(0.0))
    weight = sum((F.when(v.isNotNull(), F.lit(float(w))).otherwise(0.0) for v, w in known), F.lit(0.0))
    any_ = F.coalesce(*[v.cast("double") for v, _ in known]).isNotNull()
    return F.when(any_, F.when(weight <= 0, 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), F.bround(total / F.nullif(weight, F.lit(0.0)) * 100).cast("int")))))


def score(c: Scoring = DEFAULT) -> Column:
    return weighted_score(components(c), c.weights)


def evidence_count(c: Scoring = DEFAULT, unknown_captures: Column | None = None) -> Column:
    """How many sources have a value; unknown_captures: rows whose captures count although they are unknown."""
    total = F.lit(0)
    for name, columns in (c.sources or {x: (x,) for x in c.fields}).items():
        some = F.coalesce(*[F.col(x).cast("string") for x in columns]).isNotNull()
        if unknown_captures is not None and (name == "captures" or all(x.startswith("wayback") for x in columns)):
            some = some | F.coalesce(unknown_captures, F.lit(False))
        total = total + some.cast("int")
    return total


def verdict(soft: Column, category: Column, score_: Column, evidence: Column, c: Scoring = DEFAULT) -> Column:
    """Clean by score and evidence; Promising needs captures, and rank or links, as well; unknown signals count as 0. Rows
    have wayback_snapshots, open_page_rank and cc_source_domain_count."""
    s, e = F.coalesce(score_, F.lit(0)), F.coalesce(evidence, F.lit(0))
    enough = e >= c.least_evidence
    reaches = lambda column, least: F.coalesce(F.col(column) >= least, F.lit(least <= 0))
    grown = reaches("wayback_snapshots", c.promising_captures) & (reaches("open_page_rank", c.promising_rank) | reaches("cc_source_domain_count", c.promising_links))
    return (
        F.when(F.coalesce(soft, F.lit(False)), "Caution")
        .when(F.coalesce(category, F.lit("")).isin("parked", "empty"), "Caution")
        .when((s >= c.clean_from) & enough, "Clean")
        .when((s >= c.promising_from) & enough & grown, "Promising")
        .otherwise("Caution")
    )


def verdict_or_fallback(stored: Column, score_: Column, c: Scoring = DEFAULT) -> Column:
    """The stored verdict if it is one, else from the score alone."""
    return F.coalesce(F.when(stored.isin("Clean", "Promising", "Caution"), stored), F.when(score_ >= c.clean_from, "Clean").when(score_ >= c.promising_from, "Promising").otherwise("Caution"))


def quality_floor(rows: DataFrame, c: Scoring = DEFAULT, evidence: Column | None = None) -> DataFrame:
    """rows with floor_reason: low_score first, then incomplete; null passes. evidence: sources that reported, by default
    the column of that name."""
    evidence = F.col("evidence") if evidence is None else evidence
    low = F.coalesce(F.col("score"), F.lit(0)) < c.floor_score
    return rows.withColumn("floor_reason", F.when(low, "low_score").when(evidence < c.floor_evidence, "incomplete"))


def floor_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("floor_reason") == "low_score").alias("low_score"), F.count_if(F.col("floor_reason") == "incomplete").alias("incomplete"), F.count_if(F.col("floor_reason").isNull()).alias("kept"))


_HISTORY = "array<struct<release: string, source_domain_count: double>>"


def link_history(json: Column) -> Column:
    """A checked history, or null: one bad entry makes all of it invalid, as do no entries; null counts stay null."""
    raw = F.from_json(json, _HISTORY)
    # booleans and text do not read as numbers: they are told from real nulls by the text of the entry
    texts = F.from_json(json, "array<struct<release: string, source_domain_count: string>>")
    good = F.forall(F.arrays_zip(raw.alias("r"), texts.alias("t")), lambda x: x["r"]["release"].isNotNull() & (x["t"]["source_domain_count"].isNull() | x["t"]["source_domain_count"].rlike("^[0-9]+$")))
    counts = F.transform(texts, lambda t: F.struct(t["release"].alias("release"), t["source_domain_count"].try_cast("long").alias("source_domain_count")))
    return F.when((F.size(raw) > 0) & good, counts)


def link_trend(history: Column, band: float = 0.2) -> Column:
    """up, down or flat from the oldest to the newest known count; null with fewer than two. Newest entries come first."""
    known = F.filter(history, lambda h: h["source_domain_count"].isNotNull())
    new, old = F.get(known, F.lit(0))["source_domain_count"], F.get(known, F.size(known) - 1)["source_domain_count"]
    change = (new - old) / F.greatest(old, F.lit(1))
    return F.when(F.size(known) >= 2, F.when(change > band, "up").when(change < -band, "down").otherwise("flat"))


def registrar_links(name: Column, templates: dict[str, str]) -> Column:
    """array of (name, url) in the order of the templates, `{domain}` filled in."""
    return F.array(*[F.struct(F.lit(k).alias("name"), F.replace(F.lit(t), F.lit("{domain}"), name).alias("url")) for k, t in templates.items()])


PLACEHOLDER_REASONS = ("n/a", "none", "not scored")


def ranker_reason(raw: Column) -> Column:
    clean = F.nullif(stripped(raw), F.lit(""))
    return F.when(F.lower(clean).isin(*PLACEHOLDER_REASONS), None).otherwise(clean)


def capture_status(checked: Column, failed: Column, count: Column) -> Column:
    return F.when(~F.coalesce(checked, F.lit(False)), "not_checked").when(F.coalesce(failed, F.lit(False)), "lookup_failed").when(F.coalesce(count, F.lit(0)) > 0, "ok").otherwise("none_found")


def annotate(rows: DataFrame, today: Column) -> DataFrame:
    """days_listed since first_seen_date; new rows are seen today."""
    first = F.coalesce(F.col("first_seen_date"), today)
    return rows.withColumn("days_listed", F.datediff(today, first)).withColumn("first_seen_date", first)


PUBLISHED = ("name", "tld", "dropped_date", "score", "verdict", "days_listed", "first_seen_date", "wayback_snapshots", "open_page_rank", "cert_history", "cc_source_domain_count", "phase2_reason", "registrars", "rdap_status")


def published_row(rows: DataFrame) -> DataFrame:
    """The contract's columns; absent ones null, with rdap_status [] and days_listed 0 as defaults."""
    have = set(rows.columns)
    defaults = {"rdap_status": F.array().cast("array<string>"), "days_listed": F.lit(0)}
    return rows.select(*[(F.coalesce(F.col(c), defaults[c]) if c in defaults and c in have else F.col(c) if c in have else defaults.get(c, F.lit(None).cast("string"))).alias(c) for c in PUBLISHED])
