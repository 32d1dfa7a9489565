"""The daily and monthly jobs, each a fixed composition of operators over tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import names, rules, scoring, text
from zonewright.operators import graph, metrics, observations, ranking, signals, snapshot, state
from zonewright.sources import readers, writers
from zonewright.sources.staging import staged


@dataclass(frozen=True)
class Daily:
    rules: rules.Rules = rules.DEFAULT
    scoring: scoring.Scoring = scoring.DEFAULT
    #: Names that a ranker is sent, the least score that goes on, and how many must have it for the ranking to count.
    narrow_to: int = 2500
    gate: int = 60
    least_eligible: int = 10
    #: Names that availability is asked for, the most natural ones first; 0: all.
    most_checked: int = 15_000
    publish: int = 200
    held_days: int = 3
    required: tuple[str, ...] = ("wayback_snapshots", "open_page_rank")
    strict: bool = True
    shadow: bool = False
    classifier: str = "1"
    #: What spam terms in an excerpt make of a name.
    signature_action: str = "toxic"
    registrars: dict[str, str] = field(default_factory=lambda: {"registrar": "https://registrar.example/?q={domain}"})


def filtered_drops(yesterday: DataFrame, today: DataFrame, c: Daily = Daily()) -> DataFrame:
    """Drops with reject_reason: structural first, then lexical; null passes."""
    dropped = snapshot.drops(yesterday, today)
    reason = F.coalesce(rules.structural_reason(F.col("name"), c.rules), rules.lexical_reason(F.col("name"), c.rules))
    return dropped.withColumn("reject_reason", reason)


def ranked(lexical: DataFrame, ranker: DataFrame | None, c: Daily = Daily()) -> tuple[DataFrame, DataFrame, bool]:
    """(what goes on, the ranker's status row, whether it is ranked). ranker: name, phase2_score, phase2_reason of the names
    that it answered for. Without a ranker, or where it answered too little, the whole list goes on as it is; else the
    names at the gate or above, with their scores."""
    if ranker is None:
        return lexical, metrics.ranker_mode(lexical.limit(0).withColumn("phase2_score", F.lit(None).cast("int")), enabled=False, gate=c.gate, least=c.least_eligible), False
    sent = ranking.pre_narrow(lexical, c.narrow_to).select(*lexical.columns)
    answers = staged(sent.join(ranker.select("name", "phase2_score", "phase2_reason"), "name", "left"), "ranked")
    status = metrics.ranker_mode(answers, enabled=True, gate=c.gate, least=c.least_eligible)
    if status.first()["mode"] == "fallback":  # one row
        return lexical, status, False
    return answers.filter(F.col("phase2_score") >= c.gate), status, True


def daily_run(
    yesterday: DataFrame, today: DataFrame, previous: DataFrame, denylist: DataFrame, availability: DataFrame, evidence: DataFrame, day: Column, c: Daily = Daily(), *,
    ranker: DataFrame | None = None, services: DataFrame | None = None, quotas: DataFrame | None = None, overflow: DataFrame | None = None, held: DataFrame | None = None, categories: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The tables of one day. availability: name, is_available (free names only are looked at further). evidence: name and
    the signal columns. ranker: name, phase2_score, phase2_reason. services: tlds, urls, and quotas: host, quota, of the
    hosts that availability is asked of. overflow: what was above the gate and not asked for on earlier days. held: tld,
    name, first_held_date, checks of names whose screening was not complete. categories: name, category.

    The tables that the rest fans out from are written once: drops, answers of the ranker, scored rows. What the day
    leaves to the next one (overflow, held, denylist) comes back as tables, to be written by commit_daily.
    """
    counted = metrics.Counted()
    drops = staged(counted.of(filtered_drops(yesterday, today, c), drops=F.lit(True), lexical=F.col("reject_reason").isNull()), "drops")
    lexical = drops.filter("reject_reason is null").drop("reject_reason")
    eligible, status, is_ranked = ranked(lexical, ranker, c)
    pool = ranking.pre_narrow(eligible, c.most_checked).select(*eligible.columns) if c.most_checked > 0 else eligible
    if services is not None and quotas is not None:
        pool = ranking.within_quota(ranking.hosts_of_tlds(pool, services), quotas, day.cast("string")).drop("host")
    selected = staged(counted.of(pool, selected=F.lit(True)), "selected")
    none_yet = eligible.select("tld", "name").limit(0).withColumn("first_seen_date", day)
    left_over = state.overflow(none_yet if overflow is None else overflow, eligible.select("tld", "name") if is_ranked else none_yet.select("tld", "name"), selected, day)

    # held names are asked for first, whatever the quotas
    queue = (none_yet.select("tld", "name", day.alias("first_held_date"), F.lit(0).alias("checks")) if held is None else held).withColumn("name", F.lower(F.trim("name"))).filter("name <> ''").dropDuplicates(["name"])
    asked = snapshot.concat_ahead(queue.drop("first_held_date", "checks"), selected)
    free, turned_away = signals.available_only(asked, availability)
    enriched = free.join(evidence, "name", "left").withColumn("dropped_date", day)
    for column, kind in (("snapshot_category", "string"), ("wayback_unknown", "boolean")):
        if column not in enriched.columns:
            enriched = enriched.withColumn(column, F.lit(None).cast(kind))
    if categories is not None:
        enriched = state.apply_category(enriched, categories, shadow=c.shadow)
    enriched = staged(counted.of(enriched, available=F.col("place") == 1), "enriched")

    additions = state.denylist_additions(denylist, enriched.filter("snapshot_category = 'toxic'"), day, c.classifier)
    remembered = denylist.select(F.lower("name").alias("name")).unionByName(additions.select("name")).distinct().withColumn("_remembered", F.lit(True))
    judged = enriched.join(remembered, "name", "left")
    reason = rules.evidence_reason(F.col("spam_flagged"), F.col("surbl_listed"), F.col("spamhaus_listed"), F.col("snapshot_category"), F.col("_remembered"), F.col("wayback_snapshots"), strict=c.strict)
    judged = judged.withColumn("reject_reason", reason).drop("_remembered").withColumn("reasons", state.incomplete_reasons(c.required))
    scored = judged.withColumn("score", scoring.score(c.scoring)).withColumn("evidence", scoring.evidence_count(c.scoring))
    # a failed look-up of captures is no evidence for a verdict, and no fault of a name that is to be published
    scored = scored.withColumn("reported", scoring.evidence_count(c.scoring, F.col("wayback_unknown")))
    scored = scored.withColumn("soft", rules.soft_signal(F.col("name"), c.rules)).withColumn("verdict", scoring.verdict(F.col("soft"), F.col("snapshot_category"), F.col("score"), F.col("evidence"), c.scoring))
    scored = staged(counted.of(scored, survivors=F.col("reject_reason").isNull() & (F.col("place") == 1)), "scored")

    survivors = scored.filter("reject_reason is null")
    registered = asked.join(availability.filter("not is_available"), "name", "left_semi")
    settled = state.settle_held(queue, free.filter("place = 1"), enriched, survivors.withColumn("complete", F.size("reasons") == 0), registered, day, c.held_days, confirmed=free)
    settled = staged(settled, "settled")
    if held is None:  # no queue is kept: what survives is judged by the floor alone
        screened, queued = survivors, queue.select("tld", "name", "first_held_date", "checks").withColumn("reasons", F.array().cast("array<string>"))
    else:
        screened = survivors.join(settled.filter("action in ('released', 'publish')").select("name"), "name", "left_semi")
        queued = settled.filter("action in ('held', 'new_held')").join(asked.select("name", "tld").dropDuplicates(["name"]), "name").select("tld", "name", "first_held_date", "checks", "reasons")
    judged_out = scoring.quality_floor(screened, c.scoring, F.col("reported")).drop("reported")
    listed = state.rolling_list(previous, today, judged_out.filter("floor_reason is null"), day)
    published = staged(ranking.top(listed, c.publish).withColumn("registrars", scoring.registrar_links(F.col("name"), c.registrars)), "published")
    return {
        "drops": drops, "rejects": metrics.reason_histogram(drops.unionByName(scored.select("tld", "name", "reject_reason"))), "ranker": status, "availability": turned_away, "selected": selected,
        "scored": scored, "survivors": judged_out, "held_outcomes": metrics.value_counts(settled, "action"), "listed": listed, "published": scoring.published_row(published), "header": metrics.header(published),
        "overflow": left_over, "held": queued, "denylist": additions, "available": signals.with_publication(enriched, published),
        "archive": live_records(signals.with_publication(scored, published), day),
        "funnel": counted.table(today.sparkSession),
    }


def commit_daily(tables: dict[str, DataFrame], today: DataFrame, root: str, day: str) -> None:
    """Write a day: the published payload, then what the next day starts from, and the names themselves last, so that a run
    that fails on the way leaves yesterday's names and finds the same drops again."""
    writers.payload(tables["published"], tables["header"]).write.mode("overwrite").text(f"{root}/payload")
    writers.hand_off(tables["drops"], f"{root}/drops", day)
    writers.hand_off(tables["archive"], f"{root}/available", day)
    spark = today.sparkSession
    writers.append_events(tables["archive"], readers.archive(spark, f"{root}/archive", ARCHIVE), f"{root}/archive")
    for name in ("overflow", "held", "denylist"):
        tables[name].withColumn("day", F.lit(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{root}/{name}")
    writers.commit_snapshot(today, f"{root}/names", day)


#: What a live record keeps of a row's signals, where the row has them, with their types.
SIGNALS = {
    "wayback_snapshots": "int", "wayback_last_snapshot": "date", "wayback_unknown": "boolean", "open_page_rank": "double", "cert_history": "boolean", "cc_source_domain_count": "int", "snapshot_category": "string",
    "snapshot_classifier_version": "string", "previous_registrar": "string", "rdap_status": "array<string>", "rdap_expiration": "string",
}
ARCHIVE = "domain string, tld string, drop_date date, availability_status string, availability_confirmed_date date, phase2_score int, score int, verdict string, was_published boolean, source string, " + ", ".join(f"{c} {t}" for c, t in SIGNALS.items())


def live_records(available: DataFrame, day: Column) -> DataFrame:
    """The archive's records of all names known to be free, the low-scoring ones too: available has name, tld, dropped_date,
    score, verdict, was_published and signals. Availability was confirmed when the registry said so, else on the day."""
    value = lambda c, t: (F.col(c) if c in available.columns else F.lit(None)).cast(t).alias(c)
    confirmed = F.to_date(F.substring("availability_verified_at", 1, 10)) if "availability_verified_at" in available.columns else F.lit(None).cast("date")
    return available.select(
        F.col("name").alias("domain"), "tld", F.col("dropped_date").alias("drop_date"), F.lit("available").alias("availability_status"), F.coalesce(confirmed, day).alias("availability_confirmed_date"),
        value("phase2_score", "int"), F.col("score").cast("int").alias("score"), "verdict", "was_published", F.lit("live").alias("source"), *[value(c, t) for c, t in SIGNALS.items()],
    )


def graph_refresh(vertices: DataFrame, edges: DataFrame, release: str, *, least_rows: int, present: dict[str, int], absent: list[str]) -> tuple[DataFrame, DataFrame]:
    """(counts of the release, checks): the caller promotes the release when all checks are ok."""
    counts = staged(graph.link_release(vertices, edges).withColumn("release", F.lit(release)), "release")
    return counts, graph.release_checks(counts, release, least_rows=least_rows, present=present, absent=absent)


def promote_release(vertices: DataFrame, edges: DataFrame, pointer: DataFrame, release: str, path: str, built_at: Column, *, least_rows: int, present: dict[str, int], absent: list[str], keep: int, protected: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """A refresh to its end: the release is written and read back, checked as written, the pointer (current, previous) moves
    on if it holds, and a plan says which releases go: never one that the pointer names."""
    spark = vertices.sparkSession
    meta = writers.write_release(graph.link_release(vertices, edges), path, release, built_at)
    written = spark.read.parquet(path)
    checks = staged(graph.release_checks(written.filter(F.col("release") == release), release, least_rows=least_rows, present=present, absent=absent), "checks")
    moved = staged(graph.current_release(pointer, release, checks), "pointer")
    named = [x for r in moved.collect() for x in (r["current"], r["previous"]) if x]  # one row
    plan = graph.retention_plan(written, names.release_table_of(written), keep, [*protected, *named])
    return {"meta": meta, "checks": checks, "pointer": moved, "plan": plan, "buckets": graph.bucket_counts(written)}


def reclassify(rows: DataFrame, cache: DataFrame, fetched: DataFrame, replies: DataFrame, denylist: DataFrame, day: Column, c: Daily = Daily(), *, mode: str = "default", top: int | None = None, most_age_days: int = 90) -> dict[str, DataFrame]:
    """Carried rows classified again. cache: name, excerpt. fetched: name, excerpt, html of the excerpts that were asked for
    anew. replies: name, category of the model. Parked markers beat the model's word, and spam terms both."""
    wanted = state.targets(rows, mode, top)
    known = state.cached_excerpts(wanted, cache, day, most_age_days)
    fresh = known.filter("excerpt_source <> 'reused'").select("name").join(fetched, "name")
    merged = staged(state.merge_cache(cache, fresh.select("name", "excerpt")), "excerpts")
    pages = wanted.select("name").join(merged, "name", "left").join(fetched.select("name", "html"), "name", "left").select("name", "excerpt.title", "excerpt.meta_description", "excerpt.h1", "excerpt.h2", "html")
    found = staged(signals.classify_excerpts(pages, signals.requested_only(wanted, replies), c.rules, c.signature_action), "categories")
    labelled = state.apply_category(rows, found, shadow=c.shadow)
    additions = state.denylist_additions(denylist, found.filter("category = 'toxic'"), day, c.classifier)
    kept, evicted = state.split_toxic(labelled, denylist.select("name").unionByName(additions.select("name")))
    sources = metrics.excerpt_sources(known.join(fresh.filter(text.usable_excerpt(F.col("excerpt"))).select("name", F.lit(True).alias("fetched")), "name", "left"))
    counts = metrics.category_counts(found, list(signals.CATEGORIES))
    return {"kept": kept, "evicted": evicted, "denylist": additions, "cache": merged, "categories": counts, "blind": metrics.blind(counts), "sources": sources, "header": metrics.header(kept)}


def refilter(rows: DataFrame, c: Daily = Daily()) -> DataFrame:
    """A published table under the rules of today, verdicts made anew. metrics.header gives its new header."""
    kept = rows.filter(rules.structural_reason(F.col("name"), c.rules).isNull())
    return kept.withColumn("verdict", scoring.verdict(rules.soft_signal(F.col("name"), c.rules), F.col("snapshot_category"), F.col("score"), F.col("evidence"), c.scoring))


def backfill(payloads: DataFrame, existing: DataFrame) -> DataFrame:
    """Events to append from historical payloads: the first occurrence of a name and day."""
    day = F.coalesce(F.col("first_seen_date"), F.col("snapshot_date"))
    rows = payloads.withColumn("drop_date", day).withColumnRenamed("name", "domain").withColumn("source", F.lit("backfill"))
    return state.new_events(existing, state.first_occurrences(rows, ["domain", "drop_date"], [F.col("snapshot_date")]))


def api_snapshot(events: DataFrame, checked_since: Column, excerpts: DataFrame | None = None) -> DataFrame:
    """The documents of an archive; excerpts (name, excerpt) give their sample titles."""
    return observations.documents(state.events_by_day(observations.grouped_events(events)), checked_since, excerpts)


def page_selection(rows: DataFrame, index: DataFrame, denylist: DataFrame, cache: DataFrame, day: Column) -> DataFrame:
    """Rows that get a page, with their evidence and where it came from; a remembered failure is not fetched again."""
    good = state.qualifying(rows, index, denylist)
    known = cache.select("name", F.col("excerpt").alias("cached_excerpt"), F.lit(True).alias("_cached"))
    joined = good.join(known, "name", "left")
    where = F.when(F.col("_cached") & F.col("cached_excerpt").isNotNull(), "cache").when(F.col("_cached"), "remembered_failure").when(F.coalesce("wayback_snapshots", F.lit(0)) > 0, "absent").otherwise("no_capture")
    return state.new_entries(index, joined.withColumn("excerpt_from", where).withColumn("fields", text.evidence_fields(F.col("cached_excerpt"), F.col("name")))).drop("_cached")


def review_selection(requested: DataFrame, rows: DataFrame) -> DataFrame:
    """(name, state) of requested names: missing, wrong_verdict, eligible."""
    joined = requested.select("name").distinct().join(rows.select("name", "verdict"), "name", "left")
    return joined.select("name", F.when(F.col("verdict").isNull(), "missing").when(F.col("verdict").isin("Clean", "Promising"), "eligible").otherwise("wrong_verdict").alias("state"))


def fresh_today(rows: DataFrame) -> DataFrame:
    return rows.filter(F.coalesce("days_listed", F.lit(0)) == 0)


def newsletter_picks(rows: DataFrame, per_tld: int, n: int) -> DataFrame:
    return ranking.top(ranking.cap_per_group(fresh_today(rows), "tld", per_tld), n)


def front_page(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fresh, carried), each best first."""
    return ranking.by_score(fresh_today(rows)), ranking.by_score(rows.filter(F.coalesce("days_listed", F.lit(0)) > 0))


def front_page_figures(stages: dict[str, DataFrame]) -> DataFrame:
    """The funnel figures of the front page: no rows unless every stage is no larger than the one before."""
    table = metrics.funnel(stages)
    return table.join(table.agg(F.bool_and("consistent").alias("_all")).filter("_all"), F.lit(True)).select("place", "stage", "rows")


def run_report(lines: DataFrame, release_end: Column, now: Column, categories: tuple[str, ...] = ("legitimate", "parked", "toxic", "empty", "unknown")) -> dict[str, DataFrame]:
    """What a run's log says: coverage and its alarms, queue counters, rejects, category tallies and whether the classifier
    was blind, strikes by host, lines by kind, freshness of the link release."""
    age, old = metrics.freshness(release_end, now)
    one = lines.sparkSession.range(1)
    tallies = metrics.log_tallies(lines, "results", categories)
    return {
        "coverage": metrics.coverage_alarms(metrics.log_coverage(lines)), "held": metrics.log_counters(lines, "Held queue"), "rejects": metrics.log_map(lines, "rejections"),
        "categories": tallies, "blind": metrics.blind(tallies), "strikes": metrics.log_strikes(lines, r"host (\S+) strike ([0-9]+)"), "freshness": one.select(age.alias("age_days"), old.alias("stale")),
        "signals": metrics.log_matches(lines, {"host_stops": "circuit open for", "warnings": r"\bWARNING\b", "errors": r"\bERROR\b"}),
    }


def list_filter(rows: DataFrame, search: str, tld: str | None) -> DataFrame:
    """Rows whose name contains a search term and whose tld is the chosen one."""
    found = rows.filter(F.contains(F.lower("name"), F.lit(search.lower())))
    return found if tld is None else found.filter(names.tld(F.col("name")) == tld)
