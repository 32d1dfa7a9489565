"""Tallies, coverage, gates and the metrics of run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def reason_histogram(rows: DataFrame, reason: str = "reject_reason", renamed: dict[str, str] | None = None) -> DataFrame:
    """Rejects by reason without what stands in brackets."""
    cut = F.substring_index(F.col(reason), "(", 1)
    for old, new in (renamed or {}).items():
        cut = F.when(cut == old, new).otherwise(cut)
    # a filter before the sums, or on their key, moves below whatever made the rows distinct, and the reason with it
    counts = rows.groupBy(cut.alias("reason")).agg(F.count(F.lit(1)).alias("rejected"), F.max(cut).alias("_some"))
    return counts.filter("_some is not null").drop("_some")


def three_states(rows: DataFrame, *columns: str) -> DataFrame:
    """(field, listed, clear, unknown) for boolean columns, in one pass."""
    got = rows.agg(*[f(F.col(c)).alias(f"{c}_{n}") for c in columns for n, f in (("yes", lambda x: F.count_if(x)), ("no", lambda x: F.count_if(~x)), ("null", lambda x: F.count_if(x.isNull())))])
    return got.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"{c}_yes").alias("listed"), F.col(f"{c}_no").alias("clear"), F.col(f"{c}_null").alias("unknown")) for c in columns])))


def coverage(rows: DataFrame, *columns: str) -> DataFrame:
    """(field, known, total), for an empty input too."""
    got = rows.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(f"n_{c}") for c in columns])
    return got.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("known"), F.col("total").alias("total")) for c in columns])))


def coverage_alarms(table: DataFrame, *, ratio: float = 0.5, alarmed: tuple[str, ...] = ("wayback_snapshots", "open_page_rank")) -> DataFrame:
    """coverage rows with state (no_input, dead, degraded, ok) and whether it raises an alarm."""
    state = F.when(F.col("total") == 0, "no_input").when(F.col("known") == 0, "dead").when(F.col("known") / F.col("total") < ratio, "degraded").otherwise("ok")
    return table.withColumn("state", state).withColumn("alarm", F.col("state").isin("dead", "degraded") & F.col("field").isin(*alarmed))


def header(rows: DataFrame, days: str = "days_listed") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("domain_count"), F.count_if(F.coalesce(F.col(days), F.lit(0)) == 0).alias("today_count"), F.count_if(F.coalesce(F.col(days), F.lit(0)) > 0).alias("carryover_count"))


def score_summary(rows: DataFrame, score: str = "score") -> DataFrame:
    """top, bottom, and as median the entry number n // 2 of the descending list, without sorting all in one task: counts
    by score are summed, and there are few scores."""
    counts = rows.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    listed = counts.agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("k"), "n"))).alias("l"), F.sum("n").alias("total"))
    found = F.aggregate("l", F.struct(F.lit(0).cast("long").alias("past"), F.lit(None).cast("double").alias("at")), lambda a, x: F.struct((a["past"] + x["n"]).alias("past"), F.when(a["at"].isNull() & (a["past"] + x["n"] > F.floor(F.col("total") / 2)), -x["k"].cast("double")).otherwise(a["at"]).alias("at")))
    return listed.select((-F.get("l", F.lit(0))["k"]).cast("double").alias("top"), (-F.element_at("l", -1)["k"]).cast("double").alias("bottom"), found["at"].alias("median"), F.coalesce("total", F.lit(0)).alias("scored"))


def score_bands(rows: DataFrame, score: str = "score") -> DataFrame:
    s = F.col(score)
    band = F.when(s >= 100, "100").otherwise(F.concat((F.floor(s / 10) * 10).cast("string"), F.lit("-"), (F.floor(s / 10) * 10 + 9).cast("string")))
    return rows.filter(s.isNotNull()).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.count_if(s >= 60).alias("at_least_60"))


def category_counts(rows: DataFrame, categories: list[str], column: str = "category") -> DataFrame:
    """Every category, also those without rows; others count as unknown."""
    listed = rows.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    value = F.when(F.col(column).isin(*categories), F.col(column)).otherwise("unknown")
    counts = rows.groupBy(value.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return listed.join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


def host_outcomes(rows: DataFrame, limit: float = 0.5) -> DataFrame:
    """(host, available, taken, unknown, degraded) from rows (host, is_available)."""
    got = rows.groupBy("host").agg(F.count_if(F.col("is_available")).alias("available"), F.count_if(~F.col("is_available")).alias("taken"), F.count_if(F.col("is_available").isNull()).alias("unknown"), F.count(F.lit(1)).alias("total"))
    return got.withColumn("degraded", F.col("unknown") / F.col("total") > limit).drop("total")


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def index_facts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_distinct("tld").alias("tlds"), F.min("dropped_date").alias("earliest"))


def blind(counts: DataFrame) -> DataFrame:
    """Whether a classifier said nothing: there were rows, and all are unknown."""
    return counts.agg((F.coalesce(F.sum("n"), F.lit(0)) > 0).alias("_some"), F.coalesce(F.sum(F.when(F.col("category") != "unknown", F.col("n"))), F.lit(0)).alias("_known")).select((F.col("_some") & (F.col("_known") == 0)).alias("blind"))


def freshness(release_end: Column, now: Column, most_days: int = 45) -> tuple[Column, Column]:
    """(age in days, stale); an unknown date is never stale."""
    age = F.datediff(now, release_end)
    return age, F.coalesce(age > most_days, F.lit(False))


def ranker_mode(rows: DataFrame, *, enabled: bool, gate: int, least: int) -> DataFrame:
    """(mode, total, failed, above_gate) from ranker rows (phase2_score null: failed)."""
    got = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("phase2_score").isNull()).alias("failed"), F.count_if(F.col("phase2_score") >= gate).alias("above_gate"))
    mode = F.when(~F.lit(enabled), "disabled").when((F.col("total") == 0) | (F.col("failed") == F.col("total")) | (F.col("above_gate") < least), "fallback").when(F.col("failed") > 0, "partial").otherwise("ranker")
    return got.select(mode.alias("mode"), "total", "failed", "above_gate")


class Counted:
    """Counts of rows taken while tables are written: no stage is read again for its count."""

    def __init__(self):
        self.observed: list[tuple[str, Observation]] = []

    def of(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """df, to be written once; a count for each condition that a row may meet."""
        seen = Observation()
        self.observed += [(c, seen) for c in conditions]
        return df.observe(seen, *[F.count_if(condition).alias(c) for c, condition in conditions.items()])

    def table(self, spark: SparkSession) -> DataFrame:
        """funnel()'s rows, in the order in which stages were given."""
        counts = [(i, stage, seen.get.get(stage, 0)) for i, (stage, seen) in enumerate(self.observed)]
        rows = [(i, stage, n, i == 0 or n <= counts[i - 1][2]) for i, stage, n in counts]
        return spark.createDataFrame(rows, "place int, stage string, rows long, consistent boolean")


def funnel(stages: dict[str, DataFrame]) -> DataFrame:
    """(place, stage, rows) of each stage, and whether it is no larger than the one before."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("place"), F.lit(n).alias("stage"), "rows") for i, (n, df) in enumerate(stages.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    before = F.lag("rows").over(Window.orderBy("place"))  # one row a stage
    return out.withColumn("consistent", F.coalesce(F.col("rows") <= before, F.lit(True)))


def log_coverage(lines: DataFrame) -> DataFrame:
    """(field, known, total) of the last coverage line of a log (line_no, value)."""
    last = lines.filter(F.col("value").rlike(r"Enrichment coverage \([0-9]+ candidates\):")).agg(F.max_by("value", "line_no").alias("value"))
    tokens = F.regexp_extract_all("value", F.lit(r"[A-Za-z0-9_]+=[0-9]+/[0-9]+"), F.lit(0))
    return last.select(F.explode(tokens).alias("t")).select(F.substring_index("t", "=", 1).alias("field"), F.regexp_extract("t", "=([0-9]+)/", 1).cast("long").alias("known"), F.regexp_extract("t", "/([0-9]+)$", 1).cast("long").alias("total"))


def log_counters(lines: DataFrame, prefix: str) -> DataFrame:
    """(counter, n) of the last line `prefix: a=1 b=2` of a log."""
    last = lines.filter(F.contains("value", F.lit(prefix + ":"))).agg(F.max_by("value", "line_no").alias("value"))
    pairs = F.str_to_map(F.array_join(F.regexp_extract_all(F.substring_index("value", prefix + ":", -1), F.lit(r"[A-Za-z0-9_]+=[0-9]+"), F.lit(0)), " "), F.lit(" "), F.lit("="))
    return last.select(F.explode(pairs).alias("counter", "n")).select("counter", F.col("n").cast("long").alias("n"))


def log_map(lines: DataFrame, marker: str) -> DataFrame:
    """(key, n) of the last line with the marker and a map behind it, `{'a': 1, 'b': 2}`."""
    last = lines.filter(F.contains("value", F.lit(marker))).agg(F.max_by("value", "line_no").alias("value"))
    pairs = F.regexp_extract_all(F.substring_index("value", marker, -1), F.lit("'[^']+':\\s*[0-9]+"), F.lit(0))
    return last.select(F.explode(pairs).alias("p")).select(F.regexp_extract("p", "'([^']+)'", 1).alias("key"), F.regexp_extract("p", "([0-9]+)$", 1).cast("long").alias("n"))


def log_tallies(lines: DataFrame, marker: str, words: tuple[str, ...]) -> DataFrame:
    """(category, n) of the last line with the marker and all of `12 word, ..` behind it; none if a word is missing."""
    counts = [F.regexp_extract(F.substring_index("value", marker, -1), rf"(?<![0-9])([0-9]+)\s+{w}\b", 1) for w in words]
    found = lines.filter(F.contains("value", F.lit(marker)))
    for c in counts:
        found = found.filter(c != "")
    last = found.agg(F.max_by("value", "line_no").alias("value")).filter("value is not null")
    return last.select(F.inline(F.array(*[F.struct(F.lit(w).alias("category"), c.cast("long").alias("n")) for w, c in zip(words, counts)])))


def log_strikes(lines: DataFrame, pattern: str) -> DataFrame:
    """(host, strikes): the largest strike number that the log names of each host; pattern: groups for host and number."""
    hits = lines.select(F.regexp_extract("value", pattern, 1).alias("host"), F.regexp_extract("value", pattern, 2).alias("n")).filter("host <> ''")
    return hits.groupBy("host").agg(F.max(F.col("n").cast("int")).alias("strikes"))


def excerpt_sources(rows: DataFrame) -> DataFrame:
    """(excerpt_source, n) of rows with cached excerpts: reused, fetched (stale or missing ones that a fetch filled), missing."""
    source = F.when(F.col("excerpt_source") == "reused", "reused").when(F.col("fetched"), "fetched").otherwise("missing")
    return rows.groupBy(source.alias("excerpt_source")).agg(F.count(F.lit(1)).alias("n"))


def log_matches(lines: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(metric, lines): how many lines each pattern meets, in one pass."""
    got = lines.agg(*[F.count_if(F.col("value").rlike(p)).alias(k) for k, p in patterns.items()])
    return got.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("lines")) for k in patterns])))
