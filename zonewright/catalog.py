"""The registered queries over the driver's tables, each beside its SQL.

The tables stand in for the library's own: lineitem and part are a link graph, users on days of `events` are dated name
snapshots and archive events, customers with their orders are candidates with signals, words and titles are names.
"""

from __future__ import annotations

from collections.abc import Callable
from html import unescape
from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.functions import names, rules, scoring, text
from zonewright.operators import graph, metrics, observations, ranking, signals, snapshot, state
from zonewright.plans import jobs
from zonewright.sources import readers
from zonewright.sources.staging import staged

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- the link graph ---------------------------------------------------------------------------------------------------

_COUNTS_SQL = """
edges AS (SELECT DISTINCT l_suppkey AS from_id, l_partkey AS to_id FROM lineitem),
inbound AS (SELECT to_id, count(*) AS n FROM edges GROUP BY to_id)
"""


def _graph(spark, sf_dir):
    edges = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("from_id"), F.col("l_partkey").alias("to_id"))
    vertices = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("com.part"), F.col("p_partkey").cast("string")).alias("reversed_domain"))
    return vertices, edges


@query(f"WITH {_COUNTS_SQL} SELECT to_id, n AS source_domain_count FROM inbound")
def graph_inbound_counts(spark, sf_dir):
    return graph.inbound_counts(_graph(spark, sf_dir)[1])


@query(f"WITH {_COUNTS_SQL} SELECT 'part' || p_partkey || '.com' AS apex_domain, coalesce(n, 0) AS source_domain_count FROM part LEFT JOIN inbound ON p_partkey = to_id")
def graph_link_release(spark, sf_dir):
    return graph.link_release(*_graph(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_link_release(spark, sf_dir)


@query(f"""WITH {_COUNTS_SQL}, release AS (SELECT 'part' || p_partkey || '.com' AS name, coalesce(n, 0) AS c FROM part LEFT JOIN inbound ON p_partkey = to_id),
candidates AS (SELECT DISTINCT 'part' || (s_suppkey * 3) || '.com' AS name FROM supplier)
SELECT candidates.name, c AS source_domain_count FROM candidates LEFT JOIN release USING (name)""")
def graph_candidate_links(spark, sf_dir):
    candidates = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("part"), (F.col("s_suppkey") * 3).cast("string"), F.lit(".com")).alias("name")).distinct()
    return graph.with_link_count(candidates, graph.link_release(*_graph(spark, sf_dir)))


_YEARLY_SQL = """
yearly AS (SELECT CAST(year(l_shipdate) AS VARCHAR) || '-apr-may-jun' AS release, l_partkey AS id, count(DISTINCT l_suppkey) AS n
           FROM lineitem GROUP BY ALL)
"""


def _yearly(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem")
    edges = lines.select(F.year("l_shipdate").alias("year"), F.col("l_partkey").alias("to_id"), F.col("l_suppkey").alias("from_id"))
    counts = graph.inbound_counts(edges, "year", rows=lines.count())  # the count is in the files' footers
    return counts.select(F.concat(F.col("year").cast("string"), F.lit("-apr-may-jun")).alias("release"), F.col("to_id").alias("id"), "source_domain_count", F.concat(F.lit("part"), F.col("to_id").cast("string"), F.lit(".com")).alias("apex_domain"))


@query(f"""WITH {_YEARLY_SQL}, sized AS (SELECT release, CASE WHEN n = 0 THEN '0' WHEN n < 10 THEN '1-9' WHEN n < 100 THEN '10-99' WHEN n < 1000 THEN '100-999' ELSE '>=1000' END AS bucket FROM yearly)
SELECT release, bucket, count(*) AS names FROM sized GROUP BY ALL""")
def graph_release_buckets(spark, sf_dir):
    return graph.bucket_counts(_yearly(spark, sf_dir))


@query(f"""WITH {_YEARLY_SQL}, places AS (SELECT release, row_number() OVER (ORDER BY release DESC) - 1 AS place FROM (SELECT DISTINCT release FROM yearly) ORDER BY release DESC LIMIT 3)
SELECT 'part' || p_partkey || '.com' AS name, string_agg(places.release || '=' || coalesce(CAST(n AS VARCHAR), '?'), ',' ORDER BY place) AS history
FROM part CROSS JOIN places LEFT JOIN yearly ON yearly.release = places.release AND yearly.id = p_partkey GROUP BY p_partkey HAVING count(n) > 0""")
def graph_link_history(spark, sf_dir):
    counts = _yearly(spark, sf_dir)
    window = counts.select("release").distinct()
    last = window.agg(F.max("release")).first()[0]  # one row
    window = graph.release_window(window, names.release_table_of(window), last or "", 3)
    candidates = _t(spark, sf_dir, "part").select(F.concat(F.lit("part"), F.col("p_partkey").cast("string"), F.lit(".com")).alias("name"))
    out = graph.with_link_history(candidates, counts, window).filter("cc_backlink_history is not null")
    shown = F.array_join(F.transform("cc_backlink_history", lambda h: F.concat(h["release"], F.lit("="), F.coalesce(h["source_domain_count"].cast("string"), F.lit("?")))), ",")
    return out.select("name", shown.alias("history"))


@query(f"""WITH {_COUNTS_SQL}, release AS (SELECT 'part' || p_partkey || '.com' AS name, coalesce(n, 0) AS c FROM part LEFT JOIN inbound ON p_partkey = to_id), x AS (SELECT count(*) AS n, coalesce(max(CASE WHEN name = 'part1.com' THEN c END) >= 1, false) AS p, count(*) FILTER (name = 'absent.com') AS a FROM release)
SELECT 0 AS place, 'release' AS "check", n > 0 AS ok FROM x UNION ALL SELECT 1, 'rows', n >= 100 FROM x UNION ALL SELECT 2, 'present:part1.com', p FROM x UNION ALL SELECT 3, 'absent:absent.com', a = 0 FROM x""")
def graph_release_gate(spark, sf_dir):
    counts = graph.link_release(*_graph(spark, sf_dir)).withColumn("release", F.lit("2026-jun-jul-aug"))
    return graph.release_checks(counts, "2026-jun-jul-aug", least_rows=100, present={"part1.com": 1}, absent=["absent.com"])


@query(f"""WITH {_YEARLY_SQL}, r AS (SELECT release, row_number() OVER (ORDER BY release DESC) AS k FROM (SELECT DISTINCT release FROM yearly))
SELECT release, CASE WHEN k <= 2 OR release = '1993-apr-may-jun' THEN 'keep' ELSE 'delete' END AS action FROM r""")
def graph_retention_plan(spark, sf_dir):
    return graph.retention_plan(_yearly(spark, sf_dir), names.release_table_of(_yearly(spark, sf_dir)), 2, ["1993-apr-may-jun"])


@query(f"""WITH {_YEARLY_SQL}, a AS (SELECT id, arg_max(n, release) AS new, arg_min(n, release) AS old, count(*) AS k FROM yearly GROUP BY id)
SELECT 'part' || id || '.com' AS name, CASE WHEN k >= 2 THEN CASE WHEN (new - old) / greatest(old, 1) > 0.2 THEN 'up' WHEN (new - old) / greatest(old, 1) < -0.2 THEN 'down' ELSE 'flat' END END AS trend FROM a""")
def graph_link_trend(spark, sf_dir):
    counts = _yearly(spark, sf_dir)
    listed = counts.groupBy("apex_domain").agg(F.reverse(F.array_sort(F.collect_list(F.struct("release", "source_domain_count")))).alias("h"))
    return listed.select(F.col("apex_domain").alias("name"), scoring.link_trend(F.col("h")).alias("trend"))


# --- snapshots and the rolling list -----------------------------------------------------------------------------------

_DAYS_SQL = """
days AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS tld, 'user' || user_id || '.' || event_type AS name FROM events),
bounds AS (SELECT max(day) AS today, max(day) - 1 AS yesterday FROM days)
"""


def _days(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("tld"), F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("."), F.col("event_type")).alias("name"))
    last = rows.agg(F.max("day")).first()[0]  # one row
    day = F.lit(last).cast("date")
    return rows.filter(F.col("day") == day).select("tld", "name").distinct(), rows.filter(F.col("day") == F.date_sub(day, 1)).select("tld", "name").distinct(), rows, day


@query(f"WITH {_DAYS_SQL} SELECT y.tld, y.name FROM days y, bounds WHERE y.day = yesterday AND y.tld IN (SELECT tld FROM days, bounds WHERE day = today) AND y.name NOT IN (SELECT name FROM days, bounds WHERE day = today)")
def snapshot_drops(spark, sf_dir):
    today, yesterday, _, _ = _days(spark, sf_dir)
    return snapshot.drops(yesterday, today)


@query(f"""WITH {_DAYS_SQL}, seen AS (SELECT tld, name, min(day) AS first_seen_date FROM days, bounds WHERE day < today GROUP BY ALL)
SELECT tld, name, first_seen_date, today AS last_validated_date, CAST(date_diff('day', first_seen_date, today) AS INT) AS days_listed FROM seen, bounds
WHERE date_diff('day', first_seen_date, today) <= 20 AND name NOT IN (SELECT name FROM days, bounds WHERE day = today)""")
def state_carried_rows(spark, sf_dir):
    today, _, rows, day = _days(spark, sf_dir)
    seen = rows.filter(F.col("day") < day).groupBy("tld", "name").agg(F.min("day").alias("first_seen_date"))
    carried = snapshot.revalidate(state.age_out(seen, day, 20), today, day)
    return scoring.annotate(carried, day).select("tld", "name", "first_seen_date", "last_validated_date", "days_listed")


@query(f"""WITH {_DAYS_SQL}, new AS (SELECT name, 'new' AS origin FROM days, bounds WHERE day = today), old AS (SELECT DISTINCT name, 'old' AS origin FROM days, bounds WHERE day = yesterday)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE name NOT IN (SELECT name FROM new)""")
def state_replace_by_new(spark, sf_dir):
    today, yesterday, _, _ = _days(spark, sf_dir)
    return snapshot.replace_by(today.select("name", F.lit("new").alias("origin")), yesterday.select("name", F.lit("old").alias("origin")))


_ARCHIVE_SQL = """
archive AS (SELECT 'user' || user_id || '.com' AS domain, CAST(ts AS DATE) AS drop_date, CASE WHEN event_type = 'click' THEN 'live' ELSE 'backfill' END AS source, event_id, value, event_type FROM events)
"""


def _archive(spark, sf_dir):
    return _t(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".com")).alias("domain"), F.to_date("ts").alias("drop_date"),
        F.when(F.col("event_type") == "click", "live").otherwise("backfill").alias("source"), F.col("event_id").alias("ingest_order"), "value", "event_type",
    )


@query(f"WITH {_ARCHIVE_SQL} SELECT domain, drop_date, source, event_id AS ingest_order FROM archive QUALIFY row_number() OVER (PARTITION BY domain, drop_date ORDER BY source = 'live' DESC, event_id) = 1")
def archive_events_by_day(spark, sf_dir):
    return state.events_by_day(_archive(spark, sf_dir)).select("domain", "drop_date", "source", "ingest_order")


@query(f"""WITH {_ARCHIVE_SQL}, d AS (SELECT DISTINCT domain, drop_date, source, strftime(drop_date, '%Y-%m') AS month FROM archive)
SELECT month, count(*) AS events FROM d WHERE NOT EXISTS (SELECT 1 FROM archive a WHERE a.domain = d.domain AND a.drop_date = d.drop_date AND a.source = d.source AND a.event_id % 3 = 0) GROUP BY month""")
def archive_new_events(spark, sf_dir):
    rows = _archive(spark, sf_dir)
    before = rows.filter("ingest_order % 3 = 0").withColumn("month", F.date_format("drop_date", "yyyy-MM"))
    return state.new_events(before, rows).groupBy("month").agg(F.count(F.lit(1)).alias("events"))


@query(f"""WITH {_ARCHIVE_SQL} SELECT domain, min(drop_date) AS first_seen, max(drop_date) AS last_seen, count(DISTINCT drop_date) AS drop_days, bool_or(event_type = 'purchase') AS ever_published, count(*) AS events FROM archive GROUP BY domain""")
def archive_roll_up(spark, sf_dir):
    return observations.roll_up(_archive(spark, sf_dir).withColumn("was_published", F.col("event_type") == "purchase"))


@query("""SELECT 'user' || user_id || '.com' AS domain, event_type AS name, ts AS observed_at, value AS value_num FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY (value > 50) DESC, ts DESC, CAST(value AS VARCHAR)) = 1""")
def archive_latest_values(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".com")).alias("domain"), F.lit("metric").alias("kind"), F.col("event_type").alias("name"), F.col("ts").alias("observed_at"), F.col("value").alias("value_num"), F.lit(None).cast("string").alias("value_str"), F.when(F.col("value") > 50, "ok").otherwise("lookup_failed").alias("status"))
    return observations.latest(rows).select("domain", "name", "observed_at", "value_num")


@query(f"""WITH {_ARCHIVE_SQL}, d AS (SELECT domain, min(drop_date) AS f, max(drop_date) AS l FROM archive GROUP BY domain), cut AS (SELECT max(drop_date) - 25 AS since FROM archive)
SELECT domain, CASE WHEN f > since THEN 'added' ELSE 'updated' END AS change, l AS last_seen FROM d, cut WHERE l > since""")
def archive_change_feed(spark, sf_dir):
    rows = _archive(spark, sf_dir)
    last = rows.agg(F.max("drop_date")).first()[0]  # one row
    docs = observations.roll_up(rows.withColumn("was_published", F.lit(False)))
    return observations.changes(docs, F.date_sub(F.lit(last).cast("date"), 25))


@query("""SELECT event_type AS source, max(ts) AS latest FROM events GROUP BY 1 UNION ALL SELECT 'zone', CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) FROM events""")
def archive_source_health(spark, sf_dir):
    rows = _t(spark, sf_dir, "events")
    return observations.source_health(rows.select(F.col("event_type").alias("source"), F.col("ts").alias("observed_at")), rows.select(F.to_date("ts").alias("drop_date")))


def _full_events(spark, sf_dir):
    rows = _archive(spark, sf_dir)
    none = lambda t: F.lit(None).cast(t)
    return rows.select(
        "domain", "drop_date", "source", "ingest_order", F.col("drop_date").alias("availability_confirmed_date"), (F.col("event_type") == "purchase").alias("was_published"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("open_page_rank"), F.when(F.col("event_type") != "click", F.floor("value").cast("int")).alias("cc_source_domain_count"),
        F.when(F.col("value") > 20, F.col("value") > 60).alias("cert_history"), F.when(F.col("value") > 10, F.floor(F.col("value") / 25).cast("int")).alias("wayback_snapshots"), (F.col("value") <= 2).alias("wayback_unknown"),
        F.when(F.col("value") > 80, "clean").alias("snapshot_category"), none("int").alias("phase2_score"),
    )


@query(f"""WITH {_ARCHIVE_SQL}, o AS (
  SELECT 'availability' AS name, 'ok' AS status FROM archive
  UNION ALL SELECT 'open_page_rank', CASE WHEN event_type = 'click' AND value IS NOT NULL THEN 'ok' ELSE 'not_checked' END FROM archive
  UNION ALL SELECT 'source_domain_count', CASE WHEN event_type <> 'click' AND value IS NOT NULL THEN 'ok' ELSE 'not_checked' END FROM archive
  UNION ALL SELECT 'cert_history', CASE WHEN value > 20 THEN 'ok' ELSE 'not_checked' END FROM archive
  UNION ALL SELECT 'captures', CASE WHEN NOT (value > 10 OR value <= 2) THEN 'not_checked' WHEN value <= 2 THEN 'lookup_failed' WHEN floor(value / 25) > 0 THEN 'ok' ELSE 'none_found' END FROM archive
  UNION ALL SELECT 'category', CASE WHEN value > 80 THEN 'ok' ELSE 'not_checked' END FROM archive
  UNION ALL SELECT 'name_quality', 'not_checked' FROM archive
  UNION ALL SELECT 'left_zone', 'ok' FROM (SELECT DISTINCT domain, drop_date FROM archive))
SELECT name, status, count(*) AS n FROM o GROUP BY ALL""")
def archive_observations(spark, sf_dir):
    return observations.observations(_full_events(spark, sf_dir), F.lit("2024-01-10").cast("date")).groupBy("name", "status").agg(F.count(F.lit(1)).alias("n"))


_DOCUMENTS_SQL = f"""{_ARCHIVE_SQL}, by_day AS (SELECT * FROM archive QUALIFY row_number() OVER (PARTITION BY domain, drop_date ORDER BY source = 'live' DESC, event_id) = 1),
docs AS (SELECT domain, min(drop_date) AS first_seen, max(drop_date) AS last_seen, count(*) AS drop_days, bool_or(event_type = 'purchase') AS ever_published, count(*) AS events,
  CAST(arg_max(floor(value), drop_date) FILTER (event_type <> 'click') AS DOUBLE) AS links, arg_max(value, drop_date) FILTER (event_type = 'click') AS rank,
  CAST(CASE WHEN bool_or(value > 10) THEN arg_max(floor(value / 25), drop_date) FILTER (value > 10) END AS DOUBLE) AS captures,
  CASE WHEN bool_or(value > 10) THEN CASE WHEN arg_max(floor(value / 25), drop_date) FILTER (value > 10) > 0 THEN 'ok' ELSE 'none_found' END WHEN arg_max(value, drop_date) <= 2 THEN 'lookup_failed' ELSE 'not_checked' END AS captures_status,
  arg_max(CASE WHEN source = 'live' OR drop_date >= DATE '2024-01-10' THEN 'available' ELSE 'dropped' END, drop_date) AS status,
  CASE WHEN bool_or(value > 80) THEN 'clean' END AS verdict FROM by_day GROUP BY domain)
"""


def _documents(spark, sf_dir):
    return jobs.api_snapshot(_full_events(spark, sf_dir), F.lit("2024-01-10").cast("date"))


@query(f"""WITH {_DOCUMENTS_SQL} SELECT domain, first_seen, last_seen, drop_days, ever_published, events, captures, captures_status FROM docs""")
def archive_documents(spark, sf_dir):
    return _documents(spark, sf_dir).select("domain", "zone.first_seen", "zone.last_seen", "zone.drop_days", "ever_published", "events", F.col("captures.value_num").alias("captures"), F.col("captures.status").alias("captures_status"))


@query(f"""WITH {_DOCUMENTS_SQL} SELECT domain, 'com' AS tld, status, links, rank, captures, first_seen, last_seen, CAST(NULL AS INT) AS first_year, verdict FROM docs""")
def archive_compact(spark, sf_dir):
    return observations.compact(_documents(spark, sf_dir))


@query(f"""WITH {_DOCUMENTS_SQL} SELECT domain, first_seen, events FROM docs WHERE domain = 'user17.com'""")
def archive_lookup(spark, sf_dir):
    return observations.lookup(_documents(spark, sf_dir), " USER17.com. ").select("domain", "zone.first_seen", "events")


@query(f"""WITH {_ARCHIVE_SQL}, by_day AS (SELECT * FROM archive WHERE domain = 'user17.com' QUALIFY row_number() OVER (PARTITION BY drop_date ORDER BY source = 'live' DESC, event_id) = 1), k AS (SELECT unnest(['availability', 'captures', 'category', 'cert_history', 'name_quality', 'open_page_rank', 'source_domain_count', 'left_zone']) AS name)
SELECT CAST(drop_date AS TIMESTAMP) AS observed_at, name FROM by_day CROSS JOIN k""")
def archive_domain_observations(spark, sf_dir):
    seen = observations.observations(state.events_by_day(observations.grouped_events(_full_events(spark, sf_dir))), F.lit("2024-01-10").cast("date"))
    return observations.of_domain(seen, "User17.com").select("observed_at", "name")


# --- names, rules, scores ---------------------------------------------------------------------------------------------

_WORDS_SQL = r"words AS (SELECT DISTINCT lower(w) || '.com' AS name FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM documents))"


def _words(spark, sf_dir):
    found = _t(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+"), F.lit(0))).alias("w"))
    return found.select(F.concat(F.lower("w"), F.lit(".com")).alias("name")).distinct()


@query(rf"""WITH {_WORDS_SQL}, l AS (SELECT name, split_part(name, '.', 1) AS l FROM words), c AS (SELECT name, l, list_filter(string_split(l, ''), lambda x: x <> '') AS cs FROM l)
SELECT name, round(len(regexp_extract_all(l, '[0-9]')) / length(l), 6) AS digit_ratio,
  round(coalesce(len(regexp_extract_all(l, '[aeiouy]')) / nullif(len(regexp_extract_all(l, '[a-z]')), 0), 0), 6) AS vowel_ratio,
  round(abs(list_sum(list_transform(list_distinct(cs), lambda x: -(len(list_filter(cs, lambda y: y = x)) / len(cs)) * log2(len(list_filter(cs, lambda y: y = x)) / len(cs))))), 5) AS entropy,
  regexp_matches(l, '[bcdfghjklmnpqrstvwxz]{{6,}}') AS consonant_run FROM c""")
def names_ratios(spark, sf_dir):
    label = names.label(F.col("name"))
    return _words(spark, sf_dir).select("name", F.round(names.digit_ratio(label), 6).alias("digit_ratio"), F.round(names.vowel_ratio(label), 6).alias("vowel_ratio"), F.round(F.abs(names.entropy(label)), 5).alias("entropy"), names.has_consonant_run(label, 6).alias("consonant_run"))


_NATURAL = ", ".join(f"'{t}'" for t in names.NATURAL_TRIGRAMS)
_TRIGRAM_SQL = rf"""t AS (SELECT name, l, list_filter(list_transform(range(1, length(l) - 1), lambda i: l[i:i + 2]), lambda g: regexp_full_match(g, '[a-z]{{3}}')) AS g FROM (SELECT name, split_part(name, '.', 1) AS l FROM words))"""


@query(f"WITH {_WORDS_SQL}, {_TRIGRAM_SQL} SELECT name, len(g) AS total, len(list_filter(g, lambda x: x IN ({_NATURAL}))) AS matches FROM t")
def names_trigrams(spark, sf_dir):
    label = names.label(F.col("name"))
    return _words(spark, sf_dir).select("name", names.trigram_total(label).cast("long").alias("total"), names.trigram_matches(label).cast("long").alias("matches"))


@query(f"WITH {_WORDS_SQL}, {_TRIGRAM_SQL} SELECT name, len(list_filter(g, lambda x: x IN ({_NATURAL}))) AS trigram_matches, length(l) AS label_length FROM t ORDER BY 2 DESC, 3, 1 LIMIT 200")
def ranking_pre_narrow(spark, sf_dir):
    out = ranking.pre_narrow(_words(spark, sf_dir), 200)
    return out.select("name", F.col("trigram_matches").cast("long").alias("trigram_matches"), F.col("label_length").cast("long").alias("label_length"))


_STRUCTURAL_SQL = """CASE WHEN l = '' THEN 'empty' WHEN starts_with(l, 'xn--') THEN 'idn' WHEN length(l) < 3 THEN 'too_short' WHEN length(l) > 30 THEN 'too_long' WHEN regexp_full_match(l, '[0-9]+') THEN 'all_digits'
  WHEN l IN ('casino', 'poker', 'viagra', 'porn', 'loan') OR regexp_matches(l, '(^|[0-9])(casino|poker|viagra|porn|loan)([0-9]|$)') OR regexp_matches(l, '^(gambl|betting|escort).') THEN 'keyword'
  WHEN contains(l, 'xxx') OR contains(l, 'pharma') OR contains(l, 'replica') THEN 'substring' END"""


@query(f"""WITH {_WORDS_SQL}, r AS (SELECT {_STRUCTURAL_SQL} AS reason FROM (SELECT split_part(name, '.', 1) AS l FROM words)) SELECT reason, count(*) AS rejected FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def rules_structural(spark, sf_dir):
    return metrics.reason_histogram(_words(spark, sf_dir).withColumn("reject_reason", rules.structural_reason(F.col("name"))))


@query(rf"""WITH {_WORDS_SQL}, {_TRIGRAM_SQL}, c AS (SELECT name, l, len(g) AS total, len(list_filter(g, lambda x: x IN ({_NATURAL}))) AS matches, list_filter(string_split(l, ''), lambda x: x <> '') AS cs FROM t)
SELECT name, CASE WHEN len(regexp_extract_all(l, '[0-9]')) / length(l) > 0.30 THEN 'digit_ratio'
  WHEN coalesce(len(regexp_extract_all(l, '[aeiouy]')) / nullif(len(regexp_extract_all(l, '[a-z]')), 0), 0) < 0.15 THEN 'vowel_ratio'
  WHEN list_sum(list_transform(list_distinct(cs), lambda x: -(len(list_filter(cs, lambda y: y = x)) / len(cs)) * log2(len(list_filter(cs, lambda y: y = x)) / len(cs)))) > 3.5 THEN 'entropy'
  WHEN list_bool_or(list_transform(range(1, length(l) - 2), lambda i: l[i] = l[i + 1] AND l[i] = l[i + 2] AND l[i] = l[i + 3])) THEN 'repeat_run'
  WHEN regexp_matches(l, '[bcdfghjklmnpqrstvwxz]{{6,}}') THEN 'consonant_run' WHEN length(l) < 3 THEN 'too_short'
  WHEN total = 0 THEN 'no_trigrams' WHEN matches < 3 THEN 'few_trigrams' WHEN matches / total < 0.55 THEN 'trigram_ratio' END AS reject_reason FROM c""")
def rules_lexical(spark, sf_dir):
    return _words(spark, sf_dir).select("name", rules.lexical_reason(F.col("name")).alias("reject_reason"))


_SIGNAL_SQL = """
spent AS (SELECT o_custkey, count(*) * 60 AS n, sum(o_totalprice) AS total, max(o_orderdate) AS last FROM orders GROUP BY o_custkey),
signals AS (SELECT c_custkey AS id, 'customer' || c_custkey || '.n' || c_nationkey AS name, 'n' || c_nationkey AS tld, n AS wayback_snapshots, CAST(last AS DATE) AS wayback_last_snapshot,
  CASE WHEN c_acctbal > 0 THEN c_acctbal / 1000 END AS open_page_rank, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 3 = 1 END AS cert_history,
  CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 1000 END AS cc_source_domain_count, CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 7 = 3 END AS spam_flagged,
  CASE WHEN c_custkey % 11 > 0 THEN c_custkey % 11 = 5 END AS surbl_listed, CAST(NULL AS BOOLEAN) AS spamhaus_listed FROM customer LEFT JOIN spent ON c_custkey = o_custkey)
"""


def _signals(spark, sf_dir):
    spent = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.count(F.lit(1)) * 60).alias("wayback_snapshots"), F.to_date(F.max("o_orderdate")).alias("wayback_last_snapshot"))
    k = F.col("c_custkey")
    return _t(spark, sf_dir, "customer").join(spent, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        k.alias("id"), F.concat(F.lit("customer"), k.cast("string"), F.lit(".n"), F.col("c_nationkey").cast("string")).alias("name"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("tld"),
        "wayback_snapshots", "wayback_last_snapshot", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 1000).alias("open_page_rank"), F.when(k % 3 > 0, k % 3 == 1).alias("cert_history"),
        F.when(k % 5 > 0, k % 1000).alias("cc_source_domain_count"), F.when(k % 7 > 0, k % 7 == 3).alias("spam_flagged"), F.when(k % 11 > 0, k % 11 == 5).alias("surbl_listed"), F.lit(None).cast("boolean").alias("spamhaus_listed"),
    )


_SCORED_SQL = _SIGNAL_SQL + """,
parts AS (SELECT *, CASE WHEN wayback_snapshots IS NOT NULL THEN least(1, log10(greatest(wayback_snapshots, 0) + 1) / 3) END AS a, CASE WHEN open_page_rank IS NOT NULL THEN least(1, greatest(0, open_page_rank / 10)) END AS b, CASE WHEN cert_history IS NOT NULL THEN CAST(cert_history AS INT) END AS c,
  least(1, greatest(0, (30 - length(split_part(name, '.', 1))) / 28)) AS d, CASE WHEN cc_source_domain_count IS NOT NULL THEN least(1, log10(greatest(cc_source_domain_count, 0) + 1) / 4) END AS e FROM signals),
scored AS (SELECT *, CAST(greatest(0, least(100, round_even((coalesce(a * 0.3, 0) + coalesce(b * 0.4, 0) + coalesce(c * 0.2, 0) + coalesce(d * 0.1, 0) + coalesce(e * 0.3, 0))
   / (CASE WHEN a IS NULL THEN 0 ELSE 0.3::DOUBLE END + CASE WHEN b IS NULL THEN 0 ELSE 0.4::DOUBLE END + CASE WHEN c IS NULL THEN 0 ELSE 0.2::DOUBLE END + 0.1::DOUBLE + CASE WHEN e IS NULL THEN 0 ELSE 0.3::DOUBLE END) * 100, 0))) AS INT) AS score,
  CAST(wayback_snapshots IS NOT NULL AS INT) + CAST(b IS NOT NULL AS INT) + CAST(c IS NOT NULL AS INT) + CAST(surbl_listed IS NOT NULL AS INT) + CAST(spam_flagged IS NOT NULL AS INT) AS evidence FROM parts)
"""


_VERDICT_SQL = """CASE WHEN score >= 70 AND evidence >= 3 THEN 'Clean' WHEN score >= 40 AND evidence >= 3 AND coalesce(wayback_snapshots, 0) >= 1000
  AND (coalesce(open_page_rank, 0) >= 1.5 OR coalesce(cc_source_domain_count, 0) >= 10) THEN 'Promising' ELSE 'Caution' END"""


def _scored(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    return rows.withColumn("score", scoring.score()).withColumn("evidence", scoring.evidence_count())


@query(f"WITH {_SCORED_SQL} SELECT name, score, evidence, {_VERDICT_SQL} AS verdict FROM scored")
def scoring_scores(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    return rows.select("name", "score", "evidence", scoring.verdict(rules.soft_signal(F.col("name")), F.lit(None).cast("string"), F.col("score"), F.col("evidence")).alias("verdict"))


@query(f"""WITH {_SCORED_SQL} SELECT count(*) FILTER (score < 40) AS low_score, count(*) FILTER (score >= 40 AND evidence < 3) AS incomplete, count(*) FILTER (score >= 40 AND evidence >= 3) AS kept FROM scored""")
def scoring_quality_floor(spark, sf_dir):
    return scoring.floor_counts(scoring.quality_floor(_scored(spark, sf_dir)))


@query(f"""WITH {_SCORED_SQL}, o AS (SELECT score, row_number() OVER (ORDER BY score DESC) - 1 AS k, count(*) OVER () AS n FROM scored)
SELECT CAST(max(score) AS DOUBLE) AS top, CAST(min(score) AS DOUBLE) AS bottom, CAST(max(score) FILTER (k = n // 2) AS DOUBLE) AS median, count(*) AS scored FROM o""")
def scoring_summary(spark, sf_dir):
    return metrics.score_summary(_scored(spark, sf_dir))


@query(f"""WITH {_SCORED_SQL} SELECT CASE WHEN score >= 100 THEN '100' ELSE (score // 10 * 10) || '-' || (score // 10 * 10 + 9) END AS band, count(*) AS n, count(*) FILTER (score >= 60) AS at_least_60 FROM scored GROUP BY 1""")
def scoring_bands(spark, sf_dir):
    return metrics.score_bands(_scored(spark, sf_dir))


@query(f"WITH {_SCORED_SQL} SELECT name, score FROM scored ORDER BY score DESC, name LIMIT 100")
def ranking_top(spark, sf_dir):
    return ranking.top(_scored(spark, sf_dir), 100).select("name", "score")


@query(f"WITH {_SCORED_SQL} SELECT tld, name, score FROM scored QUALIFY row_number() OVER (PARTITION BY tld ORDER BY score DESC, name) <= 5")
def ranking_cap_per_tld(spark, sf_dir):
    return ranking.cap_per_group(_scored(spark, sf_dir), "tld", 5).select("tld", "name", "score")


@query(f"""WITH {_SCORED_SQL}, q AS (SELECT 'n' || n_nationkey AS host, CASE WHEN n_nationkey > 0 THEN greatest(1, floor(n_nationkey * 10 / 4)) END AS quota FROM nation)
SELECT name, tld AS host FROM scored JOIN q ON tld = host QUALIFY quota IS NULL OR row_number() OVER (PARTITION BY tld ORDER BY score DESC, name) <= quota""")
def ranking_host_quota(spark, sf_dir):
    quotas = _t(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("host"), F.when(F.col("n_nationkey") > 0, ranking.host_quota(F.col("n_nationkey"), F.lit(10), F.lit(4))).alias("quota"))
    rows = _scored(spark, sf_dir).select("name", F.col("tld").alias("host"), F.col("score").alias("phase2_score"))
    return ranking.within_quota(rows, quotas).select("name", "host")


@query(f"""WITH {_SCORED_SQL}, best AS (SELECT tld, name AS other, row_number() OVER (PARTITION BY tld ORDER BY score DESC, name) AS k FROM scored)
SELECT s.name, other, CAST(row_number() OVER (PARTITION BY s.name ORDER BY k) AS INT) AS place FROM scored s JOIN best USING (tld) WHERE k <= 6 AND s.name <> other QUALIFY place <= 5""")
def ranking_similar_rows(spark, sf_dir):
    return ranking.similar_rows(_scored(spark, sf_dir))


@query(f"WITH {_SCORED_SQL} SELECT name, CAST(ceil(row_number() OVER (ORDER BY score DESC, name) / 50) AS BIGINT) AS page FROM scored")
def ranking_pages(spark, sf_dir):
    return ranking.pages(_scored(spark, sf_dir).select("name", "score"), 50, F.desc("score"), F.col("name")).select("name", "page")


@query(f"WITH {_SCORED_SQL} SELECT name, (row_number() OVER (ORDER BY name) - 1) // 40 AS batch_id FROM scored")
def ranking_batches(spark, sf_dir):
    return ranking.batches(_scored(spark, sf_dir).select("name"), 40, F.col("name")).select("name", "batch_id")


@query(f"WITH {_SCORED_SQL}, s AS (SELECT name, score FROM scored WHERE score < 60 OR (score = 60 AND name > 'customer5')) SELECT name, score FROM s ORDER BY score DESC, name LIMIT 25")
def ranking_page_after(spark, sf_dir):
    return ranking.page_after(_scored(spark, sf_dir).select("name", "score"), 25, after=(60, "customer5"))


_REASON_SQL = """CASE WHEN spam_flagged THEN 'spam' WHEN surbl_listed THEN 'blocklist_a' WHEN id % 13 = 0 THEN 'toxic_remembered' WHEN wayback_snapshots < 600 THEN 'no_captures' END"""


@query(f"WITH {_SIGNAL_SQL} SELECT reason, count(*) AS rejected FROM (SELECT {_REASON_SQL} AS reason FROM signals) WHERE reason IS NOT NULL GROUP BY reason")
def rules_evidence(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    denied = rows.filter("id % 13 = 0").select("name", F.lit(True).alias("remembered"))
    joined = rows.join(denied, "name", "left")
    reason = rules.evidence_reason(F.col("spam_flagged"), F.col("surbl_listed"), F.col("spamhaus_listed"), F.lit(None).cast("string"), F.col("remembered"), F.col("wayback_snapshots"), least_captures=600)
    return metrics.reason_histogram(joined.withColumn("reject_reason", reason))


@query(f"""WITH {_SIGNAL_SQL} SELECT 'spam_flagged' AS field, count(*) FILTER (spam_flagged) AS listed, count(*) FILTER (NOT spam_flagged) AS clear, count(*) FILTER (spam_flagged IS NULL) AS unknown FROM signals
UNION ALL SELECT 'surbl_listed', count(*) FILTER (surbl_listed), count(*) FILTER (NOT surbl_listed), count(*) FILTER (surbl_listed IS NULL) FROM signals""")
def metrics_three_states(spark, sf_dir):
    return metrics.three_states(_signals(spark, sf_dir), "spam_flagged", "surbl_listed")


@query(f"""WITH {_SIGNAL_SQL}, c AS (SELECT 'wayback_snapshots' AS field, count(wayback_snapshots) AS known, count(*) AS total FROM signals UNION ALL SELECT 'open_page_rank', count(open_page_rank), count(*) FROM signals UNION ALL SELECT 'spamhaus_listed', 0, count(*) FROM signals)
SELECT field, known, total, CASE WHEN total = 0 THEN 'no_input' WHEN known = 0 THEN 'dead' WHEN known / total < 0.5 THEN 'degraded' ELSE 'ok' END AS state, state IN ('dead', 'degraded') AND field <> 'spamhaus_listed' AS alarm FROM c""")
def metrics_coverage_alarms(spark, sf_dir):
    return metrics.coverage_alarms(metrics.coverage(_signals(spark, sf_dir), "wayback_snapshots", "open_page_rank", "spamhaus_listed"))


@query(f"""WITH {_SIGNAL_SQL} SELECT tld AS host, count(*) FILTER (cert_history) AS available, count(*) FILTER (NOT cert_history) AS taken, count(*) FILTER (cert_history IS NULL) AS unknown, count(*) FILTER (cert_history IS NULL) / count(*) > 0.35 AS degraded FROM signals GROUP BY tld""")
def metrics_host_outcomes(spark, sf_dir):
    return metrics.host_outcomes(_signals(spark, sf_dir).select(F.col("tld").alias("host"), F.col("cert_history").alias("is_available")), 0.35)


@query("""WITH j AS (SELECT documents.doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'quality' AS field, count(quality) AS known, count(*) AS total FROM j UNION ALL SELECT 'toxic', count(toxic), count(*) FROM j""")
def metrics_label_coverage(spark, sf_dir):
    return metrics.coverage(_t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left"), "quality", "toxic")


@query("""WITH j AS (SELECT CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'legitimate' WHEN quality = 0 THEN 'parked' ELSE 'unknown' END AS category FROM documents LEFT JOIN labels USING (doc_id)),
c AS (SELECT unnest(['legitimate', 'parked', 'toxic', 'empty', 'unknown']) AS category)
SELECT c.category, count(j.category) AS n FROM c LEFT JOIN j ON c.category = j.category GROUP BY c.category""")
def metrics_category_counts(spark, sf_dir):
    joined = _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    rows = joined.withColumn("category", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "legitimate").when(F.col("quality") == 0, "parked").otherwise("unknown"))
    return metrics.category_counts(rows, list(signals.CATEGORIES))


@query("""SELECT 'doc' || d.doc_id AS name, CASE WHEN l.toxic = 1 OR d.doc_id % 17 = 0 THEN 'evicted' ELSE 'kept' END AS outcome FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)""")
def state_split_toxic(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    toxic = _t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.join(toxic, "doc_id", "left").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"), F.when(F.col("toxic") == 1, "toxic").alias("snapshot_category"))
    remembered = docs.filter("doc_id % 17 = 0").select(F.concat(F.lit("DOC"), F.col("doc_id").cast("string")).alias("name"))
    kept, evicted = state.split_toxic(rows, remembered)
    return kept.select("name", F.lit("kept").alias("outcome")).unionByName(evicted.select("name", F.lit("evicted").alias("outcome")))


@query("""WITH t AS (SELECT DISTINCT 'doc' || doc_id AS name FROM labels WHERE toxic = 1) SELECT name, DATE '2026-01-02' AS classified_date, '1' AS classifier_version FROM t WHERE name NOT IN (SELECT 'doc' || doc_id FROM labels WHERE doc_id % 2 = 0)""")
def state_denylist_additions(spark, sf_dir):
    named = _t(spark, sf_dir, "labels").withColumn("name", F.concat(F.lit("doc"), F.col("doc_id").cast("string")))
    return state.denylist_additions(named.filter("doc_id % 2 = 0"), named.filter("toxic = 1"), F.lit("2026-01-02").cast("date"), "1")


@query(f"""WITH {_SCORED_SQL}, x AS (SELECT *, id % 4 IN (0, 1) AS held, id % 4 <> 0 AS new, id % 10 = 0 AS registered, id % 6 <> 0 AS enriched, id % 6 <> 0 AND score >= 40 AS survived, evidence >= 4 AS complete, CAST(id % 12 AS INT) AS age FROM scored WHERE id % 4 <> 0 OR true)
SELECT CASE WHEN held AND registered THEN 'reregistered' WHEN held AND survived AND complete THEN 'released' WHEN held AND enriched AND NOT survived THEN 'rejected' WHEN held AND age >= 7 THEN 'expired' WHEN held THEN 'held'
  WHEN survived AND complete THEN 'publish' WHEN enriched AND NOT survived THEN 'gone' ELSE 'new_held' END AS action, count(*) AS n FROM x GROUP BY 1""")
def state_held_queue(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    today = F.lit("2026-01-20").cast("date")
    held = rows.filter("id % 4 in (0, 1)").select("name", F.date_sub(today, (F.col("id") % 12).cast("int")).alias("first_held_date"), F.lit(1).alias("checks"))
    survivors = rows.filter("id % 6 <> 0 and score >= 40").select("name", (F.col("evidence") >= 4).alias("complete"), F.array(F.lit("missing")).alias("reasons"))
    out = state.settle_held(held, rows.filter("id % 4 <> 0"), rows.filter("id % 6 <> 0"), survivors, rows.filter("id % 10 = 0"), today, 7)
    return metrics.value_counts(out, "action")


@query(f"""WITH {_SCORED_SQL} SELECT name, CAST('2026-01-20' AS DATE) AS first_seen_date FROM scored WHERE score >= 60 AND id % 2 = 0
UNION ALL SELECT name, DATE '2026-01-20' - CAST(id % 30 AS INT) FROM scored WHERE id % 5 = 0 AND id % 30 <= 14""")
def state_overflow(spark, sf_dir):
    rows, today = _scored(spark, sf_dir), F.lit("2026-01-20").cast("date")
    before = rows.filter("id % 5 = 0").select("name", F.date_sub(today, (F.col("id") % 30).cast("int")).alias("first_seen_date"))
    return state.overflow(before, rows.filter("score >= 60").select("name"), rows.filter("id % 2 = 1").select("name"), today).select("name", "first_seen_date")


@query(f"""WITH {_SIGNAL_SQL}, u AS (SELECT name, id % 3 = 0 AS unknown, CAST(id % 6 AS INT) AS tries FROM signals) SELECT name, CASE WHEN unknown THEN tries + 1 ELSE tries END AS attempts FROM u WHERE NOT unknown OR tries + 1 <= 3""")
def state_age_out_unknown(spark, sf_dir):
    rows = _signals(spark, sf_dir).select("name", (F.col("id") % 3 == 0).alias("wayback_unknown"), (F.col("id") % 6).cast("int").alias("wayback_unknown_attempts"))
    return state.age_out_unknown(rows, 3).select("name", F.col("wayback_unknown_attempts").alias("attempts"))


# --- pages, texts, landed responses -----------------------------------------------------------------------------------

_HOST_SQL = r"hosts AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages)"


def _hosts(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", "url", "html", F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host"))


@query(rf"""WITH {_HOST_SQL} SELECT page_id, host AS domain, split_part(host, '.', 1) AS label, split_part(host, '.', -1) AS tld, array_to_string(list_reverse(string_split(host, '.')), '.') AS reversed_domain FROM hosts""")
def names_of_hosts(spark, sf_dir):
    h = _hosts(spark, sf_dir).withColumn("domain", names.normalize_domain(F.concat(F.lit(" "), F.upper("host"), F.lit(". "))))
    return h.select("page_id", "domain", names.label(F.col("domain")).alias("label"), names.tld(F.col("domain")).alias("tld"), names.unreverse(F.col("domain")).alias("reversed_domain"))


@query(rf"WITH {_HOST_SQL} SELECT host AS name, page_id FROM hosts WHERE contains(host, 'th') AND split_part(host, '.', -1) = 'com'")
def names_list_filter(spark, sf_dir):
    return jobs.list_filter(_hosts(spark, sf_dir).select(F.col("host").alias("name"), "page_id"), "TH", "com")


@query(r"""SELECT page_id, regexp_replace(split_part(url, '#', 1), '\?.*$', '') || '?' || CASE WHEN contains(split_part(url, '#', 1), '?') THEN array_to_string(list_filter(string_split(regexp_extract(split_part(url, '#', 1), '\?(.*)$', 1), '&'), lambda p: p <> '' AND split_part(p, '=', 1) <> 'ref'), '&') || CASE WHEN len(list_filter(string_split(regexp_extract(split_part(url, '#', 1), '\?(.*)$', 1), '&'), lambda p: p <> '' AND split_part(p, '=', 1) <> 'ref')) > 0 THEN '&' ELSE '' END ELSE '' END || 'ref=list' || regexp_extract(url, '(#.*)$', 1) AS link FROM pages""")
def text_link_parameters(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", text.with_parameters(F.col("url"), {"ref": "list"}).alias("link"))


def _texts(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


#: Titles and headings with their character references read as HTML reads them: the longest name of the standard's that
#: begins the reference (some need no semicolon), or a number. Any white space is one blank.
_EXCERPT_SQL = rf"""
refs AS (SELECT unnest({_texts(html5)}) AS ref, unnest({_texts(html5.values())}) AS chars),
raw AS (SELECT page_id, 'title' AS part, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages UNION ALL SELECT page_id, 'h1', regexp_extract(html, '<h1>([^<]*)</h1>', 1) FROM pages),
pieces AS (SELECT page_id, part, unnest(string_split(t, '&')) AS piece, generate_subscripts(string_split(t, '&'), 1) AS k FROM raw),
named AS (SELECT page_id, part, k, arg_max(chars, length(ref)) AS chars, max(length(ref)) AS n FROM pieces JOIN refs ON k > 1 AND left(piece, 2) = left(ref, 2) AND starts_with(piece, ref) GROUP BY ALL),
numbered AS (SELECT *, regexp_extract(piece, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?)', 1) AS number FROM pieces),
coded AS (SELECT *, CASE WHEN number = '' THEN NULL WHEN lower(number[2]) = 'x' THEN coalesce(try_cast('0x' || rtrim(number[3:], ';') AS BIGINT), 1114112) ELSE coalesce(try_cast(rtrim(number[2:], ';') AS BIGINT), 1114112) END AS code FROM numbered),
decoded AS (SELECT page_id, part, string_agg(CASE WHEN k = 1 THEN piece WHEN n IS NOT NULL THEN chars || piece[n + 1:] WHEN code IS NULL THEN '&' || piece
    ELSE CASE WHEN code < 160 THEN {_texts(unescape(f"&#{n};") for n in range(160))}[code + 1] WHEN code BETWEEN 55296 AND 57343 OR code > 1114111 THEN chr(65533)
      WHEN code BETWEEN 64976 AND 65007 OR code % 65536 >= 65534 THEN '' ELSE chr(CAST(code AS INT)) END || piece[length(number) + 1:] END, '' ORDER BY k) AS t
  FROM coded LEFT JOIN named USING (page_id, part, k) GROUP BY ALL),
flat AS (SELECT page_id, part, trim(regexp_replace(t, '[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))[1:200] AS t FROM decoded)
"""


@query(f"WITH {_EXCERPT_SQL} SELECT page_id, nullif(rtrim(max(t) FILTER (part = 'title')), '') AS title, nullif(max(t) FILTER (part = 'h1'), '') AS h1 FROM flat GROUP BY page_id")
def signals_page_excerpts(spark, sf_dir):
    found = signals.page_excerpts(_t(spark, sf_dir, "pages"), "page_id", "html")
    return found.select("page_id", F.rtrim("title").alias("title"), F.get("h1", F.lit(0)).alias("h1"))


@query(r"""WITH c AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\x00-\x1F\x7F-\x9F]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM documents) SELECT doc_id, CASE WHEN length(t) > 80 THEN rtrim(t[1:79]) || '…' ELSE t END AS clean FROM c""")
def text_clean(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.clean_untrusted(F.col("text"), 80).alias("clean"))


#: Letters that stand for a to j in the texts of every ninth document, by its place: so the query meets each script.
_SCRIPT_LETTERS = ("абвгдежзий", "αβγδεζηθικ", "אבגדהוזחטי", "ابتثجحخدذر", "กขคงจชซฌญฎ", "漢字仮名交文章例示", "ひらがなカタカナも", "한글자모음절들의글", "क\u0916गघचछजझटठ")
_SCRIPT_SQL = """
given AS (SELECT doc_id, translate(lower(text), 'abcdefghij', [{letters}][CAST(doc_id % 10 AS INT)]) AS t FROM documents WHERE doc_id % 10 > 0 UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 10 = 0),
n AS (SELECT doc_id, len(regexp_extract_all(t, '\\p{{L}}')) AS letters, len(regexp_extract_all(t, '[A-Za-z\\x{{C0}}-\\x{{D6}}\\x{{D8}}-\\x{{F6}}\\x{{F8}}-\\x{{24F}}]')) AS latin,
  [len(regexp_extract_all(t, '\\p{{Cyrillic}}')), len(regexp_extract_all(t, '\\p{{Greek}}')), len(regexp_extract_all(t, '\\p{{Hebrew}}')), len(regexp_extract_all(t, '\\p{{Arabic}}')), len(regexp_extract_all(t, '\\p{{Thai}}')), len(regexp_extract_all(t, '\\p{{Han}}'))] AS c,
  len(regexp_extract_all(t, '[\\p{{Hiragana}}\\p{{Katakana}}]')) AS kana, len(regexp_extract_all(t, '\\p{{Hangul}}')) AS hangul, len(regexp_extract_all(t, '\\p{{Devanagari}}')) AS other FROM given)
SELECT doc_id, CASE WHEN letters = 0 OR letters = latin OR (letters - latin) * 2 < letters THEN NULL WHEN kana > 0 THEN 'Japanese' WHEN hangul > 0 THEN 'Korean'
  WHEN other >= list_max(c) OR len(list_filter(c, lambda x: x = list_max(c))) > 1 THEN 'non-English'
  ELSE ['Cyrillic', 'Greek', 'Hebrew', 'Arabic', 'Thai', 'Chinese or Japanese'][list_position(c, list_max(c))] END AS script FROM n
""".format(letters=", ".join(f"'{x}'" for x in _SCRIPT_LETTERS))


@query(f"WITH {_SCRIPT_SQL}")
def text_writing_system(spark, sf_dir):
    place = (F.col("doc_id") % 10).cast("int")
    low = F.lower("text")
    given = F.col("text")
    for k, letters in enumerate(_SCRIPT_LETTERS, 1):
        given = F.when(place == k, F.translate(low, "abcdefghij", letters)).otherwise(given)
    return _t(spark, sf_dir, "documents").select("doc_id", text.writing_system(given).alias("script"))


@query(r"""SELECT doc_id, array_to_string(list_filter(['trash', 'worthless', 'of the'], lambda t: regexp_matches(lower(text), '(^|[^a-z0-9])' || t || '($|[^a-z0-9])')), ',') AS terms FROM documents""")
def rules_spam_terms(spark, sf_dir):
    r = rules.Rules(spam_terms=("trash", "worthless", "of the"), spam_cjk=())
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(rules.spam_matches(F.array("text"), r), ",").alias("terms"))


@query("SELECT page_id, CASE WHEN contains(lower(html), 'track(') THEN 'track(' WHEN contains(lower(html), 'class=\"ad\"') THEN 'class=\"ad\"' END AS marker FROM pages")
def rules_parked_marker(spark, sf_dir):
    r = rules.Rules(parked=("track(", 'class="ad"'))
    return _t(spark, sf_dir, "pages").select("page_id", rules.parked_marker(F.col("html"), r).alias("marker"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS rank FROM events""")
def signals_page_rank(spark, sf_dir):
    body = F.concat(F.lit('{"found": true, "page_rank_decimal": "'), F.get_json_object("props", "$.k"), F.lit('"}'))
    return _t(spark, sf_dir, "events").select("event_id", signals.page_rank(body).alias("rank"))


@query("""WITH s AS (SELECT 'user' || user_id || '.com' AS domain, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM events) SELECT domain, least(count(*), 10000) AS wayback_snapshots, max(strptime(stamp[1:8], '%Y%m%d'))::DATE AS wayback_last_snapshot FROM s GROUP BY domain""")
def signals_captures(spark, sf_dir):
    return signals.captures(_t(spark, sf_dir, "events").select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".com")).alias("domain"), F.date_format("ts", "yyyyMMddHHmmss").alias("stamp")))


@query("""SELECT 'user' || user_id || '.com' AS domain, count(DISTINCT CASE WHEN value > 80 THEN event_type END) AS cert_count, bool_or(value > 80) AS cert_history FROM events GROUP BY user_id""")
def signals_certificates(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".com")).alias("domain"), F.when(F.col("value") > 80, F.col("event_type")).alias("id"))
    return signals.certificates(rows)


@query("""WITH s AS (SELECT 'user' || user_id || '.com' AS domain, strftime(ts, '%Y%m%d%H%M%S') AS stamp, CAST(ts AS DATE) AS day FROM events WHERE event_type <> 'click'), m AS (SELECT min(CAST(ts AS DATE)) + 10 AS target FROM events)
SELECT domain, stamp FROM s, m QUALIFY row_number() OVER (PARTITION BY domain ORDER BY abs(date_diff('day', target, day)), stamp DESC) = 1""")
def signals_nearest_capture(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".com")).alias("domain"), F.date_format("ts", "yyyyMMddHHmmss").alias("stamp"), F.when(F.col("event_type") == "click", 404).otherwise(200).alias("http_status"), F.lit("text/html").alias("mime"), F.to_date("ts").alias("day"))
    first = rows.agg(F.min("day")).first()[0]  # one row
    return signals.nearest_capture(rows, F.date_add(F.lit(first).cast("date"), 10)).select("domain", "stamp")


# --- jobs -------------------------------------------------------------------------------------------------------------


@query(f"""WITH {_SCORED_SQL}, f AS (SELECT *, CAST(id % 3 AS INT) AS days_listed FROM scored) SELECT name, score FROM (SELECT * FROM f WHERE days_listed = 0 QUALIFY row_number() OVER (PARTITION BY tld ORDER BY score DESC, name) <= 2) ORDER BY score DESC, name LIMIT 20""")
def jobs_newsletter_picks(spark, sf_dir):
    return jobs.newsletter_picks(_scored(spark, sf_dir).withColumn("days_listed", (F.col("id") % 3).cast("int")), 2, 20).select("name", "score")


@query(f"""WITH {_SCORED_SQL}, r AS (SELECT name, id % 2 = 0 AS asked, {_VERDICT_SQL} AS verdict, id % 3 = 0 AS listed FROM scored)
SELECT name, CASE WHEN NOT listed THEN 'missing' WHEN verdict = 'Caution' THEN 'wrong_verdict' ELSE 'eligible' END AS state FROM r WHERE asked""")
def jobs_review_selection(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    rows = rows.withColumn("verdict", scoring.verdict(F.lit(False), F.lit(None).cast("string"), F.col("score"), F.col("evidence")))
    return jobs.review_selection(rows.filter("id % 2 = 0"), rows.filter("id % 3 = 0"))


@query(f"""WITH {_SCORED_SQL} SELECT count(*) AS domain_count, count(*) FILTER (id % 3 = 0) AS today_count, count(*) FILTER (id % 3 > 0) AS carryover_count FROM scored""")
def metrics_header(spark, sf_dir):
    return metrics.header(_scored(spark, sf_dir).withColumn("days_listed", (F.col("id") % 3).cast("int")))


@query(f"""WITH {_SCORED_SQL}, a AS (SELECT 0 AS place, 'signals' AS stage, count(*) AS rows FROM scored UNION ALL SELECT 1, 'evidence', count(*) FILTER (evidence >= 3) FROM scored UNION ALL SELECT 2, 'score', count(*) FILTER (evidence >= 3 AND score >= 40) FROM scored) SELECT *, true AS consistent FROM a""")
def metrics_funnel(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    return metrics.funnel({"signals": rows, "evidence": rows.filter("evidence >= 3"), "score": rows.filter("evidence >= 3 and score >= 40")})


@query(f"""WITH {_SCORED_SQL} SELECT CASE WHEN count(*) = 0 OR count(*) FILTER (id % 9 <> 0) = 0 OR count(*) FILTER (id % 9 <> 0 AND score >= 50) < 5 THEN 'fallback' WHEN count(*) FILTER (id % 9 = 0) > 0 THEN 'partial' ELSE 'ranker' END AS mode, count(*) AS total, count(*) FILTER (id % 9 = 0) AS failed, count(*) FILTER (id % 9 <> 0 AND score >= 50) AS above_gate FROM scored""")
def metrics_ranker_mode(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("phase2_score", F.when(F.col("id") % 9 != 0, F.col("score")))
    return metrics.ranker_mode(rows, enabled=True, gate=50, least=5)


@query(f"WITH {_SCORED_SQL} SELECT count(*) AS total, count(DISTINCT tld) AS tlds, min(wayback_last_snapshot) AS earliest FROM scored")
def metrics_index_facts(spark, sf_dir):
    return metrics.index_facts(_scored(spark, sf_dir).withColumn("dropped_date", F.col("wayback_last_snapshot")))


@query(f"""WITH {_WORDS_SQL}, w AS (SELECT name, split_part(name, '.', 1) AS l, length(name) AS n FROM words), r AS (SELECT *, {_STRUCTURAL_SQL} AS s FROM w),
scored AS (SELECT name, l, n, n * 7 % 100 AS score, n % 5 AS evidence, n * 200 AS wayback_snapshots, n / 5 AS open_page_rank, CASE WHEN n % 2 = 0 THEN n END AS cc_source_domain_count FROM r WHERE s IS NULL)
SELECT name, CASE WHEN contains(l, 'crypto') OR contains(l, 'vape') OR contains(l, 'dating') OR n % 6 = 0 THEN 'Caution' ELSE {_VERDICT_SQL} END AS verdict FROM scored""")
def jobs_refilter(spark, sf_dir):
    n = F.length("name")
    rows = staged(_words(spark, sf_dir), "words").select(  # such a table is stored: its filters are not to run before the distinct
        "name", F.when(n % 6 == 0, "parked").alias("snapshot_category"), (n * 7 % 100).alias("score"), (n % 5).alias("evidence"), (n * 200).alias("wayback_snapshots"), (n / 5).alias("open_page_rank"), F.when(n % 2 == 0, n).alias("cc_source_domain_count")
    )
    return jobs.refilter(rows).select("name", "verdict")


# --- more of the inventory, over the same stand-ins -------------------------------------------------------------------


@query(f"WITH {_SIGNAL_SQL} SELECT name FROM signals WHERE cert_history IS NULL OR cert_history")
def signals_ns_prefilter(spark, sf_dir):
    rows = _signals(spark, sf_dir).select("name", F.when(F.col("cert_history"), "NXDOMAIN").when(~F.col("cert_history"), "NOERROR").alias("rcode"))
    available, _ = signals.name_servers(F.col("rcode"), F.array(F.lit("NS1.example.")))
    return signals.keep_unless_registered(rows.withColumn("dns_available", available)).select("name")


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 4 = 1 THEN true WHEN id % 4 = 2 THEN false END AS listed FROM signals""")
def signals_blocklist(spark, sf_dir):
    k = F.col("id") % 4
    answers = F.when(k == 1, F.array(F.lit("127.0.0.2"))).when(k == 3, F.array(F.lit("127.255.255.254")))
    return _signals(spark, sf_dir).select("name", signals.blocklist_listed(answers, k == 2).alias("listed"))


@query("""SELECT event_id, value > 60 AS flagged, CASE WHEN value > 60 THEN CASE WHEN event_type < 'm' THEN event_type || ',m' WHEN event_type > 'm' THEN 'm,' || event_type END ELSE '' END AS types FROM events""")
def signals_threats(spark, sf_dir):
    threat = lambda x: F.struct(x.alias("threatType"))
    body = F.when(F.col("value") > 60, F.to_json(F.struct(F.array(threat(F.lit("m")), threat(F.col("event_type")), threat(F.lit("m"))).alias("matches")))).otherwise("{}")
    flagged, types = signals.threat_reply(body)
    return _t(spark, sf_dir, "events").select("event_id", flagged.alias("flagged"), F.array_join(types, ",").alias("types"))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 2 = 0 THEN true WHEN id % 3 = 0 THEN false END AS is_available, CASE WHEN id % 2 = 1 AND id % 3 = 0 THEN strftime(wayback_last_snapshot, '%Y-%m-%d') END AS expiration_date FROM signals""")
def signals_registry_reply(spark, sf_dir):
    k = F.col("id")
    body = F.when((k % 2 == 1) & (k % 3 == 0) & F.col("wayback_last_snapshot").isNotNull(), F.concat(F.lit('{"events": [{"eventAction": "expiration", "eventDate": "'), F.col("wayback_last_snapshot").cast("string"), F.lit('T00:00:00Z"}]}')))
    rows = _signals(spark, sf_dir).select("name", F.when(k % 2 == 0, 404).when(k % 3 == 0, 200).otherwise(429).alias("http_status"), body.alias("body"))
    return signals.registry_reply(rows).select("name", "is_available", "expiration_date")


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 3 = 0 AND id % 5 > 0 THEN 'legitimate' ELSE 'unknown' END AS category FROM signals WHERE id % 2 = 0""")
def signals_requested_only(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    word = F.when(F.col("id") % 5 > 0, " Legitimate. ").otherwise(" Clean. ")  # the classifier has no such category: unknown
    return signals.requested_only(rows.filter("id % 2 = 0"), rows.filter("id % 3 = 0").select("name", signals.category(word).alias("category")))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CAST(least(100, greatest(0, id % 150)) AS INT) AS phase2_score, 'because ' || tld AS phase2_reason FROM signals""")
def signals_ranker_reply(spark, sf_dir):
    body = F.to_json(F.array(F.struct(F.col("name"), (F.col("id") % 150).cast("string").alias("score"), F.concat(F.lit("\n because "), F.col("tld"), F.lit("\t\u00a0")).alias("reason"))))
    return signals.ranker_reply(_signals(spark, sf_dir).select(body.alias("body")))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, id % 3 = 0 AS was_published FROM signals""")
def signals_publication(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    return signals.with_publication(rows.select("name"), rows.filter("id % 3 = 0"))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 3 = 0 THEN 50 ELSE 0 END AS phase2_score, CASE WHEN id % 3 = 0 THEN 'ok' ELSE 'not scored' END AS phase2_reason FROM signals""")
def ranking_ranker_scores(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    return ranking.with_ranker_scores(rows.select("name"), rows.filter("id % 3 = 0").select("name", F.lit(50).alias("phase2_score"), F.lit("ok").alias("phase2_reason")))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, tld, CASE WHEN tld IN ('n1', 'n2') THEN 'rdap.one.example' WHEN tld = 'n3' THEN 'rdap.two.example' ELSE '_unknown' END AS host FROM signals""")
def ranking_hosts_of_tlds(spark, sf_dir):
    services = spark.createDataFrame([(["n1", "n2"], ["https://Rdap.One.example/x/"]), (["n3"], ["https://rdap.two.example"])], "tlds array<string>, urls array<string>")
    return ranking.hosts_of_tlds(_signals(spark, sf_dir).select("name", "tld"), services)


@query(f"""WITH {_SIGNAL_SQL} SELECT name, 0 AS place FROM signals WHERE id % 3 = 0 UNION ALL SELECT name, 1 FROM signals WHERE id % 2 = 0 AND id % 3 <> 0""")
def state_held_ahead(spark, sf_dir):
    rows = _signals(spark, sf_dir)
    return snapshot.concat_ahead(rows.filter("id % 3 = 0").select("name"), rows.filter("id % 2 = 0").select("name"))


@query(f"""WITH {_SCORED_SQL} SELECT name FROM scored WHERE id % 5 = 0 AND coalesce(wayback_snapshots, 0) > 0 ORDER BY score DESC, name LIMIT 40""")
def state_targets(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("snapshot_category", F.when(F.col("id") % 5 == 0, "unknown").otherwise("clean"))
    return state.targets(rows, "unknown", 40).select("name")


@query(f"""WITH {_SCORED_SQL} SELECT name FROM scored WHERE {_VERDICT_SQL} <> 'Caution' AND id % 3 <> 0 AND id % 7 <> 0""")
def state_qualifying(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    rows = rows.withColumn("verdict", scoring.verdict(F.lit(False), F.lit(None).cast("string"), F.col("score"), F.col("evidence")))
    return state.qualifying(rows, rows.filter("id % 3 = 0"), rows.filter("id % 7 = 0").select(F.upper("name").alias("name"))).select("name")


@query(f"""WITH {_SIGNAL_SQL} SELECT name, 'clean' AS snapshot_category, CASE WHEN id % 2 = 0 THEN 'spam' END AS shadow_category FROM signals""")
def state_shadow_category(spark, sf_dir):
    rows = _signals(spark, sf_dir).select("id", "name", F.lit("clean").alias("snapshot_category"))
    return state.apply_category(rows, rows.filter("id % 2 = 0").select("name", F.lit("spam").alias("category")), shadow=True).select("name", "snapshot_category", "shadow_category")


@query(f"""WITH {_SIGNAL_SQL} SELECT name FROM signals WHERE id % 2 = 0 AND id % 3 <> 0""")
def state_new_entries(spark, sf_dir):
    rows = _signals(spark, sf_dir).select("id", "name")
    return state.new_entries(rows.filter("id % 3 = 0"), rows.filter("id % 2 = 0").unionByName(rows.filter("id % 4 = 0"))).select("name")


_EXCERPT_SQL = """
cache AS (SELECT page_id, 'p' || page_id AS name, CASE WHEN page_id % 5 > 0 THEN nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), '') END AS title, CASE WHEN page_id % 2 = 0 THEN '20250101000000' ELSE '20260110000000' END AS stamp FROM pages WHERE page_id % 3 > 0)
"""


def _excerpts(spark, sf_dir):
    """A cache that knows two pages of three: the others are the ones that a look-up misses."""
    return _page_excerpts(_t(spark, sf_dir, "pages").filter("page_id % 3 > 0"))


def _page_excerpts(pages, *columns):
    title = F.when(F.col("page_id") % 5 > 0, F.regexp_extract("html", "<h1>([^<]*)</h1>", 1))
    stamp = F.when(F.col("page_id") % 2 == 0, "20250101000000").otherwise("20260110000000")
    empty = F.array().cast("array<string>")
    excerpt = F.struct(stamp.alias("snapshot_timestamp"), title.alias("title"), F.lit(None).cast("string").alias("meta_description"), empty.alias("h1"), empty.alias("h2"))
    return pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name"), excerpt.alias("excerpt"), *columns)


@query(f"""WITH {_EXCERPT_SQL} SELECT 'p' || pages.page_id AS name, CASE WHEN title IS NULL THEN 'missing' WHEN date_diff('day', strptime(stamp, '%Y%m%d%H%M%S')::DATE, DATE '2026-01-20') > 90 THEN 'refetch' ELSE 'reused' END AS excerpt_source FROM pages LEFT JOIN cache USING (page_id)""")
def state_cached_excerpts(spark, sf_dir):
    rows = _t(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name"))
    return state.cached_excerpts(rows, _excerpts(spark, sf_dir), F.lit("2026-01-20").cast("date"), 90).select("name", "excerpt_source")


@query(f"""WITH {_EXCERPT_SQL}, u AS (SELECT 'p' || page_id AS name, CASE WHEN page_id % 4 = 0 THEN 'new' END AS title FROM pages WHERE page_id % 2 = 0)
SELECT coalesce(c.name, u.name) AS name, CASE WHEN u.name IS NULL OR (u.title IS NULL AND c.title IS NOT NULL) THEN c.title ELSE u.title END AS title FROM cache c FULL JOIN u ON c.name = u.name""")
def state_cache_merge(spark, sf_dir):
    empty = F.array().cast("array<string>")
    updates = _t(spark, sf_dir, "pages").filter("page_id % 2 = 0").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name"),
        F.struct(F.lit("20260119000000").alias("snapshot_timestamp"), F.when(F.col("page_id") % 4 == 0, "new").alias("title"), F.lit(None).cast("string").alias("meta_description"), empty.alias("h1"), empty.alias("h2")).alias("excerpt"),
    )
    return state.merge_cache(_excerpts(spark, sf_dir), updates).select("name", F.nullif(F.trim("excerpt.title"), F.lit("")).alias("title"))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, 'a=https://a.example/' || name || ',b=https://b.example/?q=' || name AS links FROM signals""")
def scoring_registrar_links(spark, sf_dir):
    links = scoring.registrar_links(F.col("name"), {"a": "https://a.example/{domain}", "b": "https://b.example/?q={domain}"})
    return _signals(spark, sf_dir).select("name", F.array_join(F.transform(links, lambda x: F.concat(x["name"], F.lit("="), x["url"])), ",").alias("links"))


@query(f"""WITH {_SCORED_SQL} SELECT name, CASE WHEN id % 2 = 0 THEN 'Caution' WHEN score >= 70 THEN 'Clean' WHEN score >= 40 THEN 'Promising' ELSE 'Caution' END AS verdict FROM scored""")
def scoring_verdict_fallback(spark, sf_dir):
    return _scored(spark, sf_dir).select("name", scoring.verdict_or_fallback(F.when(F.col("id") % 2 == 0, "Caution").otherwise("other"), F.col("score")).alias("verdict"))


@query(f"""WITH {_SCORED_SQL} SELECT {_VERDICT_SQL} AS verdict, count(*) AS n FROM scored GROUP BY 1""")
def metrics_verdicts(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    return metrics.value_counts(rows.select(scoring.verdict(F.lit(False), F.lit(None).cast("string"), F.col("score"), F.col("evidence")).alias("verdict")), "verdict")


@query(f"""WITH {_YEARLY_SQL} SELECT release, 'Apr–Jun ' || release[1:4] AS label FROM (SELECT DISTINCT release FROM yearly)""")
def graph_release_labels(spark, sf_dir):
    known = names.release_table(spark, 1990, 2035).select("release", "label")
    return _yearly(spark, sf_dir).select("release").distinct().join(F.broadcast(known), "release")


@query(f"""WITH {_WORDS_SQL} SELECT name FROM words WHERE contains(name, 'crypto') OR contains(split_part(name, '.', 1), 'the') OR contains(name, 'vape')""")
def rules_soft_signal(spark, sf_dir):
    return _words(spark, sf_dir).filter(rules.soft_signal(F.col("name"), rules.Rules(soft=("crypto", "the", "vape"))))


@query(r"""WITH l AS (SELECT trim(unnest(string_split(text, chr(10)))) AS line FROM documents) SELECT DISTINCT regexp_replace(lower(regexp_extract(line, '^(\S+)', 1)), '\.+$', '') AS name FROM l WHERE line <> '' AND NOT regexp_matches(line, '^[;$]') AND regexp_replace(lower(regexp_extract(line, '^(\S+)', 1)), '\.+$', '') <> ''""")
def sources_owner_names(spark, sf_dir):
    lines = _t(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.select(readers.owner_name(F.col("line")).alias("name")).filter("name <> ''").distinct()


#: Titles for every fifth page that say nothing, with the page's own name among them.
_EMPTY_TITLES = ("Untitled.", " it WORKS ", "Example.com", "..example..")


@query("""WITH c AS (SELECT page_id, CASE page_id % 10 WHEN 1 THEN 'Untitled.' WHEN 2 THEN 'it WORKS' WHEN 3 THEN 'Example.com' WHEN 4 THEN '..example..' ELSE trim(regexp_replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&amp;', '&'), '\\s+', ' ', 'g')) END AS t FROM pages),
x AS (SELECT page_id, CASE WHEN length(t) > 40 THEN rtrim(t[1:39]) || '…' ELSE t END AS t FROM c)
SELECT page_id, CASE WHEN t <> '' AND lower(trim(t, '.')) NOT IN ('untitled', 'it works', 'example.com', 'example') THEN t END AS title FROM x""")
def text_excerpt_title(spark, sf_dir):
    raw = F.replace(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), F.lit("&amp;"), F.lit("&"))
    for k, t in enumerate(_EMPTY_TITLES, 1):
        raw = F.when(F.col("page_id") % 10 == k, t).otherwise(raw)
    return _t(spark, sf_dir, "pages").select("page_id", text.excerpt_title(raw, F.lit("example.com"), 40, denied=("untitled", "it works")).alias("title"))


@query(f"""WITH {_ARCHIVE_SQL}, d AS (SELECT domain, min(drop_date) AS first_seen, max(drop_date) AS last_seen, count(*) AS links FROM archive GROUP BY domain), m AS (SELECT min(drop_date) AS lo FROM archive)
SELECT domain, links FROM d, m WHERE links >= 20 AND first_seen > lo""")
def archive_candidates(spark, sf_dir):
    rows = _archive(spark, sf_dir)
    docs = rows.groupBy("domain").agg(F.min("drop_date").alias("first_seen"), F.max("drop_date").alias("last_seen"), F.count(F.lit(1)).alias("links"))
    low = rows.agg(F.min("drop_date")).first()[0]  # one row
    return observations.candidates(docs, tld="com", least_links=20, first_after=str(low) if low else None, sort="links").select("domain", "links")


@query(f"""WITH {_SCORED_SQL} SELECT name, CASE WHEN id % 3 = 0 THEN 'fresh' ELSE 'carried' END AS list FROM scored""")
def jobs_front_page(spark, sf_dir):
    fresh, carried = jobs.front_page(_scored(spark, sf_dir).withColumn("days_listed", (F.col("id") % 3).cast("int")))
    return fresh.select("name", F.lit("fresh").alias("list")).unionByName(carried.select("name", F.lit("carried").alias("list")))


@query(f"""WITH {_SCORED_SQL}, q AS (SELECT * FROM scored WHERE {_VERDICT_SQL} <> 'Caution' AND id % 3 <> 0)
SELECT name, CASE WHEN id % 4 = 0 THEN 'remembered_failure' WHEN coalesce(wayback_snapshots, 0) > 0 THEN 'absent' ELSE 'no_capture' END AS excerpt_from FROM q""")
def jobs_page_selection(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    rows = rows.withColumn("verdict", scoring.verdict(F.lit(False), F.lit(None).cast("string"), F.col("score"), F.col("evidence")))
    none = F.lit(None).cast("struct<snapshot_timestamp: string, title: string, meta_description: string, h1: array<string>, h2: array<string>>")
    cache = rows.filter("id % 4 = 0").select("name", none.alias("excerpt"))
    return jobs.page_selection(rows, rows.filter("id % 3 = 0"), rows.limit(0).select("name"), cache, F.lit("2026-01-20").cast("date")).select("name", "excerpt_from")


@query("""WITH d AS (SELECT DISTINCT 'user' || user_id || '.com' AS domain, CAST(ts AS DATE) AS first_seen_date FROM events) SELECT strftime(first_seen_date, '%Y-%m') AS month, count(*) AS events FROM d GROUP BY 1""")
def jobs_backfill(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".com")).alias("name"), F.to_date("ts").alias("first_seen_date"), F.to_date("ts").alias("snapshot_date"))
    none = spark.createDataFrame([], "domain string, drop_date date, source string, month string")
    return jobs.backfill(rows, none).groupBy("month").agg(F.count(F.lit(1)).alias("events"))


from zonewright import catalog_jobs, catalog_stores, catalog_streams  # noqa: E402, F401  (their queries register themselves)
