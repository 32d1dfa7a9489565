"""More registered queries: what is written and read back, logs, and whole jobs, over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zonewright.catalog import _SCORED_SQL, _SIGNAL_SQL, _STRUCTURAL_SQL, _TRIGRAM_SQL, _WORDS_SQL, _YEARLY_SQL, _COUNTS_SQL, _DAYS_SQL, _NATURAL, _archive, _days, _page_excerpts, _graph, _scored, _signals, _t, _words, _yearly, query
from zonewright.functions import names, rules, scoring, text
from zonewright.operators import graph, metrics, observations, ranking, signals, state
from zonewright.plans import jobs
from zonewright.sources import readers, writers
from zonewright.sources.staging import shared_dir


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- written and read back --------------------------------------------------------------------------------------------


@query(f"WITH {_COUNTS_SQL} SELECT 'part' || p_partkey || '.com' AS apex_domain, coalesce(n, 0) AS source_domain_count FROM part LEFT JOIN inbound ON p_partkey = to_id")
def sources_graph_files(spark, sf_dir):
    folder = _folder(spark, "graph-files")
    vertices, edges = _graph(spark, sf_dir)
    vertices.select("id", "reversed_domain", F.lit(1).alias("num_hosts")).write.option("sep", "\t").option("compression", "gzip").csv(f"{folder}/vertices")
    edges.write.option("sep", "\t").option("compression", "gzip").csv(f"{folder}/edges")
    return graph.link_release(*readers.graph(spark, f"{folder}/vertices", f"{folder}/edges"))


@query(f"""WITH {_COUNTS_SQL}, r AS (SELECT 'part' || p_partkey || '.com' AS apex_domain, coalesce(n, 0) AS source_domain_count FROM part LEFT JOIN inbound ON p_partkey = to_id) SELECT '2026-jun-jul-aug' AS release, apex_domain, source_domain_count FROM r""")
def sources_release(spark, sf_dir):
    path = _folder(spark, "release")
    counts = graph.link_release(*_graph(spark, sf_dir))
    writers.write_release(counts.limit(0), path, "2026-may-jun-jul", F.lit("2026-08-20"))
    writers.write_release(counts, path, "2026-jun-jul-aug", F.lit("2026-09-20"))
    return spark.read.schema("apex_domain string, source_domain_count long, release string").parquet(path).select("release", "apex_domain", "source_domain_count")


@query(f"WITH {_DAYS_SQL} SELECT tld, day AS snapshot_date, name FROM days, bounds WHERE day = yesterday AND tld = 'click'")
def sources_snapshots(spark, sf_dir):
    path = _folder(spark, "names")
    today, yesterday, _, day = _days(spark, sf_dir)
    d = spark.range(1).select(day.cast("string"), F.date_sub(day, 1).cast("string")).first()
    for rows, at in ((yesterday, d[1]), (today, d[0]), (yesterday, d[1])):  # the second time replaces the first
        writers.commit_snapshot(rows, path, at)
    return readers.snapshot(spark, path, tld="click", day=d[1])


@query("""WITH e AS (SELECT DISTINCT 'user' || user_id || '.com' AS domain, CAST(ts AS DATE) AS drop_date, CASE WHEN event_type = 'click' THEN 'live' ELSE 'backfill' END AS source FROM events) SELECT *, strftime(drop_date, '%Y-%m') AS month FROM e""")
def sources_archive(spark, sf_dir):
    path, schema = _folder(spark, "archive"), "domain string, drop_date date, source string"
    rows = _archive(spark, sf_dir)
    for part in (rows.filter("ingest_order % 2 = 0"), rows):  # what the first run wrote is not written again
        writers.append_events(part.select("domain", "drop_date", "source"), readers.archive(spark, path, schema), path)
    return readers.archive(spark, path, schema)


@query(f"""WITH {_SCORED_SQL}, d AS (SELECT unnest([DATE '2026-01-01', DATE '2026-01-02']) AS snapshot_date) SELECT snapshot_date, name, score FROM d, (SELECT name, score FROM scored ORDER BY score DESC, name LIMIT 300)""")
def sources_payloads(spark, sf_dir):
    folder, rows = _folder(spark, "payloads"), _scored(spark, sf_dir).withColumn("days_listed", F.lit(0)).select("name", "score", "days_listed")
    document = writers.payload(ranking.top(rows, 300), metrics.header(rows))
    for day in ("2026-01-01", "2026-01-02"):
        document.coalesce(1).write.text(f"{folder}/{day}")
    # the date stands in the file's own name
    fs = spark._jvm.org.apache.hadoop.fs
    for day in ("2026-01-01", "2026-01-02"):
        at = fs.Path(f"{folder}/{day}")
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        part = next(f.getPath() for f in system.listStatus(at) if f.getPath().getName().startswith("part-"))
        system.rename(part, fs.Path(f"{folder}/{day}.json"))
    return readers.dated_payloads(spark, f"{folder}/*.json", "name string, score int")


@query(f"""WITH {_SCORED_SQL} SELECT name, score FROM scored ORDER BY score DESC, name LIMIT 50""")
def sources_payload_rows(spark, sf_dir):
    path, rows = _folder(spark, "payload"), _scored(spark, sf_dir).withColumn("days_listed", F.lit(0)).select("name", "score", "days_listed")
    writers.payload(ranking.top(rows, 50), metrics.header(rows)).write.text(path)
    return readers.payload_rows(spark, path, "name string, score int")


@query("""SELECT event_id, event_type FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0""")
def sources_json_lines(spark, sf_dir):
    path, e = _folder(spark, "lines"), _t(spark, sf_dir, "events")
    line = F.when(F.col("event_id") % 5 == 0, "{broken").when(F.col("event_id") % 7 == 0, "[1]").otherwise(F.to_json(F.struct("event_id", "event_type")))
    e.select(line.alias("value")).write.text(path)
    return readers.json_lines(spark, path, "event_id long, event_type string")[0]


@query("""SELECT count(*) FILTER (event_id % 5 = 0 OR event_id % 7 = 0) AS corrupt FROM events""")
def sources_corrupt_lines(spark, sf_dir):
    path, e = _folder(spark, "lines"), _t(spark, sf_dir, "events")
    line = F.when(F.col("event_id") % 5 == 0, "{broken").when(F.col("event_id") % 7 == 0, "[1]").otherwise(F.to_json(F.struct("event_id", "event_type")))
    e.select(line.alias("value")).write.text(path)
    return readers.json_lines(spark, path, "event_id long, event_type string")[1]


@query("""SELECT 'p' || page_id AS name, CASE WHEN page_id % 4 > 0 THEN nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') END AS title FROM pages WHERE page_id % 3 > 0""")
def sources_excerpt_cache(spark, sf_dir):
    path, p = _folder(spark, "cache"), F.col("page_id")
    title = F.nullif(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), F.lit(""))
    value = F.when(p % 3 == 0, F.when(p % 2 == 0, "[1]").otherwise('"text"')).when(p % 4 == 0, "null").otherwise(F.to_json(F.struct(title.alias("title"), F.lit("20260101000000").alias("snapshot_timestamp"))))
    entry = F.concat(F.lit('"p'), p.cast("string"), F.lit('": '), value)
    # one JSON object, as such a cache file is
    _t(spark, sf_dir, "pages").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ",\n"), F.lit("}")).alias("value")).write.text(path)
    return readers.excerpt_cache(spark, path).select("name", "excerpt.title")


@query(f"""WITH {_SIGNAL_SQL} SELECT name, was FROM (SELECT name, id % 6 = 0 AS was FROM signals)""")
def sources_hand_off(spark, sf_dir):
    path, rows = _folder(spark, "available"), _signals(spark, sf_dir).select("name", (F.col("id") % 6 == 0).alias("was"))
    for part in (rows.limit(3), rows):
        writers.hand_off(part, path, "2026-01-20")
    return spark.read.schema("name string, was boolean, day string").json(path).drop("day")


@query(f"""WITH {_SIGNAL_SQL} SELECT CASE WHEN id % 4 = 0 THEN 'rejects' WHEN id % 12 = 3 THEN 'published' ELSE 'discards' END AS stage, name FROM signals UNION ALL SELECT 'survivors', name FROM signals WHERE id % 4 <> 0""")
def sources_stage_dumps(spark, sf_dir):
    folder, rows = _folder(spark, "stages"), _signals(spark, sf_dir).select("id", "name")
    drops = rows.withColumn("reject_reason", F.when(F.col("id") % 4 == 0, "too_short"))
    survivors = rows.filter("id % 4 <> 0")
    writers.dump_stages(writers.stage_tables(drops, survivors, survivors.filter("id % 12 = 3")), folder)
    read = spark.read.text(f"{folder}/*").withColumn("stage", F.regexp_extract(F.input_file_name(), "/([a-z]+)/[^/]*$", 1))
    return read.select("stage", F.get_json_object("value", "$.name").alias("name"))


# --- columns that stand in no other query -----------------------------------------------------------------------------


@query(f"""WITH {_SCORED_SQL} SELECT name, score, 0 AS days_listed, 0 AS statuses, CAST(NULL AS VARCHAR) AS phase2_reason, wayback_snapshots FROM scored""")
def scoring_published_row(spark, sf_dir):
    out = scoring.published_row(_scored(spark, sf_dir))
    return out.select("name", "score", "days_listed", F.size("rdap_status").alias("statuses"), "phase2_reason", "wayback_snapshots")


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 4 > 0 AND cc_source_domain_count IS NOT NULL THEN 'b=' || cc_source_domain_count || ',a=?' END AS history FROM signals""")
def scoring_link_history(spark, sf_dir):
    count = F.when(F.col("id") % 4 == 0, F.lit("-1")).otherwise(F.coalesce(F.col("cc_source_domain_count").cast("string"), F.lit('"none"')))
    json = F.concat(F.lit('[{"release": "b", "source_domain_count": '), count, F.lit('}, {"release": "a", "source_domain_count": null}]'))
    shown = F.array_join(F.transform(scoring.link_history(json), lambda h: F.concat(h["release"], F.lit("="), F.coalesce(h["source_domain_count"].cast("string"), F.lit("?")))), ",")
    return _signals(spark, sf_dir).select("name", shown.alias("history"))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 3 = 2 THEN 'fine ' || tld END AS reason FROM signals""")
def scoring_ranker_reason(spark, sf_dir):
    k = F.col("id") % 3
    raw = F.when(k == 0, " \n ").when(k == 1, "\r\nNot Scored\u2003").otherwise(F.concat(F.lit("\u00a0fine "), F.col("tld"), F.lit("\t ")))
    return _signals(spark, sf_dir).select("name", scoring.ranker_reason(raw).alias("reason"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS at FROM events""")
def text_parse_time(spark, sf_dir):
    k = F.col("event_id") % 3
    raw = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise("some day")
    return _t(spark, sf_dir, "events").select("event_id", text.parse_time(raw).alias("at"))


@query("""WITH c AS (SELECT page_id, CASE WHEN page_id % 5 > 0 THEN trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) END AS t, CASE WHEN page_id % 2 = 0 THEN '20250101000000' ELSE '20260110000000' END AS stamp,
  trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS body FROM pages),
x AS (SELECT page_id, nullif(t, '') AS t, stamp, CASE WHEN page_id % 7 < 3 THEN nullif(CASE WHEN length(body) > 200 THEN rtrim(substr(body, 1, 199)) || '…' ELSE body END, '') END AS meta FROM c)
SELECT 'p' || page_id AS name, t AS title, meta AS meta_description, CASE WHEN page_id % 4 = 0 THEN 'one,three,four' ELSE '' END AS h1, CASE WHEN page_id % 4 = 0 THEN 5 ELSE 0 END AS h2, CASE WHEN t IS NOT NULL OR meta IS NOT NULL OR page_id % 4 = 0 THEN stamp END AS captured FROM x""")
def text_evidence_fields(spark, sf_dir):
    heads = F.col("page_id") % 4 == 0
    none, some = F.array().cast("array<string>"), lambda *texts: F.array(*[F.lit(x) for x in texts])
    raw = F.regexp_replace("html", "<[^>]*>", "\u200b ")
    pages = _page_excerpts(_t(spark, sf_dir, "pages"), "page_id", raw.alias("raw"))
    excerpt = F.col("excerpt").withField("meta_description", F.when(F.col("page_id") % 7 < 3, F.col("raw")))
    excerpt = excerpt.withField("h1", F.when(heads, some(" one", "\n", "three ", "four", "five")).otherwise(none)).withField("h2", F.when(heads, some(*"abcdefg")).otherwise(none))
    fields = text.evidence_fields(excerpt, F.col("name"))
    return pages.select("name", fields["title"].alias("title"), fields["meta_description"].alias("meta_description"), F.array_join(fields["h1"], ",").alias("h1"), F.size(fields["h2"]).alias("h2"), fields["captured"].alias("captured"))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 2 = 0 THEN '/d/' || name || '/' ELSE '/#' || name END AS link FROM signals""")
def names_page_link(spark, sf_dir):
    return _signals(spark, sf_dir).select("name", names.page_link(F.col("name"), F.when(F.col("id") % 2 == 0, True)).alias("link"))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, open_page_rank FROM signals ORDER BY open_page_rank DESC NULLS LAST, name LIMIT 500""")
def ranking_nulls_last(spark, sf_dir):
    return ranking.sort_nulls_last(_signals(spark, sf_dir).select("name", "open_page_rank"), "open_page_rank", True).limit(500)


@query("""WITH a AS (SELECT 'user' || user_id || '.com' AS domain, CAST(ts AS DATE) AS drop_date, event_id, value FROM events) SELECT domain, event_id AS ingest_order FROM a QUALIFY row_number() OVER (PARTITION BY domain ORDER BY (value > 95) DESC, drop_date DESC, event_id) = 1""")
def archive_newest_answer(spark, sf_dir):
    return observations.newest_answer(_archive(spark, sf_dir), F.col("value") > 95).select("domain", "ingest_order")


@query(f"""WITH {_SIGNAL_SQL} SELECT name, CASE WHEN id % 3 = 0 THEN 'toxic' WHEN id % 5 = 0 THEN 'parked' WHEN id % 7 = 1 THEN 'toxic' WHEN id % 7 = 2 THEN 'legitimate' ELSE 'unknown' END AS category FROM signals""")
def signals_final_category(spark, sf_dir):
    k = F.col("id")
    none = F.array().cast("array<string>")
    rows = _signals(spark, sf_dir).select("id", "name", F.when(k % 3 == 0, "get CIALIS now").alias("title"), F.lit(None).cast("string").alias("meta_description"), none.alias("h1"), none.alias("h2"), F.when(k % 5 == 0, "<b>This Domain Is For Sale</b>").alias("html"))
    model = rows.filter(k % 7 < 3).filter(k % 7 > 0).select("name", F.when(k % 7 == 1, "toxic").otherwise("legitimate").alias("category"))
    return signals.classify_excerpts(rows.drop("id"), model)


@query(f"""WITH {_YEARLY_SQL}, b AS (SELECT release, CASE WHEN n = 0 THEN '0' WHEN n < 10 THEN '1-9' WHEN n < 100 THEN '10-99' WHEN n < 1000 THEN '100-999' ELSE '>=1000' END AS bucket, count(*) AS names FROM yearly GROUP BY ALL),
r AS (SELECT release, lag(release) OVER (ORDER BY release) AS previous FROM (SELECT DISTINCT release FROM b)) SELECT b.release, r.previous, b.bucket, b.names, b.names / p.names AS ratio FROM b JOIN r USING (release) LEFT JOIN b p ON p.release = r.previous AND p.bucket = b.bucket""")
def graph_release_ratios(spark, sf_dir):
    return graph.bucket_ratios(_yearly(spark, sf_dir), names.release_table_of(_yearly(spark, sf_dir)))


@query(f"""WITH {_SIGNAL_SQL} SELECT name, array_to_string(list_filter([CASE WHEN id % 4 <> 1 THEN 'content_unscreened' END, CASE WHEN id % 6 = 0 THEN 'wayback_unknown' END, CASE WHEN wayback_snapshots IS NULL THEN 'missing:wayback_snapshots' END, CASE WHEN open_page_rank IS NULL THEN 'missing:open_page_rank' END], lambda x: x IS NOT NULL), ',') AS reasons FROM signals""")
def state_held_reasons(spark, sf_dir):
    k = F.col("id")
    rows = _signals(spark, sf_dir).withColumn("snapshot_category", F.when(k % 4 == 1, "clean").when(k % 4 == 2, "unknown")).withColumn("wayback_unknown", F.when(k % 3 == 0, k % 6 == 0))
    return rows.select("name", F.array_join(state.incomplete_reasons(), ",").alias("reasons"))


@query(f"""WITH {_SIGNAL_SQL} SELECT CASE WHEN id % 3 = 0 THEN 'reused' WHEN id % 2 = 0 THEN 'fetched' ELSE 'missing' END AS excerpt_source, count(*) AS n FROM signals GROUP BY 1""")
def metrics_excerpt_sources(spark, sf_dir):
    k = F.col("id")
    return metrics.excerpt_sources(_signals(spark, sf_dir).select(F.when(k % 3 == 0, "reused").when(k % 3 == 1, "refetch").otherwise("missing").alias("excerpt_source"), (k % 2 == 0).alias("fetched")))


@query("""SELECT max(CAST(ts AS DATE)) - 46 AS release_end, 46 AS age_days, true AS stale FROM events UNION ALL SELECT max(CAST(ts AS DATE)) - 45, 45, false FROM events UNION ALL SELECT NULL, NULL, false""")
def metrics_freshness(spark, sf_dir):
    now = _t(spark, sf_dir, "events").agg(F.max(F.to_date("ts")).alias("now"))
    ends = now.select("now", F.explode(F.array(F.date_sub("now", 46), F.date_sub("now", 45), F.lit(None).cast("date"))).alias("release_end"))
    age, old = metrics.freshness(F.col("release_end"), F.col("now"))
    return ends.select("release_end", age.alias("age_days"), old.alias("stale"))


@query("""SELECT count(*) > 0 AND count(*) FILTER (quality IS NOT NULL) = 0 AS blind FROM labels""")
def metrics_blind(spark, sf_dir):
    rows = _t(spark, sf_dir, "labels").withColumn("category", F.when(F.col("quality") == 1, "legitimate").when(F.col("quality") == 0, "parked").otherwise("unknown"))
    return metrics.blind(metrics.category_counts(rows, list(signals.CATEGORIES)))


_LOG_SQL = """SELECT 'strikes' AS metric, 'h' || user_id AS key, CAST(max(event_id % 9) AS BIGINT) AS n FROM events WHERE event_type = 'click' GROUP BY user_id
UNION ALL SELECT 'rejects', 'spam', max(event_id) FROM events UNION ALL SELECT 'rejects', 'toxic', 3 UNION ALL SELECT 'categories', 'clean', max(event_id) FROM events UNION ALL SELECT 'categories', 'toxic', 2
UNION ALL SELECT 'queue', 'held', max(event_id) FROM events UNION ALL SELECT 'queue', 'new', 5"""


@query(_LOG_SQL)
def metrics_log(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.col("event_id").alias("line_no"), "event_type", "user_id")
    strike = F.concat(F.lit("WARNING host h"), F.col("user_id").cast("string"), F.lit(" strike "), (F.col("line_no") % 9).cast("string"))
    n = F.col("line_no").cast("string")
    lines = e.select("line_no", F.when(F.col("event_type") == "click", strike).otherwise("noise").alias("value"))
    lines = lines.unionByName(e.select("line_no", F.concat(F.lit("Post-enrichment rejections: {'spam': "), n, F.lit(", 'toxic': 3}")).alias("value"))).unionByName(e.select("line_no", F.concat(F.lit("classifier results: "), n, F.lit(" clean, 2 toxic")).alias("value"))).unionByName(e.select("line_no", F.concat(F.lit("Held queue: held="), n, F.lit(" new=5")).alias("value")))
    named = lambda df, metric, key, value: df.select(F.lit(metric).alias("metric"), F.col(key).alias("key"), F.col(value).cast("long").alias("n"))
    report = jobs.run_report(lines, F.lit(None).cast("date"), F.current_date(), ("clean", "toxic"))
    return named(report["strikes"], "strikes", "host", "strikes").unionByName(named(report["rejects"], "rejects", "key", "n")).unionByName(named(report["categories"], "categories", "category", "n")).unionByName(named(report["held"], "queue", "counter", "n"))


# --- whole jobs -------------------------------------------------------------------------------------------------------

#: A day over words as names: k stands for all that a name has, and each step's table is some of the names by it.
_DAY_SQL = rf"""
{_WORDS_SQL}, {_TRIGRAM_SQL}, k AS (SELECT name, l, g, length(name) * 31 + ascii(name) * 7 + ascii(name[3]) AS k FROM t),
lex AS (SELECT *, len(list_filter(g, lambda x: x IN ({_NATURAL}))) AS matches, list_filter(string_split(l, ''), lambda x: x <> '') AS cs FROM k WHERE k % 3 <> 0),
kept AS (SELECT * FROM lex WHERE ({_STRUCTURAL_SQL}) IS NULL AND len(regexp_extract_all(l, '[0-9]')) / length(l) <= 0.30 AND coalesce(len(regexp_extract_all(l, '[aeiouy]')) / nullif(len(regexp_extract_all(l, '[a-z]')), 0), 0) >= 0.15
  AND list_sum(list_transform(list_distinct(cs), lambda x: -(len(list_filter(cs, lambda y: y = x)) / len(cs)) * log2(len(list_filter(cs, lambda y: y = x)) / len(cs)))) <= 3.5
  AND NOT list_bool_or(list_transform(range(1, length(l) - 2), lambda i: l[i] = l[i + 1] AND l[i] = l[i + 2] AND l[i] = l[i + 3])) IS TRUE AND NOT regexp_matches(l, '[bcdfghjklmnpqrstvwxz]{{{{6,}}}}') AND len(g) > 0 AND matches >= 3 AND matches / len(g) >= 0.55),
sent AS (SELECT *, CAST(k % 101 AS INT) AS phase2_score FROM kept ORDER BY matches DESC, length(l), name LIMIT 400),
eligible AS (SELECT * FROM sent WHERE k % 11 <> 0 AND phase2_score >= 40),
chosen AS (SELECT * FROM eligible QUALIFY row_number() OVER (ORDER BY phase2_score DESC, name) <= 150),
queue AS (SELECT name, k FROM k WHERE k % 97 = 0),
asked AS (SELECT name, k, 0 AS place FROM queue UNION ALL SELECT name, k, 1 FROM chosen WHERE name NOT IN (SELECT name FROM queue)),
enriched AS (SELECT *, k * 3 % 4000 AS snaps, k % 50 / 5 AS opr, k % 4 > 0 AS cert, CASE WHEN k % 9 = 1 THEN 'toxic' WHEN k % 9 = 2 THEN 'unknown' ELSE 'clean' END AS cat FROM asked WHERE k % 5 > 1),
survivors AS (SELECT *, array_to_string(list_filter([CASE WHEN cat = 'unknown' THEN 'content_unscreened' END, CASE WHEN k % 13 = 0 THEN 'missing:open_page_rank' END], lambda x: x IS NOT NULL), ',') AS reasons FROM enriched WHERE cat <> 'toxic' AND k % 17 <> 0 AND snaps >= 1)
"""
_DAY_SQL = _DAY_SQL.replace("{{", "{").replace("}}", "}")


def _day(spark, sf_dir):
    k = (F.length("name") * 31 + F.ascii("name") * 7 + F.ascii(F.substring("name", 3, 1))).alias("k")
    rows = _words(spark, sf_dir).select(F.lit("com").alias("tld"), "name", k)
    rows = jobs.staged(rows, "day")  # each of the day's tables is some of it
    today = rows.filter("k % 3 = 0").select("tld", "name")
    date = F.lit("2026-01-20").cast("date")
    evidence = rows.select(
        "name", (F.col("k") * 3 % 4000).alias("wayback_snapshots"), F.lit(None).cast("date").alias("wayback_last_snapshot"), F.when(F.col("k") % 13 != 0, F.col("k") % 50 / 5).alias("open_page_rank"), (F.col("k") % 4 > 0).alias("cert_history"),
        F.lit(None).cast("int").alias("cc_source_domain_count"), (F.col("k") % 17 == 0).alias("spam_flagged"), F.lit(False).alias("surbl_listed"), F.lit(False).alias("spamhaus_listed"),
    )
    categories = rows.select("name", F.when(F.col("k") % 9 == 1, "toxic").when(F.col("k") % 9 == 2, "unknown").otherwise("clean").alias("category"))
    previous = rows.select("tld", "name", date.alias("first_seen_date"), F.lit(False).alias("wayback_unknown"), F.lit(0).alias("wayback_unknown_attempts")).limit(0)
    held = rows.filter("k % 97 = 0").select("tld", "name", F.date_sub(date, (F.col("k") % 5).cast("int")).alias("first_held_date"), F.lit(1).alias("checks"))
    ranker = rows.filter("k % 11 <> 0").select("name", (F.col("k") % 101).cast("int").alias("phase2_score"), F.lit("because").alias("phase2_reason"))
    availability = rows.filter("k % 5 <> 0").select("name", (F.col("k") % 5 > 1).alias("is_available"))
    services = spark.sql("SELECT array('com') AS tlds, array('https://registry.example/') AS urls")
    quotas = spark.sql("SELECT 'registry.example' AS host, 150 AS quota")
    c = jobs.Daily(narrow_to=400, gate=40, publish=60)
    return jobs.daily_run(rows.select("tld", "name"), today, previous, rows.filter("k % 29 = 0 and k % 3 = 0").select("name"), availability, evidence, date, c, ranker=ranker, services=services, quotas=quotas, held=held, categories=categories)


@query(f"WITH {_DAY_SQL} SELECT name, phase2_score FROM chosen")
def jobs_daily_run_selected(spark, sf_dir):
    return _day(spark, sf_dir)["selected"].select("name", "phase2_score")


@query(f"WITH {_DAY_SQL} SELECT name, first_seen_date FROM (SELECT name, DATE '2026-01-20' AS first_seen_date FROM eligible WHERE name NOT IN (SELECT name FROM chosen))")
def jobs_daily_run_overflow(spark, sf_dir):
    return _day(spark, sf_dir)["overflow"].select("name", "first_seen_date")


@query(f"""WITH {_DAY_SQL}, known AS (SELECT name FROM k WHERE k % 29 = 0 AND k % 3 = 0), left_ AS (SELECT * FROM survivors WHERE name NOT IN (SELECT name FROM known))
SELECT a.name, CASE WHEN s.name IS NOT NULL THEN s.reasons ELSE 'rdap_unknown' END AS reasons FROM asked a LEFT JOIN left_ s USING (name)
WHERE (s.name IS NOT NULL AND s.reasons <> '' AND (a.place = 1 OR a.k % 5 < 3)) OR (s.name IS NULL AND a.place = 0 AND a.k % 5 = 0)""")
def jobs_daily_run_held(spark, sf_dir):
    return _day(spark, sf_dir)["held"].select("name", F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH {_DAY_SQL}, known AS (SELECT name FROM k WHERE k % 29 = 0 AND k % 3 = 0)
SELECT name, snaps AS wayback_snapshots FROM survivors WHERE reasons = '' AND name NOT IN (SELECT name FROM known)""")
def jobs_daily_run_screened(spark, sf_dir):
    return _day(spark, sf_dir)["survivors"].select("name", "wayback_snapshots")


@query(f"""WITH {_DAY_SQL} SELECT DISTINCT name FROM enriched WHERE cat = 'toxic' AND NOT (k % 29 = 0 AND k % 3 = 0)""")
def jobs_daily_run_denylist(spark, sf_dir):
    return _day(spark, sf_dir)["denylist"].select("name")


@query(f"""WITH {_DAY_SQL}, known AS (SELECT name FROM k WHERE k % 29 = 0 AND k % 3 = 0),
f AS (SELECT 0 AS place, 'drops' AS stage, (SELECT count(*) FROM lex) AS rows UNION ALL SELECT 1, 'lexical', (SELECT count(*) FROM kept) UNION ALL SELECT 2, 'selected', (SELECT count(*) FROM chosen) UNION ALL SELECT 3, 'available', (SELECT count(*) FROM enriched WHERE place = 1)
  UNION ALL SELECT 4, 'survivors', (SELECT count(*) FROM survivors WHERE place = 1 AND name NOT IN (SELECT name FROM known)))
SELECT *, true AS consistent FROM f""")
def jobs_daily_run_funnel(spark, sf_dir):
    return _day(spark, sf_dir)["funnel"]


@query(f"""WITH {_SCORED_SQL}, r AS (SELECT name, id, score FROM scored), w AS (SELECT * FROM r WHERE id % 3 > 0 ORDER BY score DESC NULLS LAST, name LIMIT 400),
f AS (SELECT name, id, CASE WHEN id % 10 = 3 THEN 'toxic' WHEN id % 6 = 1 THEN 'parked' WHEN id % 4 = 1 THEN 'toxic' WHEN id % 4 = 2 THEN 'clean' ELSE 'unknown' END AS c FROM w)
SELECT r.name, CASE WHEN r.id % 3 = 0 THEN 'clean' ELSE f.c END AS snapshot_category FROM r LEFT JOIN f USING (name) WHERE f.c IS DISTINCT FROM 'toxic' AND r.id % 50 <> 7""")
def jobs_reclassify(spark, sf_dir):
    k = F.col("id")
    rows = _scored(spark, sf_dir).select("id", "name", "score", F.when(k % 3 == 0, "clean").alias("snapshot_category"), F.lit(0).alias("days_listed"))
    excerpt = F.struct(F.lit("20260110000000").alias("snapshot_timestamp"), F.concat(F.when(k % 10 == 3, "Payday Loan ").otherwise("Shop "), F.col("name")).alias("title"), F.lit(None).cast("string").alias("meta_description"), F.array().cast("array<string>").alias("h1"), F.array().cast("array<string>").alias("h2"))
    cache = rows.filter(k % 2 == 0).select("name", excerpt.alias("excerpt"))
    fetched = rows.filter(k % 2 == 1).select("name", excerpt.alias("excerpt"), F.when(k % 6 == 1, "buy this domain").otherwise("<p>").alias("html"))
    replies = rows.filter(k % 4 > 0).filter(k % 4 < 3).select("name", F.when(k % 4 == 1, "toxic").otherwise("clean").alias("category"))
    deny = rows.filter(k % 50 == 7).select(F.upper("name").alias("name"))
    return jobs.reclassify(rows, cache, fetched, replies, deny, F.lit("2026-01-20").cast("date"), top=400)["kept"].select("name", "snapshot_category")


@query(f"""WITH {_COUNTS_SQL}, x AS (SELECT count(*) AS n FROM part), p AS (SELECT coalesce(max(n), 0) >= 1 AS p FROM inbound WHERE to_id = 1)
SELECT 'check' AS kind, 'release' AS name, CAST(n > 0 AS VARCHAR) AS value FROM x UNION ALL SELECT 'check', 'rows', CAST(n >= 100 AS VARCHAR) FROM x UNION ALL SELECT 'check', 'present:part1.com', CAST(p AS VARCHAR) FROM p UNION ALL SELECT 'check', 'absent:absent.com', 'true'
UNION ALL SELECT 'pointer', 'current', CASE WHEN n >= 100 AND p THEN '2026-jun-jul-aug' ELSE '2026-may-jun-jul' END FROM x, p UNION ALL SELECT 'pointer', 'previous', CASE WHEN n >= 100 AND p THEN '2026-may-jun-jul' END FROM x, p
UNION ALL SELECT 'meta', 'rows', CAST(n AS VARCHAR) FROM x UNION ALL SELECT 'plan', '2026-jun-jul-aug', 'keep'""")
def jobs_graph_refresh(spark, sf_dir):
    pointer = spark.sql("SELECT '2026-may-jun-jul' AS current, CAST(NULL AS STRING) AS previous")
    out = jobs.promote_release(*_graph(spark, sf_dir), pointer, "2026-jun-jul-aug", _folder(spark, "releases"), F.lit("2026-09-20"), least_rows=100, present={"part1.com": 1}, absent=["absent.com"], keep=3)
    named = lambda df, kind, name, value: df.select(F.lit(kind).alias("kind"), F.col(name).alias("name"), F.col(value).cast("string").alias("value"))
    moved = out["pointer"].select(F.inline(F.array(F.struct(F.lit("current").alias("name"), F.col("current").alias("value")), F.struct(F.lit("previous").alias("name"), F.col("previous").alias("value")))))
    return named(out["checks"], "check", "check", "ok").unionByName(named(moved, "pointer", "name", "value")).unionByName(named(out["meta"].filter("key = 'rows'"), "meta", "key", "value")).unionByName(named(out["plan"], "plan", "release", "action"))


@query(f"""WITH {_SCORED_SQL} SELECT 0 AS place, 'all' AS stage, count(*) AS rows FROM scored UNION ALL SELECT 1, 'good', count(*) FILTER (score >= 50) FROM scored""")
def jobs_front_page_figures(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    return jobs.front_page_figures({"all": rows, "good": rows.filter("score >= 50")})
