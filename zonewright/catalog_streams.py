"""Registered queries over what lands: the held queue as a stream, signal sources by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright.catalog import _t, query
from zonewright.catalog_jobs import _folder
from zonewright.operators import named
from zonewright.sources import readers
from zonewright.streaming import held


@query("""WITH RECURSIVE o AS (
  SELECT 'user' || user_id AS name, CAST(ts AS DATE) AS d, bool_or(event_type IN ('signup', 'error')) AS fresh, bool_or(event_type = 'purchase') AS registered,
    bool_or(event_type <> 'error') AS enriched, bool_or(event_type = 'view') AS survived, bool_or(event_type = 'click') AS complete FROM events GROUP BY ALL),
obs AS (SELECT *, survived AND complete AS good, enriched AND NOT survived AS bad, row_number() OVER (PARTITION BY name ORDER BY d) AS k FROM o),
walk(name, k, d, action, said_first, said_checks, gap_end, gap_first, gap_checks, first, checks, last) AS (
  SELECT DISTINCT name, CAST(0 AS BIGINT), CAST(NULL AS DATE), CAST(NULL AS VARCHAR), CAST(NULL AS DATE), CAST(NULL AS INT), CAST(NULL AS DATE), CAST(NULL AS DATE), CAST(NULL AS INT), CAST(NULL AS DATE), CAST(NULL AS INT), CAST(NULL AS DATE) FROM obs
  UNION ALL
  SELECT name, k, d, action, CASE WHEN action = 'new_held' THEN d WHEN action NOT IN ('publish', 'gone') THEN first END,
    CASE WHEN action = 'new_held' THEN 0 WHEN action = 'held' THEN before + 1 WHEN action NOT IN ('publish', 'gone') THEN before END,
    gap_end, gap_first, gap_checks, CASE action WHEN 'held' THEN first WHEN 'new_held' THEN d END, CASE action WHEN 'held' THEN before + 1 WHEN 'new_held' THEN 0 END, CASE WHEN action IN ('held', 'new_held') THEN d END
  FROM (SELECT *, CASE WHEN first IS NOT NULL THEN CASE WHEN registered THEN 'reregistered' WHEN good THEN 'released' WHEN bad THEN 'rejected' WHEN first + 3 <= d THEN 'expired' ELSE 'held' END
      WHEN fresh THEN CASE WHEN good THEN 'publish' WHEN bad THEN 'gone' ELSE 'new_held' END END AS action
    FROM (SELECT obs.name, obs.k, obs.d, fresh, registered, good, bad, CASE WHEN w.first + 3 >= obs.d THEN w.first END AS first, CAST(w.checks + (obs.d - w.last) - 1 AS INT) AS before,
        CASE WHEN w.first + 3 < obs.d THEN w.first + 3 END AS gap_end, w.first AS gap_first, CAST(w.checks + (w.first + 3 - w.last) - 1 AS INT) AS gap_checks
      FROM walk w JOIN obs ON obs.name = w.name AND obs.k = w.k + 1))),
ends AS (SELECT name, max(k) AS k FROM walk GROUP BY name)
SELECT name, d AS day, action, said_first AS first_held_date, said_checks AS checks FROM walk WHERE action IS NOT NULL
UNION ALL SELECT name, gap_end, 'expired', gap_first, gap_checks FROM walk WHERE gap_end IS NOT NULL
UNION ALL SELECT name, first + 3, 'expired', first, CAST(checks + (first + 3 - last) - 1 AS INT) FROM walk JOIN ends USING (name, k) WHERE first + 3 < (SELECT max(d) FROM obs)""")
def streaming_held_queue(spark, sf_dir):
    root, event = _folder(spark, "held"), F.col("event_type")
    days = _t(spark, sf_dir, "events").groupBy(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"), F.to_date("ts").alias("day")).agg(
        F.bool_or(event.isin("signup", "error")).alias("new"), F.bool_or(event == "purchase").alias("registered"), F.bool_or(event != "error").alias("enriched"),
        F.bool_or(event == "view").alias("survived"), F.bool_or(event == "click").alias("complete"),
    )
    # two landings, two runs: the second goes on from the checkpoint of the first
    for landing in (F.dayofmonth("day") <= 15, F.dayofmonth("day") > 15):
        days.filter(landing).write.mode("append").parquet(f"{root}/landed")
        held.settle_landed(spark, f"{root}/landed", f"{root}/out", f"{root}/state", 3).awaitTermination()
    return spark.read.schema(held.SETTLED).parquet(f"{root}/out")


@query("""WITH r AS (SELECT 'user' || user_id || '.com' AS name, *, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY ts DESC, event_id DESC) AS newest FROM events),
registry AS (SELECT * FROM r WHERE newest = 1 AND event_id % 3 = 0), ranks AS (SELECT * FROM r WHERE newest = 1 AND event_id % 3 = 1)
SELECT n.name, CASE registry.event_type WHEN 'view' THEN true WHEN 'click' THEN false END AS is_available, CASE WHEN registry.name IS NOT NULL THEN strftime(registry.ts, '%Y-%m-%d') END AS expiration_date,
  CASE WHEN registry.name IS NOT NULL THEN 'R' || registry.event_id END AS registrar, ranks.event_id % 100 / 10 AS open_page_rank, CAST(NULL AS BOOLEAN) AS threat_flagged, CAST(NULL AS INT) AS age_days
FROM (SELECT DISTINCT name FROM r) n LEFT JOIN registry USING (name) LEFT JOIN ranks USING (name)""")
def signals_named_sources(spark, sf_dir):
    root, e = _folder(spark, "landed"), _t(spark, sf_dir, "events")
    number, k = F.col("event_id").cast("string"), F.col("event_id") % 3
    registry = F.concat(F.lit('{"events": [{"eventAction": "expiration", "eventDate": "'), F.date_format("ts", "yyyy-MM-dd"), F.lit('T00:00:00Z"}], "entities": [{"roles": ["registrar"], "vcardArray": ["vcard", [["fn", {}, "text", "R'), number, F.lit('"]]]}]}'))
    rank = F.concat(F.lit('{"found": true, "page_rank_decimal": '), (F.col("event_id") % 100 / 10).cast("string"), F.lit("}"))
    replies = e.select(
        F.concat(F.lit("USER"), F.col("user_id").cast("string"), F.lit(".com")).alias("domain"), F.when(k == 0, "registry").when(k == 1, "page_rank").otherwise("unasked").alias("source"),
        F.when(F.col("event_type") == "view", 404).when(F.col("event_type") == "click", 200).otherwise(500).alias("http_status"), F.when(k == 0, registry).otherwise(rank).alias("body"), F.col("ts").alias("fetched_at"),
    )
    replies.write.partitionBy("source").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(root)
    sources = dict(named.SOURCES)
    named.declare("whois_age", "age_days int", sources=sources)  # declared, but nothing reads it here
    candidates = e.select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".com")).alias("name")).distinct()
    return named.enrich_by_name(candidates, readers.landed(spark, root), ["registry", "page_rank", "threats", "whois_age"], sources).drop("threat_types")
