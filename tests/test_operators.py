import datetime as dt
import gzip
import json

from pyspark.sql import functions as F

from zonewright.operators import graph, metrics, observations, ranking, signals, snapshot, state
from zonewright.plans import jobs
from zonewright.sources import readers, writers
from zonewright.streaming import ingest


def day():
    return F.lit("2026-01-20").cast("date")



def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_zone_names(spark, tmp_path):
    zone = "$ORIGIN com.\n; comment\nExample.com. 3600 IN NS ns1.registrar.com.\nEXAMPLE.COM. 3600 IN DS 1 8 2 AB\n\nfoo.example.com. 3600 IN A 1.2.3.4\nanother.com.\t3600 IN NS x.\n"
    path = str(tmp_path / "com.gz")
    with gzip.open(path, "wt") as f:
        f.write(zone)
    assert rows(readers.zone_names(spark, path, "com", 3), "name") == [("another.com",), ("example.com",), ("foo.example.com",)]


def test_snapshot_cold_start_commit_and_drops(spark, tmp_path):
    path = str(tmp_path / "names")
    assert readers.snapshot(spark, path).count() == 0
    old = spark.createDataFrame([("com", "a.com"), ("com", "b.com"), ("net", "c.net")], "tld string, name string")
    writers.commit_snapshot(old, path, "2026-01-01")
    writers.commit_snapshot(old, path, "2026-01-01")
    before = readers.snapshot(spark, path, day="2026-01-01")
    assert before.count() == 3
    today = spark.createDataFrame([("com", "a.com"), ("com", "new.com")], "tld string, name string")
    # net was not loaded today, so nothing of it dropped
    assert rows(snapshot.drops(before, today)) == [("com", "b.com")]
    assert snapshot.drops(before, before).count() == 0
    assert snapshot.drops(readers.snapshot(spark, str(tmp_path / "none")), today).count() == 0


def test_revalidation_leaves_unloaded_tlds_alone(spark):
    carried = spark.createDataFrame([("com", "a.com", None), ("com", "b.com", None), ("net", "c.net", None)], "tld string, name string, last_validated_date date")
    today = spark.createDataFrame([("com", "a.com")], "tld string, name string")
    assert rows(snapshot.revalidate(carried, today, day()), "name", F.col("last_validated_date").cast("string")) == [("b.com", "2026-01-20"), ("c.net", None)]


def test_link_graph(spark):
    vertices = spark.createDataFrame([(0, "com.example1", 1), (1, "com.example2", 1), (2, "org.example3", 1), (3, "com.dangling", 1), (4, "uk.co.example4", 1)], readers.VERTEX)
    edges = spark.createDataFrame([(0, 1), (0, 2), (2, 1), (3, 0), (1, 4), (0, 1)], readers.EDGE)
    release = graph.link_release(vertices, edges)
    assert rows(release) == [("dangling.com", 0), ("example1.com", 1), ("example2.com", 2), ("example3.org", 1), ("example4.co.uk", 1)]
    wanted = spark.createDataFrame([("dangling.com",), ("nowhere.com",)], "name string")
    assert rows(graph.with_link_count(wanted, release)) == [("dangling.com", 0), ("nowhere.com", None)]
    checks = graph.release_checks(release.withColumn("release", F.lit("r")), "r", least_rows=5, present={"example2.com": 3}, absent=["x.com"])
    assert [(r["check"], r["ok"]) for r in checks.orderBy("place").collect()] == [("release", True), ("rows", True), ("present:example2.com", False), ("absent:x.com", True)]


def test_graph_files(spark, tmp_path):
    for name, body in (("v", "0\tcom.a\t1\n"), ("e", "0\t0\n")):
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.write(body)
    v, e = readers.graph(spark, str(tmp_path / "v.gz"), str(tmp_path / "e.gz"))
    assert rows(graph.link_release(v, e)) == [("a.com", 1)]


def test_rolling_list_boundaries(spark):
    schema = "tld string, name string, first_seen_date date, wayback_unknown boolean, wayback_unknown_attempts int"
    d = lambda n: dt.date(2026, 1, 20) - dt.timedelta(n)
    previous = spark.createDataFrame([("com", "a.com", d(14), None, None), ("com", "b.com", d(15), None, None), ("com", "c.com", d(1), True, 2), ("com", "d.com", d(1), True, 3), ("com", "e.com", None, None, None), ("com", "f.com", d(1), None, None), ("com", "back.com", d(1), None, None)], schema)
    today = spark.createDataFrame([("com", "back.com")], "tld string, name string")
    new = spark.createDataFrame([("com", "f.com")], "tld string, name string")
    out = state.rolling_list(previous, today, new, day())
    assert rows(out, "name", "days_listed") == [("a.com", 14), ("c.com", 1), ("e.com", 0), ("f.com", 0)]


def test_held_queue_outcomes(spark):
    old = dt.date(2026, 1, 19)
    held = spark.createDataFrame([(n, old if n != "expired" else dt.date(2026, 1, 1), 1) for n in ("rereg", "released", "rejected", "expired", "kept")], "name string, first_held_date date, checks int")
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    survivors = spark.createDataFrame([("released", True, []), ("publish", True, []), ("new", False, ["missing:x"])], "name string, complete boolean, reasons array<string>")
    out = state.settle_held(held, names("publish", "gone", "new"), names("released", "rejected", "publish", "gone", "new"), survivors, names("rereg"), day(), 7)
    assert dict(rows(out, "name", "action")) == {"rereg": "reregistered", "released": "released", "rejected": "rejected", "expired": "expired", "kept": "held", "publish": "publish", "gone": "gone", "new": "new_held"}
    assert rows(out.filter("name = 'kept'"), "checks", "reasons") == [(2, ["not_enriched"])]
    assert rows(out.filter("name = 'new'"), "checks", "reasons") == [(0, ["missing:x"])]


def test_events_are_appended_once(spark, tmp_path):
    schema = "domain string, drop_date date, source string"
    path = str(tmp_path / "archive")
    events = spark.createDataFrame([("a.com", dt.date(2026, 1, 1), "live"), ("a.com", dt.date(2026, 1, 1), "live"), ("a.com", dt.date(2026, 1, 1), "backfill"), ("b.com", None, "live")], schema)
    assert writers.append_events(events, readers.archive(spark, path, schema), path) == 3
    assert writers.append_events(events, readers.archive(spark, path, schema), path) == 0
    assert rows(readers.archive(spark, path, schema).groupBy("month").count()) == [("2026-01", 2), ("unknown", 1)]


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    schema = "domain string, drop_date date, source string"
    (tmp_path / "land").mkdir()
    (tmp_path / "land/a.json").write_text('{"domain":"a.com","drop_date":"2026-01-01","source":"live"}\n')
    run = lambda k: ingest.ingest_events(spark, str(tmp_path / "land"), str(tmp_path / "archive"), str(tmp_path / f"check{k}"), schema).awaitTermination()
    run(0)
    (tmp_path / "land/b.json").write_text('{"domain":"b.com","drop_date":"2026-02-01","source":"live"}\n')
    run(0)
    run(1)  # from the beginning again
    assert rows(readers.archive(spark, str(tmp_path / "archive"), schema), "domain", "month") == [("a.com", "2026-01"), ("b.com", "2026-02")]


def test_denylist_and_eviction(spark):
    deny = spark.createDataFrame([("Old.com", dt.date(2025, 1, 1))], "name string, classified_date date")
    found = spark.createDataFrame([("New.com",), ("new.com",), ("OLD.com",)], "name string")
    assert rows(state.denylist_additions(deny, found, day(), "v"), "name") == [("new.com",)]


def test_cache_merge(spark):
    e = "struct<snapshot_timestamp string, title string, meta_description string, h1 array<string>, h2 array<string>>"
    good, bad = ("20260101000000", "T", None, None, None), ("20260101000000", " ", None, [], None)
    cache = spark.createDataFrame([("keep", good), ("worse", good), ("fail", None)], f"name string, excerpt {e}")
    new = spark.createDataFrame([("worse", bad), ("fail", good), ("none", None)], f"name string, excerpt {e}")
    out = {r["name"]: r["excerpt"] for r in state.merge_cache(cache, new).collect()}
    assert out["worse"]["title"] == "T" and out["fail"]["title"] == "T" and out["none"] is None and out["keep"]["title"] == "T"


def test_registry_replies(spark):
    body = json.dumps({"events": [{"eventAction": "registrar expiration", "eventDate": "2027-05-01T00:00:00Z"}, {"eventAction": "expiration", "eventDate": "2026-05-01T00:00:00Z"}], "entities": [{"roles": ["registrar"], "vcardArray": ["vcard", [["version", {}, "text", "4.0"], ["fn", {}, "text", "Some Registrar"]]]}]})
    df = spark.createDataFrame([("a", 404, None), ("b", 200, body), ("c", 429, "x")], "domain string, http_status int, body string")
    assert rows(signals.registry_reply(df), "domain", "is_available", "expiration_date", "registrar") == [("a", True, None, None), ("b", False, "2026-05-01", "Some Registrar"), ("c", None, None, None)]


def test_other_replies(spark):
    df = spark.createDataFrame([(["127.0.0.2"], False), (["127.255.255.254"], False), ([], True), (None, None)], "a array<string>, none boolean")
    assert [r[0] for r in df.select(signals.blocklist_listed(F.col("a"), F.col("none"))).collect()] == [True, None, False, None]
    df = spark.createDataFrame([('{"found": false}',), ('{"found": true, "page_rank_decimal": "4.5"}',), ('{"found": true, "page_rank_decimal": "x"}',), ("broken",), (None,)], "b string")
    assert [r[0] for r in df.select(signals.page_rank(F.col("b"))).collect()] == [0.0, 4.5, 0.0, None, None]
    flagged, types = signals.threat_reply(F.col("b"))
    df = spark.createDataFrame([('{"matches":[{"threatType":"B"},{"threatType":"A"},{"threatType":"B"}]}',), ("{}",)], "b string")
    assert [tuple(r) for r in df.select(flagged, types).collect()] == [(True, ["A", "B"]), (False, [])]


def test_model_replies(spark):
    df = spark.createDataFrame([('```json\n[{"name":"a","score":"7"}]\n```',), ('text [{"name":"a","score":"7"},{"name":"b","sco',), ("nothing",), (None,)], "r string")
    out = [r[0] for r in df.select(signals.model_array(F.col("r"), "array<struct<name: string, score: string>>")).collect()]
    assert [x and [tuple(i) for i in x] for x in out] == [[("a", "7")], [("a", "7")], None, None]
    replies = spark.createDataFrame([('[{"name":" A ","score":"150","reason":" r "},{"score":"3"},{"name":"b","score":"x"}]',)], "body string")
    assert rows(signals.ranker_reply(replies)) == [("a", 100, "r"), ("b", 0, None)]


def test_page_excerpts(spark):
    html = '<title>A &amp; B</title><meta name="Description" content=" some  text "><h1> </h1><h1>x</h1><h1>y</h1><h1>z</h1><h2>s</h2>'
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    assert rows(signals.page_excerpts(df, "page_id", "html")) == [(1, "A & B", "some text", ["x", "y"], ["s"])]


def test_final_category(spark):
    df = spark.createDataFrame([("legitimate", [], "p"), ("legitimate", ["t"], None), ("toxic", ["t"], None), ("legitimate", [], None), ("legitimate", ["t"], "p")], "m string, s array<string>, p string")
    final = lambda *a: [r[0] for r in df.select(signals.final_category(F.col("m"), F.col("s"), F.col("p"), *a)).collect()]
    assert final() == ["parked", "toxic", "toxic", "legitimate", "toxic"]
    assert final(" Empty ") == ["parked", "empty", "toxic", "legitimate", "empty"]
    assert final("none") == ["parked", "legitimate", "toxic", "legitimate", "parked"], "an action that is no category changes nothing"
    asked = spark.createDataFrame([("a",), ("b",)], "name string")
    answers = spark.createDataFrame([("a", "clean"), ("other", "clean")], "name string, category string")
    assert rows(signals.requested_only(asked, answers)) == [("a", "clean"), ("b", "unknown")]


def test_paging_is_the_same_for_any_partitioning(spark):
    df = spark.range(997).select(F.col("id").cast("string").alias("name"), (F.col("id") % 10).alias("score"))
    order = (F.desc("score"), F.col("name"))
    assert rows(ranking.pages(df.repartition(7), 50, *order)) == rows(ranking.pages(df.coalesce(1), 50, *order))
    first = ranking.page_after(df, 10).collect()
    second = ranking.page_after(df, 10, after=(first[-1]["score"], first[-1]["name"])).collect()
    assert [r["name"] for r in first + second] == [r["name"] for r in df.orderBy(*order).limit(20).collect()]
    token = df.limit(1).select(ranking.cursor(F.lit(1.5), F.lit("a"), "q").alias("t"))
    assert token.select(ranking.read_cursor(F.col("t"), "q")["n"], ranking.read_cursor(F.col("t"), "other")).first() == ("a", None)


def test_quota_by_hash_is_reproducible(spark):
    df = spark.range(100).select(F.lit("h").alias("host"), F.col("id").cast("string").alias("name"))
    quotas = spark.createDataFrame([("h", 5)], "host string, quota int")
    a, b, c = (rows(ranking.within_quota(d, quotas, day)) for d, day in ((df, "20260101"), (df.repartition(9), "20260101"), (df, "20260102")))
    assert a == b and len(a) == 5 and a != c
    assert ranking.within_quota(df, spark.createDataFrame([("other", 5)], "host string, quota int")).count() == 100


def test_hosts_of_tlds(spark):
    services = spark.createDataFrame([(["com", "net"], ["https://Rdap.example/com/", "https://b.example/"]), (["org"], ["https://org.example"])], "tlds array<string>, urls array<string>")
    names = spark.createDataFrame([("com",), ("org",), ("zz",)], "tld string")
    assert rows(ranking.hosts_of_tlds(names, services), "tld", "host") == [("com", "rdap.example"), ("org", "org.example"), ("zz", "_unknown")]


def test_logs(spark, tmp_path):
    log = "Enrichment coverage (1 candidates): a=0/1\nnoise\nEnrichment coverage (25 candidates): wayback_snapshots=25/25 open_page_rank=0/25\nHeld queue: held=12 new=5 released=3\nx WARNING y\n"
    (tmp_path / "run.log").write_text(log)
    lines = readers.log_lines(spark, str(tmp_path / "run.log"))
    assert [r["line_no"] for r in lines.orderBy("line_no").collect()] == list(range(5))
    report = jobs.run_report(lines, F.lit("2026-01-01").cast("date"), F.lit("2026-03-01").cast("date"))
    assert rows(report["coverage"], "field", "state", "alarm") == [("open_page_rank", "dead", True), ("wayback_snapshots", "ok", False)]
    assert rows(report["held"]) == [("held", 12), ("new", 5), ("released", 3)]
    assert rows(report["freshness"]) == [(59, True)]
    assert dict(rows(report["signals"]))["warnings"] == 1
    assert rows(report["categories"]) == [] and rows(report["strikes"]) == [] and rows(report["rejects"]) == [] and report["blind"].first()[0] is False


def test_json_readers(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"a": 1}\nbroken\n\n[1]\n{"a": 2}\n')
    good, corrupt = readers.json_lines(spark, str(tmp_path / "e.jsonl"), "a int")
    assert rows(good) == [(1,), (2,)] and corrupt.first()[0] == 2
    (tmp_path / "2026-01-02.json").write_text(json.dumps({"domains": [{"name": "a.com", "score": 3}, {"score": 4}]}))
    assert rows(readers.payload_rows(spark, str(tmp_path / "2026-01-02.json"), "name string, score int")) == [("a.com", 3)]
    assert readers.payload_rows(spark, str(tmp_path / "missing.json"), "name string, score int").count() == 0
    assert rows(readers.dated_payloads(spark, str(tmp_path / "2026-*.json"), "name string, score int"), F.col("snapshot_date").cast("string"), "name") == [("2026-01-02", "a.com")]


def test_payload(spark):
    df = spark.createDataFrame([("b.com", 1, 0), ("a.com", 9, 2)], "name string, score int, days_listed int")
    out = json.loads(writers.payload(df, metrics.header(df)).first()[0])
    assert [d["name"] for d in out["domains"]] == ["a.com", "b.com"] and out["today_count"] == 1


def test_enrichment_with_a_missing_source(spark):
    df = spark.createDataFrame([("a",), ("b",)], "name string")
    out = signals.enrich(df, {"one": (lambda n: n.filter("name = 'a'").withColumn("x", F.lit(1)), ["x"]), "gone": (None, ["y"])})
    assert rows(out, "name", "x", "y") == [("a", 1, None), ("b", None, None)]


def test_daily_run(spark):
    yesterday = spark.createDataFrame([("com", n + ".com") for n in ("garden", "market", "casino", "zzxqwk")] + [("com", "stays.com")], "tld string, name string")
    today = spark.createDataFrame([("com", "stays.com")], "tld string, name string")
    previous = spark.createDataFrame([], "tld string, name string, first_seen_date date, wayback_unknown boolean, wayback_unknown_attempts int, score int")
    deny = spark.createDataFrame([("market.com",)], "name string")
    available = spark.createDataFrame([("garden.com", True), ("market.com", True)], "name string, is_available boolean")
    evidence = spark.createDataFrame([(n, 500, dt.date(2025, 1, 1), 6.0, True, 900, False, False, False, "clean") for n in ("garden.com", "market.com")], "name string, wayback_snapshots int, wayback_last_snapshot date, open_page_rank double, cert_history boolean, cc_source_domain_count int, spam_flagged boolean, surbl_listed boolean, spamhaus_listed boolean, snapshot_category string")
    out = jobs.daily_run(yesterday, today, previous, deny, available, evidence, day())
    assert rows(out["published"], "name", "verdict") == [("garden.com", "Clean")]
    assert dict(rows(out["rejects"])) == {"keyword": 1, "toxic_remembered": 1, "vowel_ratio": 1}
    assert rows(out["header"]) == [(1, 1, 0)]


def test_daily_run_keeps_all_names_without_a_ranker(spark):
    names_ = ["garden.com", "market.com", "silver.com"]
    zone = lambda ns: spark.createDataFrame([("com", n) for n in ns], "tld string, name string")
    previous = spark.createDataFrame([], "tld string, name string, first_seen_date date, wayback_unknown boolean, wayback_unknown_attempts int, score int")
    deny, available = spark.createDataFrame([], "name string"), spark.createDataFrame([(n, True) for n in names_], "name string, is_available boolean")
    evidence = spark.createDataFrame([(n, 500, dt.date(2025, 1, 1), 6.0, True, 900, False, False, False, "clean") for n in names_], "name string, wayback_snapshots int, wayback_last_snapshot date, open_page_rank double, cert_history boolean, cc_source_domain_count int, spam_flagged boolean, surbl_listed boolean, spamhaus_listed boolean, snapshot_category string")
    out = jobs.daily_run(zone([*names_, "stays.com"]), zone(["stays.com"]), previous, deny, available, evidence, day(), jobs.Daily(narrow_to=1))
    assert sorted(r["name"] for r in out["scored"].select("name").collect()) == names_


def day_tables(spark, names_):
    zone = spark.createDataFrame([("com", n) for n in names_], "tld string, name string")
    today = spark.createDataFrame([("com", "stays.com")], "tld string, name string")
    previous = spark.createDataFrame([], "tld string, name string, first_seen_date date, wayback_unknown boolean, wayback_unknown_attempts int, score int")
    available = spark.createDataFrame([(n, True) for n in names_], "name string, is_available boolean")
    evidence = spark.createDataFrame([(n, 500, dt.date(2025, 1, 1), 6.0, True, 900, False, False, False) for n in names_], "name string, wayback_snapshots int, wayback_last_snapshot date, open_page_rank double, cert_history boolean, cc_source_domain_count int, spam_flagged boolean, surbl_listed boolean, spamhaus_listed boolean")
    return zone.unionByName(today), today, previous, spark.createDataFrame([], "name string"), available, evidence


def test_a_ranker_that_answers_too_little_is_not_used(spark):
    names_ = ["garden.com", "market.com", "silver.com", "station.com"]
    score = lambda **k: spark.createDataFrame([(n + ".com", s, "r") for n, s in k.items()], "name string, phase2_score int, phase2_reason string")
    c = jobs.Daily(gate=50, least_eligible=2)
    zone, today, *rest = day_tables(spark, names_)
    run = lambda ranker: jobs.daily_run(zone, today, *rest, day(), c, ranker=ranker)
    out = run(score(garden=90, market=10, silver=55, station=50))
    assert out["ranker"].first()["mode"] == "ranker" and rows(out["selected"], "name") == [("garden.com",), ("silver.com",), ("station.com",)]
    out = run(score(garden=90, silver=55))
    assert out["ranker"].first()["mode"] == "partial" and rows(out["selected"], "name") == [("garden.com",), ("silver.com",)]
    for few in (score(garden=90, market=10, silver=20, station=0), score().limit(0) if False else score(other=99)):
        out = run(few)
        assert out["ranker"].first()["mode"] == "fallback" and len(rows(out["selected"], "name")) == 4 and out["overflow"].count() == 0


def test_held_names_go_first_and_are_settled(spark):
    zone, today, previous, deny, available, evidence = day_tables(spark, ["garden.com", "market.com", "silver.com", "station.com", "kept.com", "gone.com"])
    zone = zone.filter("name not in ('kept.com', 'gone.com')")
    held = spark.createDataFrame([("com", "Kept.com", dt.date(2026, 1, 19), 1), ("com", "gone.com", dt.date(2026, 1, 1), 4)], "tld string, name string, first_held_date date, checks int")
    categories = spark.createDataFrame([(n, "clean") for n in ("garden.com", "kept.com")] + [("silver.com", "toxic"), ("station.com", "unknown")], "name string, category string")
    available = available.filter("name <> 'gone.com'")
    out = jobs.daily_run(zone, today, previous, deny, available, evidence, day(), held=held, categories=categories)
    assert rows(out["published"], "name") == [("garden.com",), ("kept.com",)]
    assert rows(out["held"], "name", "reasons") == [("market.com", ["content_unscreened"]), ("station.com", ["content_unscreened"])]
    assert dict(rows(out["held_outcomes"])) == {"released": 1, "publish": 1, "expired": 1, "gone": 1, "new_held": 2}
    assert rows(out["denylist"], "name") == [("silver.com",)] and rows(out["availability"]) == [(5, 0, 1)]


def test_a_day_is_committed_output_first_and_names_last(spark, tmp_path):
    zone, today, *rest = day_tables(spark, ["garden.com", "market.com"])
    root = str(tmp_path / "state")
    out = jobs.daily_run(zone, today, *rest, day())
    import pytest

    with pytest.raises(Exception):
        jobs.commit_daily(out | {"denylist": out["denylist"].withColumn("x", F.raise_error(F.lit("lost"))).unionByName(spark.range(1).select(F.lit("n").alias("name"), day().alias("classified_date"), F.lit("v").alias("classifier_version"), F.raise_error(F.lit("lost")).cast("string").alias("x")), allowMissingColumns=True)}, today, root, "2026-01-20")
    assert not (tmp_path / "state/names").exists() and (tmp_path / "state/payload").exists()
    for _ in range(2):
        jobs.commit_daily(out, today, root, "2026-01-20")
    assert rows(readers.snapshot(spark, f"{root}/names", day="2026-01-20"), "name") == [("stays.com",)]
    assert rows(readers.payload_rows(spark, f"{root}/payload", "name string"), "name") == [("garden.com",), ("market.com",)]
    assert spark.read.json(f"{root}/drops").count() == 2


def test_held_rows_without_dates_or_answers(spark):
    held = spark.createDataFrame([("nodate", None, None), ("asked", dt.date(2026, 1, 19), 2)], "name string, first_held_date date, checks int")
    none = spark.createDataFrame([], "name string")
    survivors = spark.createDataFrame([], "name string, complete boolean, reasons array<string>")
    confirmed = spark.createDataFrame([("nodate",)], "name string")
    out = state.settle_held(held, none, none, survivors, none, day(), 3, confirmed=confirmed)
    assert rows(out, "name", "action", F.col("first_held_date").cast("string"), "checks", "reasons") == [("asked", "held", "2026-01-19", 3, ["rdap_unknown"]), ("nodate", "held", "2026-01-20", 1, ["not_enriched"])]
    new = spark.createDataFrame([("new",)], "name string")
    assert rows(state.settle_held(held.limit(0), new, none, survivors, none, day(), 0), "action") == [("expired",)]


def test_a_release_is_promoted_only_when_it_holds(spark, tmp_path):
    vertices = spark.createDataFrame([(0, "com.a", 1), (1, "com.b", 1)], readers.VERTEX)
    edges = spark.createDataFrame([(0, 1)], readers.EDGE)
    pointer = spark.createDataFrame([("2026-may-jun-jul", None)], "current string, previous string")
    go = lambda least, path: jobs.promote_release(vertices, edges, pointer, "2026-jun-jul-aug", str(tmp_path / path), day(), least_rows=least, present={"b.com": 1}, absent=["c.com"], keep=1)
    assert rows(go(2, "one")["pointer"]) == [("2026-jun-jul-aug", "2026-may-jun-jul")]
    assert rows(go(3, "two")["pointer"]) == [("2026-may-jun-jul", None)]


def test_candidates_and_changes(spark):
    d = lambda n: dt.date(2026, 1, n)
    docs = spark.createDataFrame([("a.com", "available", 5, 2, d(1), d(9), 2001), ("b.com", "dropped", None, 0, d(5), d(5), None)], "domain string, status string, links int, captures int, first_seen date, last_seen date, first_year int")
    assert [r["domain"] for r in observations.candidates(docs).collect()] == ["b.com", "a.com"]
    assert [r["domain"] for r in observations.candidates(docs, least_links=0).collect()] == ["a.com"]
    assert [r["domain"] for r in observations.candidates(docs, first_after="2026-01-01").collect()] == ["b.com"]
    assert rows(observations.changes(docs, F.lit("2026-01-04").cast("date")), "domain", "change") == [("a.com", "updated"), ("b.com", "added")]


def test_similar_rows_are_neither_sorted_by_group_nor_by_name(spark):
    data = [(f"{g}{i}", g, (i * 7) % 5) for g, n in (("a", 9), ("b", 2), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(data, "name string, tld string, score int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = ranking.similar_rows(df, n=3)
        plan = found._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "Window" not in plan
    best = lambda name, g: sorted((r for r in data if r[1] == g and r[0] != name), key=lambda r: (-r[2], r[0]))[:3]
    assert rows(found) == sorted((name, r[0], i + 1) for name, g, _ in data for i, r in enumerate(best(name, g)))


def test_inbound_counts_by_release_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(graph, "PAIRS_AT_ONCE", 10)
    data = [(2000 + i % 2, i % 7, i % 3) for i in range(100)]
    edges = spark.createDataFrame(data, "year int, from_id long, to_id long")
    found = graph.inbound_counts(edges, "year", rows=100)
    assert "hashpartitioning(year#" in (plan := found._jdf.queryExecution().toString()) and ", 10), REPARTITION_BY_NUM" in plan
    assert rows(found) == sorted((y, t, len({f for a, f, b in data if (a, b) == (y, t)})) for y, t in {(y, t) for y, _, t in data})
    assert rows(graph.inbound_counts(edges)) == sorted((t, len({f for _, f, b in data if b == t})) for t in {t for _, _, t in data})
