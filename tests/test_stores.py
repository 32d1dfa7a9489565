"""What is stored to be read in part, long lists of terms, and salvage of broken replies."""

import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from zonewright import catalog_stores
from zonewright.functions import rules, terms
from zonewright.operators import graph, metrics, observations, ranking, signals, snapshot
from zonewright.plans import jobs
from zonewright.sources import digests, readers, releases, roll_up


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


# --- terms ------------------------------------------------------------------------------------------------------------


def many(n):
    rng = random.Random(5)
    return tuple(dict.fromkeys("".join(rng.choice("abcdé赌 .") for _ in range(rng.randint(2, 6))).strip() or "ab" for _ in range(n)))


def plain(text, listed, place):
    spots = lambda t: [m.start() for m in re.finditer(f"(?={re.escape(t)})", text)]
    return [t for t in listed if any(place(text, i, i + len(t)) for i in spots(t))]


@pytest.mark.parametrize("place", [terms.ANYWHERE, terms.APART, terms.BEGINS])
def test_finder_equals_one_search_a_term(place):
    rng, listed = random.Random(7), many(5000)
    find = terms.finder([(listed, place)])
    for _ in range(20):
        text = "".join(rng.choice("abcdé赌 .-1") for _ in range(rng.randint(0, 60)))
        assert find(text) == plain(text, listed, place)
    assert find("") == []


def test_finder_is_linear_in_the_text_and_not_in_the_terms():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(400_000))

    def seconds(find, t):
        best = 1e9
        for _ in range(3):
            began = time.perf_counter()
            find(t)
            best = min(best, time.perf_counter() - began)
        return best

    few, lots = (terms.finder([(tuple(f"zz{i}q" for i in range(n)), terms.ANYWHERE)]) for n in (50, 5000))
    assert seconds(lots, text) < 5 * seconds(few, text) + 0.01
    assert seconds(lots, text) < 6 * seconds(lots, text[: len(text) // 2]) + 0.01


def test_rules_give_the_same_with_either_search(spark):
    listed = ("cialis", "casino bonus", "xx", "sex.", "best")
    fill = tuple(f"never{i}" for i in range(40))
    short = rules.Rules(keywords=(), prefixes=listed, substrings=listed, soft=listed, spam_terms=listed, spam_cjk=("赌场",), parked=listed)
    long = rules.Rules(keywords=(), prefixes=fill + listed, substrings=fill + listed, soft=fill + listed, spam_terms=fill + listed, spam_cjk=("赌场",), parked=fill + listed)
    texts = ["bestbuy.com", "best.com", "my-bestbuy.com", "especialistas", "Cialis!", "金沙casino bonus娱乐赌场", "xxx", "SEX.", "", None, "abest", "cialis xx best"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for f in (rules.matched_keyword, rules.matched_substring, rules.soft_signal, rules.parked_marker, lambda c, r: rules.spam_matches(F.array(c), r), rules.structural_reason):
        got = df.select(f(F.col("t"), short).alias("a"), f(F.col("t"), long).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got]


# --- salvage ----------------------------------------------------------------------------------------------------------


def test_salvage_knows_depth_and_strings(spark):
    cases = {
        '[{"n": "a", "m": {"n": "inner"}}, {"n": "b"}, {"n": "lost", "m": {"n": "in"}': ["a", "b"],
        '[{"n": "brace } in { text"}, {"n": "quote \\" }"} {"n": "c"}]': ["brace } in { text", 'quote " }', "c"],
        '[{"n": "a"}, {"n": bad}, {"n": "c"}': ["a", "c"],
        "no objects": None,
        '{"wrapped": {"n": "inner"}, "broken"': None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, r string")
    got = {r["i"]: r["o"] for r in df.select("i", signals.model_array(F.col("r"), "array<struct<n: string>>").alias("o")).collect()}
    assert [None if got[i] is None else [x["n"] for x in got[i]] for i in range(len(cases))] == list(cases.values())


def test_salvage_takes_one_pass():
    began = time.perf_counter()
    assert signals.outer_objects("[" + "{" * 1_000_000) == []
    assert len(signals.outer_objects("{}" * 500_000)) == 500_000
    assert time.perf_counter() - began < 10
    assert [json.loads(s) for s in signals.outer_objects('x {"a": "}{"} \\" {"b": 1}')] == [{"a": "}{"}]


# --- digests of snapshots ---------------------------------------------------------------------------------------------


def test_drops_by_digest_equal_the_anti_join_and_read_less(spark, tmp_path):
    root = str(tmp_path)
    names = lambda *parts: spark.createDataFrame([(t, f"n{i}.{t}") for t, ids in parts for i in ids], "tld string, name string")
    old = names(("com", range(3000)), ("net", range(500)), ("gone", range(50)), ("org", range(5)))
    new = names(("com", [i for i in range(3010) if i not in (17, 18)]), ("net", range(500)), ("org", range(3, 9)))
    digests.commit(old.unionByName(old.limit(40)), root, "a", 64)
    digests.commit(new, root, "b", 64)
    assert rows(digests.drops(spark, root, "a", "b")) == rows(snapshot.drops(old, new)) != []
    changed = digests.differing(spark, root, "a", "b")
    assert {t for t, _ in changed} == {"com", "org"} and len(changed) < 25
    every = len(spark.read.parquet(f"{root}/names/a").inputFiles())
    assert len(digests.drops(spark, root, "a", "b").inputFiles()) < every / 2
    assert rows(digests.drops(spark, root, "b", "b")) == []
    digests.commit(old, root, "c", 32)
    with pytest.raises(ValueError, match="buckets"):
        digests.drops(spark, root, "a", "c")


# --- indexed releases -------------------------------------------------------------------------------------------------


def test_look_up_reads_few_files_and_does_not_shuffle_the_release(spark, tmp_path, capsys):
    path = str(tmp_path / "release")
    counts = spark.range(5000).select(F.concat(F.lit("name"), F.lpad(F.col("id").cast("string"), 5, "0"), F.lit(".com")).alias("apex_domain"), F.col("id").alias("source_domain_count"))
    releases.write_indexed(counts, path, 20)
    candidates = spark.createDataFrame([("name00007.com",), ("name04999.com",), ("aaa.com",), ("zzz.com",), ("name00007.com",), ("name00007x.com",), (None,)], "name string")
    assert rows(releases.look_up(spark, candidates, path)) == rows(graph.with_link_count(candidates, counts))
    assert 2 <= len(releases.files_for(spark, candidates, path)) <= 3 < len(spark.read.parquet(f"{path}/rows").inputFiles())
    hits = spark.read.parquet(*releases.files_for(spark, candidates, path)).join(F.broadcast(candidates), F.col("apex_domain") == F.col("name"))
    assert "hashpartitioning" not in hits._jdf.queryExecution().executedPlan().toString()
    assert rows(releases.look_up(spark, candidates.limit(0), path)) == []
    assert rows(releases.look_up(spark, candidates.filter("name = 'zzz.com'"), path)) == [("zzz.com", None)]


# --- the kept roll-up -------------------------------------------------------------------------------------------------


def test_roll_up_day_by_day_equals_the_whole_build(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(2)
    events = [(f"d{rng.randint(0, 40)}.com", f"2026-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d}" if rng.random() < 0.95 else None, rng.choice([True, False, None]), day) for day in range(8) for _ in range(60)]
    df = spark.createDataFrame(events, "domain string, at string, was_published boolean, day int").withColumn("drop_date", F.to_date("at"))
    for day in range(8):
        assert roll_up.add(spark, root, df.filter(F.col("day") == day), f"day{day}")
    assert not roll_up.add(spark, root, df.filter(F.col("day") == 3), "day3")
    # a batch that failed before its ledger entry leaves files that nobody reads
    observations.roll_up_parts(df).write.partitionBy("month").parquet(f"{root}/parts/batch=day9")
    columns = ["domain", "first_seen", "last_seen", "drop_days", "ever_published", "events"]
    assert rows(roll_up.roll_up(spark, root), *columns) == rows(observations.roll_up(df), *columns)
    read = roll_up.parts(spark, root, ["2026-02"]).inputFiles()
    assert read and all("month=2026-02" in f for f in read)


# --- pages, quotas, lines ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("order", ["first_seen", "links", "first_year"])
def test_walking_all_pages_gives_the_sorted_table(spark, order):
    rng = random.Random(4)
    data = [(f"d{i}.com", rng.choice([None, 1.0, 2.5, 7.0]), rng.choice([None, 2001, 2002]), f"2026-01-0{rng.randint(1, 5)}") for i in range(70)]
    df = spark.createDataFrame(data, "domain string, links double, first_year int, at string").select("domain", "links", "first_year", F.to_date("at").alias("first_seen"))
    keys = observations.ORDERS[order]
    wanted = [r["domain"] for r in df.orderBy(*ranking.sort_order(keys)).collect()]
    got, token = [], None
    while True:
        shown, token = ranking.page_of(df, keys, 16, token, order)
        got += [r["domain"] for r in shown.collect()]
        if token is None:
            break
    assert got == wanted
    _, token = ranking.page_of(df, keys, 16, None, order)
    for bad, scope in ((token, "other"), ("?", order), (token[:-4], order)):
        with pytest.raises(ValueError, match="token"):
            ranking.page_of(df, keys, 16, bad, scope)


@pytest.mark.parametrize("order", ["first_seen", "links", "first_year"])
def test_pages_placed_at_once_are_those_of_a_walk(spark, order):
    rng = random.Random(8)
    data = [(f"d{i}.com", rng.choice([None, 1.0, 2.5]), rng.choice([None, 2001, 2002]), f"2026-01-0{rng.randint(1, 5)}") for i in range(50)]
    df = spark.createDataFrame(data, "domain string, links double, first_year int, at string").select("domain", "links", "first_year", F.to_date("at").alias("first_seen"))
    keys, wanted, token, page = observations.ORDERS[order], [], None, 0
    while page == 0 or token:
        shown, token = ranking.page_of(df, keys, 16, token, order)
        wanted += [(r["domain"], page, i) for i, r in enumerate(shown.orderBy(*ranking.sort_order(keys)).collect())]
        page += 1
    placed = ranking.placed_on_pages(df, keys, 16)
    assert rows(placed, "domain", "page", "place") == sorted(wanted, key=repr) and placed.columns == [*df.columns, "page", "place"]


def test_quota_by_threshold_equals_ranks(spark):
    rng = random.Random(6)
    data = [(rng.choice(["a", "a", "a", "b", "c"]), f"n{i}", rng.choice([None, 5, 60, 60, 60, 61])) for i in range(400)]
    df = spark.createDataFrame(data, "host string, name string, phase2_score int")
    quotas = spark.createDataFrame([("a", 77), ("b", 1000), ("x", 3)], "host string, quota int")
    wanted = []
    for host, quota in (("a", 77), ("b", 1000), ("c", 10**9)):
        wanted += sorted((r for r in data if r[0] == host), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))[:quota]
    assert rows(ranking.within_quota(df, quotas), "host", "name", "phase2_score") == sorted(wanted, key=repr)
    plain = df.drop("phase2_score")
    first = rows(ranking.within_quota(plain, quotas, "d1"))
    assert first == rows(ranking.within_quota(plain.repartition(7), quotas, "d1")) != rows(ranking.within_quota(plain, quotas, "d2"))
    assert sum(r[0] == "a" for r in first) == 77


def test_log_lines_of_many_splits(spark, tmp_path):
    path = tmp_path / "run.log"
    path.write_text("".join(f"{i} {'x' * (i % 50)}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = readers.log_lines(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["line_no"], int(r["value"].split()[0])) for r in lines) == [(i, i) for i in range(3000)]


def test_log_of_many_files_is_counted_as_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog_stores, "_LOG_FILE_LINES", 100)
    spark.range(1000).select((F.col("id") + 7).alias("event_id")).write.parquet(str(tmp_path / "whole" / "events.parquet"))
    spark.range(1000).filter("id <> 500").select((F.col("id") + 7).alias("event_id")).write.parquet(str(tmp_path / "gap" / "events.parquet"))
    read = lambda name: [tuple(r) for r in catalog_stores.sources_log_lines(spark, str(tmp_path / name)).collect()]
    assert read("whole") == [("all", 1006, True)] and read("gap") == [("all", 1006, False)]


def test_live_records_keep_what_rows_have(spark):
    df = spark.createDataFrame([("a.com", "com", 7, "Caution", False, 3, None), ("b.com", "com", 80, "Clean", True, None, "2026-01-18T05:00:00Z")], "name string, tld string, score int, verdict string, was_published boolean, wayback_snapshots int, availability_verified_at string")
    day = F.lit("2026-01-20").cast("date")
    got = jobs.live_records(df.withColumn("dropped_date", day), day)
    assert rows(got.select("domain", F.col("availability_confirmed_date").cast("string"), "score", "was_published", "wayback_snapshots", "open_page_rank", "source")) == [("a.com", "2026-01-20", 7, False, 3, None, "live"), ("b.com", "2026-01-18", 80, True, None, None, "live")]
    assert {f.split()[0] for f in jobs.ARCHIVE.split(", ")} == set(got.columns)


def test_counts_are_taken_while_tables_are_written(spark):
    counted = metrics.Counted()
    counted.of(spark.range(10), all=F.lit(True), even=F.col("id") % 2 == 0).collect()
    counted.of(spark.range(7), last=F.col("id") > 0).collect()
    assert [tuple(r) for r in counted.table(spark).collect()] == [(0, "all", 10, True), (1, "even", 5, True), (2, "last", 6, False)]
