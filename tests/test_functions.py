import pytest
from pyspark.sql import functions as F

from zonewright.functions import names, rules, scoring, text


def values(spark, rows, column, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).select(column).collect()]


def test_name_parts(spark):
    x = F.col("x")
    assert values(spark, ["a.b.com", "com", ""], names.tld(x)) == ["com", "", ""]
    assert values(spark, ["uk.co.example4"], names.unreverse(x)) == ["example4.co.uk"]
    assert values(spark, ["my-4shop.com"], names.fine_tokens(x)) == [["my", "4", "shop", "com"]]
    assert values(spark, ["aabb", ""], F.round(names.entropy(x), 6)) == [1.0, 0.0]
    assert values(spark, ["aaaa", "aaa"], names.has_repeat_run(x, 4)) == [True, False]
    assert values(spark, ["bcdfgh", "bcd1fgh", "bcyfghj"], names.has_consonant_run(x, 6)) == [True, False, False]
    assert values(spark, ["ab", "ab1c", "cafe"], names.trigram_total(x)) == [0, 0, 2]


def test_normalize_domain(spark):
    got = values(spark, [" Example.COM. ", "b%C3%BCcher.de", "no dots", "-bad.com", "a" * 64 + ".com", None], names.normalize_domain(F.col("x")))
    assert got == ["example.com", "xn--bcher-kva.de", None, None, None, None]
    assert values(spark, ["bücher.de", "ok.de"], names.normalize_domain(F.col("x"), idna=False)) == [None, "ok.de"]


def test_release_names(spark):
    table = {r["release"]: (r["year"], r["end_month"], r["label"]) for r in names.release_table(spark, 2025, 2026).collect()}
    assert table["2026-jun-jul-aug"] == (2026, 8, "Jun–Aug 2026")
    assert table["2025-2026-nov-dec-jan"] == (2026, 1, "Nov 2025–Jan 2026")
    assert len(table) == 24 and "2026-nov-dec-jan" not in table


def test_structural_rules_take_the_first_that_holds(spark):
    got = values(spark, ["", "xn--abc.com", "ab.com", "a" * 31 + ".com", "12345.com", "best-casino.com", "casino24.com", "gambling.com", "gambl.com", "myxxxsite.com", "garden.com"], rules.structural_reason(F.col("x")))
    assert got == ["empty", "idn", "too_short", "too_long", "all_digits", "keyword(casino)", "keyword(casino)", "keyword(gambl)", None, "substring(xxx)", None]


def test_unknown_evidence_passes(spark):
    schema = "spam boolean, a boolean, b boolean, cat string, toxic boolean, n int"
    reason = lambda strict: rules.evidence_reason(F.col("spam"), F.col("a"), F.col("b"), F.col("cat"), F.col("toxic"), F.col("n"), strict=strict)
    rows = [(None, None, None, None, None, None), (True, True, None, None, None, 0), (False, None, True, None, None, 0), (False, False, False, None, True, 5), (False, False, False, None, None, 0)]
    assert values(spark, rows, reason(False), schema) == [None, "spam", "blocklist_b", "toxic_remembered", "no_captures(0)"]
    assert values(spark, rows[:1], reason(True), schema) == ["spam_unchecked"]


def test_spam_terms_stand_between_other_characters(spark):
    assert values(spark, ["a c++ b", "c+++", "cc"], rules.spam_matches(F.array("x"), rules.Rules(spam_terms=("c++", "(x"), spam_cjk=()))) == [["c++"], ["c++"], []]
    r = rules.Rules(spam_terms=("cialis",), spam_cjk=("赌场",))
    got = values(spark, ["especialistas", "买cialis药", "in 赌场 x", None], rules.spam_matches(F.array("x"), r))
    assert got == [[], ["cialis"], ["赌场"], []]


SIGNALS = "name string, wayback_snapshots int, open_page_rank double, cert_history boolean, cc_source_domain_count int"


def test_scores_average_what_is_known(spark):
    weights = {"captures": 0.3, "rank": 0.4, "cert": 0.2, "length": 0.1}
    c = scoring.Scoring(weights=weights)
    rows = [("a" * 30 + ".com", None, None, None, None), ("ab.com", 100_000, 10.0, True, None), ("a" * 16 + ".com", 0, None, None, 0)]
    assert values(spark, rows, scoring.score(c), SIGNALS) == [0, 100, 12]
    # half to even: 12.5
    both = scoring.weighted_score({"a": F.lit(0.125)}, {"a": 1.0})
    assert values(spark, ["x"], both) == [12]
    assert values(spark, ["x"], scoring.weighted_score({"a": F.lit(None).cast("double")}, {"a": 1.0})) == [None]
    assert values(spark, ["x"], scoring.weighted_score({"a": F.lit(0.5)}, {"a": 0.0})) == [0]


def test_zero_links_differ_from_unknown(spark):
    c = scoring.Scoring(weights={"links": 0.5, "length": 0.5})
    rows = [("ab.com", None, None, None, None), ("ab.com", None, None, None, 0)]
    assert values(spark, rows, scoring.score(c), SIGNALS) == [100, 50]


def test_link_history_is_checked_as_a_whole(spark):
    good = '[{"release":"b","source_domain_count":3},{"release":"a","source_domain_count":null}]'
    bad = ['[{"release":"b","source_domain_count":-1}]', '[{"release":"b","source_domain_count":true}]', '[{"release":"b","source_domain_count":1.5}]', "[]", "no", None]
    got = values(spark, [good, *bad], scoring.link_history(F.col("x")))
    assert [(h["release"], h["source_domain_count"]) for h in got[0]] == [("b", 3), ("a", None)] and got[1:] == [None] * len(bad)


def test_verdicts(spark):
    none = (None, None, None)
    rows = [(False, None, 80, 3, *none), (False, None, 80, 2, *none), (True, None, 80, 3, *none), (False, "parked", 80, 3, *none), (None, None, None, None, *none), (False, None, 55, 3, 500, 3.0, 100)]
    rows += [(False, None, 55, 3, 5000, 0.0, 0), (False, None, 55, 3, 1500, 1.5, 0), (False, None, 55, 3, 1500, None, 10), (False, None, 35, 3, 99999, 9.0, 99999), (False, None, 80, 2, 1500, 1.5, 0)]
    got = values(spark, rows, scoring.verdict(F.col("s"), F.col("c"), F.col("n"), F.col("e")), "s boolean, c string, n int, e int, wayback_snapshots int, open_page_rank double, cc_source_domain_count int")
    assert got == ["Clean", "Caution", "Caution", "Caution", "Caution", "Caution", "Caution", "Promising", "Promising", "Caution", "Caution"]


def test_evidence_counts_sources_and_no_links(spark):
    schema = SIGNALS + ", wayback_last_snapshot date, surbl_listed boolean, spamhaus_listed boolean, spam_flagged boolean, wayback_unknown boolean, previous_registrar string"
    rows = [("a.com", None, None, None, 7, None, None, None, None, True, None), ("b.com", 0, 0.0, False, None, None, None, None, None, None, None)]
    assert values(spark, rows, scoring.evidence_count(), schema) == [0, 3]
    assert values(spark, rows, scoring.evidence_count(unknown_captures=F.col("wayback_unknown")), schema) == [1, 3]
    assert values(spark, rows, scoring.evidence_count(scoring.Scoring(sources={}), F.col("wayback_unknown")), schema) == [2, 3]


def test_ends_lose_white_space_of_any_kind(spark):
    x = F.col("x")
    assert values(spark, ["\t a b\u00a0\r\n", "\u2003\u3000", "", None, "a"], text.stripped(x)) == ["a b", "", "", None, "a"]
    assert values(spark, ["\n not scored\t", "\u00a0", " fine\n"], scoring.ranker_reason(x)) == [None, None, "fine"]


def test_texts_of_others(spark):
    x = F.col("x")
    assert values(spark, ["a‮b\x00c   d", "x" * 12, None], text.clean_untrusted(x, 10)) == ["a b c d", "x" * 9 + "…", None]
    assert values(spark, ["Привет мир", "hello", "日本語です", "漢字", "", "한국"], text.writing_system(x)) == ["Cyrillic", None, "Japanese", "Chinese or Japanese", None, "Korean"]
    assert values(spark, ["कखगघ", "אבגד", "αβγδ אבגד", "2026 - 漢字", "ab漢字", "abc漢字", "ＡＢＣＤ", "Cafe é", "ｱｲｳ", "שּׁשּׂ", "😀🚀"], text.writing_system(x)) == ["non-English", "Hebrew", "non-English", "Chinese or Japanese", "Chinese or Japanese", None, None, None, "Japanese", "Hebrew", None]
    assert values(spark, ["https://e.com/a?x=1&ref=old#top", "https://e.com/"], text.with_parameters(x, {"ref": "new"})) == ["https://e.com/a?x=1&ref=new#top", "https://e.com/?ref=new"]
    assert values(spark, ["Home.", " Example.com ", "example", "A shop.", None], text.excerpt_title(x, F.lit("example.com"), denied=("home",))) == [None, None, None, "A shop.", None]
    assert values(spark, ["20260101000000", "junk", None], text.excerpt_age_days(x, F.lit("2026-01-31").cast("date"))) == [30, None, None]
    assert [str(v) if v else v for v in values(spark, ["2026-01-02", "2026-01-02T03:04:05.678Z", "soon"], text.parse_time(x))] == ["2026-01-02 00:00:00", "2026-01-02 03:04:05", None]


@pytest.mark.parametrize(("history", "trend"), [([5, 1], "up"), ([1, 5], "down"), ([10, None, 10], "flat"), ([5], None), ([None, 5], None)])
def test_link_trend(spark, history, trend):
    rows = [([("r", n) for n in history],)]
    assert values(spark, rows, scoring.link_trend(F.col("h")), "h array<struct<release string, source_domain_count long>>") == [trend]


def test_release_tables_reach_as_far_as_the_data(spark):
    df = spark.createDataFrame([("1994-nov-dec-jan",), ("2050-2051-nov-dec-jan",), ("2051-oct-nov-dec",), ("nightly",), (None,)], "release string")
    known = df.join(names.release_table_of(df), "release")
    assert sorted((r["release"], r["year"]) for r in known.collect()) == [("2050-2051-nov-dec-jan", 2051), ("2051-oct-nov-dec", 2051)]
    assert names.release_table_of(df.filter("release = 'nightly'")).count() == 24
