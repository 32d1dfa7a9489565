"""Signal sources by name."""

import datetime

import pytest
from pyspark.sql import functions as F

from zonewright.operators import named
from zonewright.sources import readers

REPLIES = "domain string, source string, http_status int, body string, fetched_at timestamp"


def at(h):
    return datetime.datetime(2026, 1, 1, h)


def test_sources_by_name_and_absent_ones(spark):
    names = spark.createDataFrame([("a.com", 1), ("a.com", 1), ("B.com", 2), (None, 3)], "name string, body int")
    replies = spark.createDataFrame(
        [
            ("A.com", "registry", 200, "{}", at(1)), ("a.com", "registry", 404, "{}", at(2)), ("a.com", "registry", 200, "{}", None),
            ("a.com", "page_rank", 200, '{"page_rank_decimal": 3.5}', at(1)), ("b.com", "threats", 200, "{}", at(1)),
            ("a.com", "threats", 503, '{"matches": [{"threatType": "X"}]}', at(1)), ("c.com", "registry", 404, "{}", at(1)), (None, None, None, None, None),
        ], REPLIES,
    )
    sources = dict(named.SOURCES)
    named.declare("later", "age int, seen date", sources=sources)
    out = named.enrich_by_name(names, replies, ["registry", "threats", "later", "page_rank"], sources)
    assert dict(out.dtypes) == {
        "name": "string", "body": "int", "is_available": "boolean", "expiration_date": "string", "registrar": "string",
        "threat_flagged": "boolean", "threat_types": "array<string>", "age": "int", "seen": "date", "open_page_rank": "double",
    }
    got = sorted((tuple(r) for r in out.select("name", "body", "is_available", "threat_flagged", "threat_types", "age", "open_page_rank").collect()), key=str)
    a = ("a.com", 1, True, None, None, None, 3.5)
    assert got == sorted([a, a, ("B.com", 2, None, False, [], None, None), (None, 3, None, None, None, None, None)], key=str)
    assert named.enrich_by_name(names, replies.limit(0), ["registry"]).filter("is_available is null").count() == 4


def test_a_source_of_ones_own(spark):
    sources = {}

    @named.source("age", "days int, missing string", sources)
    def _(status, body):
        return {"days": F.get_json_object(body, "$.days")}

    replies = spark.createDataFrame([("a", "age", 200, '{"days": 7}', at(1)), ("b", "age", 200, "broken", at(1))], REPLIES)
    out = named.enrich_by_name(spark.createDataFrame([("a",), ("b",)], "name string"), replies, ["age"], sources)
    assert sorted(map(tuple, out.collect())) == [("a", 7, None), ("b", None, None)]


def test_unknown_and_clashing_sources_are_errors(spark):
    names, replies = spark.createDataFrame([("a", True)], "name string, Registrar boolean"), spark.createDataFrame([], REPLIES)
    with pytest.raises(ValueError, match="no such sources: nowhere"):
        named.enrich_by_name(names, replies, ["nowhere"])
    with pytest.raises(ValueError, match="given twice: registrar"):
        named.enrich_by_name(names, replies, ["registry"])


def test_only_folders_asked_for_are_read_and_one_join_serves_all(spark, tmp_path):
    rows = [(f"n{i}", s, 200, "{}", at(1)) for i in range(5) for s in ("registry", "page_rank", "other")]
    spark.createDataFrame(rows, REPLIES).write.partitionBy("source").json(str(tmp_path / "landed"))
    out = named.enrich_by_name(spark.createDataFrame([("n1",)], "name string"), readers.landed(spark, str(tmp_path / "landed")), ["registry", "page_rank", "threats"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [source" in plan.replace("isnotnull(source", "source") or "source#" in plan.split("PartitionFilters")[1][:60]
    assert plan.count("LeftSemi") == 1 and plan.count("LeftOuter") == 1
    assert out.first()["is_available"] is False
