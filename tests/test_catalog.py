"""Every query of the library that has SQL, against DuckDB on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from zonewright import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else str(v)


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    columns = sorted(got.columns)
    found = sorted(([plain(x) for x in r] for r in got.select(*columns).collect()), key=repr)
    wanted = duck.sql(catalog.oracle_sql()[name])
    assert sorted(wanted.columns) == columns
    order = [wanted.columns.index(c) for c in columns]
    assert found == sorted(([plain(r[i]) for i in order] for r in wanted.fetchall()), key=repr)


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


def test_requested_only_reads_the_words_of_the_classifier(spark):
    found = {r["category"] for r in catalog.queries()["signals_requested_only"](spark, SF).select("category").distinct().collect()}
    assert found == {"legitimate", "unknown"}


def test_page_excerpts_read_references_as_their_sql(spark, tmp_path):
    texts = ["a &amp; b", "cut &amp", "&quot;q&quot", "&am", "&notit; &notin;", "&#38;&#x26;&#X41 &#128; &#0; &#xD800; &#99999999999999999999; &#xFFFF;x &#", "&nbsp;x\u2003 y&#11;z&nbsp", "& &&amp;amp;", "it's &apos;"]
    pages = [(i, "u", f"<title>{t}</title><h1>{t[::-1] if i % 2 else t}</h1>") for i, t in enumerate(texts)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    wanted = con.sql(catalog.oracle_sql()["signals_page_excerpts"]).fetchall()
    assert sorted(map(tuple, catalog.queries()["signals_page_excerpts"](spark, str(tmp_path)).collect())) == sorted(wanted)
