"""Decoding landed responses (domain, source, http_status, body, fetched_at) and joining signals to names."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from zonewright.functions import rules, text

# The categories of the classifier.
CATEGORIES = ("legitimate", "parked", "toxic", "empty", "unknown")


def registry_columns(status: Column, body: Column) -> dict[str, Column]:
    """is_available (404 yes, 200 no, else unknown), expiration_date and registrar of a reply.

    The expiration event comes before that of the registrar; the registrar is the name of the first such entity.
    """
    body = F.from_json(body, "events array<struct<eventAction: string, eventDate: string>>, entities array<struct<roles: array<string>, vcardArray: string>>")
    ev = lambda action: F.get(F.filter(body["events"], lambda e: F.lower(e["eventAction"]) == action), F.lit(0))["eventDate"]
    registrar = F.get(F.filter(body["entities"], lambda e: F.array_contains(e["roles"], "registrar")), F.lit(0))["vcardArray"]
    # a card is ["vcard", [[name, parameters, type, value], ..]]: each level is read as texts of the one below
    texts = lambda c: F.from_json(c, "array<string>")
    card = F.transform(texts(F.get(texts(registrar), F.lit(1))), texts)
    full_name = F.nullif(F.get(F.get(F.filter(card, lambda p: F.lower(F.get(p, F.lit(0))) == "fn"), F.lit(0)), F.lit(3)), F.lit(""))
    expires = F.substring(F.coalesce(ev("expiration"), ev("registrar expiration")), 1, 10)
    return {"is_available": F.when(status == 404, True).when(status == 200, False), "expiration_date": expires, "registrar": full_name}


def registry_reply(rows: DataFrame) -> DataFrame:
    """rows (http_status, body) with the columns of `registry_columns`."""
    return rows.select("*", *[c.alias(n) for n, c in registry_columns(F.col("http_status"), F.col("body")).items()])


def blocklist_listed(addresses: Column, no_such_name: Column) -> Column:
    """Listed for answers in 127.0.0.x or 127.0.1.x; not listed for no such name; else unknown."""
    hit = F.exists(addresses, lambda a: a.rlike(r"^127\.0\.[01]\.[0-9]+$"))
    return F.when(F.coalesce(hit, F.lit(False)), True).when(F.coalesce(no_such_name, F.lit(False)), False)


def page_rank(body: Column) -> Column:
    """found: false gives 0; a body that is no JSON gives null; a rank that is no number gives 0."""
    read = F.from_json(body, "found boolean, page_rank_decimal string, rank string")
    return F.when(read.isNull() | F.coalesce(read["found"].cast("string"), read["page_rank_decimal"], read["rank"]).isNull(), None).when(read["found"].eqNullSafe(F.lit(False)), 0.0).otherwise(F.coalesce(read["page_rank_decimal"].try_cast("double"), F.lit(0.0)))


def threat_reply(body: Column) -> tuple[Column, Column]:
    """(flagged, sorted distinct types) of a reply with matches."""
    types = F.array_sort(F.array_distinct(F.filter(F.transform(F.from_json(body, "matches array<struct<threatType: string>>")["matches"], lambda m: m["threatType"]), lambda t: t.isNotNull())))
    types = F.coalesce(types, F.array().cast("array<string>"))
    return F.size(types) > 0, types


def captures(rows: DataFrame, most: int = 10_000) -> DataFrame:
    """(domain, wayback_snapshots, wayback_last_snapshot) from capture rows (domain, stamp)."""
    day = F.to_date(F.try_to_timestamp(F.substring("stamp", 1, 8), F.lit("yyyyMMdd")))
    return rows.groupBy("domain").agg(F.least(F.count(F.lit(1)), F.lit(most)).alias("wayback_snapshots"), F.max(day).alias("wayback_last_snapshot"))


def certificates(rows: DataFrame) -> DataFrame:
    """(domain, cert_count, cert_history) from certificate rows (domain, id)."""
    return rows.groupBy("domain").agg(F.count_distinct("id").alias("cert_count"), (F.count_distinct("id") > 0).alias("cert_history"))


def name_servers(rcode: Column, servers: Column) -> tuple[Column, Column]:
    """(available, servers without last dots): no such name is available, servers mean registered, else unknown."""
    clean = F.transform(servers, lambda s: F.regexp_replace(F.lower(s), r"\.+$", ""))
    return F.when(rcode == "NXDOMAIN", True).when((rcode == "NOERROR") & (F.size(clean) > 0), False), clean


def keep_unless_registered(rows: DataFrame) -> DataFrame:
    """Rows whose name is not known to be registered (dns_available is not false): unknown passes."""
    return rows.filter(~F.col("dns_available").eqNullSafe(F.lit(False)))


def available_only(rows: DataFrame, availability: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of names known to be free, one row of counts): unknown is turned away like registered, but counted apart."""
    asked = rows.join(availability.groupBy("name").agg(F.bool_and("is_available").alias("is_available")), "name", "left")
    counts = asked.agg(F.count_if("is_available").alias("available"), F.count_if(~F.col("is_available")).alias("registered"), F.count_if(F.col("is_available").isNull()).alias("unknown"))
    return asked.filter("is_available").drop("is_available"), counts


def with_publication(available: DataFrame, published: DataFrame) -> DataFrame:
    """All available rows, with was_published."""
    marks = published.select("name").distinct().withColumn("_published", F.lit(True))
    return available.join(marks, "name", "left").withColumn("was_published", F.col("_published").isNotNull()).drop("_published")


def nearest_capture(rows: DataFrame, target: Column) -> DataFrame:
    """The successful HTML capture (domain, stamp, http_status, mime) nearest to target, the newer of two; the newest
    without a target."""
    good = rows.filter((F.col("http_status") == 200) & (F.col("mime") == "text/html"))
    day = F.to_date(F.try_to_timestamp(F.substring("stamp", 1, 8), F.lit("yyyyMMdd")))
    order = [F.abs(F.datediff(day, target)).asc_nulls_last(), F.col("stamp").desc()]
    return good.withColumn("_rank", F.row_number().over(Window.partitionBy("domain").orderBy(*order))).filter("_rank = 1").drop("_rank")


class _Signals(HTMLParser):
    """Title, meta description, h1 and h2 of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.meta, self.heads, self.open = None, None, {"h1": [], "h2": []}, None

    def handle_starttag(self, tag, attrs):
        if tag == "meta" and self.meta is None:
            values = {k: v or "" for k, v in attrs}
            if values.get("name", "").lower() == "description":
                self.meta = values.get("content", "")
        elif tag == "title" and self.title is None:
            self.open, self.title = tag, ""
        elif tag in self.heads:
            self.open = tag
            self.heads[tag].append("")

    def handle_endtag(self, tag):
        if tag == self.open:
            self.open = None

    def handle_data(self, data):
        if self.open == "title":
            self.title += data
        elif self.open:
            self.heads[self.open][-1] += data


_EXCERPT = "title string, meta_description string, h1 array<string>, h2 array<string>"


def _parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flat = lambda s: " ".join((s or "").split())[:200]
    for batch in batches:
        out = []
        for html in batch.column(1):
            parser = _Signals()
            parser.feed(html.as_py() or "")
            parser.close()
            heads = {k: [x for x in map(flat, parser.heads[k][:n]) if x] for k, n in (("h1", 3), ("h2", 5))}
            out.append((flat(parser.title) or None, flat(parser.meta) or None, heads["h1"], heads["h2"]))
        columns = list(zip(*out)) or [[], [], [], []]
        types = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["key", "title", "meta_description", "h1", "h2"])


def page_excerpts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, title, meta_description, h1, h2), each up to 200 characters: at most 3 h1 and 5 h2, blank ones dropped after
    that; pages that say nothing are left out."""
    schema = f"key {pages.schema[key].dataType.simpleString()}, {_EXCERPT}"
    rows = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(_parse_pages, schema)
    return rows.filter("title is not null or meta_description is not null or size(h1) > 0 or size(h2) > 0").withColumnRenamed("key", key)


def ranker_reply(rows: DataFrame, json: str = "body") -> DataFrame:
    """(name, phase2_score 0..100, phase2_reason up to 120) from replies that are arrays; a bad score is 0, rows without a
    name are dropped."""
    items = rows.select(F.inline(F.from_json(json, "array<struct<name: string, score: string, reason: string>>")))
    score = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(F.round(F.col("score").try_cast("double")).cast("int"), F.lit(0))))
    return items.withColumn("name", text.stripped(F.col("name"))).filter("name <> ''").select(F.lower("name").alias("name"), score.alias("phase2_score"), F.substring(text.stripped(F.col("reason")), 1, 120).alias("phase2_reason"))


#: What a scan of JSON stops at: an escape of any character, a quote, a brace.
_MARKS = re.compile(r'\\.|["{}]', re.DOTALL)


def outer_objects(text: str) -> list[str]:
    """The spans between outermost braces, in one pass; braces and quotes within strings don't count. What is left open at
    the end is no span."""
    spans, depth, begin, quoted = [], 0, 0, False
    for m in _MARKS.finditer(text):
        mark = m.group() if quoted else m.group()[-1]  # outside of strings nothing is escaped
        if mark == '"':
            quoted = not quoted
        elif quoted:
            continue
        elif mark == "{":
            begin, depth = (m.start() if depth == 0 else begin), depth + 1
        elif mark == "}" and depth:
            depth -= 1
            if depth == 0:
                spans.append(text[begin : m.end()])
    return spans


@F.arrow_udf(StringType())
def _salvage(texts: pa.Array) -> pa.Array:
    """Whole objects of a broken array, as an array; objects within a broken one are not looked for."""
    import json

    def reads(span: str) -> bool:
        try:
            return isinstance(json.loads(span), dict)
        except (ValueError, RecursionError):
            return False

    def one(text: str | None) -> str | None:
        found = [s for s in outer_objects(text or "") if reads(s)]
        return f"[{','.join(found)}]" if found else None

    return pa.array([one(t.as_py()) for t in texts], pa.string())


def model_array(reply: Column, schema: str) -> Column:
    """A model's reply as an array: fences stripped, from the first to the last bracket; only replies that do not read so
    go to Python, which keeps their complete objects."""
    bare = F.regexp_replace(text.stripped(reply), r"^```[a-zA-Z]*\s*|\s*```$", "")
    outer = F.regexp_extract(bare, r"(?s)(\[.*\])", 1)
    read = F.from_json(outer, schema)
    whole = F.when(F.get_json_object(outer, "$[0]").isNotNull() | outer.rlike(r"^\[\s*\]$"), read)
    return F.coalesce(whole, F.from_json(_salvage(F.when(whole.isNull(), bare)), schema))


def category(word: Column) -> Column:
    low = F.regexp_replace(F.lower(F.trim(word)), r"[^a-z]", "")
    return F.when(low.isin(*CATEGORIES), low).otherwise("unknown")


def final_category(model: Column, spam_terms: Column, parked: Column, action: str = "toxic") -> Column:
    """A parked marker beats the model, and spam terms beat both unless the word is toxic already: they make it `action`, or
    change nothing if that is no category."""
    word, action = F.when(parked.isNotNull(), "parked").otherwise(model), action.strip().lower()
    if action not in CATEGORIES[:-1]:
        return word
    return F.when((F.size(spam_terms) > 0) & (word != "toxic"), action).otherwise(word)


def requested_only(requested: DataFrame, replies: DataFrame) -> DataFrame:
    """(name, category) for every requested name: replies to others are dropped, names without a reply are unknown."""
    answered = replies.groupBy("name").agg(F.min("category").alias("category"))
    return requested.select("name").distinct().join(answered, "name", "left").select("name", F.coalesce("category", F.lit("unknown")).alias("category"))


Enricher = Callable[[DataFrame], DataFrame]


def enrich(candidates: DataFrame, sources: dict[str, tuple[Enricher | None, list[str]]]) -> DataFrame:
    """candidates with the columns of each source: (function of the names, columns); a missing source gives nulls."""
    for function, columns in sources.values():
        if function is None:
            candidates = candidates.withColumns({c: F.lit(None).cast("string") for c in columns})
        else:
            found = function(candidates.select("name").distinct()).dropDuplicates(["name"])
            candidates = candidates.join(found.select("name", *columns), "name", "left")
    return candidates


def classify_excerpts(excerpts: DataFrame, model: DataFrame, r: rules.Rules = rules.DEFAULT, action: str = "toxic") -> DataFrame:
    """(name, category) from excerpts (name, title, meta_description, h1, h2, html) and the model's categories; action: what
    spam terms make of a name."""
    fields = F.concat(F.array("title", "meta_description"), F.coalesce("h1", F.array().cast("array<string>")), F.coalesce("h2", F.array().cast("array<string>")))
    joined = excerpts.join(model.select("name", F.col("category").alias("_model")), "name", "left")
    return joined.select("name", final_category(F.coalesce("_model", F.lit("unknown")), rules.spam_matches(fields, r), rules.parked_marker(F.col("html"), r), action).alias("category"))
