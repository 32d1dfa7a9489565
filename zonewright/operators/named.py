"""Signal sources by name: each declares its columns and reads its replies; names get all they ask for by one join.

    @source("whois_age", "age_days int")
    def _(status, body):
        return {"age_days": F.get_json_object(body, "$.age").cast("int")}

    rows = enrich_by_name(candidates, readers.landed(spark, root), ["registry", "page_rank", "whois_age"])

A source is a function of columns, so the replies of all sources go through one aggregation and one join, however many
sources there are. A source without a function, or without replies, gives nulls of the declared types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from zonewright.operators import signals

#: (http_status, body) of a reply -> its columns
Decoder = Callable[[Column, Column], dict[str, Column]]


@dataclass(frozen=True)
class Source:
    name: str
    schema: str
    decode: Decoder | None = None

    def fields(self) -> list[StructField]:
        """The declared columns; reading DDL takes a session, so declaring does not."""
        return StructType.fromDDL(self.schema).fields


SOURCES: dict[str, Source] = {}


def declare(name: str, schema: str, decode: Decoder | None = None, sources: dict[str, Source] = SOURCES) -> Source:
    """Declare a source, or declare it anew. schema: its columns, as DDL."""
    found = sources[name] = Source(name, schema, decode)
    return found


def source(name: str, schema: str, sources: dict[str, Source] = SOURCES) -> Callable[[Decoder], Decoder]:
    def register(decode: Decoder) -> Decoder:
        declare(name, schema, decode, sources)
        return decode

    return register


declare("registry", "is_available boolean, expiration_date string, registrar string", signals.registry_columns)


@source("page_rank", "open_page_rank double")
def _page_rank(status: Column, body: Column) -> dict[str, Column]:
    return {"open_page_rank": signals.page_rank(body)}


@source("threats", "threat_flagged boolean, threat_types array<string>")
def _threats(status: Column, body: Column) -> dict[str, Column]:
    flagged, types = signals.threat_reply(body)
    answered = F.from_json(body, "matches string").isNotNull() & (status == 200)
    return {"threat_flagged": F.when(answered, flagged), "threat_types": F.when(answered, types)}


def enrich_by_name(candidates: DataFrame, replies: DataFrame, wanted: list[str], sources: dict[str, Source] = SOURCES) -> DataFrame:
    """candidates (name, ..) with the columns of the wanted sources, in their order.

    replies: (domain, source, http_status, body, fetched_at); the newest of a domain and source counts (undated ones are the
    oldest; ties: the greatest status, then body). Names are compared in lower case. A column that candidates have
    already, or that two sources declare, and a source that nobody declared are errors. A null or repeated name stays a row.
    """
    unknown = [n for n in wanted if n not in sources]
    if unknown:
        raise ValueError(f"no such sources: {', '.join(unknown)} (declared: {', '.join(sorted(sources))})")
    columns = [f.name for n in wanted for f in sources[n].fields()]
    taken = [c.lower() for c in candidates.columns]
    twice = sorted({c for c in columns if [*taken, *(x.lower() for x in columns)].count(c.lower()) > 1})
    if twice:
        raise ValueError(f"columns given twice: {', '.join(twice)}")
    asked = candidates.select(F.lower("name").alias("_low")).distinct()
    mine = replies.filter(F.col("source").isin(wanted)).select(F.lower("domain").alias("_low"), "source", F.struct("fetched_at", "http_status", "body").alias("_reply"))
    newest = mine.join(asked, "_low", "left_semi").groupBy("_low", "source").agg(F.max("_reply").alias("_reply"))
    # one entry a source
    each = newest.groupBy("_low").agg(F.map_from_entries(F.collect_list(F.struct("source", "_reply"))).alias("_replies"))
    joined = candidates.withColumn("_low", F.lower("name")).join(each, "_low", "left")
    given = []
    for n in wanted:
        reply, s = F.try_element_at("_replies", F.lit(n)), sources[n]
        made = s.decode(reply["http_status"], reply["body"]) if s.decode else {}
        given += [F.when(reply.isNotNull(), made.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in s.fields()]
    return joined.select(*[F.col(f"`{c}`") for c in candidates.columns], *given)
