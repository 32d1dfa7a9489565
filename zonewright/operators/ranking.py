"""Orders, quotas, caps and pages."""

from __future__ import annotations

import base64
import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.functions import names
from zonewright.sources.staging import staged


#: Groups up to which the best rows of each are sent to every task; beyond, both sides are shuffled.
BROADCAST_GROUPS = 20_000


def by_score(rows: DataFrame) -> DataFrame:
    """Scored rows, best first, ties by name."""
    return rows.filter("score is not null").orderBy(F.desc("score"), "name")


def top(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.desc("score"), "name").limit(n)


def pre_narrow(rows: DataFrame, n: int) -> DataFrame:
    """The n names that look most natural: trigram matches, then short labels, then the name."""
    label = names.label(F.col("name"))
    keyed = rows.withColumn("trigram_matches", names.trigram_matches(label)).withColumn("label_length", F.length(label))
    return keyed.orderBy(F.desc("trigram_matches"), "label_length", "name").limit(n)


def cap_per_group(rows: DataFrame, group: str, n: int, *order: Column) -> DataFrame:
    """At most n rows a group in the order; n of 0 or less lets all through."""
    if n <= 0:
        return rows
    order = order or (F.desc("score"), F.col("name"))
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def host_quota(runtime_s: Column, workers: Column, throttle_s: Column) -> Column:
    """What one host can be asked in a run; null (no quota) without a throttle."""
    return F.when(throttle_s > 0, F.greatest(F.lit(1), F.floor(runtime_s * workers / throttle_s)))


def within_quota(rows: DataFrame, quotas: DataFrame, day: str | Column | None = None) -> DataFrame:
    """Rows (host, name, ..) within the quota of their host: by score if rows have phase2_score, else in an order that a
    hash of name and day gives, the same in every run of that day."""
    if "phase2_score" in rows.columns:
        order = [F.desc_nulls_last("phase2_score"), F.col("name")]
    else:
        order = [F.xxhash64("name", day if isinstance(day, Column) else F.lit(day or "")), F.col("name")]
    # bins in that order, how many names each host has in them, and the bin in which its quota ends
    step = -F.floor("phase2_score") if "phase2_score" in rows.columns else F.shiftright(order[0], 48)
    joined = staged(rows.join(quotas.select("host", "quota"), "host", "left").withColumn("_bin", F.coalesce(step.cast("long"), F.lit(1 << 40))), "asked")
    counts = joined.filter("quota is not null").groupBy("host", "quota", "_bin").agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("host").orderBy("_bin"))
    ends = counts.withColumn("_to", so_far).filter(F.col("_to") >= F.col("quota")).groupBy("host").agg(F.min(F.struct("_bin", (F.col("quota") - F.col("_to") + F.col("n")).alias("left"))).alias("end"))
    cut = joined.join(ends.select("host", F.col("end._bin").alias("_end"), F.col("end.left").alias("_left")), "host", "left")
    within = cut.filter(F.col("quota").isNull() | F.col("_end").isNull() | (F.col("_bin") < F.col("_end")))
    # only the last bin of a host is ordered by name
    last = numbered_within(cut.filter("quota is not null and _bin = _end"), "host", *order).filter(F.col("rn") <= F.col("_left")).drop("rn")
    return within.unionByName(last).drop("quota", "_bin", "_end", "_left")


def with_ranker_scores(rows: DataFrame, scores: DataFrame, placeholder: str = "not scored") -> DataFrame:
    joined = rows.join(scores.select("name", "phase2_score", "phase2_reason"), "name", "left")
    return joined.withColumn("phase2_score", F.coalesce("phase2_score", F.lit(0))).withColumn("phase2_reason", F.coalesce("phase2_reason", F.lit(placeholder)))


def hosts_of_tlds(rows: DataFrame, services: DataFrame) -> DataFrame:
    """rows with host: of the first url that serves the tld, `_unknown` without one. services: tlds array, urls array."""
    first = services.select(F.explode("tlds").alias("tld"), F.lower(F.try_parse_url(F.get("urls", F.lit(0)), F.lit("HOST"))).alias("host"), F.monotonically_increasing_id().alias("at"))
    table = first.groupBy("tld").agg(F.min_by("host", "at").alias("host"))
    return rows.join(table, "tld", "left").withColumn("host", F.coalesce("host", F.lit("_unknown")))


def similar_rows(rows: DataFrame, group: str = "tld", n: int = 5) -> DataFrame:
    """(name, other, place): for each row the best n others of its group. The n + 1 best rows of a group are one row to
    join: a row finds its others there, so rows are neither sorted by group nor multiplied before a place is known."""
    w = Window.partitionBy(group).orderBy(F.desc("score"), "name")
    best = rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n + 1).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_rank", "name"))).alias("_best"))
    best = staged(best, "best")
    few = best.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    others = F.slice(F.filter("_best", lambda b: b["name"] != F.col("name")), 1, n)
    listed = rows.select("name", group).join(F.broadcast(best) if few else best, group).select("name", F.posexplode(others).alias("_at", "_other"))
    return listed.select("name", F.col("_other.name").alias("other"), (F.col("_at") + 1).alias("place"))


def sort_nulls_last(rows: DataFrame, column: str, descending: bool, tie: str = "name") -> DataFrame:
    c = F.col(column)
    return rows.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), tie)


def numbered(rows: DataFrame, *order: Column, name: str = "rn") -> DataFrame:
    """rows with their place from 1 in the whole order, without one task for all: ranges, counts by range, places inside."""
    # ranges come from a sample, so they are fixed by writing them once
    dealt = staged(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = dealt.withColumn("_in", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return inside.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_in")).drop("_range", "_n", "_before", "_in")


def numbered_within(rows: DataFrame, group: str, *order: Column, name: str = "rn") -> DataFrame:
    """rows with their place from 1 in their group; a group of any size is spread over ranges."""
    dealt = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order).withColumn("_id", F.monotonically_increasing_id())
    dealt = staged(dealt, "ranges").withColumn("_range", F.shiftright("_id", 33))
    spans = dealt.groupBy(group, "_range").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_n"))  # one row a range and group
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.withColumn("_before", before).select(F.col(group).alias("_group"), F.col("_range").alias("_of"), "_low", "_before")
    joined = dealt.join(spans, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return joined.withColumn(name, F.col("_before") + F.col("_id") - F.col("_low") + 1).drop("_id", "_range", "_group", "_of", "_low", "_before")


def pages(rows: DataFrame, size: int, *order: Column) -> DataFrame:
    """rows with page from 1."""
    return numbered(rows, *order).withColumn("page", F.ceil(F.col("rn") / size)).drop("rn")


def batches(rows: DataFrame, size: int, *order: Column) -> DataFrame:
    return numbered(rows, *order).withColumn("batch_id", F.floor((F.col("rn") - 1) / size)).drop("rn")


def page_after(rows: DataFrame, limit: int, most: int = 100, after: tuple | None = None) -> DataFrame:
    """A page of rows by (score desc, name), after the last row of the page before: no offset is counted."""
    limit = max(1, min(most, limit))
    if after is not None:
        s, n = after
        rows = rows.filter((F.col("score") < s) | ((F.col("score") == s) & (F.col("name") > n)))
    return rows.orderBy(F.desc("score"), "name").limit(limit)


Keys = list[tuple[str, bool]]


def sort_order(keys: Keys) -> list[Column]:
    """Columns with whether they descend, as an order with nulls last."""
    return [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in keys]


def after_row(keys: Keys, values: list[Column]) -> Column:
    """Rows that come after one with these values: by the first key that differs. Nothing comes after a null but what later
    keys tell apart."""
    later, equal = F.lit(False), F.lit(True)
    for (c, down), v in zip(keys, values, strict=True):
        beyond = F.col(c) < v if down else F.col(c) > v
        later = later | (equal & v.isNotNull() & F.coalesce(beyond, F.col(c).isNull()))
        equal = equal & F.col(c).eqNullSafe(v)
    return later


def page_of(rows: DataFrame, keys: Keys, size: int, token: str | None = None, scope: str = "", most: int = 100) -> tuple[DataFrame, str | None]:
    """(a page of at most `most` rows in the order of the keys, the token of the page after or None). The keys tell all rows
    apart; a token holds its page's last row and belongs to one scope, such as a query's parameters. No offset is counted."""
    size, mark = max(1, min(most, size)), hashlib.sha256(scope.encode()).hexdigest()[:16]
    types = dict(rows.dtypes)
    if token is not None:
        try:
            held = json.loads(base64.urlsafe_b64decode(token + "=" * (-len(token) % 4)))
            values, of = held["k"], held["s"]
        except (ValueError, KeyError, TypeError) as broken:
            raise ValueError("no such token") from broken
        if of != mark or len(values) != len(keys):
            raise ValueError("the token does not belong to this query")
        rows = rows.filter(after_row(keys, [F.lit(v).cast(types[c]) for v, (c, _) in zip(values, keys, strict=True)]))
    shown = rows.orderBy(*sort_order(keys)).limit(size + 1)
    ends = shown.select(*[F.col(c).cast("string").alias(c) for c, _ in keys]).collect()  # a page and one row
    if len(ends) <= size:
        return shown, None
    last = json.dumps({"k": list(ends[size - 1]), "s": mark}, separators=(",", ":")).encode()
    return rows.orderBy(*sort_order(keys)).limit(size), base64.urlsafe_b64encode(last).decode().rstrip("=")


def placed_on_pages(rows: DataFrame, keys: Keys, size: int, most: int = 100) -> DataFrame:
    """rows with page and place on it, both from 0: where a walk by `page_of` from the first token to the last shows them. All
    pages come from one numbering, so a table of any number of pages costs what one of few does."""
    size = max(1, min(most, size))
    at = F.col("_at") - 1
    return numbered(rows, *sort_order(keys), name="_at").withColumns({"page": F.floor(at / size).cast("long"), "place": (at % size).cast("long")}).drop("_at")


def cursor(score: Column, name: Column, query: str) -> Column:
    """A token for page_after that holds for one query only."""
    return F.base64(F.to_json(F.struct(score.alias("s"), name.alias("n"), F.substring(F.sha2(F.lit(query), 256), 1, 16).alias("q"))).cast("binary"))


def read_cursor(token: Column, query: str) -> Column:
    read = F.from_json(F.unbase64(token).cast("string"), "s double, n string, q string")
    return F.when(read["q"] == F.substring(F.sha2(F.lit(query), 256), 1, 16), read)
