"""Readers of zone files, graph files, payloads, caches, archives and logs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonewright.sources.staging import staged

VERTEX = "id long, reversed_domain string, num_hosts long"
EDGE = "from_id long, to_id long"
SNAPSHOT = "tld string, snapshot_date date, name string"


def owner_name(line: Column) -> Column:
    """The owner of a zone line: lower-case, without last dots; null for blanks, comments and directives."""
    bare = F.trim(line)
    return F.when((bare != "") & ~bare.rlike("^[;$]"), F.regexp_replace(F.lower(F.get(F.split(bare, r"\s+", 2), F.lit(0))), r"\.+$", ""))


def zone_names(spark: SparkSession, path: str, tld: str, partitions: int | None = None) -> DataFrame:
    """Distinct names (tld, name) of zone files. A gzip file is one task, so its lines are dealt out before they are
    made distinct."""
    rows = spark.read.text(path).select(owner_name(F.col("value")).alias("name")).filter("name <> ''")
    if partitions:
        rows = rows.repartition(partitions)
    return rows.distinct().select(F.lit(tld).alias("tld"), "name")


def snapshot(spark: SparkSession, path: str, tld: str | None = None, day: str | None = None) -> DataFrame:
    """A dated snapshot, only its partitions read; empty if there is none yet."""
    try:
        rows = spark.read.schema(SNAPSHOT).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], SNAPSHOT)
    if tld is not None:
        rows = rows.filter(F.col("tld") == tld)
    if day is not None:
        rows = rows.filter(F.col("snapshot_date") == F.lit(day).cast("date"))
    return rows.select("tld", "snapshot_date", "name")


def graph(spark: SparkSession, vertices: str, edges: str) -> tuple[DataFrame, DataFrame]:
    read = lambda schema, path: spark.read.schema(schema).option("sep", "\t").csv(path)
    return read(VERTEX, vertices), read(EDGE, edges)


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, one row with the count of corrupt ones)."""
    rows = spark.read.text(path).filter("trim(value) <> ''")
    parsed = rows.select(F.from_json("value", schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"), F.get_json_object("value", "$").rlike(r"^\{").alias("object"))
    good = F.col("r._corrupt").isNull() & F.coalesce(F.col("object"), F.lit(False))
    return parsed.filter(good).select("r.*").drop("_corrupt"), parsed.agg(F.count_if(~good).alias("corrupt"))


def payload_rows(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """Rows of a published payload that have a name; none if the file is missing or of another shape."""
    try:
        read = spark.read.schema(f"domains array<struct<{row_schema}>>").option("multiLine", True).json(path)
        return read.select(F.inline("domains")).filter("name is not null")
    except AnalysisException:
        return spark.createDataFrame([], row_schema)


def dated_payloads(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """Rows of all payloads in a folder with the date in their file name."""
    read = spark.read.schema(f"domains array<struct<{row_schema}>>").option("multiLine", True).json(path)
    day = F.to_date(F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})[^/]*$", 1))
    return read.withColumn("snapshot_date", day).select("snapshot_date", F.inline("domains")).filter("name is not null")


EXCERPT = "struct<snapshot_timestamp: string, title: string, meta_description: string, h1: array<string>, h2: array<string>>"


def excerpt_cache(spark: SparkSession, path: str) -> DataFrame:
    """(name, excerpt) of a JSON object of names; a null is a failure to remember, values of other kinds are dropped. None
    at all if the file is missing or no object."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], f"name string, excerpt {EXCERPT}")
    entries = whole.select(F.explode(F.from_json("value", "map<string, string>")).alias("name", "raw"))
    return entries.filter(F.col("raw").isNull() | F.col("raw").rlike(r"^\s*\{")).select("name", F.from_json("raw", EXCERPT).alias("excerpt"))


def archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All months of the event archive; empty before the first append."""
    try:
        return spark.read.schema(schema + ", month string").parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema + ", month string")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of log files, lines numbered from 0 in each. A file may be read in many splits: a line's number
    is its place in the split, after the lines of the splits before."""
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("at"), "value")
    lines = staged(read, "log")
    splits = lines.groupBy("file", "begin").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))  # one row a split
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(splits.withColumn("before", before).drop("n"), ["file", "begin"])
    return placed.select("file", (F.col("before") + F.col("at") - F.col("low")).alias("line_no"), "value")


def landed(spark: SparkSession, root: str) -> DataFrame:
    """Replies as they landed: JSON lines in a folder a source (`source=registry/..`), of which only those asked for are read."""
    return spark.read.schema("domain string, http_status int, body string, fetched_at timestamp, source string").json(root)
