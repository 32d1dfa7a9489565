"""Language identification by fusing evidence in Bayes' way.

Four kinds of evidence speak for a language: the text (naive Bayes over hashed byte trigrams), the language that the
document declares, the suffix of its address, and what its host usually holds. The text model is fitted on at most
`SAMPLE` labelled texts a language (those with the least keyed hash). Everything else comes from grouped aggregation over
all documents: how often a declaration or suffix goes with a language as the text has it, and the languages of each host,
smoothed towards its site, the site towards its top-level domain, that towards the whole, each with the weight of `KAPPA`
documents. A document's own text does not count in its host's prior, and the declaration of a text that the model was
fitted on counts as none, as the model has it already. Texts are scored once and written with their scores.

One more class, `und`, stands for languages that the model does not know: every trigram has the same likelihood there, less
than an even share of all trigrams and more than one that a language has never shown. Texts in a foreign script go to it;
a short text that is half numbers and keys does not.

Posteriors under `least` mean that the evidence does not decide, and texts without a letter have none: such documents are
rejected, as are those of the class `und`, and those whose language is not among the wanted ones, if any are named.

Defined cases: null and empty texts have no letters and are rejected; a null declaration, suffix or host is no evidence
(the host falls back to its parents); repeated rows are judged alike and each counts in the aggregates; without labelled
texts every document is undecided; the label `und` is none; of more labels than the parameter `languages` the most frequent
ones are languages (ties by name), and texts of others go to the nearest one or to `und`; ties of languages go to the one first by name; a text of any length is read whole; an empty table gives no rows; other columns
are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import bounded_broadcast, lean, materialize, table, unused

SAMPLE = 300
#: Languages at most: the driver gathers one row of trigram counts (256 KB) for each.
LANGUAGES = 100
UNKNOWN = "und"
#: What a trigram that a language has not shown counts.
UNSEEN = 0.02
#: Where the unknown class lies between a trigram never seen (0) and an even share of all (1), in logs.
STRANGE = 0.25
BUCKETS = 1 << 15
KAPPA = 20.0
LEAST = 0.5
#: Trigrams of a text count as so many independent ones at most: neighbours depend on each other.
EVIDENCE = 60.0
#: Host rows up to which their table is broadcast; beyond, it is joined by a shuffle.
BROADCAST_HOSTS = 50_000

_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class TextModel:
    """Log likelihoods of hashed trigrams, [language, bucket]."""

    languages: list[str]
    table: np.ndarray
    #: (label, mark): the texts that it was fitted on, by their hash.
    sample: DataFrame | None = None


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of a whole text in lower case."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(17)


def fit_text_model(labelled: DataFrame, *, text: str = "text", label: str = "lang", sample: int = SAMPLE, languages: int = LANGUAGES) -> TextModel | None:
    """A model from at most `sample` texts of each of the `languages` most frequent labels, and the unknown class."""
    rows = labelled.select(F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text")).filter((F.col("label") != UNKNOWN) & (F.length("text") > 0))
    marks = rows.select("label", F.xxhash64("text").alias("mark")).distinct()
    # hashes are spread evenly: a share that leaves some four samples a label holds the least ones, and no task ranks more
    sizes = materialize(marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(languages), "labels")
    share = F.shiftrightunsigned("mark", 1) / F.lit(float(1 << 63)) * F.col("n")
    marks = marks.join(bounded_broadcast(sizes, BROADCAST_HOSTS), "label").filter(share <= 4 * sample).select("label", "mark")
    order = Window.partitionBy("label").orderBy(F.shiftrightunsigned("mark", 1), "mark")
    chosen = materialize(marks.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= sample).select("label", "mark"), "sample")
    texts = rows.withColumn("mark", F.xxhash64("text")).join(bounded_broadcast(chosen, BROADCAST_HOSTS), ["label", "mark"], "left_semi").dropDuplicates(["label", "mark"])
    # the sample is small: a few tasks sum its trigrams, and the driver gets a row for each label
    counted = texts.select("label", "text").repartition(4).mapInArrow(lean(_count_trigrams), "label string, counts binary")
    got = counted.groupBy("label").applyInPandas(_sum_counts, "label string, counts binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: r["label"])
    counts = np.array([np.frombuffer(r["counts"], np.int64) for r in got]) + UNSEEN
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    unseen, even = np.log(UNSEEN / counts.sum(axis=1).max()), -np.log(BUCKETS)
    unknown = np.full((1, BUCKETS), unseen + STRANGE * (even - unseen))
    return TextModel([*(r["label"] for r in got), UNKNOWN], np.concatenate([logs, unknown]).astype(np.float32), chosen)


def _sum_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
    return pd.DataFrame({"label": rows["label"].iloc[:1], "counts": [total.tobytes()]})


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held = counts.setdefault(label, np.zeros(BUCKETS, np.int64))
            held += np.bincount(trigrams(text), minlength=BUCKETS)
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array([c.tobytes() for c in counts.values()], pa.binary())], names=["label", "counts"])


def _scorer(model: TextModel | None):
    """A column function: log likelihoods of a text by language, or null if it has no letter."""

    weights = None if model is None else model.table

    def scored(texts: pa.Array) -> pa.Array:
        scores: list[list[float] | None] = []
        for text in texts:
            text = text.as_py() or ""
            if weights is None or not _LETTER.search(text):
                scores.append(None)
                continue
            at = trigrams(text)
            total = np.array([row[at].sum(dtype=np.float64) for row in weights])
            total *= min(1.0, EVIDENCE / len(at))
            scores.append((total - total.max()).tolist())
        return pa.array(scores, pa.list_(pa.float64()))

    @F.arrow_udf("array<double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from lean(lambda arrays: map(scored, arrays))(batches)

    return score


def _normal(logs: Column) -> Column:
    """Probabilities from log weights."""
    top = F.array_max(logs)
    raw = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raw, lambda x: x / F.aggregate(raw, F.lit(0.0), lambda a, y: a + y))


def address_parts(url: Column) -> dict[str, Column]:
    """host, site (its last two labels), top (the last one) and suffix (a country domain or two-letter first path) of a url."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1))
    host = F.when(host != "", F.regexp_replace(host, r"^www\.", ""))
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/([a-zA-Z]{2})(?:[/?#]|$)", 1)
    top = F.substring_index(host, ".", -1)
    return {"host": host, "site": F.substring_index(host, ".", -2), "top": top, "suffix": F.coalesce(F.when(path != "", F.lower(path)), F.when(F.length(top) == 2, top))}


def identify(docs: DataFrame, model: TextModel | None, *, text: str = "text", declared: Column | None = None, suffix: Column | None = None, host: list[Column] | None = None, least: float = LEAST, wanted: list[str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """docs with language, language_probability and language_kept (under other names where those are taken).

    declared, suffix: evidence columns; host: the host and its parents, from narrow to wide; drop: columns of docs, the
    text for one, that the result leaves out.
    """
    languages = model.languages if model else [UNKNOWN]
    n = len(languages)
    none = F.lit(None).cast("string")
    levels = list(host or [])
    names = [f"_h{i}" for i in range(len(levels))]
    evidence = {"declared": declared, "suffix": suffix}

    score = _scorer(model)

    columns = [c for c in docs.columns if c not in drop]
    # the kept columns in a struct, the evidence, and the text's log likelihoods
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("kept"),
        *[(c if c is not None else none).cast("string").alias(k) for k, c in evidence.items()],
        *[c.cast("string").alias(k) for k, c in zip(names, levels, strict=True)],
        score(F.col(text).cast("string")).alias("score"),
        F.xxhash64(F.col(text).cast("string")).alias("mark"),
    )
    if model is not None and model.sample is not None and declared is not None:  # LANGUAGES times SAMPLE rows at most
        fitted = model.sample.select("mark", F.col("label").alias("fitted"))
        rows = rows.join(F.broadcast(fitted), (rows["mark"] == fitted["mark"]) & (F.col("declared") == F.col("fitted")), "left").drop(fitted["mark"])
        rows = rows.withColumn("declared", F.when(F.col("fitted").isNull(), F.col("declared"))).drop("fitted")
    rows = materialize(rows.drop("mark").withColumn("p", F.when(F.col("score").isNotNull(), _normal(F.col("score")))), "language-scores")
    seen = rows.filter("p is not null").drop("kept", "score")
    per_language = [F.sum(F.get("p", F.lit(i))).alias(f"n{i}") for i in range(n)]
    totals = seen.agg(*per_language).first()
    overall = [float(totals[f"n{i}"] or 0.0) + 1.0 for i in range(n)]
    prior = F.array(*[F.lit(x / sum(overall)) for x in overall])

    def counted(keys: list[str]) -> DataFrame:
        return seen.filter(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(*per_language)

    tables = {}
    for k, c in evidence.items():
        if c is not None:
            # how often each value goes with a language, smoothed towards its share of all documents with a value
            values = counted([k])
            share = values.agg(*[F.sum(f"n{i}").alias(f"t{i}") for i in range(n)])
            everyone = sum((F.col(f"t{i}") for i in range(n)), F.lit(0.0))
            value = sum((F.col(f"n{i}") for i in range(n)), F.lit(0.0))
            logs = F.array(*[F.log((F.col(f"n{i}") + KAPPA * value / everyone) / (F.col(f"t{i}") + KAPPA)) for i in range(n)])
            tables[k] = materialize(values.crossJoin(F.broadcast(share)).select(F.col(k), logs.alias(f"{k}_log")), f"language-{k}")
    if levels:
        # from the widest to the narrowest: counts of the level, with KAPPA documents of its parent's distribution
        smooth = None
        for i in reversed(range(len(levels))):
            keys = names[i:]
            level = counted(keys).withColumn("own", F.array(*[F.col(f"n{j}") for j in range(n)])).select(*keys, "own")
            if smooth is None:
                level = level.withColumn("parent", prior)
            else:
                level = level.join(smooth.select(*names[i + 1 :], F.col("smooth").alias("parent")), names[i + 1 :])
            size = F.aggregate("own", F.lit(0.0), lambda a, x: a + x)
            smooth = level.withColumn("smooth", F.zip_with("own", "parent", lambda a, b: (a + KAPPA * b) / (size + KAPPA)))
        tables["host"] = materialize(smooth.select(*names, "own", "parent"), "language-hosts")

    for k, t in tables.items():
        keys = names if k == "host" else [k]
        rows = rows.join(bounded_broadcast(t, BROADCAST_HOSTS), keys, "left")
    terms = [F.col("score")] + [F.coalesce(F.col(f"{k}_log"), F.array(*[F.lit(0.0)] * n)) for k in tables if k != "host"]
    if "host" in tables:
        # the document's own text leaves its host's counts
        rest = F.zip_with("own", "p", lambda a, b: F.greatest(a - b, F.lit(0.0)))
        at_host = F.zip_with(rest, "parent", lambda a, b: F.log(a + KAPPA * b + 1e-9))
        terms.append(F.coalesce(at_host, F.transform(prior, lambda x: F.log(x))))
    else:
        terms.append(F.transform(prior, lambda x: F.log(x)))
    total = terms[0]
    for t in terms[1:]:
        total = F.zip_with(total, t, lambda a, b: a + b)
    rows = rows.withColumn("posterior", F.when(F.col("score").isNotNull(), _normal(total)))
    best = F.array_max("posterior")
    language = F.get(F.array(*[F.lit(x) for x in languages]), (F.array_position("posterior", best) - 1).cast("int"))
    kept = F.coalesce((best >= least) & (language != UNKNOWN) & (language.isin(wanted) if wanted is not None else F.lit(True)), F.lit(False))
    out = [unused(columns, x) for x in ("language", "language_probability", "language_kept")]
    return rows.select(*[F.col(f"kept.`{c}`").alias(c) for c in columns], F.coalesce(language, F.lit(UNKNOWN)).alias(out[0]), best.alias(out[1]), kept.alias(out[2]))


def identify_documents(docs: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Documents: the column lang is the declaration and the label of the text model's sample; source is the host, and its
    name without the number at its end the family above it. They have no addresses."""
    return identify(docs, fit_text_model(docs), declared=F.col("lang"), host=[F.col("source"), F.regexp_replace(F.col("source"), "[0-9]+$", "")], drop=drop)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language the evidence decides, with their own columns."""
    found = identify_documents(docs)
    return found.filter(found.columns[-1]).select(*docs.columns)


def op2_language_id(spark, sf_dir):
    out = identify_documents(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), drop=("text",))
    out = out.withColumn("language_probability", F.round("language_probability", 6))
    return out.withColumnRenamed("language_kept", "kept")


def language_id_pages(spark, sf_dir):
    """Web pages: markup language, address suffix, and host, site and top-level domain; the text is the page without
    its markup, the text model comes from the documents."""
    pages = table(spark, sf_dir, "pages")
    plain = F.regexp_replace(F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    parts = address_parts(F.col("url"))
    rows = pages.select("page_id", "url", plain.alias("text"), F.lower(F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-z]{2})", 1), F.lit(""))).alias("markup"))
    out = identify(rows, fit_text_model(table(spark, sf_dir, "documents")), declared=F.col("markup"), suffix=parts["suffix"], host=[parts["host"], parts["site"], parts["top"]], drop=("text",))
    return out.select("page_id", "markup", "language", F.round("language_probability", 6).alias("language_probability"), "language_kept")
