"""Quality rules: gradient-boosted trees over document statistics, scored from flat node arrays.

A document is described by counts over its whole text. Base rules reject the clear cases; the trees judge the rest.
They are fitted on at most `sample` labelled rows (the ones with the smallest keyed hash of doc_id), with logistic loss,
histogram splits and monotonic constraints: more repetition, duplicate lines or symbols can never raise a score. Each
tree is a complete binary tree, so all trees together are three numpy arrays, and a batch of documents walks them
level by level without a Python loop over rows.

Defined cases: null text counts as no text (no words, base_failed); a null doc_id is passed through; repeated rows are
judged alike; texts of any length are counted whole, by one task each; labels that contradict each other count as the
better one; without labelled rows of both kinds there is no verdict but the base rules' (score null); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import table

#: Most labelled rows that the trees are fitted on.
SAMPLE = 6000
KEEP_FROM = 0.5
WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_stops", "n_lines", "n_distinct")
#: Features of the trees with the sign that a larger value may have on the score (0: free).
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": -1,
    "stops_per_word": 0,
    "distinct_share": 0,
}

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CLASS = (_UPPER * 1 + _DIGIT * 2 + _STOP * 4 + _SPACE * 8).astype(np.uint8)


def repeat_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """(words that stand in a window of `window` words found twice or more, distinct words)."""
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    distinct = len(number)
    m = n - window + 1
    if m < 2:
        return 0, distinct
    code, base = ids[:m].copy(), distinct
    for k in range(1, window):
        if base > (1 << 62) // distinct:  # number the prefixes anew, so that codes stay exact
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            base = int(code.max()) + 1
        code = code * distinct + ids[k : k + m]
        base *= distinct
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0, distinct
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    ends = np.zeros(n + 1, np.int64)
    ends[:m] += twice
    ends[window : window + m] -= twice
    return int((np.cumsum(ends[:n]) > 0).sum()), distinct


def counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at ASCII white space only, as the contract's word pattern has it
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=16)
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    repeats, distinct = repeat_words(words)
    spaces = int(kinds[8:].sum())
    return (len(words), len(text) - spaces, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeats, int(kinds[1]), int(kinds[2]), int(kinds[4]), len(lines), distinct)


def features(c: np.ndarray) -> np.ndarray:
    """FEATURES as columns, from rows of COUNTS."""
    words, chars, symbols, dups, repeats, upper, digits, stops, lines, distinct = c.T.astype(np.float64)
    some, some_chars = np.maximum(words, 1), np.maximum(chars, 1)
    return np.column_stack([np.log1p(words), chars / some, symbols / some, dups / np.maximum(lines, 1), repeats / some, upper / some_chars, digits / some_chars, stops / some, distinct / some])


@dataclass
class Trees:
    """All trees as arrays [tree, node]; node i has children 2i+1 and 2i+2, the last level holds the values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, depth = np.arange(len(self.feature))[None, :], int(np.log2(self.value.shape[1]))
        out = np.empty(len(x))
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            rows, node = np.arange(len(part))[:, None], np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.threshold[trees, node])
            out[at : at + 4096] = self.value[trees, node - (self.value.shape[1] - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-(out + self.start)))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], *, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: float = 5.0) -> Trees | None:
    """Boosted trees with logistic loss; None if y has one kind only. signs: monotonic constraint for each column."""
    if len(y) == 0 or y.min() == y.max():
        return None
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T]
    binned = np.column_stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T, strict=True)])
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin, leaves = np.full(len(y), start), 2**depth
    inner = leaves - 1
    feature, threshold, value = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, leaves))
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        low, high = np.full(2 * leaves - 1, -np.inf), np.full(2 * leaves - 1, np.inf)
        weight = np.zeros(2 * leaves - 1)
        weight[0] = -grad.sum() / (hess.sum() + ridge)
        for i in range(inner):
            inside = np.flatnonzero(node == i)
            left, right = 2 * i + 1, 2 * i + 2
            weight[left] = weight[right] = weight[i]
            low[left], high[left], low[right], high[right] = low[i], high[i], low[i], high[i]
            best = 1e-6
            g, h = grad[inside], hess[inside]
            total_g, total_h = g.sum(), h.sum()
            for f, sign in enumerate(signs):
                n = len(edges[f])
                if not n or len(inside) < 2 * least:
                    continue
                gl = np.cumsum(np.bincount(binned[inside, f], g, n + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[inside, f], h, n + 1))[:-1]
                cl = np.cumsum(np.bincount(binned[inside, f], minlength=n + 1))[:-1]
                wl = np.clip(-gl / (hl + ridge), low[i], high[i])
                wr = np.clip(-(total_g - gl) / (total_h - hl + ridge), low[i], high[i])
                gain = -(gl * wl + 0.5 * (hl + ridge) * wl**2) - ((total_g - gl) * wr + 0.5 * (total_h - hl + ridge) * wr**2) + (total_g * weight[i] + 0.5 * (total_h + ridge) * weight[i] ** 2)
                gain[(cl < least) | (len(inside) - cl < least) | (sign * (wr - wl) < 0)] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, feature[t, i], threshold[t, i] = gain[k], f, edges[f][k]
                    weight[left], weight[right] = wl[k], wr[k]
                    if sign:
                        mid = (wl[k] + wr[k]) / 2
                        low[left], high[left], low[right], high[right] = low[i], high[i], low[i], high[i]
                        (high if sign > 0 else low)[left], (low if sign > 0 else high)[right] = mid, mid
                    else:
                        low[left], high[left], low[right], high[right] = low[i], high[i], low[i], high[i]
            node[inside] = left + (x[inside, feature[t, i]] > threshold[t, i])
        value[t] = rate * weight[inner:]
        margin += value[t, node - inner]
    return Trees(feature, threshold, value, start)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = np.array([counts(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, c.T)], names=["doc_id", *COUNTS])


_COUNTED = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_count, _COUNTED)


def fit_on_labels(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Trees | None:
    """Trees from at most `sample` labelled rows; which rows depends on their doc_id only."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    rows = statistics(texts).groupBy("doc_id").agg(*[F.max(c).alias(c) for c in COUNTS]).join(F.broadcast(chosen), "doc_id").toPandas().sort_values("doc_id")
    x = features(rows[list(COUNTS)].to_numpy(np.int64).reshape(-1, len(COUNTS)))
    return fit(x, rows["quality"].to_numpy(np.float64), list(FEATURES.values()))


def _judge(trees: Trees | None, keep_from: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _count(batches):
            c = np.column_stack([batch.column(i).to_numpy() for i in range(1, 1 + len(COUNTS))])
            failed = (c[:, 0] < 10) | (100 * c[:, 4] > 20 * c[:, 0])
            score = trees.score(features(c)) if trees is not None and len(c) else np.full(len(c), np.nan)
            kept = ~failed & ~(score < keep_from)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(failed), pa.array(kept), pa.array(score, pa.float64(), mask=np.isnan(score))], names=["doc_id", *COUNTS[:5], "base_failed", "kept", "score"])

    return run


def judge(docs: DataFrame, trees: Trees | None, *, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: the counts, base_failed, kept and the trees' score."""
    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS[:5]), "base_failed boolean, kept boolean, score double"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_judge(trees, keep_from), schema)


def op4_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit_on_labels(docs, table(spark, sf_dir, "labels")))
