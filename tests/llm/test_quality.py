import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from zonewright.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\té#\x1c\x85 ", max_size=120))
def test_counts_equal_brute_force(text):
    assert quality.counts(text)[:5] == brute(text)


def test_counts_of_many_distinct_words():
    r = random.Random(3)
    words = [f"w{r.randrange(9000)}" for _ in range(20000)]
    words[15000:15040] = words[100:140]
    text = " ".join(words)
    assert quality.counts(text)[:5] == brute(text)


def test_trees_learn_and_keep_their_constraints():
    g = np.random.default_rng(1)
    x = g.uniform(size=(3000, 3))
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.2)).astype(float)
    y[g.uniform(size=3000) < 0.05] = 1
    trees = quality.fit(x, y, [-1, 1, 0])
    held = g.uniform(size=(2000, 3))
    truth = (held[:, 0] < 0.6) & (held[:, 1] > 0.2)
    assert ((trees.score(held) >= 0.5) == truth).mean() > 0.93
    line = np.linspace(0, 1, 101)
    for other in g.uniform(size=(20, 3)):
        for column, sign in ((0, -1), (1, 1)):
            probe = np.tile(other, (101, 1))
            probe[:, column] = line
            assert (sign * np.diff(trees.score(probe)) >= -1e-12).all()


def test_one_kind_of_label_gives_no_trees():
    assert quality.fit(np.zeros((5, 2)), np.ones(5), [0, 0]) is None


def test_judge(spark):
    good = " ".join(f"word{i}." for i in range(100))
    docs = spark.createDataFrame([(1, good, 0), (2, None, 0), (3, "", 0), (4, "same words again and now " * 20, 0), (None, good, 0), (1, good, 0)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = sorted((r["doc_id"] or 0, r["base_failed"], r["kept"], r["score"]) for r in quality.judge(docs, quality.fit_on_labels(docs, labels)).collect())
    assert rows == [(0, False, True, None), (1, False, True, None), (1, False, True, None), (2, True, False, None), (3, True, False, None), (4, True, False, None)]
    assert quality.judge(docs.limit(0), None).count() == 0


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    trees = quality.fit_on_labels(docs, labels.filter("doc_id % 2 = 0"))
    held = quality.judge(docs, trees).join(labels.filter("doc_id % 2 = 1"), "doc_id").select("quality", "kept").collect()
    assert sum((r["quality"] == 1) == r["kept"] for r in held) > 0.95 * len(held)


def test_flat_arrays_score_as_walking_the_nodes_does():
    g = np.random.default_rng(4)
    x, y = g.uniform(size=(800, 4)), g.integers(0, 2, 800).astype(float)
    x[::7, 2] = x[3, 2]  # ties at a threshold
    trees = quality.fit(x, y, [0, 1, -1, 0], rounds=12)
    edges = trees.threshold[np.isfinite(trees.threshold)]
    x[:50, :] = g.choice(edges, (50, 4))  # values right at thresholds
    for row, score in zip(x, trees.score(x), strict=True):
        total = trees.start
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (1 if row[feature[node]] <= threshold[node] else 2)
            total += value[node - len(feature)]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-12


def test_the_query_reads_every_text_whole(spark):
    d = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in quality.op4_quality_rules(spark, d).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert set(rows) == set(docs)
    for k, r in rows.items():
        n, chars, symbols, dups, repeats = brute(docs[k] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dups, repeats)
        assert r["base_failed"] == (n < 10 or 100 * repeats > 20 * n) and (not r["base_failed"] or not r["kept"])


def test_a_very_long_text():
    text = ("some words that go on " * 60_000) + "end"
    assert quality.counts(text)[:5] == brute(text)
