import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonewright.llm import jaccard_join as jj


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=5))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(r.randrange(40, 160))]
        texts.append(" ".join(base))
        for _ in range(r.randrange(0, 6)):
            near = list(base)
            for _ in range(r.randrange(0, 5)):
                near[r.randrange(len(near))] = word()
            texts.append(" ".join(near))
    hot = [word() for _ in range(120)]
    for _ in range(150):  # a large group of near copies
        near = list(hot)
        for _ in range(r.randrange(1, 4)):
            near[r.randrange(len(near))] = word()
        texts.append(" ".join(near))
    return texts + [texts[0]] * 30 + ["", "   ", "one two", "ONE two", None, None]


def sets_of(texts):
    out = []
    for i, t in enumerate(texts):
        w = None if t is None else t.lower().split()
        out.append(("null", i) if w is None else frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(texts, threshold=0.8):
    sets = sets_of(texts)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links, text_links = defaultdict(int), defaultdict(set)
    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = a == b
            near = same or (isinstance(a, frozenset) and isinstance(b, frozenset) and a and b and len(a & b) >= threshold * len(a | b))
            if near:
                parent[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
                if not same:
                    text_links[i].add(b)
                    text_links[j].add(a)
    return [find(i) for i in range(len(texts))], links, text_links


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(corpus())], "doc_id long, text string, class_id string")


def test_classes_and_links_equal_brute_force(docs):
    texts = corpus()
    label, links, text_links = brute(texts)
    least = {}
    for i, x in enumerate(label):
        least[x] = min(least.get(x, i), i)
    rows = {r["doc_id"]: r for r in jj.classes(docs).collect()}
    assert len(rows) == len(texts)
    for i in range(len(texts)):
        assert rows[i]["class_id"] == least[label[i]]
        assert rows[i]["n_links"] == links[i] and rows[i]["n_text_links"] == len(text_links[i])


def test_deep_recursion_finds_the_same_classes(docs, monkeypatch):
    monkeypatch.setattr(jj, "SMALL", 4)
    monkeypatch.setattr(jj, "LEVELS", 3)
    monkeypatch.setattr(jj, "BLOCK", 16)
    label, links, _ = brute(corpus())
    rows = {r["doc_id"]: r for r in jj.classes(docs).collect()}
    classes = defaultdict(set)
    for i, x in enumerate(label):
        classes[x].add(rows[i]["class_id"])
    assert all(len(s) == 1 for s in classes.values()) and len(classes) == len({r["class_id"] for r in rows.values()})
    assert all(rows[i]["n_links"] == links[i] for i in rows)


def test_one_of_each_class_stays(docs):
    texts = corpus()
    label, _, _ = brute(texts)
    kept = jj.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted({min(i for i, x in enumerate(label) if x == y) for y in label})


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x")] * 3 + [(None, "other words", "x")] * 2 + [(2, None, "x")] * 2, "doc_id long, text string, _row string")
    assert sorted(map(tuple, jj.keep_one(df).collect()), key=str) == sorted([(1, "a b c d e f", "x"), (None, "other words", "x"), (2, None, "x")], key=str)
    assert jj.keep_one(df.limit(0)).count() == 0 and jj.classes(df.limit(0)).count() == 0


def test_sketch_agreement_estimates_similarity():
    g = np.random.default_rng(2)
    shared = g.integers(0, 1 << 32, 800, dtype=np.uint64).astype(np.uint32)
    a, b = (np.unique(np.concatenate([shared, g.integers(0, 1 << 32, 100, dtype=np.uint64).astype(np.uint32)])) for _ in range(2))
    assert abs((jj.sketch(a) == jj.sketch(b)).mean() - 0.8) < 0.15


def test_overlaps():
    g = np.random.default_rng(3)
    items = [np.unique(g.integers(0, 50, 20).astype(np.uint32)) for _ in range(7)]
    near = jj.similar(items, 0.4)
    for i in range(7):
        for j in range(7):
            a, b = set(items[i].tolist()), set(items[j].tolist())
            assert near[i, j] == (len(a & b) >= 0.4 * len(a | b))
    assert (jj.similar(items[:3], 0.4, items[3:]) == near[:3, 3:]).all()
    assert (jj.overlaps(items[:3], items[3:]) == jj.overlaps(items)[:3, 3:]).all()


def test_signatures_agree_as_sketches_do_and_more():
    g = np.random.default_rng(5)
    shared = g.integers(0, 1 << 32, 900, dtype=np.uint64).astype(np.uint32)
    sets = [np.unique(np.concatenate([shared[: 900 - 100 * k], g.integers(0, 1 << 32, 100 * k, dtype=np.uint64).astype(np.uint32)])) for k in range(8)]
    sketches = np.array([jj.sketch(s) for s in sets])
    signed = jj.signatures(sketches)
    for a in range(8):
        for b in range(8):
            x = signed[a] ^ signed[b]
            differ = int(np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum())
            assert differ == ((sketches[a] & 3) != (sketches[b] & 3)).sum()
    assert jj.least_agreement(0.8) == 92


def test_spanning_forest():
    a, b = jj.spanning_forest(np.array([5, 9, 30, 7, 40]), np.array([9, 7, 31, 8, 40]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(7, 5), (8, 5), (9, 5), (31, 30)]


def test_deep_buckets_get_the_runs_their_depth_needs(spark, monkeypatch):
    # pairs just above the threshold, among texts that share so much that buckets split many times
    monkeypatch.setattr(jj, "SMALL", 4)
    r = random.Random(7)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=6))
    shared, texts = [word() for _ in range(260)], []
    for _ in range(120):
        own = [word() for _ in range(140)]
        texts += [" ".join(shared + own), " ".join(shared + own[:100] + [word() for _ in range(40)])]
    label, links, _ = brute(texts)
    assert len(set(label)) == 120 and set(links.values()) == {1}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {x["doc_id"]: x["class_id"] for x in jj.classes(df).collect()}
    assert [i for i in range(0, 240, 2) if rows[i] != rows[i + 1]] == []
    assert len(set(rows.values())) == 120


def test_runs_grow_with_depth():
    assert jj.runs_for(jj.RECALL, jj.THRESHOLD) == 11
    needed = [jj.runs_for(jj.RECALL, jj.THRESHOLD, d) for d in range(2, jj.LEVELS + 1)]
    assert needed == sorted(needed) and needed[-1] > 35


def test_ten_splits_lose_few_pairs_at_the_threshold(spark, monkeypatch):
    # sketches of pairs at a similarity of 0.8 whose buckets are kept large by many sets that share their minima
    monkeypatch.setattr(jj, "SMALL", 2)
    g = np.random.default_rng(11)
    common = g.integers(0, 1 << 30, jj.SIGNATURE).astype(np.uint32)
    sketches = []
    for _ in range(60):
        own = np.where(g.random(jj.SIGNATURE) < 0.75, common, g.integers(0, 1 << 30, jj.SIGNATURE)).astype(np.uint32)
        other = np.where(g.random(jj.SIGNATURE) < 0.8, own, g.integers(0, 1 << 30, jj.SIGNATURE)).astype(np.uint32)
        sketches += [own, other]
    rows = [(i, bytearray(s[: jj.SKETCH].tobytes()), *map(int, jj.signatures(s[None])[0].view(np.int64))) for i, s in enumerate(sketches)]
    names = spark.createDataFrame(rows, "id long, sketch binary, " + ", ".join(f"{x} long" for x in jj._LONGS)).withColumn("label", F.col("id"))
    _, deep, depth = jj.candidate_links(names, range(3), 0.8)
    assert depth == jj.LEVELS and deep is not None
    label = {r["id"]: r["label"] for r in jj.candidate_groups(names.drop("label")).collect()}
    estimates = [(np.array(sketches[i]) == np.array(sketches[i + 1])).mean() for i in range(0, 120, 2)]
    near = [i for i, e in zip(range(0, 120, 2), estimates) if e >= 0.75]
    assert sum(label.get(i, i) == label.get(i + 1, i + 1) for i in near) >= 0.95 * len(near)


def test_large_groups_are_counted_by_distance_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 8)
    r = random.Random(13)
    word = lambda: "".join(r.choices("abcdefghijklmnop", k=6))
    base, texts = [word() for _ in range(200)], []
    for k in range(120):  # from very near to just linked to some
        near = list(base)
        for _ in range(k % 9):
            near[r.randrange(200)] = word()
        texts += [" ".join(near)] * (1 + k % 3)
    label, links, text_links = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {x["doc_id"]: x for x in jj.classes(df).collect()}
    assert len(rows) == len(texts) and len({x["class_id"] for x in rows.values()}) == len(set(label))
    assert all(rows[i]["n_links"] == links[i] and rows[i]["n_text_links"] == len(text_links[i]) for i in rows)


def test_a_very_long_text(spark):
    r = random.Random(17)
    words = [str(r.randrange(10**6)) for _ in range(300_000)]
    near = words[:150_000] + ["x"] + words[150_001:]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, "short text")], "doc_id long, text string")
    rows = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jj.classes(df).collect()}
    assert rows == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
