import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonewright.llm import fingerprints as fp


def slow_fingerprint(text):
    raw = text.encode()

    def rolled(i):
        window = [raw[j] if j >= 0 else 0 for j in range(i - 6, i + 1)][::-1]
        mixed = 0
        for k, b in enumerate(window):
            mixed ^= (b << 5 * k) & 0xFFFFFFFF
        return (sum((8 - k) * b for k, b in enumerate(window)) + mixed) & 0xFFFFFFFF

    def ends(size):
        return [i for i in range(len(raw)) if rolled(i) % size == size - 1]

    def signature(size):
        marks = [0, *[i + 1 for i in ends(size)[:63]]]
        if marks[-1] != len(raw):
            marks.append(len(raw))
        return "".join(fp._LETTERS[zlib.crc32(raw[a:b]) & 63] for a, b in zip(marks, marks[1:]))

    size = 3
    while size * 64 < len(raw):
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=900))
def test_fingerprint_equals_the_slow_one(text):
    text = text.encode("utf-8", "ignore").decode()
    assert fp.fingerprint(text) == slow_fingerprint(text)


def test_stretches_do_not_matter(monkeypatch):
    text = "".join(random.Random(5).choices("abcdefgh ", k=5000))
    whole = fp.fingerprint(text)
    monkeypatch.setattr(fp, "_STRETCH", 97)
    assert fp.fingerprint(text) == whole == slow_fingerprint(text)


@given(st.text(alphabet="abc", max_size=30), st.text(alphabet="abc", max_size=30))
def test_common_length(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    assert fp.common_length(a, b) == table[-1, -1]


def test_edits_stay_near():
    r = random.Random(7)
    text = " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(900))
    other = " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(900))
    near = text[:2000] + "inserted" + text[2000:]
    a, b, c = map(fp.fingerprint, (text, near, other))
    assert fp.likeness(a, b) > 0.9 and fp.likeness(a, c) == 0 and fp.likeness(a, a) == 1


def test_every_row_meets_the_next(spark):
    r = random.Random(9)
    texts = {i * 7: "".join(r.choices("abc dé", k=r.randrange(0, 300))) for i in range(203)}
    texts[7], texts[14] = None, ""
    df = spark.createDataFrame([(k, v, "clash") for k, v in texts.items()], "doc_id long, text string, range string")
    for frame in (fp.compare_with_next(df, 20), fp.compare_with_next(df.repartition(5), 500)):
        rows = {x["doc_id"]: x for x in frame.collect()}
        keys = sorted(texts)
        assert sorted(rows) == keys
        for i, k in enumerate(keys):
            text, after = texts[k] or "", texts[keys[(i + 1) % len(keys)]] or ""
            changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
            x = rows[k]
            assert x["n_chars"] == len(text) and x["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
            assert x["fingerprint"] == fp.fingerprint(text) and x["edited_fingerprint"] == fp.fingerprint(changed)
            assert x["near_next"] == fp.likeness(fp.fingerprint(text), fp.fingerprint(after))


def test_ties_nulls_single_and_empty(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (None, "n"), (1, "a")], "doc_id long, text string")
    assert fp.compare_with_next(df).count() == 4
    one = fp.compare_with_next(df.filter("doc_id is null")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fp.compare_with_next(df.limit(0)).count() == 0


def test_shared_and_null_ids_are_split_and_ordered(spark):
    r = random.Random(10)
    some = lambda: "".join(r.choices("abc ", k=r.randrange(1, 40)))
    rows = [(5, some()) for _ in range(300)] + [(5, "same text")] * 400 + [(None, some()) for _ in range(150)] + [(None, "x")] * 200 + [(i, some()) for i in range(-40, 40) if i != 5]
    df = spark.createDataFrame([(*x, k) for k, x in enumerate(rows)], "doc_id long, text string, k long")
    dealt = fp.ranges(df, 20).groupBy("range", "piece").count().collect()
    assert max(x["count"] for x in dealt) < 120 and len(dealt) > 40
    order = [(x["doc_id"], x["text"]) for x in df.select("doc_id", "text", F.xxhash64("text").alias("tie")).orderBy(F.col("doc_id").asc_nulls_first(), "tie", "text").collect()]
    got = sorted((x["doc_id"] is not None, x["doc_id"], x["fingerprint"], x["edited_sha256"], x["near_next"]) for x in fp.compare_with_next(df, 20).collect())
    want = []
    for i, (k, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        want.append((k is not None, k, fp.fingerprint(text), hashlib.sha256(changed.encode()).hexdigest(), fp.likeness(fp.fingerprint(text), fp.fingerprint(after))))
    assert got == sorted(want)


def test_a_hundred_thousand_rows_of_one_id(spark):
    df = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    sizes = fp.ranges(df).groupBy("range", "piece").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] < 1000 and sizes[1] > 150
    assert fp.compare_with_next(df).count() == 100_000


def test_texts_of_equal_length_always_meet():
    r = random.Random(12)
    for n in (6, 12, 40, 900, 33_047):
        text = "".join(r.choices("abcdefgh ", k=n))
        other = text[: n - n // 2] + "".join(r.choices("ijklm", k=n // 2))
        a, b = fp.fingerprint(text), fp.fingerprint(other)
        assert a.split(":")[0] == b.split(":")[0]
        assert n < 40 or fp.likeness(a, b) > 0.2
