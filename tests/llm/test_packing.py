import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonewright.llm import packing

DOCS = "doc_id long, text string, start string"


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.tokenizer_path())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t'.,<|endoftext|>1 日\x00\x85\u0301\U0001d400\U00020000\u01c5\u02b0\u0bbeª\u2028", max_size=60))
def test_ids_of_words_joined_are_the_ids_of_the_text(encoder, text):
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t'.,<|endoftext|>1²_#日\x00\x85\u0301\u2028", max_size=30), max_size=8))
def test_ids_of_texts_at_once_are_those_of_each(encoder, texts):
    wanted = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(texts)] == wanted
    assert sum((texts[a:b] for a, b in packing._slices(texts, 40)), []) == texts


@pytest.mark.parametrize("word", [" zqx.", " zqx###", " zqx42", " 7zqx@zqx.zqx"])
def test_marks_and_digits_of_a_word_take_no_encoding_of_their_own(encoder, monkeypatch, word):
    monkeypatch.setattr(encoder, "_plain", None)
    assert np.frombuffer(encoder._word(word), "<u4").tolist() == encoder.tokenizer.encode(word, add_special_tokens=False).ids


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 256), min_size=1, max_size=200))
def test_windows_hold_every_item_once_within_the_capacity(lengths):
    windows = packing.windows_for(lengths)
    assert sorted(i for w in windows for i in w) == list(range(len(lengths)))
    assert max(sum(lengths[i] for i in w) for w in windows) <= packing.CAPACITY


def test_differencing_balances():
    # the classic example: 8 7 6 5 4 in two parts gives 16 and 14
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2)) == [14, 16]


def check(rows, texts, encoder):
    pieces: dict = {}
    sequences: dict = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text in texts.items():
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces.pop(doc_id), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    assert not pieces
    for rows_ in sequences.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
    return sequences


def test_pack(spark, encoder):
    texts = {1: "a few words", 2: None, 3: "", 4: "long word " * 3000, 5: "x  y", None: "no id"} | {i: f"text {i} " * (i % 90) for i in range(10, 400)}
    df = spark.createDataFrame([(k, v, "clash") for k, v in texts.items()], DOCS)
    rows = packing.pack(df, packing.tokenizer_path()).collect()
    sequences = check(rows, texts, encoder)
    total = sum(r["length"] for r in rows)
    assert total / (packing.CAPACITY * len(sequences)) > 0.95
    again = packing.pack(df.repartition(7), packing.tokenizer_path()).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "same", ""), (1, "same", "")], DOCS)
    rows = packing.pack(df, packing.tokenizer_path()).collect()
    assert len(rows) == 2 and sorted(r["offset"] for r in rows) == [0, rows[0]["length"]]
    assert packing.pack(df.limit(0), packing.tokenizer_path()).count() == 0


def test_added_tokens_are_read_as_the_tokenizer_does(encoder):
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert 50256 in encoder.tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids


def test_a_hundred_thousand_rows_of_one_id(spark, encoder):
    df = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"), F.lit("a few words").alias("text"))
    out = packing.pack(df, packing.tokenizer_path())
    sizes = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count(F.lit(1)).alias("pieces"))
    assert out.count() == 100_000 and sizes.filter("n > 1024").isEmpty()
    assert out.agg(F.sum("length")).first()[0] / (1024 * sizes.count()) > 0.6  # blocks hold some 1,024 tokens of such short texts
    blocks = out.groupBy(F.shiftright("sequence_id", 32)).count().agg(F.max("count")).first()[0]
    assert blocks < 600


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    def told(*settings):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())] * 6, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy"])

        return run

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    monkeypatch.setattr(packing, "_pieces", told)
    monkeypatch.setattr(packing, "_pack", lambda capacity: lambda key, rows: rows.drop(columns="_block").assign(sequence_id=0, offset=0))
    df = spark.range(3500).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text")).coalesce(1)
    sizes = [r["doc_id"] for r in packing.pack(df, "").collect()]
    assert sum(sizes) == 3500 and max(sizes) <= 1000
    assert spark.conf.get(key, None) == before


def test_ids_are_written_in_little_memory(encoder):
    texts = [" ".join(f"{'zqxj' * 4}{(i * 37 + j) % 97}" for j in range(400)) for i in range(250)]
    wanted = [encoder.encode(t) for t in texts]
    tracemalloc.start()
    found = encoder.encode_all(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == wanted
    assert peak < 4 * sum(map(len, found))  # the result itself, a run's arrays of ids and places, and the words


def test_a_worker_drops_what_it_loaded_for_another_step():
    from zonewright.llm import common, jaccard_join

    texts = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three", None]), pa.array([0, 0])], names=["doc_id", "text", "copy"])
    rows = pa.RecordBatch.from_arrays([pa.array([b"1"]), pa.array([1]), pa.array(["one two three four five six"])], names=["row", "doc_id", "text"])
    path = packing.tokenizer_path()
    packed = [b.to_pydict() for b in packing._pieces(path, 1024, 256)(iter([texts]))]
    assert list(common._worker_state()) == [f"encoder {path} {packing.CACHED_WORDS}"]
    held = common._worker_state()[f"encoder {path} {packing.CACHED_WORDS}"]
    list(packing._pieces(path, 1024, 256)(iter([texts])))
    assert common._worker_state()[f"encoder {path} {packing.CACHED_WORDS}"] is held  # the tasks of one step share it
    list(jaccard_join._sets(5)(iter([rows])))
    assert list(common._worker_state()) == ["gram_words"]
    list(jaccard_join._children(jaccard_join.SKETCH, 0.8, range(1))(iter([])))
    assert list(common._worker_state()) == []
    assert [b.to_pydict() for b in packing._pieces(path, 1024, 256)(iter([texts]))] == packed
    packing._pack(1024)((0,), packing.pd.DataFrame({"doc_id": [1], "start": [0], "length": [4], "ids_crc32": [0], "_block": [0]}))
    assert list(common._worker_state()) == []


def test_pipeline_packs_with_less_memory_to_the_same_rows(spark, monkeypatch):
    import corpus_pipeline

    seen, pieces, whole = [], packing._pieces, packing.Remembered

    def told(*settings):
        step = pieces(*settings)

        def run(batches):
            yield from step(b for b in batches if b.num_rows <= 250)  # a larger batch would be missed below

        return run

    df = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(F.lit("a few words and number "), F.col("id")).alias("text")).coalesce(1)
    wanted = sorted(packing.pack(df, packing.tokenizer_path()).collect())
    monkeypatch.setattr(packing, "_pieces", told)
    monkeypatch.setattr(packing, "Remembered", lambda make, most: seen.append(most) or whole(make, most))
    assert sorted(corpus_pipeline.packed(spark, df, "").collect()) == wanted
    packing.Encoder(packing.tokenizer_path(), 100_000)
    assert seen == [100_000]
