"""The pipeline against a version that does every stage in plain Python, on a small corpus."""

import sys
import zlib
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from zonewright.llm import packing  # noqa: E402

from tests.llm.test_jaccard import brute  # noqa: E402


def test_stages(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    junk = spark.createDataFrame([(10_001, "12 34 !!", "en", "src0", 8), (10_002, None, "en", "src0", None), (10_003, "call bob@mail.example.com " + "plain words here " * 9, "en", "src1", 177)], source.schema)
    source.unionByName(junk).unionByName(source.limit(3)).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    all_ids = {r["doc_id"] for r in docs.collect()}
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = docs.collect()
    assert {r["doc_id"] for r in kept["language ID"]} == all_ids - {10_001, 10_002}
    before = kept["language ID"]
    label, _, _ = brute([r["text"] for r in before])
    least = {}
    for r, x in zip(before, label, strict=True):
        least[x] = min(least.get(x, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in kept["n-gram Jaccard join"]) == sorted(least.values())
    assert sorted(r["doc_id"] for r in kept["PII"]) == sorted(least.values())
    assert not any("bob@mail" in r["text"] for r in kept["PII"])
    texts = {r["doc_id"]: r["text"] for r in kept["PII"]}
    assert {r["doc_id"]: r["text"] for r in kept["mixing sources"]} == texts
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    encoder = packing.Encoder(packing.tokenizer_path())
    want = sum(len(encoder.encode(r["text"])) // 4 + 1 for r in kept["mixing sources"])
    assert sum(r["length"] for r in rows) == want
    for r in rows[:200]:
        ids = encoder.encode(texts[r["doc_id"]]) + np.array([0], "<u4").tobytes()
        assert zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"]


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars int, class string, language string, mix_pass int, copy int, _row string"
    rows = [(i, f"plain words number {i} and some more of them", "en", "src0", 9, "a", "b", 1, 2, "c") for i in range(30)] + [(None, None, None, None, None, None, None, None, None, None)] * 2
    for k, part in enumerate((rows, [])):
        d = tmp_path / f"t{k}"
        spark.createDataFrame(part, schema).write.parquet(str(d / "documents.parquet"))
        docs = spark.read.parquet(str(d / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(d))
            assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in spark.read.parquet(str(d / "documents.parquet")).schema]
        found = corpus_pipeline.run(spark, str(d)).collect()
        assert {r["doc_id"] for r in found} == {r[0] for r in part if r[1]}


def test_run_is_registered(spark):
    from zonewright.llm import registry

    assert registry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert {f"op{n}_" for n in range(1, 11)} <= {q.split("_")[0] + "_" for q in registry.queries()}
