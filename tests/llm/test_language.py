import re

import numpy as np
from pyspark.sql import functions as F

from zonewright.llm import language

SAMPLE = {"en": "the house stands where the river bends and the people walk there", "de": "das haus steht wo der fluss sich biegt und die leute gehen dort", "fr": "la maison est là où la rivière tourne et les gens marchent"}


def corpus(spark, extra=()):
    rows = [(i, " ".join(SAMPLE[k].split()[i % 4 :] * 3), k, f"src{i % 3}") for i, k in enumerate(list(SAMPLE) * 20)]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string, source string")


def test_evidence_decides(spark):
    extra = [(900, None, "en", "src0"), (901, "", None, None), (902, "1234 !!", "en", "src0"), (903, SAMPLE["de"], None, None), (904, SAMPLE["fr"], "en", "new"), (905, SAMPLE["en"], "en", "src0"), (905, SAMPLE["en"], "en", "src0")]
    docs = corpus(spark, extra).withColumn("language", F.lit("clash"))
    out = language.identify_documents(docs)
    assert out.columns == [*docs.columns, "_language", "language_probability", "language_kept"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert [rows[i]["language_kept"] for i in (900, 901, 902)] == [False] * 3 and rows[901]["_language"] == "und"
    assert rows[903]["_language"] == "de" and rows[903]["language_kept"]
    assert rows[905]["_language"] == "en" and out.filter("doc_id = 905").count() == 2
    assert all(rows[i]["_language"] == rows[i]["lang"] and rows[i]["language_kept"] for i in range(60))
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == out.count() - 3


def test_posterior_equals_a_plain_computation(spark):
    docs = corpus(spark)
    model = language.fit_text_model(docs)
    fitted = {r["mark"] for r in model.sample.collect()}
    n = len(model.languages)
    docs = docs.union(spark.createDataFrame([(100 + i, f"{SAMPLE[k]} {i}", k if i % 4 else None, f"src{i % 2}") for i, k in enumerate(list(SAMPLE) * 7)], docs.schema)).withColumn("mark", F.xxhash64("text"))
    rows = language.identify(docs, model, declared=F.col("lang"), host=[F.col("source"), F.lit("all")]).collect()
    assert {r["mark"] in fitted for r in rows} == {True, False}

    def normal(x):
        x = np.exp(np.array(x) - max(x))
        return x / x.sum()

    def score(text):
        at = language.trigrams(text)
        total = np.array([r[at].sum(dtype=np.float64) for r in model.table]) * min(1.0, language.EVIDENCE / len(at))
        return total - total.max()

    p = {r["doc_id"]: normal(score(r["text"])) for r in rows}
    overall = sum(p.values()) + 1
    prior = overall / overall.sum()
    said = {r["doc_id"]: None if r["mark"] in fitted else r["lang"] for r in rows}
    declared = {k: sum(p[r["doc_id"]] for r in rows if said[r["doc_id"]] == k) for k in SAMPLE}
    share = sum(declared.values())
    smooth = lambda own, parent: (own + language.KAPPA * parent) / (own.sum() + language.KAPPA)
    wide = smooth(sum(p.values()), prior)
    host = {k: sum(p[r["doc_id"]] for r in rows if r["source"] == k) for k in ("src0", "src1", "src2")}
    for r in rows:
        own = p[r["doc_id"]]
        d = declared.get(said[r["doc_id"]])
        logs = score(r["text"]) + (0 if d is None else np.log((d + language.KAPPA * d.sum() / share.sum()) / (share + language.KAPPA))) + np.log(np.maximum(host[r["source"]] - own, 0) + language.KAPPA * wide + 1e-9)
        want = normal(logs)
        assert abs(want.max() - r["language_probability"]) < 1e-6 and model.languages[int(want.argmax())] == r["language"]
    assert n == 4 and model.languages[-1] == "und"


def test_address_parts(spark):
    df = spark.createDataFrame([("http://www.shop.example.fr/de/1?x",), ("https://a.com/page",), ("junk",), (None,)], "u string")
    parts = language.address_parts(F.col("u"))
    assert [tuple(r) for r in df.select(*[parts[k] for k in ("host", "site", "top", "suffix")]).collect()] == [("shop.example.fr", "example.fr", "fr", "de"), ("a.com", "a.com", "com", None), (None,) * 4, (None,) * 4]


def test_no_labels_and_empty_tables(spark):
    docs = corpus(spark)
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["language_kept"] for r in language.identify_documents(none).collect()} == {False}
    assert language.identify_documents(docs.limit(0)).count() == 0


def test_foreign_texts_are_rejected_and_noise_is_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    foreign = ["Ο ποταμός στρίβει εκεί που στέκεται το σπίτι και οι άνθρωποι περπατούν", "房子立在河流转弯的地方，人们在那里行走", "Дом стоит там, где река поворачивает, и люди ходят туда"]
    noisy = [f"{t} 4734663219866878 +1 (545) 555-9112 token = 40d78a45c418324758e099eb7cb89bc0f5fa9f62" for t in (r["text"][:60] for r in docs.filter("length(text) > 60").orderBy("doc_id").limit(20).collect())]
    rows = [(-1 - i, t, lang, "new") for i, t in enumerate(foreign) for lang in (None, "en")] + [(-100 - i, t, None, "new") for i, t in enumerate(noisy)]
    every = docs.union(spark.createDataFrame(rows, docs.schema))
    found = language.identify(every, language.fit_text_model(docs), declared=F.col("lang"), host=[F.col("source")])
    out = {(r["doc_id"], r["lang"]): r for r in found.collect()}
    assert all(r["language_kept"] for (i, _), r in out.items() if i >= 0 and r["text"] and re.search(r"[^\W\d_]", r["text"]))
    for i, _, lang, _ in rows:
        assert out[i, lang]["language_kept"] == (i <= -100) and (i <= -100 or out[i, lang]["language"] == "und")


def test_labels_beyond_the_bound_and_und(spark):
    docs = corpus(spark, [(900 + i, "la maison est là", "und", None) for i in range(50)])
    model = language.fit_text_model(docs, languages=2)
    assert model.languages == ["de", "en", "und"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit_text_model(docs.filter("doc_id % 2 = 0"))
    rows = language.identify(docs.filter("doc_id % 2 = 1"), model).collect()
    assert sum(r["language"] == r["lang"] for r in rows) > 0.97 * len(rows)
    assert not any(re.search(r"[^\W\d_]", r["text"]) and not r["language_kept"] for r in rows)


def test_pages_equal_a_plain_computation(spark, tmp_path):
    docs = corpus(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    page = lambda lang, body: f'<html{lang}><script>var x = "the house";</script><p>{body}</p></html>'
    made = [("http://a.example.de/en/1", ' lang="de"', SAMPLE["de"]), ("http://a.example.de/2", "", SAMPLE["de"]), ("http://b.example.de/fr/2", ' lang="fr"', SAMPLE["fr"]), ("https://www.x.org/", " LANG=en", SAMPLE["en"])]
    made += [("http://a.example.de/en/9", ' lang="en"', "das people haus walk"), (None, ' lang="en"', SAMPLE["en"]), ("http://a.example.de/7", None, None), ("junk", "", "1234"), ("http://x.org/9", "", SAMPLE["en"])]
    pages = [(i, u, None if b is None else page(lang, b)) for i, (u, lang, b) in enumerate(made)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r for r in language.language_id_pages(spark, str(tmp_path)).collect()}
    model, kappa = language.fit_text_model(docs), language.KAPPA

    def normal(x):
        x = np.exp(np.array(x) - max(x))
        return x / x.sum()

    facts = {}
    for i, url, html in pages:
        text = re.sub(r"<[^>]*>", " ", re.sub(r"(?is)<script.*?</script>", " ", html)) if html is not None else None
        said = html is not None and re.search(r"(?i)<html[^>]*\blang=[\"']?([a-z]{2})", html)
        host = re.match(r"https?://(?:www\.)?([^/]+)", url or "")
        host = host and host[1]
        path = re.match(r"https?://[^/]+/([a-z]{2})(?:/|$)", url or "")
        top = host and host.split(".")[-1]
        suffix = path[1] if path else top if top and len(top) == 2 else None
        logs = None
        if text and re.search("[a-z]", text):
            at = language.trigrams(text)
            logs = np.array([r[at].sum(dtype=np.float64) for r in model.table]) * min(1.0, language.EVIDENCE / len(at))
            logs -= logs.max()
        facts[i] = (logs, said and said[1].lower() or None, suffix, (host, host and ".".join(host.split(".")[-2:]), top))
    p = {i: normal(f[0]) for i, f in facts.items() if f[0] is not None}
    overall = sum(p.values()) + 1
    prior = overall / overall.sum()

    def ratio(at, i):
        if facts[i][at] is None:
            return 0
        some = {j for j in p if facts[j][at] is not None}
        share, own = sum(p[j] for j in some), sum(p[j] for j in some if facts[j][at] == facts[i][at])
        return np.log((own + kappa * own.sum() / share.sum()) / (share + kappa))

    def smooth(levels):
        if not levels:
            return prior
        own = sum((p[j] for j in p if facts[j][3][-len(levels) :] == levels), np.zeros(len(prior)))
        return (own + kappa * smooth(levels[1:])) / (own.sum() + kappa)

    assert set(got) == set(facts)
    for i, (logs, _, _, levels) in facts.items():
        if logs is None:
            assert got[i]["language"] == "und" and not got[i]["language_kept"]
            continue
        own = sum(p[j] for j in p if facts[j][3] == levels) - p[i] if levels[0] else None
        at_host = np.log(prior) if levels[0] is None else np.log(np.maximum(own, 0) + kappa * smooth(levels[1:]) + 1e-9)
        want = normal(logs + ratio(1, i) + ratio(2, i) + at_host)
        assert model.languages[int(want.argmax())] == got[i]["language"] and abs(want.max() - got[i]["language_probability"]) < 2e-6
