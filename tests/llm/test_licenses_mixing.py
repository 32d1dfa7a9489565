import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from zonewright.llm import licenses, mixing


def found(text):
    return [(m[0], text[m[2] : m[3]]) for m in licenses.scan(text, licenses.Index(licenses.TEMPLATES))]


def test_matches_report_their_spans():
    mit = licenses.TEMPLATES["MIT"]
    assert found("x Released under the MIT License. y") == [("MIT (notice)", "Released under the MIT License.")]
    assert found("a b\nReleased  under the\nnew MIT LICENSE, c") == [("MIT (notice)", "Released  under the\nnew MIT LICENSE,")]
    edited = "é start " + mit.replace("hereby ", "").replace("Software", "Program", 1) + " end"
    (m,) = licenses.scan(edited, licenses.Index(licenses.TEMPLATES))
    assert m[0] == "MIT" and 0.95 < m[1] < 1 and edited[m[2] : m[3]].startswith("Permission") and edited[m[2] : m[3]].endswith("Software.")
    twice = "Released under the MIT License. " + "word " * 50 + "Released under the MIT License."
    assert len(found(twice)) == 2
    assert found("") == [] and found("the License of a word") == [] and found(mit[:200]) == []


def test_scan_equals_search_on_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Counter((r["doc_id"], r["license"]) for r in licenses.scan_licenses(docs).collect())
    notices = {k: v for k, v in licenses.TEMPLATES.items() if "notice" in k}
    want = Counter({(r["doc_id"], k): r["text"].count(v) for r in docs.collect() for k, v in notices.items() if v in r["text"]})
    assert got == want
    df = spark.createDataFrame([(1, None, 0), (None, "Released under the MIT License.", 0)], "doc_id long, text string, license int")
    assert [r["doc_id"] for r in licenses.scan_licenses(df).collect()] == [None]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def plain_alignment(template, ids):
    """Most words in common in order, over the whole table."""
    row = [0] * (len(ids) + 1)
    for t in template:
        new = [0]
        for j, x in enumerate(ids):
            new.append(max(new[-1], row[j + 1], row[j] + (x == t)))
        row = new
    return row[-1]


def test_banded_alignment_equals_the_whole_table():
    r = random.Random(3)
    for _ in range(150):
        template = [r.randrange(1, 30) for _ in range(r.randrange(5, 40))]
        ids = [x for x in template if r.random() > 0.1]
        for _ in range(r.randrange(3)):
            ids.insert(r.randrange(len(ids) + 1), r.randrange(1, 30))
        lead = [0] * r.randrange(5)
        n, first, last = licenses.align(template, lead + ids + [0] * r.randrange(5), len(lead))
        assert n == plain_alignment(template, ids)
        assert len(lead) <= first <= last < len(lead) + len(ids) and plain_alignment(template, (lead + ids)[first : last + 1]) == n


def test_edited_templates_are_found_as_a_search_over_all_windows_finds_them():
    r = random.Random(5)
    index = licenses.Index(licenses.TEMPLATES)
    filler = "apple river stone walks under bright quiet morning with seven old trees".split()
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        for share in (0.0, 0.03, 0.06):
            edited = [r.choice(filler) if r.random() < share else w for w in words]
            text = " ".join(r.choices(filler, k=30) + edited + r.choices(filler, k=30))
            ids = [x for x in index.read(text).tolist() if x >= 0]
            k = index.names.index(name)
            best = plain_alignment([index.number[w] for w in index.words[k]], ids)
            got = {m[0]: m for m in licenses.scan(text, index)}
            if best >= licenses.COVERAGE * len(index.words[k]):
                assert name in got and got[name][4] == best, (name, share)


def test_whichever_words_are_changed_what_reaches_the_coverage_is_found():
    r = random.Random(9)
    index = licenses.Index(licenses.TEMPLATES)
    lead = "apple river stone walks".split()
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        most = len(words) - math.ceil(licenses.COVERAGE * len(words))
        changed = [[i] for i in range(len(words))] if most else []
        # spread evenly, changes leave the shortest runs
        changed += [[(i + 1) * len(words) // (most + 1) - 1 - s for i in range(most)] for s in range(2)] + [r.sample(range(len(words)), most) for _ in range(20)]
        for places in changed:
            for left_out in (False, True):
                kept = [None if left_out and i in places else "zebra" if i in places else w for i, w in enumerate(words)]
                text = " ".join([*lead, *[w for w in kept if w], *lead])
                got = {m[0]: m[4] for m in licenses.scan(text, index)}
                assert got.get(name, 0) >= len(words) - len(places), (name, places, left_out)
    assert found("Released under an MIT License.") == [("MIT (notice)", "Released under an MIT License.")]
    assert found("under the tree, released by the license of rivers under the moon") == []


def test_templates_of_one_and_two_words_and_other_coverages():
    index = licenses.Index({"one": "Copyleft", "two": "public domain", "none": "...", "half": "a b c d e f"}, 0.5)
    assert [(m[0], m[4]) for m in licenses.scan("copyleft and Public Domain", index)] == [("one", 1), ("two", 2)]
    assert [(m[0], m[4]) for m in licenses.scan("x a y c y e x", index)] == [("half", 3)]
    assert licenses.scan("x a y c x", index) == []


def test_a_very_long_text_is_scanned_whole():
    mit = licenses.TEMPLATES["MIT"]
    text = "word " * 300_000 + mit + " tail"
    assert [(m[0], m[2], m[3]) for m in licenses.scan(text, licenses.Index(licenses.TEMPLATES))] == [("MIT", 1_500_000, 1_500_000 + len(mit))]


def frame(spark, sizes):
    rows = [(f"{s}-{i}", s, "w " * (1 + i % 7)) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, source string, text string")


def test_weights_meet_the_repetition_limit(spark):
    sizes = {"a": 3000, "b": 600, "c": 100, None: 50}
    df = frame(spark, sizes)
    rows = mixing.mix(df, repeats=2.0, detail=True).collect()
    copies = Counter(r["doc_id"] for r in rows)
    assert set(copies) == {r["doc_id"] for r in df.collect()}  # nothing is dropped
    spent, weights, tokens = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        spent[r["source"]] += r["mix_tokens"]
        weights[r["source"]] = r["mix_weight"]
    for r in df.collect():
        tokens[r["source"]] += len(r["text"].split())
    assert abs(sum(weights.values()) - 1) < 1e-9
    total = sum(spent.values())
    assert all(abs(spent[s] / total - weights[s]) < 0.01 for s in weights)
    assert max(copies.values()) <= 2 and abs(spent[None] / tokens[None] - 2) < 0.1
    # an exponent of the shares
    share = {s: tokens[s] / sum(tokens.values()) for s in tokens}
    a = math.log(weights["a"] / weights["c"]) / math.log(share["a"] / share["c"])
    assert abs(math.log(weights["b"] / weights["c"]) / math.log(share["b"] / share["c"]) - a) < 1e-6


def test_weights_meet_an_entropy(spark):
    df = frame(spark, {"a": 2000, "b": 400, "c": 100})
    weights = {r["source"]: r["mix_weight"] for r in mixing.mix(df, repeats=None, entropy=0.9, budget=5000, detail=True).collect()}
    assert abs(-sum(w * math.log(w) for w in weights.values()) - 0.9) < 1e-3


def test_a_budget_is_never_exceeded_and_the_same_for_any_partitioning(spark):
    df = frame(spark, {"a": 2000, "b": 400})
    one = mixing.mix(df, repeats=None, budget=3000, detail=True)
    two = mixing.mix(df.repartition(9), repeats=None, budget=3000, detail=True)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    spent = sum(r["mix_tokens"] for r in one.collect())
    assert 3000 - 2 * 7 <= spent <= 3001


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", ""), (2, "a", ""), (3, None, "x")], "doc_id long, source string, text string").withColumn("mix_pass", F.lit(0))
    out = mixing.mix(df)
    assert out.columns == df.columns and out.count() == 4
    assert mixing.mix(df.filter("text is null")).count() == 1
    assert mixing.mix(df.limit(0)).count() == 0


def test_the_mixture_equals_a_plain_version(spark):
    df = frame(spark, {"a": 700, "b": 180, "c": 40, None: 9}).withColumn("source", F.when(F.col("source") == "c", F.lit("")).otherwise(F.col("source")))
    for repeats, entropy, budget in ((1.5, None, None), (None, 0.8, 2500), (4.0, None, 9000)):
        got = mixing.mix(df, repeats=repeats, entropy=entropy, budget=budget, detail=True).collect()
        # hashes are read from Spark, all else is plain
        key = F.to_json(F.struct(F.col("source").alias("s")))
        order = F.xxhash64(F.lit(mixing.SEED), "doc_id", "text")
        docs = [r.asDict() for r in df.select("doc_id", "source", key.alias("key"), mixing.tokens(F.col("text")).alias("n"), order.alias("order")).collect()]
        tokens, counts = defaultdict(int), Counter(d["key"] for d in docs)
        for d in docs:
            tokens[d["key"]] += d["n"]
        total = sum(tokens.values())
        share = {k: n / total for k, n in tokens.items()}

        def mixture(a):
            z = sum(p**a for p in share.values())
            w = {k: p**a / z for k, p in share.items()}
            spent = budget if budget is not None else max(tokens[k] / w[k] for k in w)
            return w, spent

        def allowed(a):
            w, spent = mixture(a)
            ok = entropy is None or -sum(x * math.log(x) for x in w.values()) <= entropy + 1e-9
            return ok and (repeats is None or max(w[k] * spent / tokens[k] for k in w) <= max(repeats, spent / total) * (1 + 1e-9))

        low, high = 0.0, 1.0
        if allowed(low):
            high = low
        while high - low > 1e-12:
            mid = (low + high) / 2
            low, high = (low, mid) if allowed(mid) else (mid, high)
        w, spent = mixture(high)
        mine = {k: next(r["mix_weight"] for r, d in ((r, d) for r in got for d in docs if d["doc_id"] == r["doc_id"]) if d["key"] == k) for k in w}
        assert all(abs(mine[k] - w[k]) < 1e-5 for k in w)
        # each source is read whole so many times, then in the order of its blocks while the budget lasts
        blocks = {d["doc_id"]: None for d in docs}
        listed = spark.createDataFrame([(d["doc_id"], d["key"], d["order"], math.isqrt(counts[d["key"]] - 1) + 1, int(w[d["key"]] * spent / tokens[d["key"]] + 1e-6) + 1) for d in docs], "doc_id string, key string, o long, blocks long, last int")
        block = F.pmod(F.xxhash64(F.lit(mixing.SEED + 1), "o"), F.col("blocks")).cast("int")
        for r in listed.select("doc_id", F.xxhash64(F.lit(mixing.SEED + 2), "key", "last", block).alias("at")).collect():
            blocks[r["doc_id"]] = r["at"]
        want = Counter()
        for k in tokens:
            reads = w[k] * spent / tokens[k]
            full = int(reads + 1e-6)
            part, run, held = max(0, round((reads - full) * tokens[k])), 0, True
            for d in sorted((d for d in docs if d["key"] == k), key=lambda d: (blocks[d["doc_id"]], d["order"])):
                run += d["n"]
                held = held and run <= part
                want[d["doc_id"]] += full + held
        copies = Counter(r["doc_id"] for r in got)
        assert sum(abs(copies[x["doc_id"]] - want[x["doc_id"]]) for x in docs) <= len(tokens)  # a token of rounding a source
