"""The toxicity grammar against its transducers one by one, and the model on held-out rows."""

import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonewright.llm import toxicity as t

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, toxic int, Events string"


def one_by_one(symbols):
    """Events and weights without composition."""
    machines = (t.negation(), t.report(), t.target(), t.threat(), t.insult())
    states, total, events = [0] * 5, 0.0, []
    for x in symbols:
        for k, m in enumerate(machines):
            states[k], x, weight = m.step(states[k], x)
            total += weight
        events.append(x)
    return events, total


@settings(max_examples=300, deadline=None)
@given(st.text(t.INPUT, max_size=25))
def test_the_composed_machine_is_its_parts_in_turn(symbols):
    machine, state, total, events = t.grammar(), 0, 0.0, []
    for x in symbols:
        state, out, weight = machine.step(state, x)
        total += weight
        events.append(out)
    wanted, weight = one_by_one(symbols)
    assert events == wanted and total == pytest.approx(weight)


def total(text, model=None):
    return t.Scorer(model or t.Model(t.lexicon())).total(text)[0]


def test_clauses_weigh_what_they_say():
    assert total("you are an idiot") > total("a stray idiot") > total("he said you are an idiot") > total("you are not an idiot") > 0
    assert total("I will kill you") > total("he said I will kill you") > 0
    assert total("kill the process") == total("we will win") == total("he said so") == total("") == total(None) == 0
    assert total("not today. You idiot") == total("you idiot"), "a negation ends with its clause"
    assert total("not bad but you are scum") == total("you are scum"), "a contrast ends a negation"
    assert total("you idiot. you idiot") == pytest.approx(2 * total("you idiot"))
    assert total("idiots that you are") > total("idiots that are")


def test_matches_give_spans_of_the_text(spark):
    texts = {1: "Well. YOU are an Idiot, İ say; fine", 2: None, 3: "", 4: "nothing", 5: "x " * 100_000 + "you moron\n" + "y " * 100_000}
    rows = t.matches(spark.createDataFrame([(k, v, 0.0, 1, "") for k, v in texts.items()], SCHEMA), t.Model(t.lexicon())).collect()
    assert {r["doc_id"] for r in rows} == {1, 5}
    assert all(texts[r["doc_id"]][r["start"] : r["end"]] == r["clause"] for r in rows)
    assert next(r for r in rows if r["doc_id"] == 1)["clause"] == "YOU are an Idiot, İ say"


def test_stems_are_the_longest_beginnings_that_lose_nothing():
    assert t.stems_of({"low": (100, 0), "lowe": (100, 0), "lowei": (99, 0), "loweia": (30, 0)}) == ["lowei"]
    assert sorted(t.stems_of({"los": (100, 20), "lose": (60, 0), "loser": (60, 0), "lost": (39, 1)})) == ["loser", "lost"]
    assert t.stems_of({}) == []


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def labelled(flip):
    """Toxic rows have made-up words of one beginning; labels of held-out rows can be turned round."""
    rng = np.random.default_rng(1)
    plain, rows, labels = [f"wo{c}{d}" for c in "abcdefgh" for d in "lmnop"], [], []
    for i in range(400):
        words, toxic = list(rng.choice(plain, 60)), int(i % 5 == 0)
        for k in range(3 * toxic):
            words.insert(7 * k + i % 7, "grakul" + "abcdefghij"[rng.integers(10)])
        rows.append((i, " ".join(words), 0.0, 0, ""))
        labels.append((i, 1 - toxic if flip and held_out(i) else toxic))
    return rows, labels


def test_held_out_labels_never_count(spark):
    models = []
    for flip in (False, True):
        rows, labels = labelled(flip)
        docs = spark.createDataFrame(rows, SCHEMA)
        models.append(t.fit(t.training(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))))
    assert models[0] == models[1]
    assert list(models[0].stems) == ["grakul"]
    scores = {r["doc_id"]: r["score"] for r in t.score(docs, models[0]).collect()}
    assert all((scores[i] >= t.PREDICT_FROM) == (i % 5 == 0) for i in range(400))


def test_copies_of_one_text_make_no_stem(spark):
    rows, labels = labelled(False)
    rows += [(1000 + i, f"wodl zumquist wofm copied {'woal ' * 20}", 0.0, 0, "") for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    model = t.fit(t.training(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")))
    assert not any(s.startswith("zumq") for s in model.stems)


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame([(None, "you idiot", 0.0, 0, ""), (1, None, 0.0, 0, ""), (1, None, 0.0, 0, ""), (2, "", 0.0, 0, "")], SCHEMA)
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    model = t.fit(t.training(docs, labels))
    assert model == t.Model(t.lexicon())
    got = sorted((r["doc_id"] or 0, round(r["score"], 3)) for r in t.score(docs, model).collect())
    low = round(float(t.logistic(np.array([1, 0, 0]), np.array(t.PRIOR))), 3)
    assert got[1:] == [(1, low), (1, low), (2, low)] and got[0][1] > 0.5
    assert t.score(docs.limit(0), model).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_held_out_accuracy(spark):
    got = t.op13_toxicity(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert all(held_out(r["doc_id"]) for r in rows)
    assert np.mean([r["predicted"] for r in toxic]) >= 0.6, "three languages have too few labelled rows here for stems"
    assert np.mean([r["predicted"] for r in clean]) <= 0.03
    assert got.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
