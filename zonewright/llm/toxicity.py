"""Toxicity: a weighted finite-state grammar over clauses.

A clause is what stands between full stops, colons, semicolons and line ends. Its words become symbols: insult, threat verb,
target, self, intent, negation, reporting verb, contrast, quote mark, other. Five transducers rewrite the symbols one after
another, each with a few states:

    negation   insults and threats up to three words after a negation are denied; a contrast ends that
    report     those after a reporting verb or between quote marks are somebody else's
    target     an insult up to four words after a target, or three before one, is aimed
    threat     self, intent and a threat verb up to three words apart, then a target
    insult     gives what is left its weight

They are composed once into one machine (only the states that can be reached), whose arcs carry an event and its weight. A
word counts by its event's weight times its own strength; a clause's score is the sum over its path, and a document's score
is a logistic function of the sum over its matched clauses, and of that sum in proportion to its words. So `you are an idiot` weighs more than a stray `idiot`, and `he
said that nobody is an idiot` next to nothing.

What is learned, from at most SAMPLE labelled rows (chosen by a hash of doc_id, without the held-out ones): the strengths of
the lexicon's words, further stems that stand in toxic rows far more often (counted by grouped aggregation over words and
their beginnings, and required after many different words, so that copies of one text don't make a stem), and the numbers
of the logistic function. Without labelled rows of both kinds the lexicon and fixed numbers decide.

Defined cases: a null text is an empty one and scores like any text without a match; a null doc_id is not held out; labels
that contradict each other count as toxic; repeated rows score alike; texts of any length are read whole, by one task each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import Remembered, materialize, table

#: Most labelled rows that the model is fitted on, and stems that it may learn (the ones with most evidence).
SAMPLE = 6000
STEMS = 2000
PREDICT_FROM = 0.3
#: Lengths of the beginnings of words that may become stems; a whole word ends with END.
LENGTHS = range(3, 9)
END = "$"
#: What a stem needs: likelihood ratio against chance, different words before it, and how much of its places in toxic rows
#: one longer beginning, or several, must keep to be preferred. A row counts for so many places at most.
RATIO, CONTEXTS, KEPT_BY_ONE, KEPT_BY_ALL, A_ROW = 36.0, 5, 0.85, 0.95, 5
#: Labelled rows with a word of the lexicon from which on they decide its strength.
SEEN = 5
#: Words that a Python worker remembers, and stems that it counts before it hands them on.
REMEMBERED, COUNTED = 150_000, 200_000

# The lexicon, our own: strong words, then those that are often meant otherwise.
STRONG = """idiot idiots moron morons loser losers scum stupid pathetic worthless imbecile cretin dumbass asshole bastard vermin filth disgusting
dummkopf trottel abschaum wertlos widerlich arschloch crétin abruti minable ordure connard salaud idiota imbécil estúpido estúpida
asqueroso inútil cabrón escoria""".split()
MILD = "trash clown garbage coward dumb ugly fool jerk pig rat dumm feige nul nulle débile basura payaso feo tonto".split()
THREATS = "kill hurt destroy beat burn shoot stab crush strangle töten umbringen schlagen verletzen tuer frapper détruire matar golpear destruir".split()
CLASSES = {
    "Y": "you your yours yourself u they them he him she her du dich dir dein deine ihr euch euer sie tu te toi vous ton votre ustedes usted ti vosotros él ella ellos".split(),
    "S": "i we i'll we'll i'm ich wir je j nous yo nosotros".split(),
    "M": "will shall gonna going must i'll we'll i'm werde werden muss vais allons dois voy vamos debo".split(),
    "N": "not no never nobody none neither isn't aren't don't doesn't didn't won't wasn't nicht kein keine niemals nie niemand ne pas jamais personne aucun no nunca nadie ningún".split(),
    "R": "said says say called calls wrote writes claimed claims quoted shouted reported alleged sagte sagt nannte schrieb behauptet dit appelle appelé écrit dijo dice llamó escribió".split(),
    "B": "but however aber sondern mais pero sino".split(),
}
QUOTES = "\"“”«»„"
MILDLY = 0.6
#: Weights of events. Lower-case: denied (insult, threat); J and V: somebody else's; D: aimed; A: a target after an insult; H: threat.
WEIGHTS = {"I": 0.7, "D": 1.5, "A": 0.6, "i": 0.05, "J": 0.25, "j": 0.02, "H": 2.5, "V": 0.5}
#: The logistic function of log(1 + sum) and log(1 + sum a hundred words) before labels are seen, and how firmly.
PRIOR, FIRM = (-3.0, 2.5, 1.5), 0.05

INPUT = "OITYSMNRBQ"
_TOKEN = re.compile(rf"[^\W\d_]+(?:['’][^\W\d_]+)*|[{QUOTES}]|[.!?;:\n]")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_STOPS = frozenset(".!?;:\n")


@dataclass
class Transducer:
    """arcs[state, symbol] = (next state, symbol out, weight); the start is state 0; what has no arc stays as it is."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    states: int

    @classmethod
    def of(cls, start, step: Callable, alphabet: str) -> Transducer:
        """From a function (state, symbol) -> (state, symbol out, weight) over states of any kind, as far as they are reached."""
        number, todo, arcs = {start: 0}, [start], {}
        while todo:
            state = todo.pop()
            for x in alphabet:
                after, out, weight = step(state, x)
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                arcs[number[state], x] = number[after], out, weight
        return cls(arcs, len(number))

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))


def compose(a: Transducer, b: Transducer, alphabet: str = INPUT) -> Transducer:
    """First a, then b on what it gives; weights add up."""

    def step(state, x):
        to_a, middle, w = a.step(state[0], x)
        to_b, out, v = b.step(state[1], middle)
        return (to_a, to_b), out, w + v

    return Transducer.of((0, 0), step, alphabet)


def negation(reach: int = 3) -> Transducer:
    def step(left, x):
        if x == "N":
            return reach, "O", 0.0
        if x == "B":
            return 0, "O", 0.0
        return max(0, left - 1), x.lower() if left and x in "IT" else x, 0.0

    return Transducer.of(0, step, INPUT)


def report() -> Transducer:
    elses = {"I": "J", "T": "V", "i": "j", "t": "O"}

    def step(state, x):
        told, quoted = state
        if x == "R":
            return (True, quoted), "O", 0.0
        if x == "Q":
            return (told, not quoted), "O", 0.0
        return state, elses.get(x, x) if told or quoted else x, 0.0

    return Transducer.of((False, False), step, INPUT + "it")


def target(ahead: int = 4, behind: int = 3) -> Transducer:
    def step(state, x):
        aim, pending = state
        after = max(0, aim - 1), max(0, pending - 1)
        if x == "Y":
            return (ahead, 0), "A" if pending else "Y", 0.0
        if x == "I":
            return ((after[0], 0), "D", 0.0) if aim else ((after[0], behind), "I", 0.0)
        return after, x, 0.0

    return Transducer.of((0, 0), step, "OITYSMQitJVj")


def threat(reach: int = 3) -> Transducer:
    """States: how far the pattern has come (self, intent, verb, reported verb) and how many words it may still wait."""

    def step(state, x):
        come, left = state
        waits = (come, left - 1) if left > 1 else ("", 0)
        if x in "YA" and come in ("verb", "told"):
            return ("", 0), "H" if come == "verb" else "V", 0.0
        if x == "S":
            return ("self", reach), "O", 0.0
        if x == "M" and come in ("self", "intent"):
            return ("intent", reach), "O", 0.0
        if x == "T" and come == "intent":
            return ("verb", reach), "O", 0.0
        if x == "V":
            return (("told", reach), "O", 0.0) if come == "intent" else (waits, "O", 0.0)
        return waits, "O" if x in "TMYt" else x, 0.0

    return Transducer.of(("", 0), step, "OITYSMQitJVjDA")


def insult() -> Transducer:
    return Transducer.of(0, lambda state, x: (0, x, WEIGHTS.get(x, 0.0)), "OIiJVjDAH")


def grammar() -> Transducer:
    return reduce(compose, (negation(), report(), target(), threat(), insult()))


@dataclass
class Model:
    """strengths: of whole words, and of stems (an END closes a whole word); curve: of measures()."""

    strengths: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = PRIOR

    def symbol(self, word: str) -> tuple[str, float]:
        if word in self.strengths and self.strengths[word] > 0:
            return "I", self.strengths[word]
        found = max((self.stems.get(s, 0.0) for s in beginnings(word)), default=0.0)
        return ("I", found) if found and word not in self.strengths else (_CLASS.get(word, "O"), 1.0)


_CLASS = {w: c for c, words in reversed(CLASSES.items()) for w in words} | {w: "T" for w in THREATS} | {q: "Q" for q in QUOTES}
# one word with two meanings: self and intent
_BOTH = {"i'll", "we'll", "i'm"}


def lexicon() -> dict[str, float]:
    return {w: MILDLY for w in MILD} | {w: 1.0 for w in STRONG}


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in LENGTHS if n <= len(word)] + ([word + END] if len(word) <= LENGTHS[-1] else [])


class Scorer:
    """The composed machine over the symbols of a model, for one Python worker."""

    def __init__(self, model: Model):
        machine = grammar()
        self.model, self.symbols = model, Remembered(model.symbol, REMEMBERED)
        self.table = {k: (to, out, w) for k, (to, out, w) in machine.arcs.items()}

    def clause(self, symbols: list[tuple[str, float]], words: list[str]) -> tuple[float, str]:
        """Score of one clause, and its events in order."""
        state, total, events, strength = 0, 0.0, [], 1.0
        for (x, own), word in zip(symbols, words, strict=True):
            for y in ("SM" if word in _BOTH else x):
                state, out, weight = self.table[state, y]
                if weight:
                    strength = own if y == "I" else strength if out == "A" else 1.0
                    total += weight * strength
                    events.append(out)
        return total, "".join(events)

    def read(self, text: str | None) -> tuple[str, list[str]]:
        lowered = (text or "").lower()
        if len(lowered) != len(text or ""):
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        return lowered, _TOKEN.findall(lowered)

    def clauses(self, lowered: str, tokens: list[str]) -> Iterator[tuple[int, int, float, str]]:
        """(start, end, score, events) of the clauses with an insult or a threat verb."""
        symbols = list(map(self.symbols.__getitem__, tokens))
        seeds = [i for i, (x, _) in enumerate(symbols) if x in "IT"]
        if not seeds:
            return
        spans, done = None, -1
        for i in seeds:
            if i < done:
                continue
            a = i
            while a > 0 and tokens[a - 1] not in _STOPS:
                a -= 1
            done = i
            while done < len(tokens) and tokens[done] not in _STOPS:
                done += 1
            score, events = self.clause(symbols[a:done], tokens[a:done])
            if events:
                spans = spans or [m.span() for m in _TOKEN.finditer(lowered)]
                yield spans[a][0], spans[done - 1][1], score, events

    def total(self, text: str | None) -> tuple[float, int, int]:
        """Sum over the matched clauses, their number, and the text's tokens."""
        lowered, tokens = self.read(text)
        total, n = 0.0, 0
        for _, _, score, _ in self.clauses(lowered, tokens):
            total, n = total + score, n + 1
        self.symbols.trim()
        return total, n, len(tokens)


def measures(totals: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Rows of (1, log(1 + sum), log(1 + sum a hundred tokens))."""
    return np.column_stack([np.ones(len(totals)), np.log1p(totals), np.log1p(100 * totals / np.maximum(tokens, 1))])


def logistic(x: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4


def training(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most `sample` labelled documents that are not held out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    rows = rows.filter(remainder(F.col("doc_id")) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    return materialize(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxicity-training")


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, places in toxic rows, in clean rows) of the beginnings of words."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        stems = list(counts[0].keys() | counts[1].keys())
        made = pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), *(pa.array([counts[k][s] for s in stems], pa.int64()) for k in (1, 0))], names=["stem", "toxic", "clean"])
        counts[0].clear()
        counts[1].clear()
        return made

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own: Counter = Counter()
            for w, n in Counter(_WORD.findall(text.lower())).items():
                for s in beginnings(w):
                    own[s] += n
            into = counts[toxic > 0]
            for s, n in own.items():
                into[s] += min(n, A_ROW)
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield out()
    yield out()


def _before(stems: frozenset):
    """(stem, word before it) of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                prior = ""
                for w in _WORD.findall(text.lower()):
                    found.update((s, prior) for s in beginnings(w) if s in stems)
                    prior = w
            rows = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["stem", "word"])

    return run


def ratio(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    """Likelihood ratio of a stem's places being in toxic rows more often than others (0 where they are not)."""
    n, p = toxic + clean, all_toxic / (all_toxic + all_clean)
    part = lambda k, q: F.when(k > 0, k * F.log(k / (n * q))).otherwise(0.0)
    return F.when(toxic > n * p, 2 * (part(toxic, p) + part(clean, 1 - p))).otherwise(0.0)


def strength(toxic: float, clean: float, all_toxic: int, all_clean: int) -> float:
    """0 to 1.5 from the log-odds of a word's places."""
    odds = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
    return float(np.clip(odds / 3, 0, 1.5))


def stems_of(found: dict[str, tuple[int, int]]) -> list[str]:
    """Stems, none the beginning of another. A beginning gives way to a longer one that keeps its toxic places, and to
    several that keep them and are rid of half the clean ones."""
    longer: dict[str, list[str]] = {}
    for s in found:
        longer.setdefault(s[:-1], []).append(s)
    chosen, todo = [], sorted(s for s in found if s[:-1] not in found)
    while todo:
        s = todo.pop()
        toxic, clean = found[s]
        more = longer.get(s, [])
        one = [x for x in more if found[x][0] >= KEPT_BY_ONE * toxic]
        if one:
            todo.append(max(one, key=lambda x: (found[x][0], x)))
        elif sum(found[x][0] for x in more) >= KEPT_BY_ALL * toxic and 2 * sum(found[x][1] for x in more) < clean:
            todo += more
        else:
            chosen.append(s)
    return chosen


def fit_curve(x: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, drawn towards PRIOR; no slope is negative."""
    w, free = np.array(PRIOR), np.ones(len(PRIOR), bool)
    for _ in range(40):
        p = logistic(x, w)
        grad = (x.T @ (p - toxic) + FIRM * (w - PRIOR))[free]
        step = np.linalg.solve((x.T @ (x * (p * (1 - p))[:, None]) + FIRM * np.eye(len(w)))[np.ix_(free, free)], grad)
        w[free] -= np.clip(step, -2, 2)
        if (w[1:] < 0).any():
            free[1:] &= w[1:] > 0
            w[1:] = np.maximum(w[1:], 0)
    return tuple(map(float, w))


def _totals(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            sums = np.array([scorer.total(t) for t in batch.column(0).to_pylist()], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(sums[:, 0]), pa.array(sums[:, 2]), batch.column(1)], names=["total", "tokens", "toxic"])

    return run


def fit(rows: DataFrame) -> Model:
    """A model from rows (text, toxic): at most SAMPLE of them."""
    sizes = {bool(r["toxic"]): r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    model = Model(lexicon())
    if not toxic or not clean:
        return model
    counted = rows.mapInArrow(_stems, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    known = [w + END if len(w) <= LENGTHS[-1] else w[: LENGTHS[-1]] for w in model.strengths]
    counted = counted.withColumn("ratio", ratio(F.col("toxic"), F.col("clean"), toxic, clean)).filter((F.col("ratio") >= RATIO) | F.col("stem").isin(known))
    held = {r["stem"]: r for r in counted.orderBy(F.desc("ratio"), "stem").limit(10 * STEMS + len(known)).collect()}
    for w, stem in zip(list(model.strengths), known, strict=True):
        if stem in held and held[stem]["toxic"] + held[stem]["clean"] >= SEEN:
            model.strengths[w] = strength(held[stem]["toxic"], held[stem]["clean"], toxic, clean)
    found = {s: (r["toxic"], r["clean"]) for s, r in held.items() if r["ratio"] >= RATIO}
    contexts = rows.filter("toxic > 0").select("text").mapInArrow(_before(frozenset(found)), "stem string, word string").distinct().groupBy("stem").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= CONTEXTS)
    apart = {r["stem"] for r in contexts.collect()}  # at most as many as stems
    found = {s: n for s, n in found.items() if s in apart}
    chosen = sorted(stems_of(found), key=lambda s: (-held[s]["ratio"], s))[:STEMS]
    model.stems = {s: strength(*found[s], toxic, clean) for s in chosen}
    sums = rows.mapInArrow(_totals(model), "total double, tokens double, toxic int").toPandas()
    model.curve = fit_curve(measures(sums["total"].to_numpy(), sums["tokens"].to_numpy()), (sums["toxic"] > 0).to_numpy(float))
    return model


_SCORED = "doc_id long, score double, n_clauses long"


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = np.array([scorer.total(t.as_py()) for t in batch.column(1)], float).reshape(-1, 3)
            score = logistic(measures(found[:, 0], found[:, 2]), np.array(model.curve))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(found[:, 1].astype(np.int64))], names=["doc_id", "score", "n_clauses"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and number of matched clauses of every whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_score(model), _SCORED)


def _match(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            out = [(i, a, b, (t or "")[a:b], s, e) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for a, b, s, e in scorer.clauses(*scorer.read(t))]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(types)], names=["doc_id", "start", "end", "clause", "score", "events"])

    return run


def matches(docs: DataFrame, model: Model) -> DataFrame:
    """The matched clauses: where they stand, their score and the machine's events."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_match(model), "doc_id long, start long, end long, clause string, score double, events string")


def op13_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(training(docs, table(spark, sf_dir, "labels")))
    out = score(docs, model)
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"), "n_clauses")
