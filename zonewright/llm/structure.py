"""Conversation structure repair: grammar-compressed dynamic programming over role and fault sequences.

A conversation is a string of symbols, one a row: its role's initial, in capitals if the text is truncated, or `x` if the
row has to go (blank or a duplicate). The cheapest edits that give roles `(s?(ua)+)?` are a shortest path through the
states `E` (nothing yet), `S`, `U`, `A`: each symbol is a 4 x 4 matrix over (min, +) whose entries also carry the audit, the
initials of the edits, as a rope. Insertions are part of the matrix before each row.

Re-Pair finds the pairs of symbols that stand side by side most often over all conversations (counted by Spark over the
distinct sequences) and gives each a rule. The matrix of a rule is the product of its two sides', worked out once, bottom
up, and shared by every conversation: a conversation is then a vector through the matrices of its compressed symbols.
Sequences come in blocks of at most 512 rows, so a conversation of any length is folded block after block with four costs
and four chains of ropes in memory.

Among the cheapest edits the audit that is least in ASCII counts. From a given state the letters of an audit decide all
roles, and equally cheap audits of the same rows and states are never one the beginning of another, so the least whole
consists of least parts.

Defined cases: a null in any column counts as one space (a null conv_id or turn is null in the result); a role's initial is
its first character, whatever follows; an empty or other role can only be replaced or deleted; rows come by turn, nulls
first, then role, then a digest of role and text; repeated rows are duplicates; a very long text is one row, and is read
once for its faults and once for the repaired text; an empty table gives no rows; other columns are ignored. The digest of
a repaired conversation is of one text, so one task hashes it, row by row as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import Remembered, in_order, materialize, table

#: Rules of the grammar, rules that one round of counting may add, and how often a pair must stand somewhere.
RULES = 48
RULES_A_ROUND = 6
LEAST = 2
#: Rows of a conversation in one block, and sequences of which a worker remembers the compressed form.
BLOCK = 512
REMEMBERED = 20_000

# Fixed values of the task: costs, and what each edit is called.
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLED, DELETED, INSERTED, CUT_OFF = 1, 2, 5, 5
STATES = "ESUA"
ACCEPTED = "EA"
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
SPOKEN = {"U": "user", "A": "assistant"}


class Rope:
    """A text in two parts; it is put together when it is first compared."""

    __slots__ = ("left", "right", "whole")

    def __init__(self, left, right=None):
        self.left, self.right, self.whole = left, right, left if right is None else None

    def __str__(self) -> str:
        if self.whole is None:
            out, todo = [], [self]
            while todo:
                r = todo.pop()
                if r.whole is not None:
                    out.append(r.whole)
                else:
                    todo += [r.right, r.left]
            self.whole, self.left, self.right = "".join(out), None, None
        return self.whole


Matrix = dict[tuple[str, str], tuple[int, Rope]]


def least(options) -> Matrix:
    """Of (from, to, cost, rope): the cheapest a pair of states, the least text among them."""
    out: Matrix = {}
    for p, q, cost, rope in options:
        held = out.get((p, q))
        if held is None or cost < held[0] or (cost == held[0] and str(rope) < str(held[1])):
            out[p, q] = cost, rope
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return least((p, q, c + d, Rope(x, y)) for (p, m), (c, x) in a.items() for (n, q), (d, y) in b.items() if m == n)


def insertions() -> Matrix:
    """Any number of them; going in a circle never pays."""
    step = {p: NEXT.get((p, "u")) or NEXT[p, "a"] for p in STATES}
    options = []
    for p in STATES:
        q, n = p, 0
        while n == 0 or q != p and n < len(STATES):
            options.append((p, q, n * INSERTED, Rope(INSERT * n)))
            q, n = step[q], n + 1
    return least(options)


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions, then what may become of a row with this symbol."""
    edits = [(p, p, DELETED, Rope(DELETE)) for p in STATES]
    if symbol != "x":
        more = CUT_OFF * symbol.isupper()
        for (p, role), q in NEXT.items():
            if role == symbol.lower():
                edits.append((p, q, more, Rope(KEEP)))
            if role in "ua":
                edits.append((p, q, REROLED + more, Rope(REROLE)))
    return times(insertions(), least(edits))


SYMBOLS = "suaoSUAOx"


def matrices(rules: list[str]) -> dict[str, Matrix]:
    """One matrix a symbol, and one a rule from those of its two sides."""
    out = {s: symbol_matrix(s) for s in SYMBOLS}
    for k, pair in enumerate(rules):
        out[named(k)] = times(out[pair[0]], out[pair[1]])
    return out


def named(rule: int) -> str:
    """The symbol of a rule, from a block of code points that no text uses."""
    return chr(0xE000 + rule)


def compressed(sequence: str, rules: list[str]) -> str:
    for k, pair in enumerate(rules):
        sequence = sequence.replace(pair, named(k))
    return sequence


def expanded(sequence: str, rules: list[str]) -> str:
    for k in reversed(range(len(rules))):
        sequence = sequence.replace(named(k), rules[k])
    return sequence


def learn(sequences: DataFrame, *, rules: int = RULES, a_round: int = RULES_A_ROUND, least_often: int = LEAST) -> list[str]:
    """Pairs of symbols, most frequent first, each possibly of rules before it. sequences: seq (distinct), n (times)."""
    made: list[str] = []
    while len(made) < rules:
        seq = F.col("seq")
        for k, pair in enumerate(made):
            seq = F.replace(seq, F.lit(pair), F.lit(named(k)))
        now = sequences.select(seq.alias("seq"), "n").filter(F.length("seq") > 1)
        pairs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("seq") - 1), lambda i: F.substring(F.col("seq"), i, F.lit(2))))
        each = now.select("seq", "n", F.explode(pairs).alias("pair"))
        often = (F.length("seq") - F.length(F.replace(F.col("seq"), F.col("pair"), F.lit("")))) / 2
        counted = each.groupBy("pair").agg(F.sum(F.col("n") * often).alias("times")).filter(F.col("times") >= least_often)
        found, used = [r["pair"] for r in counted.orderBy(F.desc("times"), "pair").limit(4 * a_round).collect()], set()
        chosen = []
        for pair in found:  # what one pair takes away is not counted for another
            if not used & set(pair):
                chosen.append(pair)
                used |= set(pair)
        if not chosen:
            break
        made += chosen[: min(a_round, rules - len(made))]
    return made


# A chain of ropes: (chain before, rope). Chains of one conversation are equally long.
def before(a: tuple, b: tuple) -> bool:
    """Is the text of chain a less than that of chain b?"""
    left, right = [], []
    while a is not b:
        left.append(str(a[1]))
        right.append(str(b[1]))
        a, b = a[0], b[0]
    return "".join(reversed(left)) < "".join(reversed(right))


def moved(vector: dict, matrix: Matrix) -> dict:
    """A vector of state: (cost, chain), one matrix on."""
    out: dict = {}
    for (p, q), (cost, rope) in matrix.items():
        if p in vector:
            c = vector[p][0] + cost
            if q not in out or c < out[q][0]:
                out[q] = c, (vector[p][1], rope)
            elif c == out[q][0] and before(link := (vector[p][1], rope), out[q][1]):
                out[q] = c, link
    return out


def finished(vector: dict) -> tuple[int, str]:
    """Cost and audit of the cheapest way to an end."""
    ends = moved(vector, insertions())
    cost, chain = min((ends[q] for q in ACCEPTED if q in ends), key=lambda x: x[0])
    for q in ACCEPTED:
        if q in ends and ends[q][0] == cost and before(ends[q][1], chain):
            chain = ends[q][1]
    parts = []
    while chain is not None:
        parts.append(str(chain[1]))
        chain = chain[0]
    return cost, "".join(reversed(parts))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text) as the task damages them, nulls of role and text as one space."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" "))).cast("binary")) % 20
    rows = conversations.select(conv.alias("conv"), turn.alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def _order() -> list[Column]:
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]


def blocks(rows: DataFrame) -> DataFrame:
    """(conv, block, seq, initials, counts ..): the symbols of at most BLOCK rows each, in order by block."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    marks = rows.select("conv", "turn", "role", _digest().alias("key"), initial.alias("initial"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    placed = in_order(materialize(marks, "marks"), _order(), "at")
    # the first of equal rows, found by its place: no join meets a hot text
    first = placed.groupBy("conv", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    told = placed.select("conv", "turn", "initial", "blank", "cut", "at").join(first, "at", "left")
    again = F.col("first").isNull() & ~F.col("blank")
    cut = F.col("cut") & ~F.col("blank") & ~again
    symbol = F.when(F.col("blank") | again, "x").when(cut, F.upper("initial")).otherwise(F.col("initial"))
    told = told.select("conv", F.expr(f"at div {BLOCK}").alias("block"), F.struct("at", symbol.alias("symbol"), "initial", "turn").alias("row"), F.col("blank"), again.alias("again"), cut.alias("cut"))
    out = told.groupBy("conv", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"), F.count_if("blank").alias("blank"), F.count_if("again").alias("duplicate"), F.count_if("cut").alias("truncated"))
    joined = lambda f: F.array_join(F.transform("rows", lambda r: r[f]), "")
    turns = F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())
    out = out.select("conv", "block", joined("symbol").alias("seq"), joined("initial").alias("initials"), turns.alias("turns"), "blank", "duplicate", "truncated")
    legal = F.length("initials") - F.length(F.regexp_replace("initials", "s(?=u)|u(?=a)|a(?=u)", ""))
    return out.select(
        "conv", "block", "seq", "blank", "duplicate", "truncated",
        (F.length("initials") - 1 - legal).cast("long").alias("illegal"), F.substring("initials", 1, 1).alias("begins"), F.right("initials", F.lit(1)).alias("ends"),
        F.array_min("turns").alias("low"), F.array_max("turns").alias("high"), F.size(F.array_distinct("turns")).cast("long").alias("turns"),
    )


_BLOCK = ["conv", "seq", "blank", "duplicate", "truncated", "illegal", "begins", "ends", "low", "high", "turns"]
_JUDGED = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SUMS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _judge(rules: list[str]):
    """Fold the blocks of each conversation, which come one after another; one without rows has a block without symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(rules)
        short = Remembered(lambda s: compressed(s, rules), REMEMBERED)
        conv = vector = sums = None

        def ended() -> list:
            cost, audit = finished(vector)
            span = 0 if sums["low"] is None else sums["high"] - sums["low"] + 1 - sums["turns"]
            return [conv[0], span, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], cost, audit]

        def batch_of(out: list) -> pa.RecordBatch:
            types = [pa.int64()] * 7 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=[x.split()[0] for x in _JUDGED.split(", ")])

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if conv is None or conv[0] != r["conv"]:
                    if conv is not None:
                        out.append(ended())
                    conv, vector = (r["conv"],), {"E": (0, None)}
                    sums = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "low": None, "high": None, "turns": 0, "ends": None}
                if not r["seq"]:
                    continue
                for s in short[r["seq"]]:
                    vector = moved(vector, known[s])
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    sums[c] += r[c]
                sums["illegal"] += sums["ends"] is not None and sums["ends"] + r["begins"] not in ("su", "ua", "au")
                if r["low"] is not None:
                    sums["turns"] += r["turns"] - (sums["high"] == r["low"])
                    sums["low"] = r["low"] if sums["low"] is None else sums["low"]
                    sums["high"] = r["high"]
                sums["ends"] = r["ends"]
            short.trim()
            if out:
                yield batch_of(out)
        if conv is not None:
            yield batch_of([ended()])

    return run


def judge(conversations: DataFrame, rows: DataFrame, *, rules: int = RULES) -> DataFrame:
    """One row per original conversation: its faults, the cost of the cheapest repair and its audit."""
    parts = materialize(blocks(rows), "blocks")
    grammar = learn(materialize(parts.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "sequences"), rules=rules)
    # a block without symbols for every conversation, so that those without rows are there too
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv")).distinct().withColumn("block", F.lit(-1).cast("long"))
    whole = parts.unionByName(ids, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "block")
    return whole.select(_BLOCK).mapInArrow(_judge(grammar), _JUDGED)


def edits(audit: str) -> Iterator[tuple[str, str | None]]:
    """The edits of an audit with the role that the grammar asks for there (None: the row's own, or none)."""
    state = "E"
    for letter in audit:
        if letter in (INSERT, REROLE):
            state = NEXT.get((state, "u")) or NEXT[state, "a"]
            yield letter, SPOKEN[state]
        else:
            role = yield letter, None
            if letter == KEEP:
                state = NEXT[state, role[0]]


_REPAIRED = _JUDGED + ", repaired_sha256 string"


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit, then its rows in order: the digest of what they become."""
    names = [x.split()[0] for x in _REPAIRED.split(", ")]
    head = digest = walk = pending = None
    first = True

    def say(role: str, text: str) -> None:
        nonlocal first
        digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
        first = False

    def onward(role: str | None = None) -> None:
        """Go to the next edit that takes a row."""
        nonlocal pending
        try:
            pending = next(walk) if role is None else walk.send(role)
            while pending[0] == INSERT:
                say(pending[1], "")
                pending = next(walk)
        except StopIteration:
            pending = None

    def ended(out: list) -> None:
        if head is not None:
            out.append([*(head[c] for c in names[:-1]), digest.hexdigest()])

    def batch_of(out: list) -> pa.RecordBatch:
        types = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    for batch in batches:
        out: list = []
        for r in batch.to_pylist():
            if r["audit"] is not None:
                ended(out)
                head, digest, walk, first = r, hashlib.sha256(), edits(r["audit"]), True
                onward()
                continue
            letter, role = pending
            if letter == REROLE:
                say(role, r["text"])
            elif letter == KEEP:
                say(r["role"], r["text"])
            onward(r["role"] if letter == KEEP else None)
        if out:
            yield batch_of(out)
    last: list = []
    ended(last)
    if last:
        yield batch_of(last)


def repair(conversations: DataFrame, rows: DataFrame, *, rules: int = RULES) -> DataFrame:
    """judge()'s rows with the digest of the repaired conversation."""
    judged = materialize(judge(conversations, rows, rules=rules), "judged")
    spoken = rows.withColumn("key", _digest()).withColumn("audit", F.lit(None).cast("string"))
    both = spoken.unionByName(judged, allowMissingColumns=True)
    dealt = both.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), *_order()[1:])
    return dealt.select("conv", *_SUMS, "audit", "role", "text").mapInArrow(_hash, _REPAIRED)


def op11_structure_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(conversations, damaged(conversations)).withColumnRenamed("conv", "conv_id")


#: CRC-32 of `conv_id:turn`, eight shifts a character.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(name) + 1), lambda i: ascii(substring(name, i::INT, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295)"""

#: The same row by row: the cheapest way to each state after each row, with its audit and text.
OP11_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), kinds AS (SELECT *, {_CRC} % 20 AS kind FROM raw
), harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds JOIN range(2) AS t(copy) ON copy = 0 OR kind = 3 WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text)) AS k FROM harmed
), marked AS (
  SELECT *, substring(role, 1, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
    lag(substring(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS prior
  FROM numbered
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
    count(*) FILTER (k > 1 AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), inserts(p, q, cost, letters, said) AS (VALUES
  ('E', 'E', 0, '', ''), ('S', 'S', 0, '', ''), ('U', 'U', 0, '', ''), ('A', 'A', 0, '', ''),
  ('E', 'U', 5, 'I', 'user:' || chr(10)), ('S', 'U', 5, 'I', 'user:' || chr(10)), ('A', 'U', 5, 'I', 'user:' || chr(10)), ('U', 'A', 5, 'I', 'assistant:' || chr(10)),
  ('E', 'A', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), ('S', 'A', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))
), edits(letter, initial, p, q, cost, role) AS (VALUES
  ('K', 's', 'E', 'S', 0, NULL), ('K', 'u', 'E', 'U', 0, NULL), ('K', 'u', 'S', 'U', 0, NULL), ('K', 'u', 'A', 'U', 0, NULL), ('K', 'a', 'U', 'A', 0, NULL),
  ('R', NULL, 'E', 'U', 1, 'user'), ('R', NULL, 'S', 'U', 1, 'user'), ('R', NULL, 'A', 'U', 1, 'user'), ('R', NULL, 'U', 'A', 1, 'assistant'),
  ('D', NULL, 'E', 'E', 2, NULL), ('D', NULL, 'S', 'S', 2, NULL), ('D', NULL, 'U', 'U', 2, NULL), ('D', NULL, 'A', 'A', 2, NULL)
), steps(conv_id, k, p, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 'E', {{'cost': 0, 'audit': '', 'said': ''}} FROM conversations
  UNION ALL
  SELECT s.conv_id, s.k + 1, e.q, min({{'cost': s.best.cost + i.cost + e.cost + CASE WHEN m.cut AND e.letter <> 'D' THEN 5 ELSE 0 END,
    'audit': s.best.audit || i.letters || e.letter,
    'said': s.best.said || i.said || CASE WHEN e.letter = 'D' THEN '' ELSE coalesce(e.role, m.role) || ':' || m.text || chr(10) END}})
  FROM steps s JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.k = s.k + 1 JOIN inserts i ON i.p = s.p
    JOIN edits e ON e.p = i.q AND (e.initial IS NULL OR e.initial = m.initial) AND (e.letter = 'D' OR NOT (m.blank OR m.again))
  GROUP BY s.conv_id, s.k, e.q
), ends AS (
  SELECT s.conv_id, min({{'cost': s.best.cost + i.cost, 'audit': s.best.audit || i.letters, 'said': s.best.said || i.said}}) AS best
  FROM steps s LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM s.conv_id JOIN inserts i ON i.p = s.p AND i.q IN ('E', 'A')
  WHERE s.k = coalesce(f.n, 0) GROUP BY s.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  e.best.cost::BIGINT AS cost, e.best.audit AS audit, sha256(CASE WHEN e.best.said = '' THEN '' ELSE substring(e.best.said, 1, length(e.best.said) - 1) END) AS repaired_sha256
FROM ends e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""
