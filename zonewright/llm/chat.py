"""Chat formatting: root-to-leaf paths of reply trees, by DataFrame functions only.

Messages point to the message they answer. Self-joins that double their reach give every message the sum of scores up to
its root: after k rounds each knows its ancestor 2^k steps up and the sum between, so a tree of depth d takes log2(d)
rounds, on ids and numbers alone. Branches of a conversation are ranked by that sum at their leaves, and only the chosen
ones are listed, by the same doubled jumps, and become one formatted text each.

A turn is written `<|turn|>role\\ntext<|end|>`. In roles and texts, control strings (of this template and of others in common
use) get a backslash after their first character, one more if there are backslashes already, so none survives and
unescaping gives the original back. The loss mask is read from the output: the texts of the assistant's turns.

Defined cases: null role and text count as empty; a message whose parent is missing or null is a root; a cycle of parents
is opened at its least id, which becomes a root, and branches with that root have `opened` true; ties of branches go to
the lesser leaf; ties in a turn are ordered by role and text; equal rows of a turn stay as turns of their own; an empty
table gives no rows; a null conv_id is a conversation of its own; a text of any length is one turn, and a formatted
conversation is as long as its turns together; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, table

START, END = "<|turn|>", "<|end|>"
TRAINED = "assistant"

# What follows the first character of a control string. None of it holds a first character itself, so that
# escaping one string never changes how another is found.
_REST = r"(?:\|[A-Za-z0-9_]{1,40}\||/?s>|/?INST\]|/?SYS>>|(?:bos|eos|pad|unk|start_of_turn|end_of_turn|begin_of_text)>)"
_ESCAPE = rf"([<\[])(\\*)(?={_REST})"
_UNESCAPE = rf"([<\[])\\(\\*)(?={_REST})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def turn(role: Column, text: Column) -> Column:
    # a role is one line: its line ends are kept apart from the one that ends it
    return F.concat(F.lit(START), F.regexp_replace(F.regexp_replace(escape(role), r"\\", r"\\\\"), "\n", r"\\n"), F.lit("\n"), escape(text), F.lit(END))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    pieces = F.filter(F.split(formatted, F.concat(F.lit(r"\Q"), F.lit(END), F.lit(r"\E")), -1), lambda p: p != "")

    def parse(p: Column) -> Column:
        body = F.substring(p, F.lit(len(START) + 1), F.length(p))
        role = F.substring_index(body, "\n", 1)
        plain = F.array_join(F.transform(F.split(role, r"\\\\", -1), lambda x: F.replace(x, F.lit(r"\n"), F.lit("\n"))), "\\")
        return F.struct(unescape(plain).alias("role"), unescape(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"))

    return F.transform(pieces, parse)


def climbed(messages: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """(conv, id, total) with the sum of scores up to the root; the jumps (conv, id, next) of 1, 2, 4, .. steps; and
    (conv, id) of the messages at which cycles were opened.

    messages: conv, id, parent, score; (conv, id) is unique, ids are never null.
    """
    links = messages.select("conv", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    ids = links.select(F.col("conv").alias("c"), F.col("id").alias("i"), F.lit(True).alias("there"))
    known = links.filter("parent is not null").join(ids, F.col("conv").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("i")))
    roots = links.join(known.select(F.col("conv").alias("c"), F.col("id").alias("i")), F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")), "left_anti")
    begin = known.select("conv", "id", F.col("parent").alias("next"), "total").unionByName(roots.select("conv", "id", F.lit(None).cast("long").alias("next"), "total"))
    start = begin = materialize(begin.withColumn("low", F.col("id")), "climb")
    longest = begin.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    opened = begin.limit(0).select("conv", "id")
    while True:
        state, jumps = begin, []
        while True:
            going = state.filter("next is not null")
            if going.isEmpty() or 1 << len(jumps) > longest:
                break
            jumps.append(going.select("conv", "id", "next"))
            up = state.select(F.col("conv").alias("c"), F.col("id").alias("i"), F.col("next").alias("onward"), F.col("total").alias("more"), F.col("low").alias("lower"))
            met = going.join(up, F.col("conv").eqNullSafe(F.col("c")) & (F.col("next") == F.col("i")))
            met = met.select("conv", "id", F.col("onward").alias("next"), (F.col("total") + F.col("more")).alias("total"), F.least("low", "lower").alias("low"))
            state = materialize(state.filter("next is null").unionByName(met), "climb")
        if going.isEmpty():
            return state.select("conv", "id", "total"), jumps, opened
        # who still climbs after more steps than there are messages ends in a cycle, and has seen its least id
        targets = going.select("conv", F.col("next").alias("id")).distinct()
        opened = materialize(targets.join(state.select(F.col("conv").alias("c"), F.col("id").alias("i"), "low"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i"))).filter("id = low").select("conv", "id"), "opened")
        cut = opened.select(F.col("conv").alias("c"), F.col("id").alias("i"), F.lit(True).alias("cut"))
        begin = start.join(cut, F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")), "left")
        begin = materialize(begin.withColumn("next", F.when(F.col("cut").isNull(), F.col("next"))).select("conv", "id", "next", "total", "low"), "climb")


def leaves(jumps: list[DataFrame], totals: DataFrame) -> DataFrame:
    """totals of the messages that no other answers."""
    if not jumps:
        return totals
    answered = jumps[0].select(F.col("conv").alias("c"), F.col("next").alias("i")).distinct()
    return totals.join(answered, F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")), "left_anti")


def paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(conv, leaf, up, id): every message above each leaf (conv, id), up steps away (the leaf itself at 0)."""
    reached = materialize(chosen.select("conv", F.col("id").alias("leaf"), F.lit(0).cast("long").alias("up"), "id"), "paths")
    for k, jump in enumerate(jumps):
        step = jump.select(F.col("conv").alias("c"), F.col("id").alias("i"), "next")
        further = reached.join(step, F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i"))).select("conv", "leaf", (F.col("up") + (1 << k)).alias("up"), F.col("next").alias("id"))
        reached = materialize(reached.unionByName(further), "paths")
    return reached


def format_trees(messages: DataFrame, *, branches: int = 1) -> DataFrame:
    """One row for each chosen branch: conv, leaf, branch (1 is the best), score, n_turns, opened, formatted.

    messages: conv, id, parent, role, text, score. Branches are ranked by score (null: 0), then by leaf.
    """
    totals, jumps, opened = climbed(messages)
    order = Window.partitionBy("conv").orderBy(F.desc("total"), "id")
    best = materialize(leaves(jumps, totals).withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= branches), "branches")
    body = messages.select(F.col("conv").alias("c"), F.col("id").alias("i"), turn(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("turn"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i"))
    turns = paths(best, jumps).join(body, same).drop("c", "i")
    if opened.isEmpty():
        turns = turns.withColumn("cut", F.lit(False))
    else:
        turns = turns.join(opened.select(F.col("conv").alias("c"), F.col("id").alias("i"), F.lit(True).alias("cut")), same, "left").drop("c", "i")
    whole = turns.groupBy("conv", "leaf").agg(F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "turn"))).alias("turns"), F.coalesce(F.max("cut"), F.lit(False)).alias("opened"))
    ranked = best.select(F.col("conv").alias("c"), F.col("id").alias("i"), "branch", F.col("total").alias("score"))
    whole = whole.join(ranked, F.col("conv").eqNullSafe(F.col("c")) & (F.col("leaf") == F.col("i")))
    return whole.select("conv", "leaf", "branch", "score", F.size("turns").cast("long").alias("n_turns"), "opened", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"))


def from_rows(conversations: DataFrame) -> DataFrame:
    """Messages of a table (conv_id, turn, role, text): each row answers the one before it."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("id", F.row_number().over(order).cast("long"))
    return rows.withColumn("parent", F.when(F.col("id") > 1, F.col("id") - 1)).withColumn("score", F.lit(0.0)).drop("turn")


def digest(formatted: DataFrame) -> DataFrame:
    """What the contract reads back from formatted texts."""
    turns = F.col("turns")
    trained = F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == TRAINED), lambda t: t["text"]), "")
    spoken = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = formatted.withColumn("turns", read_back(F.col("formatted"))).withColumn("trained", trained)
    return back.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    return digest(format_trees(from_rows(rows.unionByName(extra))))


#: The same from the plain rows. The formatted length follows from the template: 16 code points and a line end a turn,
#: and one for each escaped control string.
OP6_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(16 + length(role) + length(text)
    + len(regexp_extract_all(text, '[<\[]\\*(\|[A-Za-z0-9_]{1,40}\||/?s>|/?INST\]|/?SYS>>|(bos|eos|pad|unk|start_of_turn|end_of_turn|begin_of_text)>)'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
