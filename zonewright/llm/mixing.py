"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens to the power of an exponent between 0 and 1 (one over the temperature),
normalised. The exponent is searched by repeated sectioning until the weights meet a target entropy, or are as flat as a
limit on repetition allows. The weights become token budgets: every source is read whole as many times as its budget
holds, and the rest of it is spent on a block permutation: documents fall into as many blocks as a block has documents (the
root of their number, so that neither grows faster) by a keyed hash, blocks and the
documents in them are ordered by keyed hashes, and rows are taken in that order while they fit. Where the cut falls in a
source is two hash values, so a document's copies follow from its own row and its source's row; texts never move.

Without a budget the least one is taken at which no source is read less than once: small sources are repeated, nothing
is dropped.

Defined cases: a null source is a source of its own; null text has no tokens; a source without tokens keeps every row
once; repeated rows fall on the same side of the cut; ties in hash values stay together; a text of any length is counted
whole, and taken or left as a whole; an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import bounded_broadcast, materialize, table, unused

REPEATS = 1.5
SEED = 20250101
#: Sources up to which their table is broadcast; with more it is joined by a shuffle.
BROADCAST_SOURCES = 20_000
_SECTIONS, _SEARCHES = 32, 5


def tokens(text: Column) -> Column:
    """Words of the whole text, the measure of all shares and budgets here."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass
class Mixture:
    exponent: float
    entropy: float
    budget: float
    total: float


def search_exponent(sources: DataFrame, *, repeats: float | None = REPEATS, entropy: float | None = None, budget: float | None = None) -> Mixture | None:
    """The exponent that meets the targets, from a table with a column `tokens`; None if there are no tokens.

    Each search evaluates a grid of exponents in one aggregation, so the sources may be any number.
    """
    shares = sources.filter("tokens > 0").crossJoin(F.broadcast(sources.agg(F.sum("tokens").alias("total")))).select((F.col("tokens") / F.col("total")).alias("p"), "total")
    low, high, found = 0.0, 1.0, None
    for _ in range(_SEARCHES):
        grid = [low + (high - low) * i / (_SECTIONS - 1) for i in range(_SECTIONS)]
        power = [F.pow(F.col("p"), F.lit(a)) for a in grid]
        got = shares.agg(F.min("p").alias("least"), F.max("p").alias("most"), F.max("total").alias("total"), *[F.sum(x).alias(f"z{i}") for i, x in enumerate(power)], *[F.sum(x * F.log(F.col("p"))).alias(f"s{i}") for i, x in enumerate(power)]).first()
        if got["total"] is None:
            return None
        points = []
        for i, a in enumerate(grid):
            z, h = got[f"z{i}"], math.log(got[f"z{i}"]) - a * got[f"s{i}"] / got[f"z{i}"]
            all_once = got["total"] * z * got["most"] ** (1 - a)
            spent = budget if budget is not None else all_once
            most_read = spent / got["total"] * got["least"] ** (a - 1) / z
            points.append((a, h, spent, (entropy is None or h <= entropy + 1e-12) and (repeats is None or most_read <= max(repeats, spent / got["total"]) * (1 + 1e-9))))
        first = next((i for i, x in enumerate(points) if x[3]), len(points) - 1)  # flatter mixtures break a target; exponent 1 is the corpus as it is
        found = Mixture(points[first][0], points[first][1], points[first][2], float(got["total"]))
        low, high = (points[first - 1][0] if first else points[0][0]), points[first][0]
        if first == 0:
            break
    return found


def mix(docs: DataFrame, *, repeats: float | None = REPEATS, entropy: float | None = None, budget: float | None = None, seed: int = SEED, source: str = "source", detail: bool = False) -> DataFrame:
    """docs with each row as often as the mixture reads it; detail: and the columns mix_tokens, mix_weight, mix_pass
    (from 1), mix_block (order of the block in its source's pass) and mix_order (of the row in its block)."""
    names = {k: unused(docs.columns, k) for k in ("mix_source", "mix_tokens", "mix_weight", "mix_pass", "mix_block", "mix_order", "_full", "_cut_block", "_cut_order", "_blocks", "_doc", "_block")}
    n = names.get
    ids = [c for c in docs.columns if c in ("doc_id", "text")]
    rows = docs.withColumn(n("mix_source"), F.to_json(F.struct(F.col(source).cast("string").alias("s")))).withColumn(n("mix_tokens"), tokens(F.col("text")))
    rows = rows.withColumn(n("mix_order"), F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in ids]))
    small = materialize(rows.select(F.col(n("mix_source")).alias("source"), F.col(n("mix_tokens")).alias("tokens"), F.col(n("mix_order")).alias("doc")), "mix-rows")
    per_source = materialize(
        small.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).withColumn("blocks", F.ceil(F.sqrt("docs")).cast("int")), "mix-sources"
    )
    mixture = search_exponent(per_source, repeats=repeats, entropy=entropy, budget=budget)
    if mixture is None:
        plan = per_source.withColumn("weight", F.lit(0.0)).withColumn("reads", F.lit(1.0))
    else:
        share = F.col("tokens") / F.lit(mixture.total)
        plan = per_source.crossJoin(F.broadcast(per_source.filter("tokens > 0").agg(F.sum(F.pow(share, F.lit(mixture.exponent))).alias("z"))))
        plan = plan.withColumn("weight", F.when(F.col("tokens") > 0, F.pow(share, F.lit(mixture.exponent)) / F.col("z")).otherwise(0.0))
        plan = plan.withColumn("reads", F.when(F.col("tokens") > 0, F.col("weight") * F.lit(mixture.budget) / F.col("tokens")).otherwise(1.0))
    # a hair more than a whole number of passes is that number
    plan = plan.withColumn("full", F.floor(F.col("reads") + 1e-6).cast("int")).withColumn("part", F.greatest(F.lit(0), F.round((F.col("reads") - F.col("full")) * F.col("tokens"))).cast("long"))
    plan = materialize(plan.select("source", "tokens", "docs", "blocks", "weight", "full", "part"), "mix-plan")
    sources = bounded_broadcast(plan, BROADCAST_SOURCES)

    def block(doc: Column, blocks: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed + 1), doc), blocks.cast("long")).cast("int")

    def block_order(source_: Column, pass_: Column, block_: Column) -> Column:
        return F.xxhash64(F.lit(seed + 2), source_, pass_, block_)

    # the last pass of each source: blocks in their order, until the budget ends in one of them
    placed = small.join(sources.select("source", "blocks", "full", "part"), "source").filter("part > 0")
    placed = placed.withColumn("order", block_order(F.col("source"), F.col("full") + 1, block(F.col("doc"), F.col("blocks"))))
    blocks = placed.groupBy("source", "order").agg(F.sum("tokens").alias("tokens"), F.first("part").alias("part"))
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("order").rowsBetween(Window.unboundedPreceding, -1))
    ends = blocks.withColumn("before", F.coalesce(before, F.lit(0))).filter("before <= part").groupBy("source").agg(F.max(F.struct("order", "before")).alias("end"))
    ends = materialize(ends.select("source", F.col("end.order").alias("cut_block"), F.col("end.before").alias("before")), "mix-ends")
    last = placed.join(bounded_broadcast(ends, BROADCAST_SOURCES), "source").filter(F.col("order") == F.col("cut_block"))
    run = F.sum("tokens").over(Window.partitionBy("source").orderBy("doc").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cuts = last.withColumn("run", run).filter(F.col("before") + F.col("run") <= F.col("part")).groupBy("source").agg(F.max("doc").alias("cut_order"))
    decided = plan.join(ends.drop("before"), "source", "left").join(cuts, "source", "left")
    decided = materialize(decided.select("source", "blocks", "weight", "full", "cut_block", "cut_order"), "mix-decided")

    decided = decided.select(F.col("source").alias(n("mix_source")), F.col("blocks").alias(n("_blocks")), F.col("weight").alias(n("mix_weight")), F.col("full").alias(n("_full")), F.col("cut_block").alias(n("_cut_block")), F.col("cut_order").alias(n("_cut_order")))
    out = rows.join(bounded_broadcast(decided, BROADCAST_SOURCES), n("mix_source")).withColumn(n("_block"), block(F.col(n("mix_order")), F.col(n("_blocks"))))
    at = block_order(F.col(n("mix_source")), F.col(n("_full")) + 1, F.col(n("_block")))
    more = F.coalesce((at < F.col(n("_cut_block"))) | ((at == F.col(n("_cut_block"))) & F.coalesce(F.col(n("mix_order")) <= F.col(n("_cut_order")), F.lit(False))), F.lit(False))
    out = out.withColumn(n("mix_pass"), F.explode(F.sequence(F.lit(0), F.col(n("_full")) + more.cast("int")))).filter(F.col(n("mix_pass")) > 0)
    if not detail:
        return out.select(*docs.columns)
    return out.select(*docs.columns, n("mix_tokens"), n("mix_weight"), n("mix_pass"), block_order(F.col(n("mix_source")), F.col(n("mix_pass")), F.col(n("_block"))).alias(n("mix_block")), n("mix_order"))


def op9_mixing_sources(spark, sf_dir):
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), detail=True)
    return out.drop("text")
