"""Sharding by balanced label propagation.

Linked documents (here: those with equal texts) should share a shard; shards should hold equally many rows. The state is
a table (group, shard, rows): members of a group are alike, so it says all. Every round joins it with what each group
sees of its members: a group prefers the shard where most of them are and moves the others there, as far as the quotas of
the receiving shards allow; groups in overfull shards move to the emptiest. Groups larger than a quarter of a quota are
split beforehand into parts that move on their own, so no copy group can swamp a shard. In the end what is still spread
follows its largest share, parts that a shard's quota has no room for leave it as a whole, and they (the largest first) and
the unlinked rows fill the quotas exactly: row counts differ by one at most, and only a part across the end of a shard is
split, at most one a shard.

Work is dealt by hashes of doc_id, into as many buckets as a bucket has rows. The rows of an id that more than a thousand
rows have (or of null) are told apart by their place in the input, so that they spread too; which of them goes where then
depends on that place.

Defined cases: null text counts as empty (all such rows are linked); null doc_ids and repeated rows are rows like
others; ties in a ranking are rows that are alike in all that the result has; a very long text is a row like others (only
its size and checksums travel); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import buckets_for, hash_bucket, materialize, spread_rank, table, told_apart

SHARDS = 16
ROUNDS = 4


def _share(shards: int, *salt: str):
    """A number in [0, 1) that a hash gives."""
    return F.pmod(F.xxhash64(*salt), F.lit(1 << 20)) / float(1 << 20)


def propagate(state: DataFrame, shards: int, quota: int, rounds: int = ROUNDS) -> DataFrame:
    """(part, shard, n) after some rounds of moves under the quota; n sums to the same for every part."""
    for k in range(rounds):
        loads = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # at most one row a shard
        room = sorted((quota - loads.get(s, 0), s) for s in range(shards))
        votes = state.groupBy("part").agg(F.max(F.struct("n", F.xxhash64("part", "shard").alias("tie"), "shard")).alias("best"), F.sum("n").alias("total"))
        votes = votes.select("part", "total", F.col("best.shard").alias("target"))
        over = {s: -free / loads[s] for free, s in room if free < 0}
        if over:  # parts that leave an overfull shard, dealt over the shards with room, by how much they have
            free = [(f, s) for f, s in room if f > 0]
            whole = float(sum(f for f, _ in free)) or 1.0
            leaving = F.create_map(*[F.lit(x) for s, f in over.items() for x in (s, float(f))])
            pick, upto = F.lit(free[-1][1] if free else 0), 0.0
            spin = _share(shards, "part", F.lit(2 * k))
            for f, s in reversed(free[:-1]):
                upto += f / whole
                pick = F.when(spin >= 1 - upto, s).otherwise(pick) if upto < 1 else pick
            goes = _share(shards, "part", F.lit(2 * k + 1)) < F.coalesce(leaving[F.col("target")], F.lit(0.0))
            votes = votes.withColumn("target", F.when(goes, pick).otherwise(F.col("target")))
        moves = state.join(votes, "part")
        flow = {r["target"]: r for r in moves.groupBy("target").agg(F.sum(F.when(F.col("shard") != F.col("target"), F.col("n")).otherwise(0)).alias("coming"), F.sum("n").alias("after")).collect()}
        # what a shard takes in is cut to its quota; which parts move is a matter of a hash
        allowed = [F.lit(x) for t, r in flow.items() for x in (t, 1.0 if r["after"] <= quota or not r["coming"] else max(0.0, 1 - (r["after"] - quota) / r["coming"]))]
        if not allowed:
            return state
        accepted = _share(shards, "part", F.lit(-1 - k)) < F.create_map(*allowed)[F.col("target")]
        state = materialize(moves.withColumn("shard", F.when(accepted, F.col("target")).otherwise(F.col("shard"))).groupBy("part", "shard").agg(F.sum("n").alias("n")), "shards")
    return state


def shard(docs: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, and whether it is linked to another."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    nodes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("group"),
    )
    nodes = materialize(told_apart(nodes, "doc_id", "copy"), "nodes")
    rows = nodes.count()
    if not rows:
        return nodes.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(False).alias("linked"))
    quotas = [rows // shards + (s < rows % shards) for s in range(shards)]
    quota, most = quotas[-1], max(1, quotas[0] // 4)

    # written first, so that the join has an exchange of its own, which AQE splits where copies of one text are many
    groups = materialize(nodes.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "groups")
    linked = nodes.join(groups, "group")
    # ties in doc_id: members with equal ids and texts are alike, so any order among them gives the same rows
    linked = linked.withColumn("part", F.xxhash64("group", F.pmod(F.xxhash64("doc_id", "copy"), F.ceil(F.col("members") / most))))
    linked = materialize(linked.select("doc_id", "copy", "size", "text_crc32", "part", hash_bucket(shards, "doc_id", "copy").alias("first")), "linked")
    start = linked.groupBy("part", F.col("first").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    state = propagate(materialize(start, "shards"), shards, quota, rounds)

    # what is still spread follows its largest share; parts beyond a shard's quota leave it, each as a whole
    whole = state.groupBy("part").agg(F.max(F.struct("n", F.xxhash64("part", "shard").alias("tie"), "shard"))["shard"].alias("shard"), F.sum("n").alias("n"))
    limit = F.get(F.array(*[F.lit(q).cast("long") for q in quotas]), F.col("shard"))
    by_part = [("_part", hash_bucket(buckets_for(quota), "part"))]
    whole = spread_rank(materialize(whole, "parts"), ["shard"], by_part, ["part"], "before", weight="n")
    whole = materialize(whole.withColumn("stays", F.col("before") + F.col("n") <= limit).drop("before"), "parts")
    staying = spread_rank(whole.filter("stays"), ["shard"], by_part, ["part"], "at", weight="n")
    # the largest first, so that what little room is left after them goes to small ones and to single rows
    by_size = [("_size", (-F.floor(F.log2("n"))).cast("int")), ("_part", hash_bucket(buckets_for(rows), "part"))]
    leaving = spread_rank(whole.filter("not stays"), [], by_size, ["part"], "at", weight="n")
    parts = materialize(staying.unionByName(leaving), "parts")
    sums = whole.groupBy("stays", "shard").agg(F.sum("n").alias("n")).collect()  # at most two rows a shard
    taken = {r["shard"]: r["n"] for r in sums if r["stays"]}
    left = sum(r["n"] for r in sums if not r["stays"])

    # members by rank in their part, which has at most a quarter of a quota; then what leaves and the single rows fill what is free
    fine = [("_fine", hash_bucket(buckets_for(most), "doc_id", "copy"))]
    members = spread_rank(linked, ["part"], fine, ["doc_id", "copy"], "rank").join(parts.select("part", "shard", "stays", "at"), "part")
    members = members.select("doc_id", "size", "text_crc32", F.when(F.col("stays"), F.col("shard")).alias("shard"), (F.col("at") + F.col("rank")).alias("rank"), F.lit(True).alias("linked"))
    singles = nodes.join(groups, "group", "left_anti").select("doc_id", "copy", "size", "text_crc32")
    singles = spread_rank(singles, [], [("_at", hash_bucket(buckets_for(rows), "doc_id", "copy", "text_crc32"))], ["doc_id", "copy", "text_crc32", "size"], "rank")
    singles = singles.select("doc_id", "size", "text_crc32", F.lit(None).cast("int").alias("shard"), (F.col("rank") + left).alias("rank"), F.lit(False).alias("linked"))
    place, at, before = F.col("shard"), F.col("rank"), 0
    for s in sorted(range(shards), key=lambda s: taken.get(s, 0) - quotas[s]):
        free = quotas[s] - taken.get(s, 0)
        here = F.col("shard").isNull() & (F.col("rank") >= before) & (F.col("rank") < before + free)
        place, at, before = F.when(here, s).otherwise(place), F.when(here, F.col("rank") - before + taken.get(s, 0)).otherwise(at), before + free
    return members.unionByName(singles).select("doc_id", "size", "text_crc32", place.alias("shard"), at.cast("long").alias("slot"), "linked")


def op10_sharding(spark, sf_dir):
    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"), "linked")
