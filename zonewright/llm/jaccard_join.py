"""N-gram Jaccard join by chosen paths: classes of near-duplicate documents.

A text is the set of its word n-grams (five words, lower case, hashed to 32 bits). Equal sets are one representative. Each
representative has a sketch of minhashes, and every run of the join grows a forest of buckets: a bucket picks a few sketch
coordinates by a hash of its own path and splits its members by the values there, so two sets of similarity s stay
together with probability s a split. The expected number of picks is 1 / threshold, which keeps the number of common
buckets of a pair at the threshold steady. Every run begins with two splits. Runs are independent repetitions; their number
follows from the target recall for pairs two splits deep. Members of buckets that split on further have more runs among
themselves, as many as the depth really reached asks for.

Only signatures travel with buckets: two bits of each minhash, 32 bytes a set. Small buckets are compared by brute force
on these; a pair goes on if they agree as often as a pair at the threshold does, less `SIGMAS` standard deviations (a loss
of 1e-4 of the pairs right at the threshold, far below that of the paths; less above it). Connected sets of such pairs are
candidate groups, kept as labels. Buckets whose members all have one label have nothing to tell and are left out, which is
what becomes of dense groups: a first pass over a few runs links the members of each bucket with one of them that they
agree with. Larger
buckets with several labels split on, and what is left after `LEVELS` splits is compared in blocks.

Then each member of a candidate group gets its exact set, once, and all pairs of a group are compared exactly: groups of
up to `BLOCK` sets (or as many grams as so many sets of `BLOCK` grams have) in one task, larger ones in pairs of blocks.
There, the distance to one member of the group decides most pairs without a comparison: Jaccard distance is a metric, so
two sets whose distances to that member sum to at most 1 - threshold are linked, and two whose distances differ by more
are not. The former are counted from a histogram of distances; pairs of blocks with undecided pairs only are compared.
What leaves a task is a spanning forest of links and sums of links, never pairs. Connected components over the links are
the classes.

Defined cases: null text is in a class of its own; a text with fewer words than n has one gram of all its words; texts
without words have equal (empty) sets and form one class; repeated rows are copies of each other; a null doc_id is passed
through (as class id it gives way to others); an empty table gives no rows; other columns are ignored. Texts of any length
are read whole; the memory of a task grows with its longest text, and a very long one weighs as many grams as it has.
Sets are told apart by 64 bits of a 128-bit digest: of n different sets n * n / 2 ** 65 pairs are taken for one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import Remembered, bounded_broadcast, discard, lean, materialize, per_process, small_batches, spread_rank, table, unused

N = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Coordinates of a sketch that buckets split by, and of a signature (two bits each, 32 in a long).
SKETCH = 64
SIGNATURE = 128
SIGMAS = 4
#: Members up to which the signatures of a bucket are compared by brute force in one task.
SMALL = 2048
LEVELS = 10
#: Runs of the first pass.
FIRST_RUNS = 3
#: Sets of a block in exact comparisons; its square is the number of grams that a block may have.
BLOCK = 1024
#: Steps of a distance between 0 and 1.
STEPS = 1000
CACHED_WORDS = 150_000
#: Repeated rows up to which their keys are broadcast; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 20_000
_FACTORS = np.random.default_rng(0x5DEECE66D).integers(1, 1 << 63, (2, SIGNATURE), dtype=np.uint64) | np.uint64(1)
_LONGS = [f"s{i}" for i in range(SIGNATURE // 32)]


def runs_for(recall: float, threshold: float, levels: int = 2) -> int:
    """Runs after which a pair at the threshold has met with the target probability, with splits down to some levels."""
    # a branching process with a mean of one common child: Poisson offspring, at least one pick a bucket
    meet = 1.0
    for _ in range(levels):
        meet = 1 - math.exp(-meet)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def least_agreement(threshold: float) -> int:
    """Coordinates of two signatures that must agree for the pair to be looked at."""
    p = threshold + (1 - threshold) / 4
    return max(1, math.floor(SIGNATURE * p - SIGMAS * math.sqrt(SIGNATURE * p * (1 - p))))


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def grams(text: str, n: int, words: Remembered) -> np.ndarray:
    """The distinct hashed n-grams of a whole text, ascending."""
    words.trim()
    parts = text.lower().split()
    ids = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    if not len(ids):
        return np.zeros(0, np.uint32)
    m = max(1, len(ids) - n + 1)
    code = np.zeros(m, np.uint64)
    for k in range(min(n, len(ids))):
        code = _mix(code * _MIX[0] + ids[k : k + m])
    return np.unique((code >> np.uint64(32)).astype(np.uint32))


def sketch(items: np.ndarray, coordinates: int = SIGNATURE) -> np.ndarray:
    """Minhashes of a non-empty set, one for each coordinate."""
    out = np.empty(coordinates, np.uint32)
    factor = _FACTORS[:, :coordinates]
    least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 2048):  # long texts in stretches, to bound the memory
        x = items[at : at + 2048].astype(np.uint64)
        h = (x[None, :] + factor[1][:, None]) * factor[0][:, None]
        h ^= h >> np.uint64(31)
        h *= _MIX[1]
        np.minimum(least, h.min(axis=1), out=least)
    out[:] = least >> np.uint64(32)
    return out


def signatures(sketches: np.ndarray) -> np.ndarray:
    """[set, long]: the two lowest bits of each coordinate of [set, coordinate]."""
    bits = (sketches & np.uint32(3)).astype(np.uint64).reshape(len(sketches), -1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(bits, axis=2)


_SETS = "row binary, doc_id long, set_id binary, size int, sketch binary, " + ", ".join(f"{s} long" for s in _LONGS)
_ITEMS = "row binary, items binary"


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_process("gram_words", lambda: Remembered(_word_hash, CACHED_WORDS))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, sizes, sketches, minima = [], [], [], np.zeros((part.num_rows, SIGNATURE), np.uint32)
                for k, (row, text) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    items = grams(text or "", n, words)
                    if len(items):
                        minima[k] = sketch(items)
                    ids.append(b"null" + row if text is None else hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    sizes.append(-1 if text is None else len(items))
                    sketches.append(minima[k, :SKETCH].tobytes() if len(items) else b"")
                signed = signatures(minima).view(np.int64)
                columns = [part.column(0), part.column(1), pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), *(pa.array(c) for c in signed.T.copy())]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _SETS.split(", ")])

    return lean(run, keeps="gram_words")


def _items(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_process("gram_words", lambda: Remembered(_word_hash, CACHED_WORDS))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [grams(t.as_py() or "", n, words).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], names=["row", "items"])

    return lean(run, keeps="gram_words")


_CHILDREN = "id long, label long, path long"


def _children(coordinates: int, threshold: float, all_runs: range | None):
    """Splits: (id, label, path) rows from rows with id, label, sketch; two from the root for every run, one for a path."""
    chance = 1 / (threshold * coordinates)
    numbers = np.arange(coordinates, dtype=np.uint64)

    def picks(path: np.ndarray, root: bool = False) -> np.ndarray:
        """[bucket, coordinate]: whether the bucket splits by it; at the root one does at least."""
        draw = _mix(_mix(path[:, None] + numbers[None, :] * _MIX[0]))
        chosen = draw < np.uint64(int(chance * 2**64))
        if root:
            chosen[np.arange(len(path)), np.argmin(draw, axis=1)] = True
        return chosen

    def below(path: np.ndarray, coordinate: np.ndarray, value: np.ndarray) -> np.ndarray:
        return _mix(_mix(path + (coordinate.astype(np.uint64) + np.uint64(1)) * _MIX[1]) + value * _MIX[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(batch.num_rows, coordinates).astype(np.uint64)
            roots = _mix(np.arange(all_runs.start + 1, all_runs.stop + 1, dtype=np.uint64) * _MIX[0]) if all_runs else None
            for k in range(len(all_runs) if all_runs else 1):
                if all_runs:
                    first = np.nonzero(picks(roots[k : k + 1], root=True)[0])[0]
                    owner, begun = np.repeat(np.arange(batch.num_rows), len(first)), np.tile(first, batch.num_rows)
                    path = below(roots[k], begun, values[owner, begun])
                else:
                    owner, path = np.arange(batch.num_rows), batch.column(3).to_numpy().view(np.uint64)
                split, coordinate = np.nonzero(picks(path))
                member = owner[split]
                child = below(path[split], coordinate, values[member, coordinate])
                at = pa.array(member)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(child.view(np.int64))], names=["id", "label", "path"])

    return lean(run)


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For edges (a, b): (node, least node of its component), for nodes that are not the least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        least = np.minimum(label[a], label[b])
        for x in (label[a], label[b], a, b):
            np.minimum.at(new, x, least)
        while ((hop := new[new]) != new).any():
            new = hop
        if (new == label).all():
            moved = label != np.arange(len(nodes))
            return nodes[moved], nodes[label[moved]]
        label = new


def _agreeing(least: int):
    """For mapInArrow over rows with one column, the members of a bucket as (label, signature): edges (a, b) that span
    what the agreeing pairs of different labels connect in a batch of buckets."""
    pairs, most = np.uint64(0x5555555555555555), SIGNATURE - least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                lists = batch.column(0).slice(at, 256)
                lengths = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                label, *longs = (flat.field(i).to_numpy() for i in range(1 + len(_LONGS)))
                signed = np.stack([x.view(np.uint64) for x in longs], axis=1)
                after = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(label)) - 1  # members of the bucket behind each
                here, step, found = np.nonzero(after > 0)[0], 1, []
                while len(here):
                    x = signed[here] ^ signed[here + step]
                    near = np.bitwise_count((x | (x >> np.uint64(1))) & pairs).sum(axis=1) <= most
                    near &= label[here] != label[here + step]
                    if near.any():
                        found.append((label[here[near]], label[here[near] + step]))
                    step += 1
                    here = here[after[here] >= step]
                if found:
                    a, b = spanning_forest(*(np.concatenate(x) for x in zip(*found)))
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return lean(run)


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """[left, right]: sizes of the intersections; without right, of all pairs of left."""
    flat, owner = np.concatenate(left), np.repeat(np.arange(len(left)), [len(x) for x in left])
    if right is None:
        values, number, times = np.unique(flat, return_inverse=True, return_counts=True)
        shared = times > 1
        column = np.cumsum(shared) - 1
        width, keep = int(shared.sum()), shared[number]
        sides = [(owner[keep], column[number[keep]])] * 2
        shape = (len(left), len(left))
    else:
        other = np.concatenate(right)
        values = np.intersect1d(flat, other)
        width, shape, sides = len(values), (len(left), len(right)), []
        for f, o in ((flat, owner), (other, np.repeat(np.arange(len(right)), [len(x) for x in right]))):
            column = np.searchsorted(values, f)
            keep = column < width
            keep[keep] = values[column[keep]] == f[keep]
            sides.append((o[keep], column[keep]))
    ordered = [(own[order], col[order]) for own, col in sides for order in [np.argsort(col, kind="stable")]]
    out = np.zeros(shape, np.float32)
    for at in range(0, width, 4096):  # a strip of the member-by-gram matrices at a time
        strips = []
        for n, (own, col) in zip(shape, ordered, strict=True):
            a, b = np.searchsorted(col, [at, at + 4096])
            strip = np.zeros((n, min(4096, width - at)), np.float32)
            strip[own[a:b], col[a:b] - at] = 1
            strips.append(strip)
        out += strips[0] @ strips[1].T
    return out


def similar(left: list[np.ndarray], threshold: float, right: list[np.ndarray] | None = None) -> np.ndarray:
    """[left, right]: which pairs have a Jaccard similarity of the threshold or more; without right, of all pairs of left."""
    sizes = np.array([len(x) for x in left], np.float64)
    other = sizes if right is None else np.array([len(x) for x in right], np.float64)
    if right is None and len(left) == 2:
        one = float(len(np.intersect1d(*left, assume_unique=True)))
        both = np.array([[sizes[0], one], [one, sizes[1]]])
    else:
        both = overlaps(left, right).astype(np.float64)
        if right is None:
            np.fill_diagonal(both, sizes)
    return both >= threshold * (sizes[:, None] + other[None, :] - both) - 1e-6


def by_group(keys: int, compare):
    """For mapInArrow over sorted rows: compare(rows of one group), whose leading columns are the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                out = []
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True):
                    if row[:keys] != current:
                        if held:
                            out += compare(held)
                        current, held = row[:keys], []
                    held.append(row)
                if out:
                    yield _compared(out)
        if held and (out := compare(held)):
            yield _compared(out)

    return lean(run)


_COMPARED = "a long, b long, sets long, docs long"


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=[x.split()[0] for x in _COMPARED.split(", ")])


def _compare(threshold: float, limit: int):
    """Links (a, b) that span what is similar between the two blocks of a group or inside its one block, and for each set
    the numbers of links (a, null, sets, docs) that its distance to the group's pivot doesn't decide.

    Rows: class_id, i, j, block, id, distance, copies, items.
    """

    def compare(rows: list[tuple]) -> list[tuple]:
        at = sum(r[3] == r[1] for r in rows)
        ids, distance, copies = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 6))
        items = [np.frombuffer(r[7], np.uint32) for r in rows]
        inside = rows[0][1] == rows[0][2]
        near = similar(items, threshold) if inside else similar(items[:at], threshold, items[at:])
        one, other = (slice(None), slice(None)) if inside else (slice(None, at), slice(at, None))
        if inside:
            np.fill_diagonal(near, False)
        a, b = np.nonzero(np.triu(near) if inside else near)
        if not len(a):
            return []
        out = [(int(x), int(y), None, None) for x, y in zip(*spanning_forest(ids[one][a], ids[other][b]), strict=True)]
        near &= distance[one][:, None] + distance[other][None, :] > limit
        for side, who, whom in [(near, one, other)] + ([] if inside else [(near.T, other, one)]):
            counts = zip(ids[who], side.sum(axis=1), side @ copies[whom], strict=True)
            out += [(int(x), None, int(n), int(m)) for x, n, m in counts if n]
        return out

    return compare


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (class_id, id, items, items of the pivot): the distance in steps, rounded up."""
    for batch in batches:
        steps = []
        for mine, pivot in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(mine, np.uint32), np.frombuffer(pivot, np.uint32)
            both = len(np.intersect1d(a, b, assume_unique=True))
            steps.append(-((both - len(a) - len(b) + both) * STEPS // (len(a) + len(b) - both)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(steps, pa.int32())], names=["class_id", "id", "distance"])


def components(links: DataFrame) -> DataFrame:
    """(id, class_id): the least id of each connected component, for all ids in links (a, b)."""
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), F.col("label").alias("seen")), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        hop = labels.join(seen, labels["id"] == seen["a"], "left").select("id", "label", F.least("label", "seen").alias("next"))
        # and on to the label of the label: paths shrink by half each round
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("further"))
        moved = materialize(hop.join(jump, "next", "left").select("id", F.least("next", F.coalesce("further", "next")).alias("label"), F.col("label").alias("before")), "labels")
        discard(labels)
        labels = moved
        if moved.filter("label < before").isEmpty():
            discard(both)
            return labels.select("id", F.col("label").alias("class_id"))


def _relabelled(names: DataFrame, links: DataFrame, *columns: str) -> DataFrame:
    """(id, label, columns) of names, with the labels that links (a, b) between labels connect made one."""
    merged = components(links).withColumnRenamed("id", "label")
    return materialize(names.join(merged, "label", "left").withColumn("label", F.coalesce("class_id", "label")).select("id", "label", *columns), "names")


def _disagreement(left: str, right: str) -> Column:
    """Coordinates in which the signatures in two groups of columns differ."""
    differ = [F.col(f"{left}{s}").bitwiseXOR(F.col(f"{right}{s}")) for s in _LONGS]
    return reduce(Column.__add__, [F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(0x5555555555555555))) for x in differ])


def pivot_links(names: DataFrame, runs: range, threshold: float) -> DataFrame:
    """(a, b): each member of the buckets of some runs with the bucket's least member, where they agree enough."""
    held = materialize(names.select("id", "label", "sketch").mapInArrow(_children(SKETCH, threshold, runs), _CHILDREN).select("id", "path"), "frontier")
    pivots = held.groupBy("path").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("members")).filter("members > 1").select("path", "pivot")
    signed = names.select("id", *_LONGS)
    pivots = pivots.join(signed.select(F.col("id").alias("pivot"), *[F.col(s).alias(f"of_{s}") for s in _LONGS]), "pivot")
    met = held.join(pivots, "path").filter("id != pivot").join(signed, "id").select(F.col("id").alias("a"), F.col("pivot").alias("b"), _disagreement("", "of_").alias("differ"))
    links = materialize(met.filter(F.col("differ") <= SIGNATURE - least_agreement(threshold)).select("a", "b"), "pivots")
    discard(held)
    return links


def candidate_links(names: DataFrame, runs: range, threshold: float) -> tuple[DataFrame, DataFrame | None, int]:
    """What the chosen paths of some runs bring together: (a, b) links between labels, (id) of the members that split more
    than twice, if there are any, and the number of splits reached. names: id, label, sketch, signature."""
    frontier = names.select("id", "label", "sketch").mapInArrow(_children(SKETCH, threshold, runs), _CHILDREN)
    signed = names.select("id", *_LONGS)
    member = F.struct("label", *_LONGS).alias("member")
    links, deep = None, None

    def agreeing(buckets: DataFrame) -> DataFrame:
        nonlocal links
        found = materialize(buckets.mapInArrow(_agreeing(least_agreement(threshold)), "a long, b long"), "candidates")
        links = found if links is None else links.unionByName(found)

    held = None
    for splits in range(2, LEVELS + 1):
        # buckets of one label have nothing to tell; counts are summed before the shuffle, so a hot bucket is one row a task
        frontier = materialize(frontier, "frontier")
        if held is not None:
            discard(held)
        counts = frontier.groupBy("path").agg(F.count(F.lit(1)).alias("members"), F.min("label").alias("least"), F.max("label").alias("most"))
        held = materialize(frontier.join(counts.filter("least < most").select("path", "members"), "path"), "buckets")
        discard(frontier)
        agreeing(held.filter(F.col("members") <= SMALL).join(signed, "id").groupBy("path").agg(F.collect_list(member).alias("bucket")).select("bucket"))
        large = held.filter(F.col("members") > SMALL)
        if large.isEmpty():
            break
        if splits == LEVELS:  # blocks of hashes, each with each
            count = F.ceil(F.col("members") * 2 / SMALL).cast("int")
            dealt = large.join(signed, "id").withColumn("at", F.pmod(F.xxhash64("id", "path"), count).cast("int")).withColumn("to", F.explode(F.sequence(F.lit(0), count - 1)))
            agreeing(dealt.groupBy("path", F.least("at", "to").alias("i"), F.greatest("at", "to").alias("j")).agg(F.collect_list(member).alias("bucket")).select("bucket"))
            break
        found = materialize(large.select("id").distinct(), "deep")
        deep = found if deep is None else deep.unionByName(found)
        frontier = large.select("id", "label", "path").join(names.select("id", "sketch"), "id").select("id", "label", "sketch", "path").mapInArrow(_children(SKETCH, threshold, None), _CHILDREN)
    discard(held)
    return links, None if deep is None else materialize(deep.distinct(), "deep"), splits


def candidate_groups(names: DataFrame, *, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, label) of the sets in candidate groups of two or more; names: id, sketch, signature."""
    names = names.withColumn("label", F.col("id"))
    names = _relabelled(names, pivot_links(names, range(FIRST_RUNS), threshold), "sketch", *_LONGS)
    runs = runs_for(recall, threshold)
    links, deep, depth = candidate_links(names, range(runs), threshold)
    # a pair that parts deeper down meets less often in a run; both of its members are deep then, so these go on alone
    while deep is not None and (needed := runs_for(recall, threshold, depth)) > runs:
        names, before = _relabelled(names, links, "sketch", *_LONGS), names
        discard(before)
        links, _, reached = candidate_links(names.join(deep, "id", "left_semi"), range(runs, needed), threshold)
        runs, depth = needed, max(depth, reached)
    labels = _relabelled(names, links)
    discard(names)
    # a label is the least id of its group: a join by id, so that a large group is no hot key
    others = labels.filter("label <> id")
    heads = labels.join(others.select(F.col("label").alias("id")).distinct(), "id", "left_semi")
    return materialize(others.select("id", "label").unionByName(heads.select("id", "label")), "groups")


def compared(members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that span what is similar in the groups, and (id, sets, docs), the exact numbers of other sets and of
    their documents linked to each; members: id, class_id, size, copies, items."""
    limit = math.floor((1 - threshold) * STEPS + 1e-6)
    weighed = members.withColumn("weight", F.greatest(F.col("size"), F.lit(BLOCK)).cast("long"))
    groups = weighed.groupBy("class_id").agg(F.count(F.lit(1)).alias("members"), F.sum("weight").alias("weight"), F.min(F.struct(-F.col("copies"), "id")).alias("first"))
    large = materialize(groups.filter(F.col("weight") > BLOCK * BLOCK).select("class_id", "members", F.col("first.id").alias("pivot")), "large-groups")
    one = members.join(large.select("class_id"), "class_id", "left_anti")
    zero = F.lit(0)
    dealt = one.select("class_id", zero.alias("i"), zero.alias("j"), zero.alias("block"), "id", F.lit(STEPS).alias("distance"), "copies", "items")
    certain_links, certain = None, None
    if not large.isEmpty():
        pivots = members.join(large.select(F.col("pivot").alias("id")), "id", "left_semi").select("class_id", F.col("items").alias("of_pivot"))
        far = members.join(pivots, "class_id").select("class_id", "id", "items", "of_pivot").mapInArrow(lean(_distances), "class_id long, id long, distance int")
        far = materialize(far, "distances").join(weighed.select("id", "copies", "weight"), "id").join(large, "class_id")
        # order by distance; places come from sums, so no task orders a whole group
        mix = F.pmod(F.xxhash64("id"), F.ceil(F.col("members") / 10_000)).cast("int")
        placed = spread_rank(far, ["class_id"], [("_distance", F.col("distance")), ("_mix", mix)], ["id"], "before", "weight")
        placed = materialize(placed.select("class_id", "id", "distance", "copies", "pivot", F.floor(F.col("before") / (BLOCK * BLOCK)).cast("int").alias("block")), "blocks")
        certain_links = placed.filter((F.col("distance") <= limit) & (F.col("id") != F.col("pivot"))).select(F.col("id").alias("a"), F.col("pivot").alias("b"))
        histogram = placed.groupBy("class_id", "distance").agg(F.count(F.lit(1)).alias("sets"), F.sum("copies").alias("docs"))
        upto = Window.partitionBy("class_id").orderBy("distance")
        steps = placed.select("class_id").distinct().select("class_id", F.explode(F.sequence(F.lit(0), F.lit(limit))).alias("distance"))
        sums = steps.join(histogram, ["class_id", "distance"], "left").select("class_id", "distance", *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in ("sets", "docs")])
        sums = sums.select("class_id", (limit - F.col("distance")).alias("distance"), "sets", "docs")
        itself = (F.col("distance") * 2 <= limit).cast("int")
        certain = placed.join(sums, ["class_id", "distance"]).select(F.col("id").alias("a"), (F.col("sets") - itself).alias("sets"), (F.col("docs") - itself * F.col("copies")).alias("docs"))
        # blocks with undecided pairs: one of the two at least lies beyond half the limit
        blocks = placed.groupBy("class_id", "block").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
        left = blocks.select("class_id", F.col("block").alias("i"), F.col("low").alias("i_low"), F.col("high").alias("i_high"))
        right = blocks.select("class_id", F.col("block").alias("j"), F.col("low").alias("j_low"), F.col("high").alias("j_high")).filter(F.col("j_high") * 2 > limit)
        meets = left.join(right, "class_id").filter((F.col("i") <= F.col("j")) & (F.col("i_high") + F.col("j_high") > limit) & (F.col("j_low") - F.col("i_high") <= limit + 1)).select("class_id", "i", "j")
        sides = meets.select("class_id", "i", "j", F.col("i").alias("block")).unionByName(meets.filter("i < j").select("class_id", "i", "j", F.col("j").alias("block")))
        many = placed.select("class_id", "id", "distance", "copies", "block").join(sides, ["class_id", "block"]).join(members.select("id", "items"), "id")
        dealt = dealt.unionByName(many.select(*dealt.columns))
    dealt = dealt.repartition("class_id", "i", "j").sortWithinPartitions("class_id", "i", "j", "block", "id")
    found = materialize(dealt.mapInArrow(by_group(3, _compare(threshold, limit)), _COMPARED), "compared")
    links, counts = found.filter("b is not null").select("a", "b"), found.filter("b is null").select("a", "sets", "docs")
    if certain is not None:
        links, counts = links.unionByName(certain_links), counts.unionByName(certain)
    return links, counts.groupBy(F.col("a").alias("id")).agg(F.sum("sets").alias("text_links"), F.sum("docs").alias("doc_links"))


def row_key(docs: DataFrame):
    """Identifies a row up to rows that are equal to it in every column."""
    return F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(docs.columns)]), {"ignoreNullFields": "false"}).cast("binary")))


def classes(docs: DataFrame, *, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: row (its key), doc_id, set_id, class_id (the least doc_id of its class), n_copies (other
    documents with an equal set), n_text_links (other sets linked to its own), n_links (other documents linked)."""
    with small_batches(docs.sparkSession):
        rows = docs.select(row_key(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        sets = materialize(rows.mapInArrow(_sets(n), _SETS), "sets")
        reps = sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"), F.min("row").alias("row"), *[F.first(c).alias(c) for c in ("size", "sketch", *_LONGS)])
        reps = materialize(reps.withColumn("id", F.xxhash64("set_id")), "reps")
        groups = candidate_groups(reps.filter("size > 0").select("id", "sketch", *_LONGS), threshold=threshold, recall=recall)
        members = materialize(reps.select("row", "id", "size", "copies").join(groups.withColumnRenamed("label", "class_id"), "id"), "members")
        # only these need their sets, which are made again; always by shuffle: the members grow with the input, whatever their size here
        content = rows.select("row", "text").mapInArrow(_items(n), _ITEMS).join(members.hint("merge"), "row").drop("row")
        content = materialize(content, "content")
        if not content.groupBy("id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").isEmpty():
            content = materialize(content.dropDuplicates(["id"]), "content")  # rows repeated in every column
        links, counts = compared(content, threshold)
        labels = components(links)
        whole = reps.join(labels, "id", "left").withColumn("class", F.coalesce("class_id", "id")).drop("class_id")
        # written first, so that the join by class has an exchange of its own, which AQE splits where a class is large
        least = materialize(whole.groupBy("class").agg(F.min("least").alias("class_id")), "least")
        whole = whole.join(counts, "id", "left").join(least, "class").select(
            "set_id", "class", "class_id", (F.col("copies") - 1).alias("n_copies"), F.coalesce("text_links", F.lit(0)).cast("long").alias("n_text_links"), (F.coalesce("doc_links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")
        )
        whole = materialize(whole, "classes")
        discard(content, members, reps)
    return sets.select("row", "doc_id", "set_id").join(whole, "set_id")


def keep_one(docs: DataFrame, *, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """docs with one row of each class: the one with the least doc_id, then the least key of its whole row."""
    found = materialize(classes(docs, n=n, threshold=threshold, recall=recall).select("row", "doc_id", "class"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    kept = found.groupBy("class").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("members"))
    alone = kept.filter("members = 1")
    chosen = kept.filter("members > 1").select(F.col("best.row").alias("row"))
    dropped = materialize(found.join(alone, "class", "left_anti").select("row").distinct().join(chosen, "row", "left_anti"), "dropped")
    # a kept row may have exact repetitions in every column; only such rows are made distinct
    repeated = found.groupBy("row").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("row")
    repeated = materialize(repeated.join(dropped, "row", "left_anti"), "repeated")
    mark = unused(docs.columns, "_row")
    marked = docs.withColumn(mark, row_key(docs))
    # always by shuffle: what is dropped grows with the input, whatever its size here
    as_mark = lambda keys: keys.select(F.col("row").alias(mark)).hint("merge")
    if repeated.isEmpty():
        return marked.join(as_mark(dropped), mark, "left_anti").select(*docs.columns)
    plain = marked.join(as_mark(dropped.unionByName(repeated)), mark, "left_anti")
    once = marked.join(bounded_broadcast(repeated.select(F.col("row").alias(mark)), BROADCAST_ROWS), mark, "left_semi").dropDuplicates([mark])
    return plain.select(*docs.columns).unionByName(once.select(*docs.columns))


def op5_ngram_jaccard_join(spark, sf_dir):
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "n_text_links", "n_copies")
