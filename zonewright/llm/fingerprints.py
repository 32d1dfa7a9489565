"""Context-triggered piecewise hashing of documents.

A hash over a rolling window of seven bytes marks chunk ends wherever it meets -1 modulo the block size; every chunk gives
one base-64 character, so an edit changes only the characters around it. The block size follows from the length of the
text alone, so a text and its edited version of equal length always meet. A fingerprint holds the block size and the
signatures at that size and at twice that size; two fingerprints are compared where their sizes meet, by edit distance
(insertions and deletions) over signatures with long runs shortened, and count as unlike without seven characters in a row
in common (half the shorter signature, three at least, where it has fewer than fourteen). What is left at 0: texts whose
lengths differ so much that no sizes meet, and repetitive texts whose rolling hash hardly ever marks an end.

To set every text beside the next one in doc_id order, ids are cut into ranges: at approximate quantiles and around the ids
that many rows share (both lists are bounded and come to the driver), and between those evenly by the id, or for one
shared id by the hash of the text, into pieces of some `ROWS_PER_RANGE` rows by counts that stay in tables. The first row
of each range is also sent to the range before it, and each task streams its sorted ranges keeping one row in memory.

Defined cases: null text counts as empty; an empty text has the fingerprint `3::`, and two such are alike (1); rows with
the same doc_id are ordered by a hash of their text, then the text; a null doc_id comes first; a single row follows
itself; a text of any length is read whole, in stretches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, table

WINDOW = 7
LEAST_SIZE = 3
LENGTH = 64
ROWS_PER_RANGE = 500
#: Marks that the driver holds: quantiles at most, and ids that more than one in so many rows share.
MARKS = 1024
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_STRETCH = 1 << 20
_RUNS = re.compile(r"(.)\1{3,}")


def rolling(raw: np.ndarray) -> np.ndarray:
    """For each byte the hash of the seven bytes that end there (zeros before the start)."""
    padded = np.zeros(len(raw) + WINDOW - 1, np.uint32)
    padded[WINDOW - 1 :] = raw
    total, mixed, shifted = np.zeros(len(raw), np.uint32), np.zeros(len(raw), np.uint32), np.empty(len(raw), np.uint32)
    for back in range(WINDOW):
        part = padded[WINDOW - 1 - back : WINDOW - 1 - back + len(raw)]
        np.multiply(part, np.uint32(WINDOW + 1 - back), out=shifted)
        total += shifted
        np.left_shift(part, np.uint32(5 * back), out=shifted) if 5 * back < 32 else shifted.fill(0)
        mixed ^= shifted
    total += mixed
    return total


def _ends(raw: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash meets -1 modulo size, and their hashes; texts are read in stretches to bound the memory."""
    places, hashes = [], []
    for at in range(0, len(raw), _STRETCH):
        begin = max(0, at - WINDOW + 1)
        h = rolling(raw[begin : at + _STRETCH])[at - begin :]
        hit = np.flatnonzero(h % np.uint32(size) == np.uint32(size - 1))
        places.append(hit + at)
        hashes.append(h[hit])
    return (np.concatenate(places), np.concatenate(hashes)) if places else (np.zeros(0, np.int64), np.zeros(0, np.uint32))


def _signature(raw: bytes, ends: np.ndarray) -> str:
    marks = [0, *(ends[: LENGTH - 1] + 1).tolist()]
    if marks[-1] != len(raw):
        marks.append(len(raw))
    return "".join([_LETTERS[zlib.crc32(raw[a:b]) & 63] for a, b in zip(marks, marks[1:])])


def fingerprint(text: str) -> str:
    """`size:signature:signature at twice the size`."""
    raw = text.encode("utf-8", "surrogatepass")
    size = LEAST_SIZE
    while size * LENGTH < len(raw):
        size *= 2
    places, hashes = _ends(np.frombuffer(raw, np.uint8), size)
    first = places
    second = places[hashes % np.uint32(2 * size) == 2 * size - 1]
    return f"{size}:{_signature(raw, first)}:{_signature(raw, second)}"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word at a time."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & every
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    a, b = _RUNS.sub(r"\1\1\1", a), _RUNS.sub(r"\1\1\1", b)
    n = max(3, min(WINDOW, min(len(a), len(b)) // 2))
    grams = {a[i : i + n] for i in range(len(a) - n + 1)}
    if not any(b[i : i + n] in grams for i in range(len(b) - n + 1)):
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: one minus the edit distance in proportion to both signatures, at the best size they share."""
    if a == b:
        return 1.0
    (x, x1, x2), (y, y1, y2) = a.split(":"), b.split(":")
    x, y = int(x), int(y)
    if x == y:
        return max(_alike(x1, y1), _alike(x2, y2))
    return _alike(x2, y1) if 2 * x == y else _alike(x1, y2) if x == 2 * y else 0.0


def edited(text: str, following: str) -> str:
    """text with its last floor(n / 2) code points replaced by the first as many (or all) of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def ranges(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(range, piece, guest, doc_id, tie, text): rows by ranges of doc_id and their pieces; a guest is the first row of the
    piece after, and it stands at the end. The last piece has the first one's. Rows of one id and text are alike; where they
    are many their pieces are dealt by their place in the input."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n = ids.count()
    k = max(1, min(MARKS, n // rows_per_range))
    shared = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(rows_per_range, n // MARKS)).collect()  # fewer than MARKS
    marks = {int(m) for m in ids.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / k for i in range(1, k)], 0.2 / k)} if k > 1 else set()
    alone = sorted(r["doc_id"] for r in shared if r["doc_id"] is not None)
    marks = sorted(marks.union(alone, (m + 1 for m in alone if m + 1 < 1 << 63)))
    # range 0 is for null, and a shared id has one of its own
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(1 + (_rank_in(marks) if marks else F.lit(0))))
    single = F.col("doc_id").isNull() | F.col("doc_id").isin(alone) if alone else F.col("doc_id").isNull()
    rows = rows.withColumn("at", F.when(single, F.col("tie")).otherwise(F.col("doc_id")))
    # pieces of a range, evenly by the id or the hash: counts and ends of each range, one row a range
    size = rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), F.max("at").alias("high"))
    size = materialize(size, "ranges")  # 3 * MARKS rows at most
    width = (F.col("high").cast("double") - F.col("low").cast("double") + 1) / F.ceil(F.col("n") / rows_per_range)
    rows = rows.join(F.broadcast(size), "range").withColumn("even", F.floor((F.col("at").cast("double") - F.col("low").cast("double")) / width))
    # one text that many rows of one id share: their number is known from the ties of shared ids
    alike = rows.filter(single).groupBy("range", "at").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > max(rows_per_range, n // MARKS)).collect() if shared else []  # fewer than MARKS
    sub, step = F.lit(0).cast("long"), F.lit(0)
    if alike:
        held = F.create_map(*[x for r in alike for x in (F.concat_ws(":", F.lit(str(r["range"])), F.lit(str(r["at"]))), F.lit(-(-r["times"] // rows_per_range)))])
        parts = held[F.concat_ws(":", F.col("range").cast("string"), F.col("at").cast("string"))]
        # the rows before and after them in the same piece of hashes keep their order
        sub = F.when(parts.isNotNull(), F.pmod(F.monotonically_increasing_id(), parts)).otherwise(0).cast("long")
        lesser = [F.when((F.col("range") == r["range"]) & (F.col("at") > r["at"]), 1).otherwise(0) for r in alike]
        equal = [F.when((F.col("range") == r["range"]) & (F.col("at") == r["at"]), 1).otherwise(0) for r in alike]
        step = sum((2 * a + b for a, b in zip(lesser, equal)), F.lit(0))
    rows = rows.withColumn("piece", F.struct(F.col("even").cast("long").alias("even"), step.cast("long").alias("step"), sub.alias("sub")))
    place = F.struct("tie", F.col("text"))
    first = rows.groupBy("range", "piece").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", place.alias("place"))).alias("first"))
    # each piece's first row goes to the piece before it; a piece every some rows_per_range, and their keys alone are ordered
    first = materialize(first.select("range", "piece", "first.doc_id", "first.place.tie", "first.place.text"), "firsts")
    keys = first.select("range", "piece")
    within = Window.partitionBy("range").orderBy("piece")
    ends = keys.groupBy("range").agg(F.max("piece").alias("last"))
    before = Window.orderBy("range")  # one row a range
    ends = ends.withColumn("back", F.lag(F.struct("range", "last")).over(before)).withColumn("end", F.last(F.struct("range", "last")).over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    hosts = keys.withColumn("prior", F.lag("piece").over(within)).join(F.broadcast(ends.select("range", F.coalesce("back", "end").alias("host"))), "range")
    inside = F.col("prior").isNotNull()
    hosts = hosts.select("range", "piece", F.when(inside, F.col("range")).otherwise(F.col("host.range")).alias("to_range"), F.when(inside, F.col("prior")).otherwise(F.col("host.last")).alias("to_piece"))
    guests = first.join(hosts, ["range", "piece"]).select(F.col("to_range").alias("range"), F.col("to_piece").alias("piece"), F.lit(True).alias("guest"), "doc_id", "tie", "text")
    return rows.select("range", "piece", F.lit(False).alias("guest"), "doc_id", "tie", "text").unionByName(guests)


def _rank_in(marks: list[int]) -> Column:
    """How many of the sorted marks are at most doc_id: first among every step-th of them, then between two of those."""
    step = max(1, int(len(marks) ** 0.5))
    below = lambda m: m <= F.col("doc_id")
    coarse = F.size(F.filter(F.array(*[F.lit(m).cast("long") for m in marks[::step]]), below))
    blocks = F.array(*[F.array(*[F.lit(m).cast("long") for m in marks[i : i + step]]) for i in range(0, len(marks), step)])
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + F.size(F.filter(F.get(blocks, coarse - 1), below)))


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _OUT.split(", ")]
    held = None  # the row whose next one is still to come
    for batch in batches:
        out = []
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for rng, guest, doc_id, text in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                print_ = fingerprint(text) if held is None or text != held[3] else held[4]
                if held is not None and held[0] == rng and not held[1]:
                    changed = edited(held[3], text)
                    after = fingerprint(changed)
                    out.append((held[2], len(held[3]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), held[4], after, likeness(held[4], after), likeness(held[4], print_)))
                held = (rng, guest, doc_id, text, print_)
        if out:
            cols = list(zip(*out))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def compare_with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per document with the fingerprints of its text and its edited text, and their likeness."""
    rows = ranges(docs, rows_per_range)
    rows = rows.select(F.concat_ws("/", F.col("range").cast("string"), "piece.even", "piece.step", "piece.sub").alias("piece"), "guest", "doc_id", "text", "tie")
    dealt = rows.repartition("piece").sortWithinPartitions("piece", "guest", F.col("doc_id").asc_nulls_first(), "tie", "text")
    return dealt.select("piece", "guest", "doc_id", "text").mapInArrow(_compare, _OUT)


def op8_document_fingerprints(spark, sf_dir):
    return compare_with_next(table(spark, sf_dir, "documents"))
