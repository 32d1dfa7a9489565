"""Merkle manifest of a dataset: a tree of SHA-256 over documents, with proofs and folding from kept hash states.

Each document is a leaf. Per source, leaves ascend by doc_id; while more than one node remains, every three consecutive ones
become the hash of their digests. The subroots of the sources make the root in the same way.

A parent keeps a copy of its hash state before each child's slot. Folding a changed child resumes the state of its slot
with the new digest and what stands to the right: what stands to the left is never hashed again. Trees are built in chunks
of 3^7 nodes, one task each: a chunk's top is a node of the next round, so a source of any size takes a few rounds, each
2,187 times smaller than the one before. On the way down every chunk gets the path above it once (the digests left and
right of it, level by level), and its leaves fold through their own states first, then through the path's.

Only the digests of leaves and of what tampering makes of them travel; texts are hashed where they are read.

Defined cases: nulls in any column are leaves' `-`; a null doc_id comes first in its source and is never tampered with; a
null source is a source of its own and comes first; repeated rows are leaves of their own, ties in doc_id ascend by leaf;
empty texts have length 0 and differ from null; texts of any length are hashed whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import bounded_broadcast, in_order, materialize, table

WIDTH = 3
#: Levels of the tree that one task builds, and rows of the list of ranges up to which it is broadcast.
LEVELS = 7
BROADCAST_RANGES = 50_000


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))).cast("binary"), 256)


class Tree:
    """Levels of digests above a run of nodes, with the hash states that parents keep before their children's slots."""

    def __init__(self, digests: list[str], levels: int | None):
        """levels: how many are built at least; None: until one node remains."""
        self.states, self.left, self.right = [], [], []
        while len(self.states) < levels if levels is not None else len(digests) > 1:
            states, left, right, above = [], [], [], []
            for at in range(0, len(digests), WIDTH):
                run = digests[at : at + WIDTH]
                h = hashlib.sha256()
                for k, d in enumerate(run):
                    states.append(h.copy())
                    left.append("".join(run[:k]))
                    right.append("".join(run[k + 1 :]))
                    h.update(d.encode())
                above.append(h.hexdigest())
            self.states.append(states)
            self.left.append(left)
            self.right.append(right)
            digests = above
        self.top = digests[0]

    def fold(self, at: int, digest: str) -> str:
        """The top, had node `at` this digest."""
        for states, right in zip(self.states, self.right, strict=True):
            h = states[at].copy()
            h.update(digest.encode())
            h.update(right[at].encode())
            digest, at = h.hexdigest(), at // WIDTH
        return digest

    def path(self, at: int) -> list[tuple[str, str]]:
        """(digests to the left, to the right) of node `at` and of what is above it."""
        out = []
        for left, right in zip(self.left, self.right, strict=True):
            out.append((left[at], right[at]))
            at //= WIDTH
        return out


def written(path: list[tuple[str, str]]) -> str:
    return "".join(f"{a}|{b}/" for a, b in path)


def read(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split("|")) for level in path.split("/")[:-1]]


class Above:
    """Folding along a path, from the states before its slots."""

    def __init__(self, path: list[tuple[str, str]]):
        self.steps = [(hashlib.sha256(left.encode()), right.encode()) for left, right in path]
        self.siblings = "".join(left + right for left, right in path)

    def fold(self, digest: str) -> str:
        for state, right in self.steps:
            h = state.copy()
            h.update(digest.encode())
            h.update(right)
            digest = h.hexdigest()
        return digest


def _tree(rows: pd.DataFrame, levels: int) -> Tree:
    return Tree(list(rows["digest"]), None if rows["n"].iloc[0] <= WIDTH**levels else levels)


def _tops(rows: pd.DataFrame, levels: int) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    size = WIDTH**levels
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "pos": [rows["pos"].iloc[0] // size], "n": [-(-rows["n"].iloc[0] // size)], "digest": [_tree(rows, levels).top]})


def _paths(rows: pd.DataFrame, above: pd.DataFrame, levels: int) -> pd.DataFrame:
    rows = rows.sort_values("pos").reset_index(drop=True)
    if rows.empty:
        return pd.DataFrame(columns=["part", "pos", "path", "top", "root"])
    tree, upper = _tree(rows, levels), above.iloc[0]
    paths = [written(tree.path(i)) + upper["path"] for i in range(len(rows))]
    return pd.DataFrame({"part": rows["part"], "pos": rows["pos"], "path": paths, "top": upper["top"], "root": upper["root"]})


_NODE = "part string, pos long, n long, digest string"
_PATH = "part string, pos long, path string, top string, root string"


def chunk(levels: int) -> Column:
    return F.expr(f"pos div {WIDTH**levels}")


def rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (part, pos, n, digest) and, round by round, the tops of their chunks, up to one a part."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        tops = out[-1].select("part", "pos", "n", "digest").groupBy("part", chunk(levels).alias("chunk")).applyInPandas(lambda rows: _tops(rows, levels), _NODE)
        out.append(materialize(tops, "tops"))
    return out


def down(trees: list[DataFrame], paths: DataFrame, levels: int) -> DataFrame:
    """Paths (part, pos, path, top, root) of the nodes of trees[0], from those of trees[-1]."""
    for nodes in reversed(trees[:-1]):
        below = nodes.withColumn("chunk", chunk(levels)).groupBy("part", "chunk")
        above = paths.withColumnRenamed("pos", "chunk").groupBy("part", "chunk")
        paths = materialize(below.cogroup(above).applyInPandas(lambda rows, upper: _paths(rows, upper, levels), _PATH), "paths")
    return paths


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with pos (from 0) and n (rows) in their part, by the order; no task holds a part."""
    dealt = in_order(rows, [F.col("part"), *order], "_id").withColumn("_range", F.shiftright("_id", 33))
    spans = dealt.groupBy("part", "_range").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_many"))
    # as many rows as ranges and parts together
    part = Window.partitionBy("part")
    spans = spans.withColumn("_before", F.coalesce(F.sum("_many").over(part.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("n", F.sum("_many").over(part))
    spans = bounded_broadcast(materialize(spans.drop("_many"), "spans"), BROADCAST_RANGES)
    return dealt.join(spans, ["part", "_range"]).withColumn("pos", (F.col("_before") + F.col("_id") - F.col("_low")).cast("long")).drop("_id", "_range", "_low", "_before")


def _fold(rows: pd.DataFrame, above: pd.DataFrame, levels: int) -> pd.DataFrame:
    rows = rows.sort_values("pos").reset_index(drop=True)
    names = ["part", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    if rows.empty:
        return pd.DataFrame(columns=names)
    tree, upper = _tree(rows, levels), above.iloc[0]
    over = Above(read(upper["path"]))
    proofs, folded = [], []
    for i, digest in enumerate(rows["tampered"]):
        proofs.append(hashlib.sha256(("".join(a + b for a, b in tree.path(i)) + over.siblings).encode()).hexdigest())
        folded.append(over.fold(tree.fold(i, digest)))
    return pd.DataFrame({"part": rows["part"], "doc_id": rows["doc_id"], "leaf": rows["digest"], "subroot": upper["top"], "root": upper["root"], "proof_sha256": proofs, "folded_root": folded})


def manifest(leaves: DataFrame, *, levels: int = LEVELS) -> DataFrame:
    """One row per leaf: part, doc_id, leaf, subroot, root, proof_sha256, and folded_root, the root that the tampered leaf
    gives with the original siblings.

    leaves: part (source, ordered bytewise), doc_id, digest, tampered.
    """
    leaves = placed(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("tampered")])
    leaves = materialize(leaves, "leaves")
    trees = rounds(leaves.select("part", "pos", "n", "digest"), levels)
    subroots = trees[-1].select(F.lit("").alias("part"), F.col("part").alias("source"), "digest")
    subroots = materialize(placed(subroots, [F.col("source")]), "subroots")
    crown = rounds(subroots.select("part", "pos", "n", "digest"), levels)
    paths = crown[-1].select("part", F.lit(0).cast("long").alias("pos"), F.lit("").alias("path"), F.lit("").alias("top"), F.col("digest").alias("root"))
    paths = down(crown, paths, levels)
    # a source's path begins with that of its subroot
    paths = paths.drop("part").join(subroots.select("pos", "source", "digest"), "pos").select(F.col("source").alias("part"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("top"), "root")
    paths = down(trees[1:] or trees, paths, levels)
    # ids as text: pandas makes floats of longs with nulls
    rows = leaves.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("chunk", chunk(levels))
    out = rows.groupBy("part", "chunk").cogroup(paths.withColumnRenamed("pos", "chunk").groupBy("part", "chunk"))
    out = out.applyInPandas(lambda own, upper: _fold(own, upper, levels), "part string, doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def tampered_text(doc_id: Column, text: Column) -> Column:
    """text without its line ends where 2 divides the CRC of the decimal doc_id."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def leaves_of(docs: DataFrame) -> DataFrame:
    """(part, doc_id, digest, tampered) of documents; only digests leave the task that reads a text."""
    doc_id, source, lang, n_chars, text = F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"), F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("part"),
        doc_id.alias("doc_id"),
        leaf(doc_id, source, lang, n_chars, text).alias("digest"),
        leaf(doc_id, source, lang, n_chars, tampered_text(doc_id, text)).alias("tampered"),
    )


def op12_merkle_manifest(spark, sf_dir):
    leaves = materialize(leaves_of(table(spark, sf_dir, "documents")), "digests")
    out = manifest(leaves)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: CRC-32 of the decimal doc_id, eight shifts a digit; only its parity counts.
_EVEN = """list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substring(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))) % 2 = 1"""


def _leaf_sql(text: str) -> str:
    each = (f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(each)})"


#: The same by whole rehashing: all levels of all trees first, then every leaf climbs with its siblings.
OP12_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS digest, {_leaf_sql(f"CASE WHEN {_EVEN} THEN replace(text, chr(10), '') ELSE text END")} AS tampered FROM documents
), places AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves
), trees(level, source, idx, digest, n) AS (
  SELECT 0, source, idx, digest, n FROM places
  UNION ALL
  SELECT level + 1, source, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM trees WHERE n > 1 GROUP BY level, source, idx // 3, n
), subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM trees WHERE n = 1
), crown(level, idx, digest, n) AS (
  SELECT 0, idx, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM crown WHERE n > 1 GROUP BY level, idx // 3, n
), climb(k, leaf_at, level, source, idx, n, digest, proof) AS (
  SELECT row_number() OVER (), idx, 0, source, idx, n, tampered, '' FROM places
  UNION ALL
  SELECT c.k, c.leaf_at, c.level + 1, c.source, c.idx // 3, (c.n + 2) // 3,
    sha256(string_agg(CASE WHEN t.idx = c.idx THEN c.digest ELSE t.digest END, '' ORDER BY t.idx)),
    c.proof || coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx <> c.idx), '')
  FROM climb c JOIN trees t ON t.source IS NOT DISTINCT FROM c.source AND t.level = c.level AND t.idx // 3 = c.idx // 3
  WHERE c.n > 1 GROUP BY c.k, c.leaf_at, c.source, c.level, c.idx, c.n, c.digest, c.proof
), upward(k, leaf_at, source, level, idx, n, digest, proof) AS (
  SELECT c.k, c.leaf_at, c.source, 0, s.idx, s.n, c.digest, c.proof FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1
  UNION ALL
  SELECT c.k, c.leaf_at, c.source, c.level + 1, c.idx // 3, (c.n + 2) // 3,
    sha256(string_agg(CASE WHEN t.idx = c.idx THEN c.digest ELSE t.digest END, '' ORDER BY t.idx)),
    c.proof || coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx <> c.idx), '')
  FROM upward c JOIN crown t ON t.level = c.level AND t.idx // 3 = c.idx // 3
  WHERE c.n > 1 GROUP BY c.k, c.leaf_at, c.source, c.level, c.idx, c.n, c.digest, c.proof
)
SELECT p.doc_id, p.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(o.proof) AS proof_sha256, o.digest AS folded_root, o.digest = r.digest AS verified
FROM places p JOIN upward o ON o.n = 1 AND o.source IS NOT DISTINCT FROM p.source AND o.leaf_at = p.idx
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN crown r ON r.n = 1
"""
