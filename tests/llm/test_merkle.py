"""The Merkle manifest against plain rehashing of whole trees."""

import hashlib
import zlib

import pytest

from zonewright.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, part string, pos long, Digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def top(nodes):
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0]


def siblings(nodes, at):
    out = []
    while len(nodes) > 1:
        run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
        out += run[: at % 3] + run[at % 3 + 1 :]
        nodes, at = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], at // 3
    return out


def plain(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    leaves = {s: [leaf(r) for r in trees[s]] for s in order}
    subroots = [top(leaves[s]) for s in order]
    root, out = top(subroots), []
    for k, s in enumerate(order):
        for i, r in enumerate(trees[s]):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            changed = leaf((*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4]))
            folded = top(subroots[:k] + [top(leaves[s][:i] + [changed] + leaves[s][i + 1 :])] + subroots[k + 1 :])
            out.append((r[0], leaves[s][i], subroots[k], root, h(*siblings(leaves[s], i), *siblings(subroots, k)), folded))
    return out


def documents():
    rows = [(i, f"src{i % 3}" if i % 7 else None, ["en", None][i % 2], None if i % 5 == 0 else i, None if i % 11 == 0 else f"line {i}\nmore ä\U0001f600\n" * (i % 4)) for i in range(150)]
    rows += [(3, "src0", "en", 3, "tie"), (3, "src0", "en", 3, "other\ntie"), (3, "src0", "en", 3, "other\ntie"), (None, "src0", "en", 1, "x\ny"), (None, None, None, None, None), (1 << 60, "z", "en", 4, "lone\n"), ((1 << 60) + 1, "src1", None, 2, ""), (8, "long", "en", 9, "a b\n" * 200_000)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_whole_rehashing(spark, levels):
    rows = documents()
    docs = spark.createDataFrame([(*r, "clash", 5, "clash") for r in rows], SCHEMA)
    got = merkle.manifest(merkle.leaves_of(docs), levels=levels).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)


def test_one_row_and_no_row(spark):
    one = merkle.manifest(merkle.leaves_of(spark.createDataFrame([(1, "a", "en", 3, "a\nb", "", 0, "")], SCHEMA))).collect()
    assert [tuple(r)[1:] for r in one] == [tuple(r) for r in plain([(1, "a", "en", 3, "a\nb")])]
    assert merkle.manifest(merkle.leaves_of(spark.createDataFrame([], SCHEMA))).collect() == []


def test_a_chunk_never_rehashes_the_left(monkeypatch):
    digests = [h(str(i)) for i in range(20)]
    tree = merkle.Tree(digests, None)
    for i in range(20):
        assert tree.fold(i, digests[i]) == tree.top
        assert tree.fold(i, h("other")) == top(digests[:i] + [h("other")] + digests[i + 1 :])
        assert merkle.Above(merkle.read(merkle.written(tree.path(i)))).fold(digests[i]) == tree.top
