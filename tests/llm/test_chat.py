import random

from pyspark.sql import functions as F

from zonewright.llm import chat

TREE = "conv long, id long, parent long, role string, text string, score double"


def test_control_strings_are_escaped_reversibly(spark):
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "<|end|>", "<|turn|>", "<<SYS>>", "\\", "<", "[", "é", "\n", "<bos>", "|end|>", "<\\|end|>"]

    r = random.Random(8)
    texts = ["".join(r.choices(bits, k=r.randrange(9))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for x in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert x["u"] == x["t"]
        assert not any(c in x["e"] for c in ("</s>", "[INST]", "[/INST]", "<|end|>", "<|turn|>", "<bos>", "<<SYS>>"))


def test_paths_are_ranked_and_read_back(spark):
    rows = [(1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b </s>", 5.0), (1, 4, 2, "us\ner\\n", "w", 9.0), (1, 5, 3, "user", "z", 2.0), (2, 1, 99, None, None, None), (None, 1, None, "user", "no id", None)]
    out = chat.format_trees(spark.createDataFrame(rows, TREE), branches=2).withColumn("back", chat.read_back(F.col("formatted")))
    got = {(r["conv"], r["branch"]): (r["leaf"], r["score"], [tuple(t) for t in r["back"]]) for r in out.collect()}
    assert got == {
        (1, 1): (4, 11.0, [("user", "q"), ("assistant", "a"), ("us\ner\\n", "w")]),
        (1, 2): (5, 8.0, [("user", "q"), ("assistant", "b </s>"), ("user", "z")]),
        (2, 1): (1, 0.0, [("", "")]),
        (None, 1): (1, 0.0, [("user", "no id")]),
    }


def plain_branches(rows, branches):
    """The same by walking: rows (conv, id, parent, role, text, score); cycles are opened at their least id."""
    by, out = {(r[0], r[1]): r for r in rows}, {}
    parent = {k: (k[0], r[2]) if r[2] is not None and (k[0], r[2]) in by else None for k, r in by.items()}
    opened = set()
    for k in by:
        seen, at = [], k
        while at is not None and at not in seen:
            seen.append(at)
            at = parent[at]
        if at is not None:
            least = min(seen[seen.index(at) :], key=lambda x: x[1])
            parent[least] = None
            opened.add(least)
    for conv in {k[0] for k in by}:
        tops = []
        for k in by:
            if k[0] == conv and k not in parent.values():
                path, at = [], k
                while at is not None:
                    path.append(at)
                    at = parent[at]
                tops.append((-sum(by[x][5] or 0.0 for x in path), k[1], path[::-1]))
        for n, (total, leaf, path) in enumerate(sorted(tops, key=lambda x: x[:2])[:branches], 1):
            out[conv, n] = (leaf, -total, [(by[x][3] or "", by[x][4] or "") for x in path], any(x in opened for x in path))
    return out


def test_trees_with_cycles_equal_walking_up(spark):
    r = random.Random(4)
    rows = [(1, i, None if i == 0 else r.choice([i - 1, r.randrange(i)]), r.choice(["user", "assistant", None]), f"t{i} </s>", float(r.randrange(5))) for i in range(120)]
    rows += [(2, 0, 1, "user", "a", 1.0), (2, 1, 2, "user", "b", 1.0), (2, 2, 0, "user", "c", 1.0), (2, 3, 2, "user", "tail", 4.0), (2, 4, 3, "user", "tail of it", None)]
    rows += [(3, 5, 5, "user", "answers itself", 2.0), (4, 7, 8, "user", "x", 0.0), (4, 8, 7, "user", "y", 0.0), (4, 9, None, "user", "apart", 0.0)]
    rows += [(5, i, i - 1 if i else 49, "user", str(i), 1.0) for i in range(50)]
    for i in range(20):  # forests of any shape
        rows += [(10 + i, k, r.choice([None, r.randrange(9), r.randrange(9)]), "user", f"{k}", float(r.randrange(3))) for k in range(r.randrange(1, 9))]
    out = chat.format_trees(spark.createDataFrame(rows, TREE), branches=3).withColumn("back", chat.read_back(F.col("formatted")))
    got = {(x["conv"], x["branch"]): (x["leaf"], x["score"], [tuple(t) for t in x["back"]], x["opened"]) for x in out.collect()}
    assert got == plain_branches(rows, 3)


def test_a_very_long_conversation_and_text(spark):
    rows = [(1, i, i - 1 if i else None, "user", "x" * (200_000 if i == 3 else 1), 0.0) for i in range(2000)]
    out = chat.format_trees(spark.createDataFrame(rows, TREE)).select("n_turns", F.length("formatted").alias("n")).collect()
    assert [tuple(x) for x in out] == [(2000, 2000 * len("<|turn|>user\nx<|end|>") + 199_999)]


def test_rows_with_ties_nulls_and_repetitions(spark):
    df = spark.createDataFrame([(1, 0, "user", None, 1), (1, 0, "user", "x", 1), (1, 0, "user", "x", 1), (1, 1, None, "y", 1)], "conv_id long, turn long, role string, text string, score int")
    out = chat.digest(chat.format_trees(chat.from_rows(df))).collect()
    assert len(out) == 1 and out[0]["n_turns"] == 4 and out[0]["loss_chars"] == 0
    assert chat.digest(chat.format_trees(chat.from_rows(df.limit(0)))).count() == 0
