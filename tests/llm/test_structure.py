"""Structure repair against exhaustive search and a plain row-by-row version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonewright.llm import structure as s

SCHEMA = "conv_id long, turn long, role string, text string, conv long, key string, seq string"
WHITE = " \t\n\x0b\x0c\r"


def exhaustive(symbols):
    """All edits with few insertions: cost and audit of the best."""
    best = None
    slots = len(symbols) + 1
    for inserted in itertools.product(range(3), repeat=slots):
        if sum(inserted) > 3:
            continue
        for letters in itertools.product("DKR", repeat=len(symbols)):
            audit = "".join("I" * n + x for n, x in zip(inserted, [*letters, ""]))
            cost, at, state, ok = 0, 0, "E", True
            for x in audit:
                c = None
                if x == "I":
                    cost += 5
                    c = "a" if state == "U" else "u"
                else:
                    symbol, at = symbols[at], at + 1
                    if x == "D":
                        cost += 2
                        continue
                    ok &= symbol != "x"
                    cost += (x == "R") + 5 * symbol.isupper()
                    c = symbol.lower() if x == "K" else "a" if state == "U" else "u"
                state = s.NEXT.get((state, c))
                if state is None:
                    ok = False
                    break
            if ok and state in "EA":
                best = min(best or (cost, audit), (cost, audit))
    return best


def evaluated(symbols, rules):
    known, vector = s.matrices(rules), {"E": (0, None)}
    for x in s.compressed(symbols, rules):
        vector = s.moved(vector, known[x])
    return s.finished(vector)


@settings(max_examples=60, deadline=None)
@given(st.text(s.SYMBOLS, max_size=4))
def test_matrices_equal_exhaustive_search(symbols):
    assert evaluated(symbols, []) == exhaustive(symbols)


@settings(max_examples=150, deadline=None)
@given(st.text(s.SYMBOLS, max_size=60), st.lists(st.text(s.SYMBOLS, min_size=2, max_size=2), max_size=5))
def test_a_grammar_changes_nothing(symbols, rules):
    rules = [*rules, *(s.named(k) + s.named(k) for k in range(len(rules)))]
    assert s.expanded(s.compressed(symbols, rules), rules) == symbols
    assert evaluated(symbols, rules) == evaluated(symbols, [])


def test_rules_are_the_frequent_pairs(spark):
    sequences = spark.createDataFrame([("uauaua", 10), ("suaua", 3), ("ax", 1), ("", 4)], "seq string, n long")
    rules = s.learn(sequences, rules=3, a_round=1)
    assert rules[0] == "ua" and rules[1] == s.named(0) * 2
    assert s.compressed("uauauaua", rules[:2]) == s.named(1) * 2
    assert s.learn(spark.createDataFrame([], "seq string, n long")) == []


def plain(rows):
    """The task row by row, with one dictionary of states."""
    out, ids = {}, {r[0] for r in rows}
    for conv in ids:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        blank = duplicate = truncated = illegal = 0
        best, seen, turns, prior = {"E": (0, "", [])}, set(), [t for t, *_ in kept if t is not None], None

        def insert(best):
            for _ in range(3):
                for p, (c, a, o) in list(best.items()):
                    role = "assistant" if p == "U" else "user"
                    q, new = s.NEXT[p, role[0]], (c + 5, a + "I", o + [role + ":"])
                    best[q] = min(best.get(q, new), new)
            return best

        for _, role, text in kept:
            bare = text.rstrip(WHITE)
            dead = cut = False
            if not bare:
                blank, dead = blank + 1, True
            elif (role, text) in seen:
                duplicate, dead = duplicate + 1, True
            elif bare[-1] not in ".!?":
                truncated, cut = truncated + 1, True
            seen.add((role, text))
            illegal += prior is not None and prior + role[:1] not in ("su", "ua", "au")
            prior, nxt = role[:1], {}
            for p, (c, a, o) in insert(best).items():
                new = [(p, (c + 2, a + "D", o))]
                if not dead:
                    if (p, role[:1]) in s.NEXT:
                        new.append((s.NEXT[p, role[:1]], (c + 5 * cut, a + "K", o + [f"{role}:{text}"])))
                    other = "assistant" if p == "U" else "user"
                    new.append((s.NEXT[p, other[0]], (c + 1 + 5 * cut, a + "R", o + [f"{other}:{text}"])))
                for q, x in new:
                    nxt[q] = min(nxt.get(q, x), x)
            best = nxt
        cost, audit, said = min(v for q, v in insert(best).items() if q in "EA")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def conversations():
    rng = random.Random(3)
    rows = [(i // 6, rng.choice([i % 6, i % 6, None, 3, i % 6 + 40]), rng.choice(["user", "assistant", "system", "tool", "uncle", "", None]), rng.choice(["Hi.", "Well", "", None, " \n", "So?", "é! ", f"{i}."])) for i in range(900)]
    rows += [(1000, i, ["user", "assistant"][i % 2], f"line {i}.") for i in range(40)]
    rows += [(1001, i, rng.choice(["user", "assistant", "user", "system"]), rng.choice([f"a {i}.", f"b {i}", "same."])) for i in range(1500)]
    rows += [(None, None, "user", "again."), (None, None, "user", "again."), (None, 2, "assistant", "x" * 300_000 + ".")]
    rows += rows[:30]
    return rows


@pytest.mark.parametrize(("block", "rules"), [(512, 48), (7, 12)])
def test_repair_equals_the_plain_version(spark, monkeypatch, block, rules):
    monkeypatch.setattr(s, "BLOCK", block)
    rows = conversations()
    table = spark.createDataFrame([(*r, 5, "clash", "clash") for r in rows], SCHEMA)
    got = {r["conv"]: tuple(r)[1:] for r in s.repair(table, s.damaged(table), rules=rules).collect()}
    assert got == plain(rows)


def test_conversations_that_vanish_and_empty_tables(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 1, "user", "Hi.", 0, "", "")], SCHEMA)
    assert [tuple(r) for r in s.repair(table, s.damaged(table)).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert s.repair(table.limit(0), s.damaged(table.limit(0))).collect() == []
