"""Many literal terms in one pass over a text."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Terms from which on a list is an automaton in a Python worker; shorter ones are expressions, which cost less than the way
#: to Python. Both give the same.
AUTOMATON_FROM = 24


def _anywhere(text: str, begin: int, end: int) -> bool:
    return True


def _apart(text: str, begin: int, end: int) -> bool:
    """Between other characters than ASCII letters and digits."""
    plain = lambda c: c.isascii() and c.isalnum()
    return not (begin and plain(text[begin - 1])) and not (end < len(text) and plain(text[end]))


def _begins(text: str, begin: int, end: int) -> bool:
    """At the beginning of a part of a name that goes on."""
    return (begin == 0 or text[begin - 1] in ".-") and end < len(text) and text[end] not in ".-"


Place = Callable[[str, int, int], bool]
ANYWHERE, APART, BEGINS = _anywhere, _apart, _begins


def finder(groups: list[tuple[tuple[str, ...], Place]]) -> Callable[[str], list[str]]:
    """A function from a text to the terms in it, in the order of the groups and their lists. The automaton is made once;
    a text is read once, whatever the number of terms."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    where: dict[str, list[tuple[int, Place]]] = {}
    listed = [(t, place) for terms, place in groups for t in terms]
    for k, (term, place) in enumerate(listed):
        if term:
            where.setdefault(term, []).append((k, place))
    for term, uses in where.items():
        automaton.add_word(term, (len(term), uses))
    automaton.make_automaton()

    def find(text: str) -> list[str]:
        found = {k for k, (term, _) in enumerate(listed) if not term}
        for last, (length, uses) in automaton.iter(text):
            for k, place in uses:
                if k not in found and place(text, last + 1 - length, last + 1):
                    found.add(k)
        return [listed[k][0] for k in sorted(found)]

    # an automaton without a word cannot be searched
    return find if where else lambda text: [t for t, _ in listed]


def matches(text: Column, groups: list[tuple[tuple[str, ...], Place]]) -> Column:
    """The terms in a text (lower-cased by the caller), as finder() orders them; null for a null text."""

    def run(texts: pa.Array) -> pa.Array:
        find = finder(groups)
        return pa.array([None if t is None else find(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ArrayType(StringType()))(text)
