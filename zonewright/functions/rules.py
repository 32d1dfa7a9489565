"""Reject rules: each is one reason column, null where the row passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewright.functions import names, terms


@dataclass(frozen=True)
class Rules:
    """Thresholds and our own small word lists; all of them parameters."""

    least_length: int = 3
    most_length: int = 30
    keywords: tuple[str, ...] = ("casino", "poker", "viagra", "porn", "loan")
    prefixes: tuple[str, ...] = ("gambl", "betting", "escort")
    substrings: tuple[str, ...] = ("xxx", "pharma", "replica")
    soft: tuple[str, ...] = ("crypto", "vape", "dating")
    digit_ratio: float = 0.30
    vowel_ratio: float = 0.15
    entropy: float = 3.5
    repeat_run: int = 4
    consonant_run: int = 6
    lexical_length: int = 3
    trigram_matches: int = 3
    trigram_ratio: float = 0.55
    spam_terms: tuple[str, ...] = ("cialis", "casino bonus", "cheap pills", "payday loan")
    spam_cjk: tuple[str, ...] = ("赌场", "博彩", "カジノ")
    parked: tuple[str, ...] = ("domain is for sale", "buy this domain", "sedoparking", "parkingcrew")


DEFAULT = Rules()


def first_of(*rules: tuple[Column, Column | str]) -> Column:
    """The reason of the first rule that holds; null if none does."""
    out = F.lit(None).cast("string")
    for condition, reason in reversed(rules):
        out = F.when(F.coalesce(condition, F.lit(False)), reason if isinstance(reason, Column) else F.lit(reason)).otherwise(out)
    return out


def _first_hit(words: tuple[str, ...], text: Column, hit, place: terms.Place = terms.ANYWHERE) -> Column:
    """The first term, in the order of the list, that hit() holds for; a long list is searched in one pass."""
    if len(words) >= terms.AUTOMATON_FROM:
        return F.get(terms.matches(text, [(words, place)]), F.lit(0))
    return F.coalesce(*[F.when(hit(t), t) for t in words], F.lit(None).cast("string"))


def _literally(term: str) -> str:
    """A pattern of the term's own characters."""
    return "".join(c if c.isalnum() or c == " " else rf"\x{{{ord(c):x}}}" for c in term)


def matched_keyword(name: Column, rules: Rules = DEFAULT) -> Column:
    """An exact token, coarse or fine; else a coarse token that goes on after a prefix."""
    coarse = names.coarse_tokens(name)
    both = F.array_union(coarse, names.fine_tokens(name))
    exact = F.get(F.array_intersect(F.array(*[F.lit(t) for t in rules.keywords]), both), F.lit(0)) if rules.keywords else F.lit(None).cast("string")
    low = F.lower(name)
    begun = _first_hit(rules.prefixes, low, lambda t: low.rlike(rf"(?:^|[.-]){_literally(t)}[^.-]"), terms.BEGINS)
    return F.coalesce(exact, begun)


def matched_substring(name: Column, rules: Rules = DEFAULT) -> Column:
    label = F.lower(names.label(name))
    return _first_hit(rules.substrings, label, lambda t: F.contains(label, F.lit(t)))


def soft_signal(name: Column, rules: Rules = DEFAULT) -> Column:
    label = F.lower(names.label(name))
    return _first_hit(rules.soft, label, lambda t: F.contains(label, F.lit(t))).isNotNull()


def structural_reason(name: Column, rules: Rules = DEFAULT) -> Column:
    label = names.label(name)
    keyword, part = matched_keyword(name, rules), matched_substring(name, rules)
    return first_of(
        (name.isNull() | (name == "") | (label == ""), "empty"),
        (F.exists(F.split(F.lower(name), r"\."), lambda x: F.startswith(x, F.lit("xn--"))), "idn"),
        (F.length(label) < rules.least_length, "too_short"),
        (F.length(label) > rules.most_length, "too_long"),
        (label.rlike("^[0-9]+$"), "all_digits"),
        (keyword.isNotNull(), F.concat(F.lit("keyword("), keyword, F.lit(")"))),
        (part.isNotNull(), F.concat(F.lit("substring("), part, F.lit(")"))),
    )


def lexical_reason(name: Column, rules: Rules = DEFAULT) -> Column:
    label = names.label(name)
    total, matches = names.trigram_total(label), names.trigram_matches(label)
    return first_of(
        (names.digit_ratio(label) > rules.digit_ratio, "digit_ratio"),
        (names.vowel_ratio(label) < rules.vowel_ratio, "vowel_ratio"),
        (names.entropy(label) > rules.entropy, "entropy"),
        (names.has_repeat_run(label, rules.repeat_run), "repeat_run"),
        (names.has_consonant_run(label, rules.consonant_run), "consonant_run"),
        (F.length(label) < rules.lexical_length, "too_short"),
        (total == 0, "no_trigrams"),
        (matches < rules.trigram_matches, "few_trigrams"),
        (matches / F.nullif(total, F.lit(0)) < rules.trigram_ratio, "trigram_ratio"),
    )


def evidence_reason(spam: Column, list_a: Column, list_b: Column, category: Column, remembered_toxic: Column, captures: Column, *, least_captures: int = 1, strict: bool = False) -> Column:
    """Rejects by evidence, in this order. Unknown (null) passes everywhere but in the last rule, which is for strict runs."""
    yes = lambda c: c.eqNullSafe(F.lit(True))
    return first_of(
        (yes(spam), "spam"),
        (yes(list_a), "blocklist_a"),
        (yes(list_b), "blocklist_b"),
        (category == "toxic", "toxic"),
        (yes(remembered_toxic), "toxic_remembered"),
        (captures < least_captures, F.concat(F.lit("no_captures("), captures.cast("string"), F.lit(")"))),
        (spam.isNull() & F.lit(strict), "spam_unchecked"),
    )


def spam_matches(fields: Column, rules: Rules = DEFAULT) -> Column:
    """Spam terms in an array of fields, in the order of the lists. A Latin term stands between other characters than
    ASCII letters and digits; terms of other scripts stand anywhere; none spans two fields."""
    text = F.lower(F.array_join(F.filter(fields, lambda x: x.isNotNull()), "\n"))
    if len(rules.spam_terms) + len(rules.spam_cjk) >= terms.AUTOMATON_FROM:
        return terms.matches(text, [(rules.spam_terms, terms.APART), (rules.spam_cjk, terms.ANYWHERE)])
    latin = [F.when(text.rlike(rf"(?<![a-z0-9]){_literally(t)}(?![a-z0-9])"), t) for t in rules.spam_terms]
    other = [F.when(F.contains(text, F.lit(t)), t) for t in rules.spam_cjk]
    return F.array_compact(F.array(*latin, *other))


def parked_marker(html: Column, rules: Rules = DEFAULT) -> Column:
    low = F.lower(html)
    return _first_hit(rules.parked, low, lambda t: F.contains(low, F.lit(t)))


def all_pass(*reasons: Column) -> Column:
    return reduce(lambda a, b: a & b, [r.isNull() for r in reasons])
