"""Personal data: keyed surrogates for detected entities, by DataFrame functions only.

Found are e-mail addresses, phone numbers, payment cards, social security and bank account numbers, IPv4 and IPv6 addresses,
access keys, bearer tokens and other secrets, and names after one or more titles. Every entity has a canonical form (digits of a number, an address in
lower case, a given name or surname in lower case), so different spellings of one entity keep one surrogate. A surrogate
comes from a keyed SHA-256 of type, canonical form and attempt, and looks like the original: digits for digits, letters
for letters of the same case, the separators as written, a valid check digit where there was one, octets in range, given
names of the same gender and script (letter by letter of the same script where there are no syllables for it), other
initials for initials (a keyed permutation, so different ones stay different); titles and particles of names stay. A given
name without a gendered title anywhere takes the surrogate of its mentions with one. Words of a found name are replaced
wherever they stand alone in the same text. Collisions are checked over the whole corpus: a surrogate that
is a real entity, or that another entity has, is drawn again, so distinct entities stay distinct. Entities that draw in
vain `ATTEMPTS` times (of formats with few values, nearly all of them real) take each other's forms in a keyed ring. What
has no surrogate even then is an error: nothing found is ever written as it was.

Every text is searched once, and the rows with their findings are written once. Texts without entities move no further;
texts with some are joined with their replacements by a hash of the text.

Defined cases: null text stays null; empty and clean texts stay as they are; repeated rows are rewritten alike; a text of
any length is searched whole; of ties for a surrogate the least canonical form wins; n_chars, if there is such a column,
is set anew in rewritten rows; other columns stay as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, table, unused

KEY = "surrogates-v1"
ATTEMPTS = 16

# The patterns of the entities, and the titles that mark a name with their gender.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Lord", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Lady", "Dame", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof", "Professor", "Doctor", "Mx", "Доктор"),
}
PARTICLES = ("van", "von", "der", "den", "de", "di", "da", "del", "della", "la", "le", "du", "dos", "das", "bin", "ibn", "al", "el", "ter", "ten", "zu", "zum", "zur", "af", "y")
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
KEYED = r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
_SET = r"[=:][ \t]{0,4}[\"']?"
#: The cheap looks back come first: most places fail them.
SECRET = rf"(?<=[=: \t\"'])(?![\"'])(?<={_SET})(?<=(?i:password|passwd|pwd|passphrase|secret|api_key|token)[\"']?[ \t]{{0,4}}{_SET})[^\s\"']{{6,}}"
BEARER = r"(?<=(?i:bearer) )[A-Za-z0-9._~+/-]{8,}=*"
BANK = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
ADDRESS = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?!\.?[0-9])"
#: With all groups, or shortened; what begins with a group of at least three digits and holds a decimal one.
ADDRESS6 = r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{3,4}:)(?=[A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?:[0-9A-Fa-f]{1,4}:){1,7}:)(?![0-9A-Za-z:])"
CARD = r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|(?<![0-9])[0-9]{3}[ .-])[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_TITLES = sorted((t for ts in TITLES.values() for t in ts), key=lambda x: (-len(x), x))
_TITLE, _SHOUTED = "|".join(_TITLES), "|".join(t.upper() for t in _TITLES)
#: Goes on over inner capitals, hyphens and apostrophes, but for a possessive s; with one small letter at least, in
#: capitals throughout, or of letters that have no case.
_GOES_ON = r"(?:[\p{L}\p{M}]|[-‐‑](?=\p{L})|['’](?!s(?!\p{L}))(?=\p{L}))"
_WORD = rf"\p{{Lu}}(?=[\p{{L}}\p{{M}}'’‐‑-]*\p{{Ll}}){_GOES_ON}+"
_CAPITALS = rf"\p{{Lu}}(?![\p{{L}}\p{{M}}'’‐‑-]*\p{{Ll}}){_GOES_ON}+"
_UNCASED = r"\p{Lo}[\p{Lo}\p{M}]*"
_INITIALS = r"(?:\p{Lu}\.)+"
_PARTICLE = rf"(?:{'|'.join(PARTICLES)}|\p{{Lu}})"


def _person(word: str, words: int) -> str:
    return rf"(?:{_INITIALS} ?)*(?:{_PARTICLE} )*{word}(?: {_INITIALS})*(?: (?:{_PARTICLE} )*{word}){{0,{words - 1}}}"


_GAP = r"\s{1,3}"
_LOW = "mr|mrs|ms|mme"
#: One title or more; M only with its dot and alone, as it is an initial after others.
_HEAD = rf"(?:(?:(?:{_TITLE})\.?{_GAP})+|M\.{_GAP})"
_SHOUTED_HEAD = rf"(?:(?:{_SHOUTED})\.?{_GAP})+"
#: A title in capitals marks a name in capitals, or with its dot any name; one in small letters, with its dot, a small word.
NAME = rf"(?<!\p{{L}})(?:{_HEAD}(?:{_person(_WORD, 3)}|{_person(_CAPITALS, 2)}|{_UNCASED})|{_SHOUTED_HEAD}{_person(_CAPITALS, 2)}|(?:{_SHOUTED})\.{_GAP}{_person(_WORD, 3)}|(?:{_LOW})\.{_GAP}\p{{Ll}}{{2,}})"
_ANY_HEAD = rf"^(?:{_HEAD}|{_SHOUTED_HEAD}|(?:{_LOW})\.{_GAP})"
ANY = f"{SECRET}|{BEARER}|{EMAIL}|{KEYED}|{BANK}|{ADDRESS}|{ADDRESS6}|{SOCIAL}|{CARD}|{PHONE}|{NAME}"
#: The words between findings, each by itself, and what is between them.
_APART = rf"\p{{L}}(?:{_GOES_ON})*|[^\p{{L}}]+"
#: What every entity has somewhere; the quick test that most texts fail.
SOME = rf"[0-9@]|AKIA[A-Z]{{16}}|(?<!\p{{L}})(?:{_TITLE}|{_SHOUTED}|M\.|(?:{_LOW})\.)\.?{_GAP}\p{{L}}|(?i:password|passwd|pwd|passphrase|secret|api_key|token|bearer)"

#: Types of the parts of a name that get surrogates.
_OF_NAMES = ("given_m", "given_f", "given_n", "surname")
# Syllables of invented names by script, with the endings of given names by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha jo ka ke la le li lo ma me mi mo na ne ni no ra re ri ro sa ta".split(),
    "cyrillic": "ба бе бо да де до фа фе га го ха жо ка ке ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са та".split(),
}
ENDINGS = {
    ("latin", "m"): "ron ten lus mar vin dor kel rik".split(),
    ("latin", "f"): "ria lena sia mila vina dora nela rika".split(),
    ("latin", "s"): "berg mann ford wick dale sten holm land".split(),
    ("cyrillic", "m"): "рон тен лус мар вин дор кел рик".split(),
    ("cyrillic", "f"): "рия лена сия мила вина дора нела рика".split(),
    ("cyrillic", "s"): "ский цын ров лин дов тен хин гин".split(),
}
# Letters that stand for others of their script in secrets.
LETTERS = {
    "[а-яё]": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "[А-ЯЁ]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", r"\p{IsCyrillic}": "абвгдежзийклмнопрстуфхцчшщъыьэюя", r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת", r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", r"\p{IsHan}": "一二三四五六七八九十人大小中山水火木金土日月", r"\p{IsHiragana}": "あいうえおかきくけこさしすせそ", r"\p{IsKatakana}": "アイウエオカキクケコサシスセソ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하", r"\p{IsDevanagari}": "कखगघचछजझटठडढणतथदधनपफबभम", r"\p{IsThai}": "กขคงจชซดตถทนบปผพฟมยรลวสหอ", r"\p{Nd}": "0123456789", r"\p{Lu}": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"[^\x00-\x7F]": "abcdefghijklmnopqrstuvwxyz",
}


def _literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def entities(text: Column) -> Column:
    """All entities of a text in their order, as written."""
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def kind(value: Column) -> Column:
    rules = [("email", f"^{EMAIL}$"), ("name", f"^{NAME}$"), ("access_key", f"^{KEYED}$"), ("address", f"^{ADDRESS}$"), ("address6", f"^{ADDRESS6}$"), ("social", f"^{SOCIAL}$"), ("card", f"^{CARD}$"), ("phone", r"^[+(0-9][0-9 .()-]*[0-9]$"), ("bank", f"^{BANK}$")]
    return reduce(lambda rest, r: F.when(value.rlike(r[1]), r[0]).otherwise(rest), reversed(rules), F.lit("secret"))


def _joined(value: Column) -> Column:
    """A name without its titles; initials that touch each other or the next word are parts of their own."""
    return F.regexp_replace(F.regexp_replace(value, _ANY_HEAD, ""), r"((?:\p{Lu}\.)+)(?=\p{L})", "$1\u0001")


def words_of(value: Column) -> Column:
    """The titles of a name with the blanks after them, then its words."""
    return F.concat(F.array(F.regexp_extract(value, _ANY_HEAD, 0)), F.split(_joined(value), "[ \u0001]"))


def parts(value: Column) -> Column:
    """The entities in a finding: array of (place, type, canonical, before), where `before` is written before the
    surrogate; of a name: the title, particles (both of type `kept`), initials, given name and surnames."""
    k = kind(value)
    words, spaced = words_of(value), F.split(F.regexp_replace(_joined(value), "[^ \u0001]", ""), "")
    titles = F.transform(F.split(F.lower(F.get(words, F.lit(0))), r"\s+"), lambda t: F.regexp_replace(t, r"\.$", ""))
    of = lambda g: F.arrays_overlap(titles, _literal([t.lower() for t in TITLES[g]] + ["m"] * (g == "m")))
    gender = F.when(of("m"), "given_m").when(of("f"), "given_f").otherwise("given_n")
    sort = F.transform(words, lambda w, i: F.when((i == 0) | w.isin(*PARTICLES), "kept").when(w.rlike(f"^{_INITIALS}$"), "initials").otherwise("word"))
    names = F.size(F.filter(sort, lambda x: x == "word"))
    first = F.array_position(sort, F.lit("word")) - 1
    of_name = F.transform(
        words,
        lambda w, i: F.struct(
            i.alias("place"),
            F.when(F.get(sort, i) != "word", F.get(sort, i)).when((names > 1) & (i == first), gender).otherwise("surname").alias("type"),
            F.when(F.get(sort, i) == "word", F.lower(w)).otherwise(w).alias("canonical"),
            F.when((i > 1) & (F.get(spaced, i - 2) == " "), " ").otherwise("").alias("before"),
        ),
    )
    digits = F.regexp_replace(value, "[^0-9+]", "")
    # a number with the country code 1 is the same number without it
    plain = F.when(k == "phone", F.regexp_replace(digits, r"^\+1(?=[0-9]{10}$)", "")).when(k.isin("card", "social"), digits).when(k.isin("email", "address6"), F.lower(value)).when(k == "bank", F.regexp_replace(value, " ", "")).otherwise(value)
    return F.when(k != "name", F.array(F.struct(F.lit(0).alias("place"), k.alias("type"), plain.alias("canonical"), F.lit("").alias("before")))).otherwise(of_name)


# Capitals of names by alphabet.
CAPITALS = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ", "ĀĂĄĆĈĊČĎĐĒĔĖĘĚĜĞĠĢĤĦĨĪĬĮİĴĶĹĻĽŁŃŅŇŌŎŐŒŔŖŘŚŜŞŠŢŤŦŨŪŬŮŰŲŴŶŸŹŻŽ", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
)


def other_initials(value: Column, key: str) -> Column:
    """Each capital of initials becomes another of its alphabet: the next one in a keyed order, so that different initials
    stay different. Capitals of other alphabets become an X."""
    pairs = []
    for letters in CAPITALS:
        ring = sorted(letters, key=lambda c: hashlib.sha256(f"{key}|initials|{c}".encode()).hexdigest())
        pairs += zip(ring, ring[1:] + ring[:1])
    source, to = ("".join(x) for x in zip(*pairs))
    return F.regexp_replace(F.translate(value, source, to), rf"[^.{to}]", "X")


def surrogate(type_: Column, canonical: Column, attempt: int, key: str) -> Column:
    """The canonical surrogate of an entity: keyed, of the same format."""
    seed = F.concat(F.lit(f"{key}|{attempt}|"), type_, F.lit("|"), canonical)
    # two hex digits for each character, from as many digests as the value needs
    digest = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(canonical) / 32).cast("int")), lambda b: F.sha2(F.concat(seed, F.lit("|"), b.cast("string")), 256)), "")
    draw = lambda i: F.conv(F.substring(digest, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
    hexadecimal = canonical.rlike("^[0-9a-f]+$") & canonical.rlike("[a-f]")

    def like(c: Column, i: Column) -> Column:
        n = draw(i)
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike("[a-f]") & hexadecimal, F.substring(F.lit("abcdef"), n % 6 + 1, F.lit(1)))
            .when(c.rlike("[a-z]"), F.char(n % 26 + 97))
            .when(c.rlike("[A-Z]"), F.char(n % 26 + 65))
            .otherwise(c)
        )

    letters = F.split(canonical, "")
    shuffled = lambda kept: F.array_join(F.transform(letters, lambda c, i: F.when(kept(c, i), c).otherwise(like(c, i))), "")
    dot = F.length(canonical) - F.length(F.substring_index(canonical, ".", -1))
    email = shuffled(lambda c, i: i >= dot)  # the top-level domain stays
    # a phone number keeps its country code, a card the digit of its issuer
    phone = shuffled(lambda c, i: (c == "+") | (canonical.startswith("+") & (i <= F.length(canonical) - 11)))
    card = shuffled(lambda c, i: i == 0)
    card = F.when(luhn(canonical) == 0, with_check_digit(card)).otherwise(card)
    access = shuffled(lambda c, i: i < 4)
    bank = shuffled(lambda c, i: i < 2)
    address = F.array_join(F.transform(F.split(canonical, r"\."), lambda c, i: (draw(i) % 254 + 1).cast("string")), ".")

    address6 = F.array_join(F.transform(letters, lambda c, i: F.when(c == ":", c).otherwise(F.substring(F.lit("0123456789abcdef"), draw(i) % 16 + 1, F.lit(1)))), "")
    other = lambda c, i: reduce(lambda rest, r: F.when(c.rlike(r[0]), F.substring(F.lit(r[1]), draw(i) % len(r[1]) + 1, F.lit(1))).otherwise(rest), reversed(LETTERS.items()), c)
    foreign = F.array_join(F.transform(letters, lambda c, i: F.when(c.rlike(r"[\x00-\x7F]"), like(c, i)).otherwise(other(c, i))), "")

    def name(script: str, gender: str) -> Column:
        ends = ENDINGS[script, "m"] + ENDINGS[script, "f"] if gender == "n" else ENDINGS[script, gender]
        return F.initcap(F.concat(*[F.get(_literal(SYLLABLES[script]), draw(F.lit(i)) % len(SYLLABLES[script])) for i in range(2 + attempt // 3)], F.get(_literal(ends), draw(F.lit(9)) % len(ends))))

    def named(gender: str) -> Column:
        return F.when(canonical.rlike(r"\p{IsCyrillic}"), name("cyrillic", gender)).when(canonical.rlike(r"[a-z]"), name("latin", gender)).otherwise(F.initcap(foreign))

    made = F.when(type_ == "email", email).when(type_ == "phone", phone).when(type_ == "card", card).when(type_ == "access_key", access).when(type_ == "bank", bank).when(type_ == "address", address).when(type_ == "address6", address6)
    made = made.when(type_ == "given_m", named("m")).when(type_ == "given_f", named("f")).when(type_ == "given_n", named("n")).when(type_ == "surname", named("s"))
    marks = F.array_join(F.transform(letters, lambda c, i: F.substring(F.lit("!#$%&*+-=?@^_~"), draw(i) % 14 + 1, F.lit(1))), "")
    plain = F.when(canonical.rlike("[0-9A-Za-z]"), shuffled(lambda c, i: F.lit(False))).otherwise(marks)
    return made.otherwise(F.when(canonical.rlike(r"[^\x00-\x7F]"), foreign).otherwise(plain))


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a string of digits: 0 if its check digit is right."""
    turned = F.split(F.reverse(digits), "")
    doubled = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    return F.aggregate(F.transform(turned, doubled), F.lit(0), lambda a, x: a + x) % 10


def with_check_digit(digits: Column) -> Column:
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return F.concat(body, ((10 - luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))


def written(type_: Column, value: Column, canonical_surrogate: Column) -> Column:
    """The surrogate in the spelling of the finding: separators and case as they were."""
    abroad = (type_ == "phone") & F.regexp_replace(value, "[^0-9+]", "").rlike(r"^\+1[0-9]{10}$")
    canonical_surrogate = F.when(abroad, F.concat(F.lit("+1"), canonical_surrogate)).otherwise(canonical_surrogate)
    spelled = F.aggregate(
        F.split(value, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda a, c: F.when(
            c.rlike("[0-9A-Za-z+]"),
            F.struct(F.concat(a["out"], F.substring(canonical_surrogate, a["next"], F.lit(1))).alias("out"), (a["next"] + 1).alias("next")),
        ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["next"].alias("next"))),
    )
    rest = lambda s: F.concat(s["out"], F.substring(canonical_surrogate, s["next"], F.length(canonical_surrogate)))
    case = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substring(canonical_surrogate, i + 1, F.lit(1)))).otherwise(F.substring(canonical_surrogate, i + 1, F.lit(1)))), "")
    more = F.substring(canonical_surrogate, F.length(value) + 1, F.length(canonical_surrogate))
    shouted = F.when((F.upper(value) == value) & (F.lower(value) != value), F.upper(canonical_surrogate)).when((F.lower(value) == value) & (F.upper(value) != value), F.lower(canonical_surrogate)).otherwise(canonical_surrogate)
    named = F.when(type_.isin("given_m", "given_f", "given_n", "surname"), shouted).otherwise(canonical_surrogate)
    return F.when(type_.isin("card", "phone", "social", "bank"), rest(spelled)).when(type_ == "email", F.concat(case, more)).otherwise(named)


def assign(values: DataFrame, key: str = KEY) -> DataFrame:
    """(type, canonical, surrogate) for distinct (type, canonical): no two surrogates of a type are equal in spelling
    regardless of case, none is its own entity's form, and none is an entity of the corpus but in the ring at the end."""
    real = values.select("type", F.lower("canonical").alias("look"))
    pending, done = values, []
    for attempt in range(ATTEMPTS):
        drawn = pending.withColumn("surrogate", surrogate(F.col("type"), F.col("canonical"), attempt, key)).withColumn("look", F.lower("surrogate"))
        won = drawn.groupBy("type", "look").agg(F.min(F.struct("canonical", "surrogate")).alias("first"))
        won = won.join(real, ["type", "look"], "left_anti")
        for taken in done:
            won = won.join(taken.select("type", F.lower("surrogate").alias("look")), ["type", "look"], "left_anti")
        done.append(materialize(won.select("type", "first.canonical", "first.surrogate"), "surrogates"))
        pending = materialize(pending.join(done[-1], ["type", "canonical"], "left_anti"), "pending")
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, done)
    # a ring within each format, by keyed places: ranges of hashes, so that no task orders a whole format
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("canonical", "[0-9]", "0"), r"\p{Lu}", "A"), r"\p{Ll}", "a")
    at = F.xxhash64(F.lit(key), "type", "canonical")
    ring = pending.select("type", "canonical", shape.alias("shape"), at.alias("at"), F.pmod(at, F.lit(256)).cast("int").alias("slice"))
    ends = ring.groupBy("type", "shape", "slice").agg(F.min(F.struct("at", "canonical")).alias("first"))
    order = Window.partitionBy("type", "shape").orderBy("slice")  # 256 rows a format
    after = F.coalesce(F.lead("first").over(order), F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ring = ring.join(ends.select("type", "shape", "slice", after["canonical"].alias("onward")), ["type", "shape", "slice"])
    inside = F.lead("canonical").over(Window.partitionBy("type", "shape", "slice").orderBy("at", "canonical"))
    ringed = ring.withColumn("surrogate", F.coalesce(inside, "onward")).filter("surrogate <> canonical").select("type", "canonical", "surrogate")
    return reduce(DataFrame.unionByName, [*done, ringed])


def replace_entities(docs: DataFrame, *, key: str = KEY, count: str | None = None) -> DataFrame:
    """docs with every entity in `text` replaced; count: name of a column for the number of findings."""
    mark, found, swap, known = (unused(docs.columns, x) for x in ("_mark", "_found", "_swap", "_known"))
    text = F.col("text").cast("string")
    none = F.array().cast("array<string>")
    scanned = materialize(docs.withColumn(found, F.when(F.coalesce(text.rlike(SOME), F.lit(False)), entities(text)).otherwise(none)), "scanned")
    hit = scanned.filter(F.size(found) > 0).withColumn(mark, F.md5(text.cast("binary")))
    listed = materialize(hit.select(F.col(mark).alias("mark"), F.explode(F.array_distinct(found)).alias("value")).distinct(), "findings")
    single = listed.select("value").distinct().select("value", F.explode(parts(F.col("value"))).alias("part")).select("value", "part.*")
    single = materialize(single, "parts")
    # a given name after a title of no gender is the same as after one that has it
    gendered = single.filter("type in ('given_m', 'given_f')").groupBy("canonical").agg(F.min("type").alias("_type"))
    of_none = single.filter("type = 'given_n'").join(gendered, "canonical", "left").withColumn("type", F.coalesce("_type", "type"))
    single = materialize(single.filter("type <> 'given_n'").unionByName(of_none.select(single.columns)), "parts")
    surrogates = assign(materialize(single.filter("type not in ('kept', 'initials')").select("type", "canonical").distinct(), "entities"), key)
    drawn = single.join(surrogates, ["type", "canonical"], "left")
    word = F.when(F.col("type").isin(*_OF_NAMES), F.element_at(words_of(F.col("value")), F.col("place") + 1)).otherwise(F.col("value"))
    new = F.when(F.col("type") == "kept", F.col("canonical")).when(F.col("type") == "initials", other_initials(F.col("canonical"), key)).otherwise(written(F.col("type"), word, F.col("surrogate")))
    new = F.coalesce(new, F.raise_error(F.concat(F.lit("no surrogate for a finding of type "), F.col("type"))).cast("string"))
    renamed = drawn.filter(F.col("type").isin(*_OF_NAMES)).select("value", word.alias("word"), F.struct("type", new.alias("new")).alias("as")).filter(F.length("word") > 1)
    spelled = drawn.groupBy("value").agg(F.array_sort(F.collect_list(F.struct("place", F.concat("before", new).alias("piece")))).alias("pieces"))
    spelled = spelled.select("value", F.array_join("pieces.piece", "").alias("new"))
    swaps = listed.join(spelled, "value", "left").groupBy("mark").agg(F.map_from_entries(F.collect_list(F.struct(F.col("value").alias("k"), F.col("new").alias("v")))).alias("swap"))

    # words of a text's names, for where they stand alone; a surname if a word is one as well
    words = listed.join(renamed, "value").groupBy("mark", "word").agg(F.max("as").alias("as"))
    words = words.groupBy("mark").agg(F.map_from_entries(F.collect_list(F.struct("word", "as.new"))).alias("names"))
    swaps = swaps.join(words, "mark", "left")

    # rows without findings stay where they are; the others meet their replacements
    hit = hit.join(swaps.select(F.col("mark").alias(mark), F.col("swap").alias(swap), F.col("names").alias(known)), mark, "left")

    def again(piece: Column) -> Column:
        other = lambda t: F.coalesce(F.col(known)[t], F.when((F.upper(t) == t) & (F.length(t) > 1), F.upper(F.col(known)[F.initcap(F.lower(t))])), t)
        return F.when(F.col(known).isNull(), piece).otherwise(F.array_join(F.transform(F.regexp_extract_all(piece, F.lit(_APART), F.lit(0)), other), ""))
    lost = F.raise_error(F.lit("a finding has no replacement")).cast("string")
    replaced = F.transform(found, lambda e: F.coalesce(F.col(swap)[e], lost))
    joined = F.array_join(F.zip_with(F.split(text, ANY, -1), replaced, lambda a, b: F.concat(again(a), F.coalesce(b, F.lit("")))), "")
    hit = hit.withColumn("text", joined)
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    counted = [] if count is None else [F.size(found).cast("long").alias(count)]
    clean = scanned.filter(F.size(found) == 0)
    return clean.select(*docs.columns, *counted).unionByName(hit.select(*docs.columns, *counted))


def op1_pii_surrogates(spark, sf_dir):
    return replace_entities(table(spark, sf_dir, "documents"), count="n_entities")
