"""Columns over names: parts, tokens, ratios, trigrams, release names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letter classes of names.
VOWELS = "aeiouy"
CONSONANTS = "bcdfghjklmnpqrstvwxz"
#: Our own seed words; their trigrams count as natural.
SEED_WORDS = (
    "about account active after agent air alpha animal apple art auto baby bank base beach best better bike bird black blog blue board "
    "body book box brand bridge bright build business cafe camp capital car card care case center chain change chat child choice city "
    "class clean clear click cloud club code coffee color company connect cook core corner craft create credit cross culture data day "
    "deal design digital direct doctor dog dream drive earth easy eco edge energy event expert express eye fair family farm fashion fast "
    "field film finance find fine fire first fish fit flow food forest form free fresh friend fun future game garden gate gift global gold "
    "good grand great green group grow guide hand happy health heart help high home hope horse hotel house idea image inn insight job join "
    "journey key kid kitchen lab land language leader learn legal letter life light line link list live local logic love lucky magic mail "
    "main map market master media medical mind mobile modern money moon motor mountain music nation nature network new news night north "
    "number ocean office online open orange order organic paper park part partner path people perfect person pet phone photo pilot place "
    "plan planet plant play point power press price prime print product project property pure quick radio rain ready real red rental report "
    "rest rich ring river road rock room root safe sale school science sea search secret secure select sense service shop shore show silver "
    "simple site sky small smart social solar solution sound source south space speed spirit sport spring star start station stay stone "
    "store storm story stream street strong student studio style summer sun support surf sweet system table talent team tech test thing "
    "ticket time today tool total touch tour town track trade train travel tree trend trip true trust union unit urban value video view "
    "village vision voice walk wall watch water wave way wealth weather web well west white wild wind window wine winter wise wonder wood "
    "word work world yard year yellow young zone"
).split()
NATURAL_TRIGRAMS = sorted({w[i : i + 3] for w in SEED_WORDS for i in range(len(w) - 2)})


def label(name: Column) -> Column:
    """What stands before the first dot."""
    return F.substring_index(name, ".", 1)


def tld(name: Column) -> Column:
    """What stands after the last dot; empty without one."""
    return F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1)).otherwise(F.lit(""))


def unreverse(name: Column) -> Column:
    """com.example -> example.com."""
    return F.array_join(F.reverse(F.split(name, r"\.")), ".")


def coarse_tokens(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(name), r"[.-]"), lambda x: x != ""))


def fine_tokens(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(name), r"[.-]|(?<=[0-9])(?=[a-z])|(?<=[a-z])(?=[0-9])"), lambda x: x != ""))


def digit_ratio(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[0-9]")) / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def vowel_ratio(text: Column) -> Column:
    """Vowels among letters; 0 without letters."""
    low = F.lower(text)
    return F.coalesce(F.regexp_count(low, F.lit(f"[{VOWELS}]")) / F.nullif(F.regexp_count(low, F.lit("[a-z]")), F.lit(0)), F.lit(0.0))


def entropy(text: Column) -> Column:
    """Shannon entropy in bits a character, lower-cased; 0 for the empty text."""
    low = F.lower(text)
    # equal characters stand together once they are sorted: one run each
    runs = F.regexp_extract_all(F.array_join(F.array_sort(F.split(low, "")), ""), F.lit(r"(?s)(.)\1*"), F.lit(0))
    share = lambda run: F.length(run) / F.length(low).cast("double")
    return F.aggregate(runs, F.lit(0.0), lambda total, run: total - share(run) * F.log2(share(run)))


def has_repeat_run(text: Column, n: int) -> Column:
    return text.rlike(rf"(.)\1{{{n - 1},}}")


def has_consonant_run(text: Column, n: int) -> Column:
    return F.lower(text).rlike(f"[{CONSONANTS}]{{{n},}}")


def trigrams(text: Column) -> Column:
    """The alphabetic trigrams of a label, with repetitions."""
    low = F.lower(text)
    n = F.length(low)
    all_ = F.when(n >= 3, F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substring(low, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    return F.filter(all_, lambda t: t.rlike("^[a-z]{3}$"))


def trigram_matches(text: Column) -> Column:
    return F.size(F.filter(trigrams(text), lambda t: t.isin(NATURAL_TRIGRAMS)))


def trigram_total(text: Column) -> Column:
    return F.size(trigrams(text))


_HOST = r"^(?=.{1,253}$)(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?$"


@F.arrow_udf(StringType())
def _idna(names):
    import pyarrow as pa

    def one(x):
        try:
            return x.encode("idna").decode("ascii")
        except (UnicodeError, AttributeError):
            return None

    return pa.array([one(x.as_py()) for x in names], pa.string())


def normalize_domain(raw: Column, idna: bool = True) -> Column:
    """URL-decoded, trimmed, lower-case, without the last dot, in ASCII form; null if it is no host name with a dot.

    Only names with other letters than ASCII reach Python; idna=False makes those null instead.
    """
    name = F.regexp_replace(F.lower(F.trim(F.try_url_decode(raw))), r"\.$", "")
    if idna:
        plain = F.when(name.rlike(r"^[\x00-\x7F]*$"), name).otherwise(_idna(F.when(~name.rlike(r"^[\x00-\x7F]*$"), name)))
    else:
        plain = name
    return F.when(plain.rlike(_HOST), plain)


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def release_table(spark, first_year: int = 2017, last_year: int = 2035):
    """(release, year, end_month, label): every rolling three-month release name, as a dimension to join.

    `YYYY-mmm-mmm-mmm` where the year holds; `YYYY-YYYY-mmm-mmm-mmm` across the turn of the year. Names outside of the table
    are not canonical.
    """
    months = F.array(*[F.lit(m) for m in MONTHS])
    ends = spark.range((last_year - first_year + 1) * 12).select((F.lit(first_year) + F.floor(F.col("id") / 12)).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("end_month"))
    begin = F.col("end_month") - 2
    at = lambda m: F.get(months, F.pmod(m - 1, F.lit(12)).cast("int"))
    three = F.concat_ws("-", at(begin), at(begin + 1), at(F.col("end_month")))
    turns = begin < 1
    name = F.when(turns, F.concat_ws("-", (F.col("year") - 1).cast("string"), F.col("year").cast("string"), three)).otherwise(F.concat_ws("-", F.col("year").cast("string"), three))
    shown = F.concat(F.initcap(at(begin)), F.when(turns, F.concat(F.lit(" "), (F.col("year") - 1).cast("string"))).otherwise(F.lit("")), F.lit("–"), F.initcap(at(F.col("end_month"))), F.lit(" "), F.col("year").cast("string"))
    return ends.select(name.alias("release"), "year", "end_month", shown.alias("label"))


def release_table_of(releases):
    """The `release_table` of the years that a table's release names begin with, and of the one after: read from the data, so
    no release is ever past its end. Names that begin with no year count for nothing."""
    years = releases.select(F.regexp_extract("release", "^([0-9]{4})-", 1).try_cast("int").alias("year")).agg(F.min("year").alias("low"), F.max("year").alias("high")).first()
    low = years["low"] if years["low"] is not None else 2017
    return release_table(releases.sparkSession, low, (years["high"] if years["high"] is not None else low) + 1)


def page_link(name: Column, archived: Column) -> Column:
    """The own page of an archived name in safe characters, else an anchor in the list."""
    return F.when(F.coalesce(archived, F.lit(False)) & name.rlike("^[a-z0-9.-]+$"), F.concat(F.lit("/d/"), name, F.lit("/"))).otherwise(F.concat(F.lit("/#"), name))
