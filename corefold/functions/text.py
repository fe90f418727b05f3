"""Normalisation of names, addresses and countries, as expressions that stay in the JVM (Unicode NFC excepted)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import vocabulary as V

SPACE = r"[\s\x1c-\x1f\u0085\p{Z}]"
# Python's \w: letters, numbers and the underscore, but no combining marks.
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s\x1c-\x1f\u0085\p{Z}]"
NOT_WORD = r"[^\p{L}\p{N}_]"
PUNCTUATION = r"[\p{P}\p{S}]"
DIGITS = r"(?<![\p{L}\p{N}_])\p{Nd}+(?![\p{L}\p{N}_])"
ZIP = r"(?<![\p{L}\p{N}_])\p{Nd}{5,6}(?![\p{L}\p{N}_])"
SCHEME = r"(?i)^(https?://)?(www\.)?"
TLD = r"(?i)\.(com|org|net|in|co|io|biz|info|us|gov|edu|ai|app|tech)\b"
DOMAIN = r"(?i)\b[a-zA-Z0-9-]+\.(com|org|net|in|co|io|biz|info|us|gov|edu)\b"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once."""
    return F.transform(F.array(value), body)[0]


def trim(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), rf"^{SPACE}+|{SPACE}+$", "")


def clean_input(c: Column | str, missing: list[str] = V.MISSING) -> Column:
    """Null and the sentinels for missing become "", other values are stripped."""
    t = trim(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.when(F.lower(t).isin(missing), "").otherwise(t)


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


# So marked, Spark computes it in a step of its own and does not move it into a lambda function, which can't call Python.
_nfc = _nfc.asNondeterministic()


def nfc(c: Column | str) -> Column:
    """Unicode NFC. ASCII texts are in it already and don't leave the JVM's value."""
    c = _c(c)
    return F.when(c.rlike(r"^[\x00-\x7F]*$"), c).otherwise(_nfc(c))


def collapse_space(c: Column | str) -> Column:
    return trim(F.regexp_replace(_c(c), f"{SPACE}+", " "))


def clean_punctuation(c: Column | str) -> Column:
    """``&`` becomes the word and; punctuation and symbols become spaces; letters, numbers and marks stay."""
    return collapse_space(F.regexp_replace(F.replace(_c(c), F.lit("&"), F.lit(" and ")), PUNCTUATION, " "))


def alphanumeric(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(_c(c)), r"[\p{P}\p{S}\p{Z}]", "")


def tokens(c: Column | str) -> Column:
    return F.filter(F.split(_c(c), f"{SPACE}+"), lambda t: t != "")


def sorted_text(t: Column) -> Column:
    return F.array_join(F.array_sort(t), " ")


def strip_legal(t: Column) -> Column:
    """Tokens without legal forms; all of them if there are no others."""
    return let(F.filter(t, lambda x: ~F.lower(x).isin(V.LEGAL)), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(t))


def clean_domain(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(c), SCHEME, ""), TLD, "")


def standardize_address(t: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in V.ADDRESS.items() for x in pair])
    return F.transform(t, lambda x: F.coalesce(F.try_element_at(table, F.lower(x)), F.lower(x)))


def country(c: Column | str) -> Column:
    return F.upper(collapse_space(clean_input(c)))


def fast_punctuation(c: Column | str) -> Column:
    """The lower text with all but word characters and space as spaces: splits words at combining marks."""
    return F.regexp_replace(F.lower(_c(c)), NOT_WORD_OR_SPACE, " ")


def fast_alpha(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(_c(c)), NOT_WORD, "")


def digit_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(DIGITS), F.lit(0))


def zip_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(ZIP), F.lit(0))


def is_digits(c: Column) -> Column:
    return c.rlike(r"^\p{Nd}+$")


def script(c: Column | str) -> Column:
    c = _c(c)
    out = F.when(c.rlike(V.SCRIPTS[0][1]), V.SCRIPTS[0][0])
    for name, pattern in V.SCRIPTS[1:]:
        out = out.when(c.rlike(pattern), name)
    return out.when(c.rlike(r"[^\x00-\x7F]"), "Other Non-Latin").otherwise("Latin/English")


def script_type(c: Column | str) -> Column:
    """The shorter ladder of the blocking evaluation."""
    c = _c(c)
    out = F.when(c.rlike(V.SCRIPTS[0][1]), V.SHORT_SCRIPTS[0][0])
    for name, k in V.SHORT_SCRIPTS[1:]:
        out = out.when(c.rlike(V.SCRIPTS[k][1]), name)
    return out.when(c.rlike(r"[^\x00-\x7F]"), "Other Non-Latin").otherwise("Latin")


def forensic_legal(c: Column | str) -> Column:
    """Lower text without legal terms, of words trimmed of commas and dots; may be empty."""
    words = F.transform(tokens(F.lower(_c(c))), lambda t: F.regexp_replace(t, "^[,.]+|[,.]+$", ""))
    return F.array_join(F.filter(words, lambda t: ~t.isin(V.FORENSIC_LEGAL)), " ")


def forensic_punctuation(c: Column | str) -> Column:
    return F.lower(collapse_space(F.regexp_replace(_c(c), NOT_WORD_OR_SPACE, " ")))


def _either_way(a: Column, b: Column, left: Callable[[Column], Column], right: Callable[[Column], Column]) -> Column:
    return (left(a) & right(b)) | (right(a) & left(b))


def state_variant(a: Column, b: Column) -> Column:
    """One address spells a state out (anywhere), the other has its abbreviation as a word."""
    spaced = lambda s: F.concat(F.lit(" "), s, F.lit(" "))
    out = F.lit(False)
    for full, short in V.STATES.items():
        out = out | _either_way(a, b, lambda s, x=full: s.contains(x), lambda s, x=short: spaced(s).contains(f" {x} "))
    return out


def address_variant(a: Column, b: Column) -> Column:
    """One address holds the long, the other the short form of a word, anywhere."""
    out = F.lit(False)
    for full, short in V.FORENSIC_ADDRESS:
        out = out | _either_way(a, b, lambda s, x=full: s.contains(x), lambda s, x=short: s.contains(x))
    return out


def has_domain(c: Column | str) -> Column:
    return _c(c).rlike(DOMAIN)


def acronym(t: Column) -> Column:
    return F.array_join(F.transform(t, lambda x: F.substring(x, 1, 1)), "")


def alnum_only(c: Column | str) -> Column:
    """Characters for which Python's isalnum holds."""
    return F.regexp_replace(_c(c), r"[^\p{L}\p{N}]", "")


def indic_fold(c: Column | str) -> Column:
    c = _c(c)
    for old, new in V.INDIC_FOLDS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def name_struct(c: Column | str, cleaned: Column | None = None) -> Column:
    """All representations of a name. ``cleaned`` is ``nfc(clean_input(c))``, computed before; without it texts count as being in NFC."""
    original = F.coalesce(_c(c).cast("string"), F.lit(""))
    s = F.lower(clean_input(c) if cleaned is None else cleaned)
    clean = clean_punctuation(s)
    domain = clean_punctuation(clean_domain(s))
    return F.struct(
        original.alias("original"), (s == "").alias("is_empty"), clean.alias("clean"), alphanumeric(clean).alias("alphanumeric"), tokens(clean).alias("tokens"),
        sorted_text(tokens(clean)).alias("sorted_tokens"), F.array_join(strip_legal(tokens(clean)), " ").alias("no_legal"), strip_legal(tokens(clean)).alias("no_legal_tokens"),
        sorted_text(strip_legal(tokens(clean))).alias("no_legal_sorted"), domain.alias("domain_clean"), tokens(domain).alias("domain_clean_tokens"),
    )


def address_struct(c: Column | str, cleaned: Column | None = None) -> Column:
    """All representations of an address; ``cleaned`` as with names."""
    original = F.coalesce(_c(c).cast("string"), F.lit(""))
    s = F.lower(clean_input(c) if cleaned is None else cleaned)
    clean = clean_punctuation(s)
    standard = standardize_address(tokens(clean))
    return F.struct(
        original.alias("original"), (s == "").alias("is_empty"), clean.alias("clean"), alphanumeric(clean).alias("alphanumeric"), tokens(clean).alias("tokens"),
        sorted_text(tokens(clean)).alias("sorted_tokens"), standard.alias("standardized_tokens"), sorted_text(standard).alias("standardized_sorted"),
    )


def normalize_records(df: DataFrame) -> DataFrame:
    """``entity_id, original_*, name, address, country``. The id column is entity_id, else source1_entity_id, else the first; the others may be absent."""
    key = next((k for k in ("entity_id", "source1_entity_id") if k in df.columns), df.columns[0])
    at = lambda k: F.col(k) if k in df.columns else F.lit(None).cast("string")
    work = df.withColumns({"__n": nfc(clean_input(at("business_name"))), "__a": nfc(clean_input(at("business_address")))})
    return work.select(
        trim(F.col(key).cast("string")).alias("entity_id"), at("business_name").alias("original_business_name"), at("business_address").alias("original_business_address"),
        at("country").alias("original_country"), name_struct(at("business_name"), F.col("__n")).alias("name"), address_struct(at("business_address"), F.col("__a")).alias("address"), country(at("country")).alias("country"),
    )
