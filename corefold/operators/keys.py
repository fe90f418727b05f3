"""Blocking keys: ``COUNTRY|type:value`` strings, one array per record in the order of the passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocabulary as V

NONE = "array<string>"


def _prefix(country: Column) -> Column:
    c = F.upper(T.trim(F.coalesce(country, F.lit(""))))
    return F.when((c == "") | c.isin(V.NO_COUNTRY), "GLOBAL").otherwise(c)


def _one(condition: Column, key: Column) -> Column:
    return F.when(condition, F.array(key)).otherwise(F.array().cast(NONE))


def _typed(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(f"{kind}:"), v))


def _informative(t: Column, digits_too: bool = False) -> Column:
    ok = (F.char_length(t) >= 4) & ~t.isin(V.STOPWORDS)
    return ok if digits_too else ok & ~T.is_digits(t)


def _has_domain(low: Column) -> Column:
    return low.contains(".com") | low.contains(".in") | low.contains(".org") | low.contains(".net")


def _number_and_street(punct: Column, least: int) -> Column:
    """First number and first word of an address that is no number, generic word or shorter than ``least``."""
    numbers = T.digit_tokens(punct)
    words = F.filter(T.standardize_address(T.tokens(punct)), lambda t: ~T.is_digits(t) & (F.char_length(t) >= least) & ~t.isin(V.STOPWORDS))
    return T.let(numbers, lambda n: T.let(words, lambda w: _one((F.size(n) > 0) & (F.size(w) > 0), F.concat(F.lit("anum:"), F.get(n, 0), F.lit("_"), F.get(w, 0)))))


def with_keys(df: DataFrame, variant: str = "serve", name: str = "business_name", address: str = "business_address", country: str = "country", out: str = "keys") -> DataFrame:
    """Add ``out``. Variants:

    * ``serve``: a list; a token that a name repeats posts its record twice.
    * ``train``: distinct keys, with zip codes and the tokens of domain names; the words nan, null and none count as missing.
    * ``weighted``: as ``serve`` (the evidence score's keys).
    * ``v4``: no domain key, any two first tokens, longer street words.
    """
    if variant not in ("serve", "train", "weighted", "v4"):
        raise ValueError(variant)
    raw_n, raw_a = F.coalesce(F.col(name), F.lit("")), F.coalesce(F.col(address), F.lit(""))
    if variant == "train":
        known = lambda c: F.when(F.lower(T.trim(c)).isin("nan", "null", "none"), "").otherwise(T.trim(c))
        raw_n, raw_a = known(raw_n), known(raw_a)
    work = df.withColumns({"__low": F.lower(raw_n), "__punct": T.fast_punctuation(raw_n), "__alpha": T.fast_alpha(raw_n), "__a_punct": T.fast_punctuation(raw_a)})
    work = work.withColumn("__toks", T.strip_legal(T.tokens("__punct")))
    alpha, toks, low = F.col("__alpha"), F.col("__toks"), F.col("__low")
    n = F.char_length(alpha)
    first, second = F.get(toks, 0), F.get(toks, 1)
    two = F.size(toks) >= 2
    parts = [
        _one(n >= 4, F.concat(F.lit("alpha:"), alpha)),
        _one(n >= 6, F.concat(F.lit("pfx6:"), F.substring(alpha, 1, 6))),
        _one(n >= 8, F.concat(F.lit("pfx8:"), F.substring(alpha, 1, 8))),
        _typed("tok", F.filter(toks, lambda t: _informative(t))),
        _one(two if variant == "v4" else two & (~first.isin(V.STOPWORDS) | ~second.isin(V.STOPWORDS)), F.concat(F.lit("2tok:"), first, F.lit("_"), second)),
    ]
    if variant != "v4":
        domain = T.clean_domain(low)
        d_alpha = T.fast_alpha(domain)
        parts.append(_one(_has_domain(low) & (F.char_length(d_alpha) >= 6), F.concat(F.lit("dom6:"), F.substring(d_alpha, 1, 6))))
        if variant == "train":
            d_toks = F.filter(T.tokens(T.fast_punctuation(domain)), lambda t: _informative(t, True))
            parts.append(F.when(_has_domain(low), _typed("tok", d_toks)).otherwise(F.array().cast(NONE)))
    if variant == "train":
        parts.append(_typed("zip", T.zip_tokens("__a_punct")))
    parts.append(_number_and_street(F.col("__a_punct"), 4 if variant == "v4" else 3))
    prefix = _prefix(F.col(country))
    keys = F.transform(F.concat(*parts), lambda k: F.concat(prefix, F.lit("|"), k))
    return work.withColumn(out, F.array_distinct(keys) if variant == "train" else keys).drop("__low", "__punct", "__alpha", "__a_punct", "__toks")


def key_type(key: Column) -> Column:
    return F.regexp_extract(key, r"\|([a-z0-9]+):", 1)


def key_weight(key: Column, weights: dict[str, float] = V.KEY_WEIGHTS) -> Column:
    """The weight of a key's type; of an unknown type that of a token."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key_type(key)), F.lit(weights["tok"]))


def postings(df: DataFrame, entity: str = "entity_id", pos: str = "pos", keys: str = "keys") -> DataFrame:
    """``(entity_id, pos, key_pos, block_key)``: one row for each key occurrence of each record."""
    # Of an inner generator Spark infers a filter on the size of the keys, which it moves to the source with the keys' whole expression (hundreds of kilobytes in the plan) in it.
    return df.select(F.col(entity).alias("entity_id"), F.col(pos).alias("pos"), F.posexplode_outer(keys).alias("key_pos", "block_key")).where("key_pos IS NOT NULL")
