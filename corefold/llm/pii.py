"""Personal data replaced by format-preserving pseudonyms, with SQL functions only.

Numbers and dates are validated (check digits, calendar, ranges), then permuted by a keyed Feistel network within their format: a card
number stays a valid card number of its length and grouping, a date a valid date in its notation. What is permuted is the value and not its
notation (a date's day, a phone number's national digits), so the same value gets the same pseudonym in all documents
and notations. The key's holder can undo it (``reveal=True``). E-mail addresses and secrets get keyed digests in
their format, which can't be undone. What fails validation is left as it is.

The patterns repeat groups a bounded number of times only, since Java's matcher recurses for each repetition of a group, and single characters possessively:
texts of any length are matched in linear time and bounded depth.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import fresh

KEY_SETTING = "corefold.pii.key"
ROUNDS = 10
WALK = 96  # most steps to get back into a format; each fails in at most half of the cases
FIRST_DAY, DAYS = "1900-01-01", 73049  # to 2099-12-31

# The formats. In order: where several match at a place, the first holds.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "secret": r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+)(?![A-Za-z0-9_-])|(?<![A-Za-z0-9])(?=[a-fA-F]*+[0-9])(?=[0-9]*+[a-fA-F])[0-9a-fA-F]{32,}+(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])|(?<![0-9+])\+[0-9]{8,15}(?![0-9])",
}


def _pattern() -> str:
    """All formats in one pattern; the groups that a format's back references name are renumbered."""
    parts, groups = [], 0
    for p in KINDS.values():
        mine = p.count("([-/.])")
        for k in range(mine, 0, -1):
            p = p.replace(f"\\{k}", f"\\{k + groups}")
        parts.append(p)
        groups += mine
    return "|".join(f"(?:{p})" for p in parts)


PATTERN = _pattern()


# The lengths of country calling codes (ITU-T E.164).
COUNTRY_CODE = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def key_of(spark: SparkSession) -> str:
    """The key that the session's ``corefold.pii.key`` names; there is no other."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"set {KEY_SETTING}: whoever knows the key can undo the pseudonyms")
    return key


def run_key(spark: SparkSession) -> str:
    """The session's key; where none is set, one is drawn for this session and kept nowhere, so that nobody can undo its pseudonyms."""
    if spark.conf.get(KEY_SETTING, None):
        return key_of(spark)
    if getattr(spark, "_corefold_pii_key", None) is None:
        spark._corefold_pii_key = secrets.token_hex(32)
    return spark._corefold_pii_key


def _secret_column(spark: SparkSession, key: str) -> Column:
    """The key as a scalar subquery over one row: plans, the UI and event logs show the query and not its value."""
    return spark.createDataFrame([(key,)], "k string").scalar()


def _number(s: Column) -> Column:
    return F.when(F.length(s) > 0, s).otherwise(F.lit("0")).cast("bigint")


def _padded(x: Column, n: Column) -> Column:
    return F.when(n > 0, F.lpad(x.cast("string"), n, "0")).otherwise("")


def _feistel(a: Column, b: Column, ma: Column, mb: Column, tweak: Column, key: Column, reveal: bool) -> Column:
    """Permute the pairs (a below ma, b below mb); a struct of both. ``tweak`` keeps formats apart."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if reveal else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def mask(i: Column, x: Column, m: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", key, tweak, i.cast("string"), x.cast("string")), 256)
        return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), m)

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        if reveal:  # (a, b) came from (x, a), with b = x + mask(a)
            m = F.when(even, ma).otherwise(mb)
            return F.struct(F.pmod(s["b"] - mask(i, s["a"], m), m).alias("a"), s["a"].alias("b"))
        m = F.when(even, ma).otherwise(mb)
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + mask(i, s["b"], m), m).alias("b"))

    return F.aggregate(rounds, F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b")), step)


def _permuted(digits: Column, tweak: str, key: Column, reveal: bool) -> Column:
    """A permutation of the digit strings of each length up to 36."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    power = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("bigint")
    s = _feistel(_number(F.substring(digits, F.lit(1), u)), _number(F.substring(digits, u + 1, v)), power(u), power(v), F.concat(F.lit(tweak), n.cast("string")), key, reveal)
    return _let(s, lambda r: F.concat(_padded(r["a"], u), _padded(r["b"], v)))


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _walk(start: Column, step, valid) -> Column:
    """Cycle walking: ``step`` at least once, and on until ``valid``."""
    first = _let(start, step)
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda s, _: F.when(valid(s), s).otherwise(step(s)))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column) -> Column:
    """m with its digits, in order, replaced by the given ones."""
    return _let(
        digits,
        lambda d: F.array_join(
            F.transform(
                F.sequence(F.lit(1), F.length(m)),
                lambda i: F.when(F.substring(m, i, F.lit(1)).rlike("[0-9]"), F.substring(d, F.length(_digits(F.substring(m, F.lit(1), i))), F.lit(1))).otherwise(F.substring(m, i, F.lit(1))),
            ),
            "",
        ),
    )


def _luhn(digits: Column) -> Column:
    """The sum that is a multiple of ten for a valid number."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: _let(F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def _card(m: Column, key: Column, reveal: bool) -> Column:
    d = _digits(m)
    n = F.length(d)
    inner = _permuted(F.substring(d, F.lit(2), n - 2), "card", key, reveal)
    body = F.concat(F.substring(d, 1, 1), inner)
    return _let(body, lambda x: _refill(m, F.concat(x, F.pmod(-_luhn(F.concat(x, F.lit("0"))), F.lit(10)).cast("string"))))


def _mod97(text: Column) -> Column:
    """An IBAN's remainder: head moved to the end, letters as 10 to 35."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text) - 4), F.substring(text, 1, 4))
    chars = F.transform(F.sequence(F.lit(1), F.length(moved)), lambda i: F.substring(moved, i, F.lit(1)))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(chars, F.lit(0), lambda s, c: _let(value(c), lambda x: (s * F.when(x > 9, 100).otherwise(10) + x) % 97))


def _iban(m: Column, key: Column, reveal: bool) -> Column:
    head = F.substring(m, 1, 2)
    tail = F.substring(m, F.lit(5), F.length(m) - 4)
    refilled = _refill(tail, _permuted(_digits(tail), "iban", key, reveal))
    return _let(refilled, lambda t: F.concat(head, F.lpad((98 - _mod97(F.concat(head, F.lit("00"), F.replace(t, F.lit(" "), F.lit(""))))).cast("string"), 2, "0"), t))


def _ip(m: Column, key: Column, reveal: bool) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    s = _feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536).cast("bigint"), F.lit(65536).cast("bigint"), F.lit("ip"), key, reveal)
    return _let(s, lambda r: F.concat_ws(".", F.floor(r["a"] / 256).cast("string"), (r["a"] % 256).cast("string"), F.floor(r["b"] / 256).cast("string"), (r["b"] % 256).cast("string")))


def _ssn_ok(d: Column) -> Column:
    area = F.substring(d, 1, 3)
    return (area != "000") & (area != "666") & (area < "900") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")


def _ssn(m: Column, key: Column, reveal: bool) -> Column:
    return _refill(m, _walk(_digits(m), lambda d: _permuted(d, "ssn", key, reveal), _ssn_ok))


def _date_fields(m: Column) -> tuple[Column, Column]:
    """(the date or null, its order: ymd, mdy or dmy). With slashes the month comes first unless that is no date, else the day."""
    p = F.split(m, "[-/.]")
    mark = F.regexp_extract(m, "[-/.]", 0)
    make = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    ymd, mdy, dmy = make(p[0], p[1], p[2]), make(p[2], p[0], p[1]), make(p[2], p[1], p[0])
    american = mdy.isNotNull() & ((mark == "/") | dmy.isNull())
    return (
        F.when(F.length(p[0]) == 4, ymd).when(american, mdy).otherwise(dmy),
        F.when(F.length(p[0]) == 4, "ymd").when(american, "mdy").otherwise("dmy"),
    )


def _date(m: Column, key: Column, reveal: bool) -> Column:
    """The day is permuted whatever its notation. Days of the month up to 12 stay among themselves, so that the order of day and month stays as clear as it was."""
    p, mark = F.split(m, "[-/.]"), F.regexp_extract(m, "[-/.]", 0)
    date, order = _date_fields(m)
    day = F.date_diff(date, F.lit(FIRST_DAY).cast("date")).cast("bigint")
    as_date = lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))
    ma, mb = 317, 231  # their product is just over DAYS

    def step(n: Column) -> Column:
        s = _feistel(F.floor(n / mb), n % mb, F.lit(ma).cast("bigint"), F.lit(mb).cast("bigint"), F.lit("date"), key, reveal)
        return _let(s, lambda r: r["a"] * mb + r["b"])

    valid = lambda n: (n < DAYS) & ((F.dayofmonth(as_date(n)) > 12) == (F.dayofmonth(date) > 12))
    short = F.exists(p, lambda x: F.length(x) == 1)
    part = lambda x: F.when(short, x.cast("string")).otherwise(F.lpad(x.cast("string"), 2, "0"))

    def shown(n: Column) -> Column:
        d = as_date(n)
        y, mo, dd = F.year(d).cast("string"), part(F.month(d)), part(F.dayofmonth(d))
        return F.when(order == "ymd", F.concat(y, mark, mo, mark, dd)).when(order == "mdy", F.concat(mo, mark, dd, mark, y)).otherwise(F.concat(dd, mark, mo, mark, y))

    return _let(_walk(day, step, valid), shown)


def _phone(m: Column, key: Column, reveal: bool) -> Column:
    """The country code, leading zeros and the first digit after them stay. The rest is permuted alike with and without a country code."""
    d = _digits(m)
    head = F.when(m.startswith("+"), F.regexp_extract(d, f"^{COUNTRY_CODE}0*[0-9]?", 0)).otherwise(F.regexp_extract(d, "^0*[0-9]?", 0))
    n = F.length(head)
    return _refill(m, F.concat(head, _permuted(F.substring(d, n + 1, F.length(d) - n), "phone", key, reveal)))


def _hex(value: Column, key: Column, what: str, n: Column | None = None) -> Column:
    """Hex digits that depend on the key and the value: 128, or ``n`` of them."""
    first = F.sha2(F.concat_ws("|", key, F.lit(what), value), 512)
    if n is None:
        return first
    more = _let(first, lambda h: F.array_join(F.transform(F.sequence(F.lit(0), F.floor(n / 128).cast("int")), lambda i: F.sha2(F.concat_ws("|", key, h, i.cast("string")), 512)), ""))
    return F.substring(more, F.lit(1), n)


def _email(m: Column, key: Column) -> Column:
    h = _hex(F.lower(m), key, "email")
    return F.concat(F.lit("u"), F.substring(h, 1, 12), F.lit("@d"), F.substring(h, 13, 8), F.lit(".example"))


def _secret(m: Column, key: Column) -> Column:
    head = F.regexp_extract(m, "^(?:AKIA|ASIA|gh[pousr]_|sk-)", 0)
    body = _hex(m, key, "secret", F.length(m) - F.length(head))
    return F.concat(head, F.when(F.upper(m) == m, F.upper(body)).otherwise(body))


def kind(m: Column) -> Column:
    """The kind of a match if it is valid, else null."""
    is_ = {k: m.rlike(f"^(?:{p})$") for k, p in KINDS.items()}
    octets = F.forall(F.split(m, r"\."), lambda x: (x.cast("int") <= 255) & ((F.length(x) == 1) | ~x.startswith("0")))
    date, _ = _date_fields(m)
    in_range = date.between(F.lit("1900-01-01").cast("date"), F.lit("2099-12-31").cast("date"))
    n = F.length(_digits(m))
    return (
        F.when(is_["email"], "email")
        .when(is_["secret"], "secret")
        .when(is_["iban"], F.when(_mod97(F.replace(m, F.lit(" "), F.lit(""))) == 1, "iban"))
        .when(is_["card"], F.when((_luhn(_digits(m)) % 10 == 0) & ~_digits(m).rlike("^0+$"), "card"))
        .when(is_["ip"], F.when(octets, "ip"))
        .when(is_["ssn"], F.when(_ssn_ok(_digits(m)), "ssn"))
        .when(is_["date"], F.when(in_range, "date"))
        .when(is_["phone"], F.when(n.between(7, 15), "phone"))
    )


def _pseudonym(m: Column, k: Column, key: Column, reveal: bool) -> Column:
    return (
        F.when(k == "email", m if reveal else _email(m, key))
        .when(k == "secret", m if reveal else _secret(m, key))
        .when(k == "iban", _iban(m, key, reveal))
        .when(k == "card", _card(m, key, reveal))
        .when(k == "ip", _ip(m, key, reveal))
        .when(k == "ssn", _ssn(m, key, reveal))
        .when(k == "date", _date(m, key, reveal))
        .when(k == "phone", _phone(m, key, reveal))
        .otherwise(m)
    )


def pseudonymised(docs: DataFrame, text: str = "text", key: str | None = None, reveal: bool = False, found: str | None = "__found") -> DataFrame:
    """``docs`` with ``text`` rewritten, and the column ``found``: an array of (kind, pseudonym), one for each replaced value in order.

    The key is the session's ``corefold.pii.key`` if none is given; without one this raises. A null text stays null, an empty one empty; texts of any length are
    taken whole, and repeated rows give the same row again. Other columns stay, whatever their names; one named like ``found`` is replaced, and ``found=None`` adds none.
    Only texts with a digit or an @ can hold such values; others pass through.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c != found]
    secret, matches, values = fresh([*docs.columns, found or ""], "__secret", "__matches", "__values")
    source = F.col(f"`{text}`").cast("string")
    may = source.rlike("[0-9@]")
    each = F.when(may, F.regexp_extract_all(source, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    replaced = F.transform(matches, lambda m: _let(kind(m), lambda k: F.struct(k.alias("kind"), _pseudonym(m, k, F.col(secret), reveal).alias("value"))))
    out = docs.withColumn(secret, _secret_column(spark, key or key_of(spark))).withColumn(matches, each).withColumn(values, replaced)
    joined = F.array_join(F.flatten(F.zip_with(F.split(source, PATTERN, -1), values, lambda part, v: F.array(part, v["value"]))), "")
    out = out.withColumn(text, F.when(F.size(matches) > 0, joined).otherwise(source))
    more = [F.filter(values, lambda v: v["kind"].isNotNull()).alias(found)] if found else []
    return out.select(*[F.col(f"`{c}`") for c in columns], *more)


def report(docs: DataFrame, key: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, the rewritten ``text``, ``n_found``, and the kinds found as a sorted list."""
    out = pseudonymised(docs.select("doc_id", "text"), "text", key)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("__found", lambda v: v["kind"]))), ",")
    return out.select("doc_id", "text", F.size("__found").cast("long").alias("n_found"), kinds.alias("kinds"))
