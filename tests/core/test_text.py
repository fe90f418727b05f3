import re
import unicodedata

from pyspark.sql import functions as F

from corefold.functions import text as T
from corefold.functions import vocabulary as V

SAMPLES = ["Acme & Sons, Inc.", "  NULL ", "n/a", None, "", "தமிழ் நாடு", "हिन्दी कंपनी", "Müller & Söhne GmbH", "https://www.Foo-Bar.com", "x² Nº5 ½", "a b_c", "Enterprises Inc", "école", "100 Main Street #4"]


def one(spark, column_of):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    return [r.x for r in df.select("i", column_of(F.col("s")).alias("x")).orderBy("i").collect()]


def test_fast_regex_is_pythons(spark):
    want = [re.sub(r"[^\w\s]", " ", (s or "").lower()) for s in SAMPLES]
    assert one(spark, lambda c: T.fast_punctuation(F.coalesce(c, F.lit("")))) == want
    assert one(spark, lambda c: T.fast_alpha(F.coalesce(c, F.lit("")))) == [re.sub(r"[^\w]", "", (s or "").lower()) for s in SAMPLES]


def test_punctuation_keeps_marks(spark):
    def python(s):
        s = "".join(" " if unicodedata.category(c)[0] in "PS" else c for c in s.replace("&", " and "))
        return re.sub(r"\s+", " ", s).strip()

    assert one(spark, lambda c: T.clean_punctuation(F.coalesce(c, F.lit("")))) == [python(s or "") for s in SAMPLES]


def test_missing_and_nfc(spark):
    got = one(spark, T.clean_input)
    assert got[1] == got[2] == got[3] == got[4] == "" and got[0] == "Acme & Sons, Inc."
    assert one(spark, T.nfc)[12] == "école"


def test_records(spark):
    rows = [
        ("S1-1", "Springfield Tools LLC", "100 North Main Street, Suite #400, Springfield, IL", "US"),
        ("S1-2", "TOOLS Springfield", "Springfield IL St 100 N Main Ste 400", " us "),
        ("S1-3", "https://www.lopez-network.com", None, None),
        ("S1-4", "Enterprises Inc", "NaN", "<MISSING>"),
        ("S1-5", "Müller & Söhne GmbH", "x", "France"),
        ("S1-6", None, "", "India"),
    ]
    got = {r.entity_id: r for r in T.normalize_records(spark.createDataFrame(rows, "source1_entity_id string, business_name string, business_address string, country string")).collect()}
    assert got["S1-1"].address.standardized_sorted == got["S1-2"].address.standardized_sorted == "100 400 il main n springfield st ste"
    assert got["S1-1"].name.no_legal == "springfield tools" and got["S1-2"].country == "US"
    assert got["S1-3"].name.domain_clean == "lopez network" and got["S1-3"].country == "" and got["S1-3"].address.is_empty
    assert got["S1-4"].name.no_legal == "enterprises inc" and got["S1-4"].address.is_empty and got["S1-4"].country == ""
    assert got["S1-5"].name.clean == "müller and söhne gmbh" and got["S1-5"].original_business_name == "Müller & Söhne GmbH"
    assert got["S1-6"].name.is_empty and got["S1-6"].name.tokens == []


def test_small_functions(spark):
    lit = F.lit
    row = spark.range(1).select(
        T.script(lit("தமிழ்")).alias("a"), T.script(lit("é")).alias("b"), T.script_type(lit("Привет")).alias("c"), T.indic_fold(lit("vishveepore")).alias("d"),
        T.state_variant(lit("x california y"), lit("x ca y")).alias("e"), T.address_variant(lit("main street"), lit("main st")).alias("f"), T.has_domain(lit("see foo.com")).alias("g"),
        T.forensic_legal(lit("Acme Co., Ltd.")).alias("h"), T.zip_tokens(lit("a 12345 1234567 123456")).alias("i"), T.digit_tokens(lit("12a 34 5")).alias("j"), T.acronym(T.tokens(lit("a bc d"))).alias("k"),
    ).first()
    assert tuple(row) == ("Tamil", "Other Non-Latin", "Other Non-Latin", "wiswipur", True, True, True, "acme", ["12345", "123456"], ["34", "5"], "abd")
    assert (len(V.LEGAL), len(V.STOPWORDS), len(V.ADDRESS), len(V.STATES), len(V.ABBREVIATIONS)) == (30, 65, 29, 60, 22)
