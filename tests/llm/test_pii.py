import hashlib
import os
import pathlib
import random
import re
import subprocess
import sys
from datetime import date

import pytest

from corefold.llm import pii


def luhn_ok(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def card(rng, n=16):
    d = "4" + "".join(rng.choices("0123456789", k=n - 2))
    return next(d + c for c in "0123456789" if luhn_ok(d + c))


def feistel(a, b, ma, mb, tweak, key):
    """A plain version of the network."""
    for i in range(pii.ROUNDS):
        m = ma if i % 2 == 0 else mb
        digest = hashlib.sha256(f"{key}|{tweak}|{i}|{b}".encode()).hexdigest()
        a, b = b, (a + int(digest[:15], 16) % m) % m
    return a, b


def permuted(d, tweak, key):
    u = len(d) // 2
    v = len(d) - u
    a, b = feistel(int(d[:u] or 0), int(d[u:] or 0), 10**u, 10**v, f"{tweak}{len(d)}", key)
    return (str(a).zfill(u) if u else "") + (str(b).zfill(v) if v else "")


def mod97(s):
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def iban(rng):
    body = "".join(rng.choices("0123456789", k=18))
    return f"DE{98 - mod97('DE00' + body):02d}{body}"


def found(spark, texts, key="k0", **more):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    return {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string, kinds string, __values int"), key, **more).collect()}


def test_formats_links_and_the_way_back(spark):
    rng = random.Random(6)
    values = []
    for _ in range(40):
        c = card(rng)
        values += [c, " ".join(re.findall("....", c)), "-".join(re.findall("....", c)), card(rng, rng.randint(13, 19)), iban(rng), " ".join(re.findall(".{1,4}", iban(rng)))]
        values += [".".join(str(rng.randint(0, 255)) for _ in range(4)), f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"]
        d = date.fromordinal(rng.randint(date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()))
        values += [d.isoformat(), f"{d:%d.%m.%Y}", f"{d:%m/%d/%Y}", f"{d:%Y/%m/%d}"] + ([f"{d:%d/%m/%Y}"] if d.day > 12 else [])
        values += [f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(0, 9999):04d}", f"{rng.randint(200, 999)}-555-{rng.randint(0, 9999):04d}"]
    texts = [f"Before {v}### and, {v}\nend" for v in values]
    got = found(spark, texts, key="k1")
    seen = {}
    for i, v in enumerate(values):
        new = re.fullmatch(r"Before (.*)### and, (.*)\nend", got[i].text)
        assert new and new[1] == new[2] != v and got[i].n_found == 2, (v, got[i])
        assert re.sub(r"\d", "0", new[1]) == re.sub(r"\d", "0", v) or got[i].kinds == "ip"
        assert seen.setdefault((got[i].kinds, new[1]), v) == v
        if got[i].kinds == "card":
            d = re.sub(r"\D", "", v)
            n = re.sub(r"\D", "", new[1])
            assert luhn_ok(n) and n[:-1] == d[0] + permuted(d[1:-1], "card", "k1")
        if got[i].kinds == "iban":
            assert mod97(new[1].replace(" ", "")) == 1
        if got[i].kinds == "ip":
            o = list(map(int, v.split(".")))
            a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip", "k1")
            assert new[1] == f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    assert {r.kinds for r in got.values()} == {"card", "iban", "ip", "ssn", "date", "phone"}
    back = pii.pseudonymised(spark.createDataFrame([(i, got[i].text) for i in got], "doc_id long, text string"), key="k1", reveal=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))
    other = found(spark, texts[:30], key="k2")
    assert all(other[i].text != got[i].text for i in other)


def test_emails_and_secrets(spark):
    texts = ["a.b@mail3.example.com X@y.org", "é.72@mail8.example.com###", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "AKIA" + "A1" * 8, "x@y z@ @w 24be6443 deadbeef"]
    got = found(spark, texts)
    assert [got[i].n_found for i in range(5)] == [2, 1, 1, 1, 0]
    assert got[4].text == texts[4]
    assert "mail3" not in got[0].text and "@" in got[0].text and got[1].text.endswith("###")
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[2].text) and re.fullmatch("AKIA[0-9A-F]{16}", got[3].text)


def test_invalid_values_and_odd_rows_stay(spark):
    texts = [None, "", " ", "4111 1111 1111 1112", "0000000000000000", "256.1.1.1 1.2.3.4.5 01.2.3.4", "000-12-3456 666-12-3456", "2023-02-29 31.04.2020 13/13/2020 1850-01-01", "DE00370400440532013000", "year 2024, 3.14"]
    got = found(spark, texts)
    assert [got[i].text for i in range(len(texts))] == texts
    assert all(r.n_found == 0 and r.kinds == "" for r in got.values())


def test_long_text_repeated_rows_and_empty_table(spark):
    text = "word 4111111111111111 " * 20000
    rows = [(1, text), (1, text), (None, "555-123-4567")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.report(df, "k").collect()
    assert sorted(r.n_found for r in got) == [1, 20000, 20000]
    assert pii.report(df.limit(0), "k").collect() == []


def test_one_value_in_several_notations_stays_one(spark):
    dates = {i: date(2020, 1, 5 + i) for i in range(20)}
    shown = ["%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d.%m.%Y", "%d-%m-%Y"]
    got = found(spark, [" and ".join(f"{d:{f}}" for f in shown) for d in dates.values()])
    for i in dates:
        a, b, c, d, e = got[i].text.split(" and ")
        y, m, dd = a.split("-")
        assert a != f"{dates[i]:%Y-%m-%d}" and (int(dd) > 12) == (dates[i].day > 12)
        assert (b, c, d, e) == (f"{y}/{m}/{dd}", f"{m}/{dd}/{y}", f"{dd}.{m}.{y}", f"{dd}-{m}-{y}")
    late = found(spark, ["25/12/2020 12/25/2020 12-25-2020 2020-12-25 5.1.2020 2020-1-5"])[0].text.split()
    y, m, d = late[3].split("-")
    assert late[:3] == [f"{d}/{m}/{y}", f"{m}/{d}/{y}", f"{m}-{d}-{y}"] and int(d) > 12
    assert late[4] == ".".join(reversed(late[5].split("-")))
    phones = found(spark, ["+1 415-555-0100 +14155550100 (415) 555-0100 415.555.0100", "+49 30 1234 5678 +493012345678"])
    digits = [re.sub(r"\D", "", x) for x in re.findall(r"\+1 [\d-]+|\+\d+|\(\d+\) [\d-]+|[\d.]+", phones[0].text)]
    assert digits[0] == digits[1] == "1" + digits[2] == "1" + digits[3] != "14155550100"
    german = re.findall(r"\+49 [\d ]+|\+49\d+", phones[1].text)
    assert len({re.sub(r"\D", "", x) for x in german}) == 1 and german[0][:5] == "+49 3"


def test_secrets_of_any_length(spark):
    rng = random.Random(3)
    hexes = "".join(rng.choices("0123456789abcdef", k=1000))
    texts = ["sk-" + "aB3_" * 90, "ghp_" + "a1B2" * 60, hexes, hexes[:129], "sk-" + "x1" * 200000]
    got = found(spark, [f"key={t} end" for t in texts])
    for i, t in enumerate(texts):
        new = got[i].text[4:-4]
        assert len(new) == len(t) and new != t and t[8:40] not in got[i].text and got[i].n_found == 1


def test_a_key_is_needed_and_not_shown(spark):
    df = spark.createDataFrame([(1, "card 4111111111111111")], "doc_id long, text string")
    with pytest.raises(ValueError):
        pii.pseudonymised(df)
    out = pii.pseudonymised(df, key="s3cr3t-k3y")
    plan = out._jdf.queryExecution().toString()
    assert "s3cr3t" not in plan and "Python" not in plan and "4111" not in out.first().text
    assert pii.run_key(spark) == pii.run_key(spark) and len(pii.run_key(spark)) == 64


def test_columns_with_clashing_names_stay(spark):
    rows = [(1, "card 4111111111111111", 1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __matches int, __values int, __secret int, __found int")
    out = pii.pseudonymised(df, key="k", found=None)
    assert out.columns == df.columns and tuple(out.first())[2:] == (1, 2, 3, 4)
    assert [v.kind for v in pii.pseudonymised(df, key="k").first()["__found"]] == ["card"]


HOSTILE = """
from pyspark.sql import SparkSession
from corefold.llm import pii
spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
units = ["a.", "1.", "1 ", "AA00 ", "A1B2 ", "a1", "0", "+1 ", "(12) ", "1-", "x@", "sk-", "4111 ", "\u00e9", "\u20ac", "12/"]
unit = "element_at(array(" + ",".join(f"'{u}'" for u in units) + "), CAST(id + 1 AS INT))"
df = spark.range(0, len(units), 1, len(units)).selectExpr("id AS doc_id", f"concat('x@', repeat({unit}, CAST(1000000 * if(id = 0, 10, 1) / length({unit}) AS INT)), '! ') AS text")
print(pii.report(df, "k").where("length(text) >= 999998").count())
"""


def test_hostile_texts_of_10_mb_in_a_fresh_jvm():
    here = pathlib.Path(__file__).parents[2]
    got = subprocess.run([sys.executable, "-c", HOSTILE], capture_output=True, text=True, timeout=900, cwd=here, env=os.environ | {"PYTHONPATH": str(here)})
    assert got.stdout.strip() == "16", got.stdout[-500:] + got.stderr[-2000:]
