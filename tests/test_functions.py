"""One small table-driven test per scalar cleaning function."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cropledger.functions import (
    avg_half_even,
    collapse_spaces,
    entity_id,
    fingerprint,
    parse_amount,
    scheme_id,
    to_amount,
    trim_cell,
    usable,
)
from cropledger.operators.clean import with_address
from cropledger.operators.lookups import country_code, guess_scheme, rate_to_eur


def address_of(spark, full, parts, cc, legacy=False):
    names = [f"p{i}" for i in range(len(parts))]
    df = spark.createDataFrame([(full, cc, *parts)], ", ".join(f"{n} string" for n in ("full", "cc", *names)))
    return with_address(df, "a", "full", names, "cc", legacy).first()["a"]


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw,expected",
    [('" Foo Bar ",', "Foo Bar"), ("'x'", "x"), ("  a b  ", "a b"), (",,", ""), ("\tz\n", "z")],
)
def test_trim_cell(spark, raw, expected):
    assert one(spark, trim_cell, raw) == expected


def test_collapse(spark):
    assert one(spark, collapse_spaces, " a \t b\n\nc ") == "a b c"


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("ATEV Fehérjefeldolgozó  Zrt.", "atev feherjefeldolgozo zrt"),
        ("Müller & Söhne GmbH", "gmbh muller sohne"),
        ("b a b", "a b"),
        ("Straße", "strasse"),
        ("ACME Limited Company", "acme co ltd"),
        ("Αγροτικός Συνεταιρισμός Ναούσης", "agrotikos naousis synetairismos"),
        ("ΑΓΡΟΤΙΚΟΣ ΣΥΝΕΤΑΙΡΙΣΜΟΣ ΝΑΟΥΣΗΣ", "agrotikos naousis synetairismos"),
        ("Ευφυής άυλος αϋπνία Άγγελος Αγχίαλος", "anchialos angelos aylos aypnia evfyis"),
        ("Иван Петров ЕООД", "eood ivan petrov"),
        ("Щастя Київ їжак", "kiyiv shchastya yizhak"),
        ("Ђорђе Његош", "djordje njegosh"),
        ("Łódź Żółw", "lodz zolw"),
        ("Ærø Ødegård", "aero odegard"),
        ("Þór Eiður", "eidur thor"),
        ("İSTANBUL Şirketi ılık", "ilik istanbul sirketi"),
        ("cafe\u0301", "cafe"),
        ("株式会社 東京", "東京 株式会社"),
        ("Ь", None),
        ("!!!", None),
        (None, None),
    ],
)
def test_fingerprint(spark, raw, expected):
    assert one(spark, fingerprint, raw) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("Anna", True), ("--", False), ("**", False), ("Private Individual", False), ("NIJE primjenjivo x", False),
     ("ro-nan", False), ("", False), (None, False), ("?!", False), ("é", True),
     ("Αθήνα", True), ("София", True), ("東京", True), ("ь", False), ("١٢", True)],
)
def test_usable(spark, raw, expected):
    assert one(spark, usable, raw) is expected


@pytest.mark.parametrize(
    "raw,expected",
    [("12,5", "12.500000"), ("1234.56", "1234.560000"), ("1.234,56", None), ("12,345", None), ("", None),
     ("abc", None), ("-3,10", "-3.100000"), (None, None)],
)
def test_parse_amount(spark, raw, expected):
    got = one(spark, parse_amount, raw)
    assert (got if got is None else str(got)) == expected


def test_to_amount_rounds_half_up(spark):
    assert one(spark, to_amount, Decimal("1.005"), "decimal(24,6)") == Decimal("1.01")


def test_entity_id(spark):
    df = spark.createDataFrame([("a", "bc", None), ("ab", "c", None), (None, None, None)], "x string, y string, z string")
    r = df.select(entity_id("x", "y", "z").alias("id")).collect()
    assert r[0]["id"] != r[1]["id"] and len(r[0]["id"]) == 40 and r[2]["id"] is None
    r2 = df.select(entity_id("x", "y").alias("id")).collect()
    assert r2[0]["id"] == r[0]["id"]  # null parts skipped


def test_scheme_id(spark):
    a = one(spark, scheme_id, "II.1 - Export refunds")
    b = one(spark, scheme_id, "ii 1   export REFUNDS")
    assert a == b and one(spark, scheme_id, None) is None


@pytest.mark.parametrize(
    "raw,expected",
    [("II.10 some text", "II.10 - Storage aid"), ("ii.1 x", "II.1 - Export refunds"), ("II.1x", "II.1x"),
     ("export", "II.1 - Export refunds"), ("IV.9 z", "IV.9"), ("nothing known", "nothing known")],
)
def test_guess_scheme(spark, raw, expected):
    assert one(spark, guess_scheme, raw) == expected


@pytest.mark.parametrize("raw,expected", [("de", "DE"), ("Germany", "DE"), (" deutschland ", "DE"), ("Atlantis", None)])
def test_country_code(spark, raw, expected):
    assert one(spark, country_code, raw) == expected


def test_rate(spark):
    df = spark.createDataFrame([("HUF", 2014), ("HUF", 2016), ("XXX", 2014)], "c string, y int")
    r = [x["r"] for x in df.select(rate_to_eur(F.col("c"), F.col("y")).alias("r")).collect()]
    assert r == [Decimal("0.0033700000"), None, None]


@pytest.mark.parametrize(
    "full,parts,cc,expected",
    [
        (None, ["Main St 1", "Weiswampach", None, "LU"], "LU", "Main St 1, Weiswampach"),
        ("Main St 1, Town", ["Town", "1097.0"], "LU", "Main St 1, Town, 1097"),
        (None, [None, None], "DE", "Germany"),
        ("xpath /x data='Rue 5'", [], "FR", "Rue 5"),
        ("Paul Street", ["LU"], "LU", "Paul Street"),
    ],
)
def test_address(spark, full, parts, cc, expected):
    assert address_of(spark, full, parts, cc) == expected


def test_address_legacy_charset_strip(spark):
    assert address_of(spark, "Paul Street, LU", [], "LU", legacy=True) == "Paul Street"


def test_avg_half_even(spark):
    df = spark.createDataFrame(
        [("a", Decimal("10.02")), ("a", Decimal("10.03")), ("b", Decimal("10.01")), ("b", Decimal("10.02")),
         ("c", Decimal("-0.01")), ("c", Decimal("-0.02")), ("d", None)],
        "k string, v decimal(18,2)",
    )
    got = {r["k"]: r["a"] for r in df.groupBy("k").agg(avg_half_even("v").alias("a")).collect()}
    assert got == {"a": Decimal("10.02"), "b": Decimal("10.02"), "c": Decimal("-0.02"), "d": None}


@pytest.mark.parametrize(
    "parts,cc,expected",
    [
        (("Αθήνα", "GR"), "GR", "Αθήνα"),
        (("улица Шипка 1", "София", "BG"), "BG", "улица Шипка 1, София"),
        (("DE",), "DE", "Germany"),
        ((None, "DE"), "DE", "Germany"),
        (("?", "GR"), "GR", "Greece"),
        (("DE", "Köln", "DE"), "DE", "DE, Köln"),
    ],
)
def test_address_letters_and_code_alone(spark, parts, cc, expected):
    assert address_of(spark, None, parts, cc) == expected


def test_local_names_make_one_recipient(spark):
    """Names and schemes in other letters stay, equal ones share an id."""
    from cropledger.operators.clean import clean

    rows = [("GR", "2019", n, "Αθήνα", s, "10", "EUR") for n, s in (("Αγρός ΑΕ", "Βασική ενίσχυση"), ("ΑΓΡΟΣ ΑΕ", "Βασική ενίσχυση"), ("Άλλος", "東京"), ("--", "?"))]
    raw = spark.createDataFrame(rows, "country string, year string, recipient_name string, recipient_location string, scheme string, amount string, currency string")
    got = clean(raw).rows.select("recipient_name", "recipient_fingerprint", "recipient_address", "recipient_id", "scheme").collect()
    known = {r.recipient_name: r for r in got if not r.recipient_name.startswith("Anonymous ")}
    assert set(known) == {"Αγρός ΑΕ", "ΑΓΡΟΣ ΑΕ", "Άλλος"} and len(got) == 4
    assert known["Αγρός ΑΕ"].recipient_id == known["ΑΓΡΟΣ ΑΕ"].recipient_id != known["Άλλος"].recipient_id
    assert known["Αγρός ΑΕ"].recipient_fingerprint == "ae agros"
    assert {r.recipient_address for r in got} == {"Αθήνα"}
    assert sorted(str(r.scheme) for r in got) == sorted(["Βασική ενίσχυση", "Βασική ενίσχυση", "東京", "None"])


def test_scheme_table_equals_dictionary(spark):
    from cropledger.dims import SCHEMES, schemes_df
    from cropledger.operators.lookups import guess_scheme, match_schemes

    texts = [None, "a", "e ", "\u00e9", "zz", "zzz top", "II.1 x", "ii.1\tx", "xII.1 y I.1 z", "no id here ", "II.1", " ", "%", "\\s"]
    for sid, _article, name, _description in SCHEMES:
        texts += [f"{sid} tail", f"before {sid.lower()} tail", sid, f"{sid}\n"]
        if name:
            texts += [name, name.upper(), name[2:9], name[-4:], name[:3], name[3:5], name + "!", name[1:6] + "q"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts * 2)], "i int, text string, id string")
    got = match_schemes(df, "text", schemes_df(spark), "found").withColumn("want", guess_scheme(F.col("text")))
    assert got.columns == ["i", "text", "id", "found", "want"]
    bad = got.where(~F.col("found").eqNullSafe(F.col("want"))).collect()
    assert not bad and got.count() == 2 * len(texts)


def test_scheme_table_cases(spark):
    from cropledger.operators.lookups import match_schemes

    schemes = spark.createDataFrame(
        [("A", "Aid for oats", 2), ("a", "second of an id", 3), ("B.1", "aid for oats and rye", 1), (None, "no id", 0), ("C", None, 4)],
        "scheme_id string, scheme_name string, ord int",
    )
    texts = ["", "oats", "for OATS and", "A x", "b.1 a x", "c\u00a0x", "c x", "no id", "oats for"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["m"] for r in match_schemes(df, "t", schemes, "m").collect()}
    assert got == {
        "": "", "oats": "B.1 - aid for oats and rye", "for OATS and": "B.1 - aid for oats and rye", "A x": "A - Aid for oats",
        "b.1 a x": "B.1 - aid for oats and rye", "c\u00a0x": "c\u00a0x", "c x": "C", "no id": "no id", "oats for": "oats for",
    }
    assert match_schemes(df, "t", schemes.limit(0), "m").where("m <> t").count() == 0
    assert match_schemes(df.limit(0), "t", schemes, "m").count() == 0


def test_clean_with_a_scheme_table(spark):
    from cropledger.dims import schemes_df
    from cropledger.operators.clean import Lookups, clean
    from cropledger.plans.testdata import raw_payments

    raw = raw_payments(spark, "/root/testdata/sf0.001")
    built_in = clean(raw).cleaned.select("pk", "scheme", "scheme_id")
    by_table = clean(raw, lookups=Lookups(schemes=schemes_df(spark))).cleaned.select("pk", "scheme", "scheme_id")
    assert built_in.exceptAll(by_table).count() == by_table.exceptAll(built_in).count() == 0
