"""Dimension tables: currencies and rates, countries, schemes, region codes.

All lookup data is small and bounded by construction (the row counts are
stated next to each table), so the DataFrames built here may be broadcast
without a runtime size check. Payment data itself never passes through the
driver.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES that must equal the source data's conventions for right results.
# ---------------------------------------------------------------------------

# National currency by payment country (30 rows). Euro members keep their
# legacy currency code here; rows reporting "EUR" are never converted.
COUNTRY_CURRENCY = {
    "AT": "ATS",
    "BE": "BEF",
    "BG": "BGN",
    "CY": "CYP",
    "DE": "DEM",
    "EE": "EEK",
    "ES": "ESP",
    "FI": "FIM",
    "FR": "FRF",
    "GR": "GRD",
    "IE": "IEP",
    "IT": "ITL",
    "LT": "LTL",
    "LU": "LUF",
    "LV": "LVL",
    "MT": "MTL",
    "NL": "NLG",
    "PT": "PTE",
    "SI": "SIT",
    "SK": "SKK",
    "SE": "SEK",
    "CZ": "CZK",
    "HU": "HUF",
    "LI": "CHF",
    "PL": "PLN",
    "RO": "RON",
    "DK": "DKK",
    "HR": "HRK",
    "GB": "GBP",
    "UA": "UAH",
}

# Known currencies: the national ones plus EUR (31 values).
CURRENCIES = list(COUNTRY_CURRENCY.values()) + ["EUR"]

# Yearly rates to EUR, keyed "CURRENCY|year" (112 entries, 10 currencies).
# HUF has only 2014, 2015, 2019-2022; LTL only 2015-2016.
CURRENCY_RATES = {
    "BGN|2010": 0.5135734541302986,
    "BGN|2011": 0.5108445917095082,
    "BGN|2012": 0.5101972209031305,
    "BGN|2013": 0.5107423232019341,
    "BGN|2014": 0.511683348114363,
    "BGN|2015": 0.5129901950182264,
    "BGN|2016": 0.512046956861136,
    "BGN|2017": 0.5112993620285876,
    "BGN|2018": 0.5109268759665186,
    "BGN|2019": 0.5134566041289047,
    "BGN|2020": 0.5111195340593252,
    "BGN|2021": 0.5137864317779282,
    "BGN|2022": 0.515,
    "CZK|2010": 0.03791335575336573,
    "CZK|2011": 0.03989465160499548,
    "CZK|2012": 0.038943858983306774,
    "CZK|2013": 0.039748599891225145,
    "CZK|2014": 0.03656805948121443,
    "CZK|2015": 0.03612867651218881,
    "CZK|2016": 0.0370698298780991,
    "CZK|2017": 0.03699579986360396,
    "CZK|2018": 0.03913489096829461,
    "CZK|2019": 0.03885435830207158,
    "CZK|2020": 0.039339046051480316,
    "CZK|2021": 0.03831734039192274,
    "CZK|2022": 0.04,
    "DKK|2010": 0.13459503043890436,
    "DKK|2011": 0.134156233443214,
    "DKK|2012": 0.13453601442604265,
    "DKK|2013": 0.13377227271980405,
    "DKK|2014": 0.13410797055918583,
    "DKK|2015": 0.13446277718792288,
    "DKK|2016": 0.13419606160865488,
    "DKK|2017": 0.1344315986510879,
    "DKK|2018": 0.13432836302503653,
    "DKK|2019": 0.13394317218137594,
    "DKK|2020": 0.13384930038111884,
    "DKK|2021": 0.1350228955013212,
    "DKK|2022": 0.13,
    "GBP|2010": 1.1278323067367169,
    "GBP|2011": 1.1640740786868093,
    "GBP|2012": 1.1987647423960273,
    "GBP|2013": 1.2298456260720414,
    "GBP|2014": 1.2042849191255889,
    "GBP|2015": 1.2888502131649957,
    "GBP|2016": 1.3571345417892833,
    "GBP|2017": 1.1728008278771325,
    "GBP|2018": 1.1248304484806564,
    "GBP|2019": 1.1127682803022187,
    "GBP|2020": 1.181214492918793,
    "GBP|2021": 1.1248800164080126,
    "GBP|2022": 1.16,
    "HRK|2010": 0.1372081522839623,
    "HRK|2011": 0.13482231159457528,
    "HRK|2012": 0.13248306882762317,
    "HRK|2013": 0.13214956676908385,
    "HRK|2014": 0.1312634474031841,
    "HRK|2015": 0.1305943194567761,
    "HRK|2016": 0.1310237929935581,
    "HRK|2017": 0.1323586470252115,
    "HRK|2018": 0.13443985144518006,
    "HRK|2019": 0.13500541577693187,
    "HRK|2020": 0.1342584057232302,
    "HRK|2021": 0.13313282842994464,
    "HRK|2022": 0.133,
    "HUF|2014": 0.00337,
    "HUF|2015": 0.00318,
    "HUF|2019": 0.00316,
    "HUF|2020": 0.00302,
    "HUF|2021": 0.00274,
    "HUF|2022": 0.0025,
    "LTL|2015": 0.290,
    "LTL|2016": 0.2962000840716404,
    "PLN|2010": 0.24472230411770488,
    "PLN|2011": 0.2513521671987936,
    "PLN|2012": 0.2240935915447809,
    "PLN|2013": 0.24503308900747217,
    "PLN|2014": 0.24088763090332407,
    "PLN|2015": 0.23272355900235261,
    "PLN|2016": 0.23441005323191594,
    "PLN|2017": 0.2269930937394312,
    "PLN|2018": 0.23938711727175754,
    "PLN|2019": 0.23320645985577051,
    "PLN|2020": 0.23498886150033615,
    "PLN|2021": 0.21916126987002402,
    "PLN|2022": 0.212,
    "RON|2010": 0.23632290263267156,
    "RON|2011": 0.23292352769482222,
    "RON|2012": 0.2310683776151275,
    "RON|2013": 0.22470325537666003,
    "RON|2014": 0.22352059644110517,
    "RON|2015": 0.22309530080138454,
    "RON|2016": 0.22126071574265782,
    "RON|2017": 0.22021411280224826,
    "RON|2018": 0.21416997706238533,
    "RON|2019": 0.2149778784829439,
    "RON|2020": 0.2090018605861726,
    "RON|2021": 0.20654289372599233,
    "RON|2022": 0.202,
    "SEK|2010": 0.09767301777858403,
    "SEK|2011": 0.11143100052829193,
    "SEK|2012": 0.11217364055074694,
    "SEK|2013": 0.11622620354782562,
    "SEK|2014": 0.11299766363093607,
    "SEK|2015": 0.1060185082307759,
    "SEK|2016": 0.10919127101531909,
    "SEK|2017": 0.10435818288485496,
    "SEK|2018": 0.10175969251091803,
    "SEK|2019": 0.09839547948689177,
    "SEK|2020": 0.09536620931226081,
    "SEK|2021": 0.09948629205167554,
    "SEK|2022": 0.0923,
}

# Placeholder substrings that make a name or id unusable (lower case).
EMPTY_MARKERS = ("**", "--", "private individual", "nije primjenjivo", "nan # nan", "ro-nan")

# Text tokens read as missing on CSV input (pandas default NA tokens).
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Years visible to anonymous API users (row restriction P13).
PUBLIC_YEARS = (2020, 2021)

# Programme literal of every payment node in the entity graph.
PROGRAMME = "The Common Agricultural Policy (CAP)"

# ---------------------------------------------------------------------------
# Our own tables (the source snapshot ships none of these).
# ---------------------------------------------------------------------------

# Served countries: ISO code, English name, native name.
COUNTRIES = [
    ("AT", "Austria", "Österreich"),
    ("BE", "Belgium", "België"),
    ("BG", "Bulgaria", "България"),
    ("CY", "Cyprus", "Κύπρος"),
    ("CZ", "Czech Republic", "Česko"),
    ("DE", "Germany", "Deutschland"),
    ("DK", "Denmark", "Danmark"),
    ("EE", "Estonia", "Eesti"),
    ("ES", "Spain", "España"),
    ("FI", "Finland", "Suomi"),
    ("FR", "France", "France"),
    ("GB", "United Kingdom", "United Kingdom"),
    ("GR", "Greece", "Ελλάδα"),
    ("HR", "Croatia", "Hrvatska"),
    ("HU", "Hungary", "Magyarország"),
    ("IE", "Ireland", "Éire"),
    ("IT", "Italy", "Italia"),
    ("LI", "Liechtenstein", "Liechtenstein"),
    ("LT", "Lithuania", "Lietuva"),
    ("LU", "Luxembourg", "Lëtzebuerg"),
    ("LV", "Latvia", "Latvija"),
    ("MT", "Malta", "Malta"),
    ("NL", "Netherlands", "Nederland"),
    ("PL", "Poland", "Polska"),
    ("PT", "Portugal", "Portugal"),
    ("RO", "Romania", "România"),
    ("SE", "Sweden", "Sverige"),
    ("SI", "Slovenia", "Slovenija"),
    ("SK", "Slovakia", "Slovensko"),
    ("UA", "Ukraine", "Україна"),
]

# FIXED VALUES: codes in use for countries beside their ISO code.
COUNTRY_CODE_ALIASES = {"EL": "GR", "UK": "GB"}

# Scheme dictionary: id, article, name, description. ``II.1`` and ``II.10``
# exercise longest-id-first matching; ``IV.9`` has no name.
SCHEMES = [
    ("I.1", "Art. 1", "Decoupled direct payments", "Single area payment per hectare"),
    ("I.2", "Art. 2", "Greening payment", "Climate and environment practices"),
    ("I.3", "Art. 3", "Young farmer payment", "Top-up for farmers under forty"),
    ("II.1", "Art. 21", "Export refunds", "Refunds on exports to third countries"),
    ("II.10", "Art. 30", "Storage aid", "Private storage of produce"),
    ("II.2", "Art. 22", "School milk", "Milk distributed to pupils"),
    ("III.1", "Art. 41", "Rural development investment", "Investment in physical assets"),
    ("III.2", "Art. 42", "Agri-environment-climate", "Voluntary environment commitments"),
    ("III.3", "Art. 43", "Organic farming", "Conversion to organic methods"),
    ("IV.1", "Art. 51", "Producer organisations", "Operational funds of producers"),
    ("IV.2", "Art. 52", "Wine sector support", "Restructuring of vineyards"),
    ("IV.9", "Art. 59", None, "Other market measures"),
    ("V.1", "Art. 61", "Fisheries fund", "Maritime and fisheries support"),
    ("V.2", "Art. 62", "Economy promotion", "Promotion of agricultural products"),
]

# Legal forms shortened by the fingerprint (our own short list).
LEGAL_FORMS = [
    ("limited", "ltd"),
    ("company", "co"),
    ("corporation", "corp"),
    ("incorporated", "inc"),
    ("aktiengesellschaft", "ag"),
    ("gesellschaft mit beschrankter haftung", "gmbh"),
    ("societe anonyme", "sa"),
    ("spolka z ograniczona odpowiedzialnoscia", "sp z o o"),
]

# Served payment countries indexed by TPC-H nation key (testdata adapter):
# 25 codes, covering every currency that has rates.
NATION_COUNTRY = [
    "AT", "BE", "BG", "CY", "CZ", "DE", "DK", "EE", "ES", "FI",
    "FR", "GB", "GR", "HR", "HU", "IE", "IT", "LT", "LU", "LV",
    "NL", "PL", "PT", "RO", "SE",
]


# ---------------------------------------------------------------------------
# DataFrame builders. All tiny, bounded by the literals above.
# ---------------------------------------------------------------------------

RATE_TYPE = T.DecimalType(12, 10)




@lru_cache(maxsize=1)
def world_countries() -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    """(ISO code, English name, names in the country's own languages) of every
    country, by rule: from the locale data of the JVM that Spark runs on. The served
    countries' names come first."""
    from pyspark.sql import SparkSession as Session

    locale = Session.active().sparkContext._jvm.java.util.Locale
    own: dict[str, set[str]] = {}
    for x in locale.getAvailableLocales():
        if x.getCountry():
            own.setdefault(x.getCountry(), set()).add(x.getDisplayCountry(x))
    served = {c: (n, native) for c, n, native in COUNTRIES}
    out = []
    for code in sorted({*locale.getISOCountries(), *served}):
        english = locale("", code).getDisplayCountry(locale.ENGLISH)
        name, native = served.get(code, (english, english))
        out.append((code, name, tuple(sorted({native, english, *own.get(code, ())}))))
    return tuple(out)


def countries_df(spark: SparkSession) -> DataFrame:
    """country string, name string: one row per served country."""
    return spark.createDataFrame(
        [(code, name) for code, name, _ in COUNTRIES], "country string, name string"
    )



def schemes_df(spark: SparkSession) -> DataFrame:
    """scheme_id, scheme_article, scheme_name, scheme_description, ord,
    plus derived lower-case id, lower-case name and full name."""
    rows = [(i, a, n, d, pos) for pos, (i, a, n, d) in enumerate(SCHEMES)]
    df = spark.createDataFrame(
        rows,
        "scheme_id string, scheme_article string, scheme_name string, "
        "scheme_description string, ord int",
    )
    return df.select(
        "*",
        F.lower("scheme_id").alias("scheme_id_lower"),
        F.lower("scheme_name").alias("scheme_name_lower"),
        scheme_full_name(F.col("scheme_id"), F.col("scheme_name")).alias("scheme_full_name"),
    )


def scheme_full_name(scheme_id, scheme_name):
    """``id - name`` with a trailing `` -`` stripped (name may be null)."""
    full = F.concat(scheme_id, F.lit(" - "), F.coalesce(scheme_name, F.lit("")))
    return F.regexp_replace(full, r"[ -]+$", "")


def nuts_rows() -> list[tuple[int, str, str]]:
    """(level, nuts_id, name): region codes of the served countries, built by
    rule: level 0 is the country code, each further level appends a digit."""
    rows = []
    for code, name, _ in COUNTRIES:
        for level in range(4):
            suffix = "1" * level
            rows.append((level, f"{code}{suffix}", f"{name} {suffix}".strip()))
    return rows


def nuts_df(spark: SparkSession) -> DataFrame:
    """level int, nuts_id string, name string (4 rows per country)."""
    return spark.createDataFrame(nuts_rows(), "level int, nuts_id string, name string")
