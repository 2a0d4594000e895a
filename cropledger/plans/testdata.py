"""Adapter from the driver's TPC-H-like tables to the payments model (§7.2).

``payments(spark, sf_dir)`` builds the cleaned-payments table (F2) as one lazy
star join: lineitem is the fact, one payment per line item. ``raw_payments``
turns the same join into messy source text (F1) that drives the cleaning
pipeline. Both grow linearly with the input tables.

Plan at scale: lineitem ⋈ part and orders ⋈ customer, then both by the order's key:
equi-joins on keys of large tables, left to the planner (sort-merge with AQE skew
splitting), like nation ⋈ region. So a line item is shuffled twice, without the
recipient's columns, and a filter on recipients leaves fewer orders to join. A reader with
such a filter joins orders first (``few_recipients``): only its own line items go on to part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.dims import COUNTRY_CURRENCY, CURRENCY_RATES, NATION_COUNTRY
from cropledger.functions import entity_id, fingerprint, scheme_id
from cropledger.schema import AMOUNT_TYPE, PAYMENT_COLUMNS

# FIXED VALUES of the adapter (ours): the segment whose address and region
# codes are null, and the part size under which a payment has no scheme.
NO_ADDRESS_SEGMENT = "AUTOMOBILE"
MIN_SCHEME_SIZE = 5
YEAR_SHIFT = 15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def country_of(nationkey: Column) -> Column:
    codes = F.array(*[F.lit(c) for c in NATION_COUNTRY])
    return F.element_at(codes, nationkey + 1)


def _lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ (nation ⋈ region), both joins left to the planner."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey)


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ (nation ⋈ region) ⋈ part, pruned to
    the columns the payments model needs."""
    li = _lineitems(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = _customers(spark, sf_dir)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    items = li.join(part, li.l_partkey == part.p_partkey)
    return items.join(orders.join(cust, orders.o_custkey == cust.c_custkey), items.l_orderkey == orders.o_orderkey)


def payments(spark: SparkSession, sf_dir: str, few_recipients: bool = False) -> DataFrame:
    """The cleaned payments table (F2 schema) derived from the test tables.
    ``few_recipients`` joins the same rows in the order for a reader that filters on
    recipients: line items meet the orders that are left before they meet their parts.

    Recipient columns (id, fingerprint, address, region codes) depend only on
    the customer and scheme columns only on the part, so they are computed on
    those tables before the join: Catalyst prunes columns through joins but
    does not move computed expressions below them, and the dimension sides
    are 30-40x smaller than the line items."""
    li = _lineitems(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = _customers(spark, sf_dir)
    country = country_of(F.col("c_nationkey"))
    has_geo = F.col("c_mktsegment") != NO_ADDRESS_SEGMENT
    recipients = cust.select(
        "c_custkey",
        country.alias("country"),
        entity_id("c_custkey").alias("recipient_id"),
        F.col("c_name").alias("recipient_name"),
        fingerprint("c_name").alias("recipient_fingerprint"),
        F.when(has_geo, F.concat_ws(", ", "c_mktsegment", country)).alias("recipient_address"),
        F.when(has_geo, F.col("r_name")).alias("nuts1"),
        F.when(has_geo, country).alias("nuts2"),
        F.when(has_geo, F.concat_ws("-", country, "c_mktsegment")).alias("nuts3"),
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    scheme = F.when(F.col("p_size") >= MIN_SCHEME_SIZE, F.concat_ws(" ", "p_type", "p_brand"))
    schemes = part.select("p_partkey", scheme.alias("scheme"), scheme_id(scheme).alias("scheme_id"))

    placed = orders.join(recipients, orders.o_custkey == recipients.c_custkey)
    if few_recipients:
        s = li.join(placed, li.l_orderkey == orders.o_orderkey).join(schemes, li.l_partkey == schemes.p_partkey)
    else:
        s = li.join(schemes, li.l_partkey == schemes.p_partkey).join(placed, li.l_orderkey == orders.o_orderkey)
    amount = F.col("l_extendedprice").cast(AMOUNT_TYPE)
    null_str = F.lit(None).cast("string")
    df = s.select(
        entity_id("l_orderkey", "l_linenumber").alias("pk"),
        "country",
        (F.year("l_shipdate") + YEAR_SHIFT).cast("int").alias("year"),
        "recipient_id",
        "recipient_name",
        "recipient_fingerprint",
        "recipient_address",
        F.col("country").alias("recipient_country"),
        null_str.alias("recipient_url"),
        "scheme_id",
        "scheme",
        null_str.alias("scheme_code"),
        null_str.alias("scheme_description"),
        amount.alias("amount"),
        F.lit("EUR").alias("currency"),
        amount.alias("amount_original"),
        F.lit("EUR").alias("currency_original"),
        "nuts1",
        "nuts2",
        "nuts3",
    )
    return df.select(*PAYMENT_COLUMNS)


# ---------------------------------------------------------------------------
# raw_payments: the same line items as messy source text (F1)
# ---------------------------------------------------------------------------

# FIXED VALUES (ours): how raw text is varied, chosen by key arithmetic so
# every variant occurs at every scale.
PLACEHOLDER_NAMES = ("--", "**", "private individual")
# scheme ids written into raw scheme text (II.1 and II.10 test longest match)
RAW_SCHEME_IDS = ("II.1", "II.10", "III.3")


# FIXED VALUES (ours): names, places and schemes in the letters of some countries, for
# every fourth customer there (Ukrainian holders in RO)
LOCAL = {
    "GR": ("Αγροτικός Συνεταιρισμός Ναούσης", "Θεσσαλονίκη", "Βασική ενίσχυση"),
    "CY": ("Γεωργική Εταιρεία Ουρανός", "Λευκωσία", "Ευφυής στήριξη γης"),
    "BG": ("Иван Петров ЕООД", "Пловдив", "Схема за единно плащане"),
    "RO": ("Щастя Київ Юг", "Чернівці", "Підтримка їжі"),
    "PL": ("Łódź Żółw Spółka", "Świętochłowice", "Płatność obszarowa"),
    "DK": ("Ærø Ødegård", "Nykøbing", "Støtte til økologi"),
}


def _local(country: Column, which: int) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for c, texts in LOCAL.items() for x in (c, texts[which])]), country)


# recipients abroad and in unknown places: customer key divisor -> text
FOREIGN = {23: "CH", 29: "United States", 31: "EL", 37: "uk", 41: "Atlantis", 43: "Ελλάδα"}


def _foreign(ck: Column, country: Column) -> Column:
    out = F.when(ck % 11 == 0, F.lit(""))
    for n, text in FOREIGN.items():
        out = out.when(ck % n == 0, F.lit(text))
    return out.when(ck % 3 == 0, F.lower(country)).otherwise(country)


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text source rows, one per line item, with the defects of F1:
    decimal commas, quoted and padded cells, placeholder names with and
    without a source id, malformed and empty amounts, national currencies (no
    HUF rate for some years), lower-case country codes, blank recipient
    countries, ``1097.0`` postcodes, ``xpath`` addresses, scheme ids and
    partial scheme names, and names, places and schemes in Greek, Cyrillic, Polish
    and Danish letters. ``_row`` is the source line key."""
    s = _star(spark, sf_dir)
    ok = F.col("l_orderkey")
    ck = F.col("c_custkey")
    size = F.col("p_size")
    country = country_of(F.col("c_nationkey"))
    natl = F.element_at(
        F.create_map(*[F.lit(x) for kv in COUNTRY_CURRENCY.items() for x in kv]), country
    )
    converted = country.isin(*RATE_COUNTRIES)
    here = (ck % 4 == 3) & country.isin(*LOCAL)
    price = F.col("l_extendedprice").cast(AMOUNT_TYPE).cast("string")
    comma = F.replace(price, F.lit("."), F.lit(","))
    amount = (
        F.when(ok % 97 == 0, F.concat(F.lit("1."), comma))
        .when(ok % 89 == 0, F.lit(""))
        .when(ok % 2 == 1, comma)
        .otherwise(price)
    )
    name = (
        F.when(ck % 53 == 0, F.lit(PLACEHOLDER_NAMES[0]))
        .when(ck % 59 == 0, F.lit(PLACEHOLDER_NAMES[1]))
        .when(ck % 61 == 0, F.lit(PLACEHOLDER_NAMES[2]))
        .when(here, F.concat(_local(country, 0), F.lit(" "), ck.cast("string")))
        .when(ck % 7 == 0, F.concat(F.lit('" '), F.col("c_name"), F.lit('  ",')))
        .when(ck % 5 == 0, F.replace(F.col("c_name"), F.lit("#"), F.lit("  #  ")))
        .otherwise(F.col("c_name"))
    )
    postcode = (F.lit(1000) + ck % 900).cast("string")
    street_no = (ck % 100).cast("string")
    scheme_ids = F.array(*[F.lit(i) for i in RAW_SCHEME_IDS])
    scheme = (
        F.when(size < MIN_SCHEME_SIZE, F.lit(""))
        .when(size % 5 == 0, F.concat(F.element_at(scheme_ids, (size % 3 + 1).cast("int")), F.lit(" "), F.col("p_type")))
        .when(size % 5 == 1, F.lower(F.col("p_type")))
        .when(here & (size % 5 == 2), _local(country, 2))
        .otherwise(F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand")))
    )
    return s.select(
        F.when(ck % 19 == 0, F.lower(country)).otherwise(country).alias("country"),
        (F.year("l_shipdate") + YEAR_SHIFT).cast("string").alias("year"),
        name.alias("recipient_name"),
        F.when(ck % 2 == 0, ck.cast("string")).alias("recipient_id"),
        F.when(ck % 17 == 0, F.concat(F.lit("xpath /a data='Street "), street_no, F.lit("'")))
        .otherwise(F.concat(F.lit("Street "), street_no))
        .alias("recipient_street"),
        F.when(here, _local(country, 1)).otherwise(F.col("c_mktsegment")).alias("recipient_location"),
        F.when(ck % 13 == 0, F.concat(postcode, F.lit(".0"))).otherwise(postcode).alias("recipient_postcode"),
        _foreign(ck, country).alias("recipient_country"),
        scheme.alias("scheme"),
        amount.alias("amount"),
        F.when(ok % 101 == 0, F.lit("XXX")).when(converted, natl).otherwise(F.lit("EUR")).alias("currency"),
        (ok * 100 + F.col("l_linenumber")).cast("long").alias("_row"),
    )


def _has_rates(country: str) -> bool:
    cur = COUNTRY_CURRENCY.get(country)
    return any(k.startswith(f"{cur}|") for k in CURRENCY_RATES)


# served countries whose payments are reported in their national currency
RATE_COUNTRIES = tuple(c for c in NATION_COUNTRY if _has_rates(c))
