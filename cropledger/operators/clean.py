"""Whole cleaning pipeline (T22): raw text rows → payments table rows.

Order (it matters): drop repeated headers (U2) → fill year/country/currency
from options (S5) → check required columns (V1) → trim cells (T1) and take
column alternatives (T3) → country code (J7) → recipient name (T6) and
fingerprint (T5) → amount in EUR with the original kept (T13, J1, T14) →
recipient country (T9) → address (T7, T8) → recipient id (T16) → scheme
(T10, J3, J4) and scheme code (T19) → scheme id (T17) → payment key (T18) →
region codes (J2) → de-duplication by key (W1) → final shape (T20).

Everything is a column expression over the whole input, so the plan is one
scan, one projection pipeline in whole-stage codegen, an optional geocode
join, and one aggregation by ``pk`` for de-duplication. Data errors never
fail the job: each row carries ``errors array<struct<code, value>>`` (V2) and
rows that break a domain or not-null rule go to a quarantine output (V3).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cropledger.dims import COUNTRIES, CURRENCIES, SCHEMES
from cropledger.errors import ERR_AMOUNT, ERR_COUNTRY, ERR_CURRENCY, ERR_SOURCE, InvalidSource
from cropledger.functions import (
    collapse_spaces,
    entity_id,
    fingerprint,
    has_fingerprint,
    null_token,
    pack_ids,
    parse_amount,
    scheme_id,
    to_amount,
    trim_cell,
    unpack_ids,
    usable,
)
from cropledger.operators.lookups import (
    country_code,
    country_name,
    guess_scheme,
    match_schemes,
    national_currency,
    rate_to_eur,
    with_geocode,
)
from cropledger.schema import PAYMENT_COLUMNS, RAW_COLUMNS, TOO_LONG_COL, YEAR_MAX, YEAR_MIN
from cropledger.session import compiled_methods, shuffles_dropped

# FIXED VALUES: required column groups (V1): any one of each group must exist
REQUIRED_COLUMNS = (
    ("recipient_name", "denumire_beneficiar"),
    ("recipient_country", "country"),
    ("amount", "cuantum"),
    ("currency",),
    ("year",),
)

# FIXED VALUES: column alternatives (T3): first usable value wins
ALTERNATIVES = (
    ("recipient_name", "denumire_beneficiar"),
    ("recipient_id", "cod_unic"),
    ("recipient_location", "localitate"),
    ("scheme", "masura"),
    ("amount", "cuantum"),
)

# FIXED VALUES: the columns an address is made of
ADDRESS_PARTS = (
    "recipient_street",
    "recipient_street1",
    "recipient_street2",
    "recipient_location",
    "recipient_postcode",
    "recipient_county",
    "recipient_country",
)

# where a row stands: its file, the file's part it was read from, its number there
FILE_COL = "_file"
BLOCK_COL = "_block"
ROW_COL = "_row"
ERRORS_COL = "errors"
ANON_COL = "_anon"


@dataclass(frozen=True)
class Lookups:
    """Tables of a deployment; None takes the built-in one.

    ``countries``: (code, name, other names); ``rates``: ``CUR|year`` → rate;
    ``schemes``: (id, article, name, description), or a DataFrame of any size
    (``lookups.match_schemes``); ``regions``: known region codes
    (None: any).
    """

    countries: tuple | None = None
    rates: dict | None = None
    schemes: tuple | DataFrame | None = None
    regions: frozenset | None = None


@dataclass
class CleanResult:
    """Outputs of one cleaning plan, all lazy. ``every`` holds every source row with its
    ``errors`` and what orders equal keys, rows with too many cells marked; all outputs
    come from it. ``staged`` first writes it, so that several outputs clean once and only
    rows whose key may come again are shuffled whole."""

    every: DataFrame
    missing_columns: list[tuple[str, ...]]
    stored: bool = False

    def staged(self, path: str, columns: list[str] | None = None) -> CleanResult:
        """The same outputs from ``every`` as a table at ``path`` (replaced if it is there),
        of the payment columns all of them, or only ``columns``."""
        spark, every = self.every.sparkSession, self.every
        if columns is not None:
            every = every.select(*(c for c in every.columns if c not in PAYMENT_COLUMNS or c in columns or c == "pk"))
        with shuffles_dropped(spark):
            every.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return CleanResult(spark.read.schema(every.schema).parquet(path), self.missing_columns, stored=True)

    @property
    def rows(self) -> DataFrame:
        """Every source row, cleaned."""
        return self.every.where(~F.col(TOO_LONG_COL)).drop(TOO_LONG_COL, ANON_COL)

    @property
    def skipped(self) -> DataFrame:
        """Rows with too many cells, counted by file."""
        return self.every.where(TOO_LONG_COL).groupBy(FILE_COL).agg(F.count(F.lit(1)).alias("rows"))

    @property
    def cleaned(self) -> DataFrame:
        """The first row of each payment key by file and place, equal places by content."""
        rows = self.every.where(~F.col(TOO_LONG_COL)).drop(TOO_LONG_COL)
        first = dedup_stored if self.stored else dedup_first
        return first(rows, "pk", [FILE_COL, BLOCK_COL, ROW_COL, ANON_COL]).drop(ANON_COL)

    @property
    def payments(self) -> DataFrame:
        return self.cleaned.filter(F.col("_valid")).select(*(c for c in PAYMENT_COLUMNS if c in self.every.columns))

    @property
    def quarantine(self) -> DataFrame:
        return self.cleaned.filter(~F.col("_valid")).drop("_valid")

    @property
    def errors(self) -> DataFrame:
        """V2: distinct error messages per file with their row counts, counted before
        rows are de-duplicated, plus one ``InvalidSource`` line per missing required
        column group (V1)."""
        # equal lists are counted first: few rows are left to take apart
        lists = self.rows.groupBy(FILE_COL, ERRORS_COL).agg(F.count(F.lit(1)).alias("n"))
        e = lists.select(FILE_COL, "n", F.explode(ERRORS_COL).alias("e"))
        rows = e.groupBy(FILE_COL, F.col("e.code").alias("code"), F.col("e.value").alias("value")).agg(F.sum("n").alias("rows"))
        if not self.missing_columns:
            return rows
        spark = self.every.sparkSession
        missing = spark.createDataFrame(
            [(None, ERR_SOURCE, f"needs one of {', '.join(group)}", 0) for group in self.missing_columns],
            rows.schema,
        )
        return rows.unionByName(missing)


def _opt(value) -> Column:
    """An option value: a literal, or a per-row Column (file-name context)."""
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


ERROR_TYPE = "array<struct<code:string,value:string>>"


def _err(cond: Column, code: str, value: Column) -> Column:
    """A one-element error array when ``cond`` holds, else an empty one; the
    row's errors are the ``concat`` of these (no lambda, stays codegen'd)."""
    entry = F.array(F.struct(F.lit(code).alias("code"), value.cast("string").alias("value")))
    return F.when(F.coalesce(cond, F.lit(False)), entry).otherwise(F.array().cast(ERROR_TYPE))


def check_source(columns: list[str], year=None, country=None) -> list[tuple[str, ...]]:
    """V1: a missing year or country (with no option to fill it) rejects the
    whole source; other missing column groups are only reported."""
    if "year" not in columns and year is None:
        raise InvalidSource("the source says no year")
    if "country" not in columns and country is None:
        raise InvalidSource("the source says no country")
    present = set(columns) | ({"year"} if year is not None else set()) | ({"country"} if country is not None else set())
    return [group for group in REQUIRED_COLUMNS if not present & set(group)]


def clean(
    raw: DataFrame,
    year: int | str | Column | None = None,
    country: str | Column | None = None,
    currency: str | Column | None = None,
    geocode: DataFrame | None = None,
    legacy_address_strip: bool = False,
    lookups: Lookups | None = None,
) -> CleanResult:
    """Clean raw all-text rows (F1) into payments rows (F2).

    ``raw`` may carry ``_file`` (source path), ``_block`` and ``_row`` (numbers that
    place the row in its file). They give the de-duplication order; ids of nameless
    rows come from the place in the file and the row's cells, so the same file gives
    the same ids wherever it lies and whatever is read with it.
    """
    lookups = lookups or Lookups()
    compiled_methods(raw.sparkSession)
    present = list(raw.columns)
    missing = check_source(present, year, country)
    has_currency_col = "currency" in present
    has_rcountry_col = "recipient_country" in present
    has_code_short = "scheme_code_short" in present

    # one projection: raw columns as text (absent ones null), S3 null tokens
    null = F.lit(None).cast("string")
    text_cols = list(RAW_COLUMNS)
    known = set(text_cols) | {FILE_COL, BLOCK_COL, ROW_COL, TOO_LONG_COL}
    number = F.lit(None).cast("long")
    too_long = F.coalesce(F.col(TOO_LONG_COL), F.lit(False)) if TOO_LONG_COL in present else F.lit(False)
    df = raw.select(
        *[(F.col(c).cast("string") if c in present else null).alias(c) for c in text_cols],
        too_long.alias(TOO_LONG_COL),
        (F.col(FILE_COL).cast("string") if FILE_COL in present else null).alias(FILE_COL),
        *[(F.col(c).try_cast("long") if c in present else number).alias(c) for c in (BLOCK_COL, ROW_COL)],
        *[F.col(f"`{c}`") for c in present if c not in known],  # e.g. file-name context for options
    )
    df = df.withColumns({c: null_token(c) for c in text_cols if c in present})

    # Repeated header lines inside the data
    df = df.filter(
        F.col(TOO_LONG_COL)
        | (~F.col("recipient_name").eqNullSafe("recipient_name") & ~F.col("denumire_beneficiar").eqNullSafe("denumire_beneficiar"))
    )

    # T1 trim every cell, blanks → null
    df = df.withColumns({c: F.nullif(trim_cell(c), F.lit("")) for c in text_cols})

    # S5 fill from options; S7 currency override only fills a missing column
    fills = {}
    if year is not None:
        fills["year"] = F.coalesce(F.col("year"), _opt(year))
    if country is not None:
        fills["country"] = F.coalesce(F.col("country"), _opt(country))
    if currency is not None:
        if not has_currency_col:
            fills["currency"] = _opt(currency)
        elif "_no_currency" in present:  # files of several headers: those without the column
            fills["currency"] = F.when(F.col("_no_currency"), _opt(currency)).otherwise(F.col("currency"))
    if fills:
        df = df.withColumns(fills)

    # T3 alternatives; stable anonymous key (H3) over the raw row
    alt = {group[0]: F.coalesce(*[F.when(usable(c), F.col(c)) for c in group]) for group in ALTERNATIVES}
    place = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (BLOCK_COL, ROW_COL)]
    anon_key = F.sha1(F.concat_ws("\u001f", *place, *[F.coalesce(F.col(c), F.lit("")) for c in text_cols]))
    df = df.withColumn(ANON_COL, anon_key).withColumns(alt)

    # J7 payment country
    cc = country_code(F.col("country"), lookups.countries)
    df = df.withColumns({"_country_raw": F.col("country"), "country": cc})

    # T6 name, T5 fingerprint
    ident = F.col("recipient_id")
    name = (
        F.when(F.col("recipient_name").isNotNull(), collapse_spaces("recipient_name"))  # usable values are left (T3)
        .when(ident.isNotNull(), F.concat_ws(" ", F.col("country"), ident))
        .otherwise(F.concat(F.lit("Anonymous "), F.substring(F.col(ANON_COL), 1, 22)))
    )
    df = df.withColumn("recipient_name", name).withColumn("recipient_fingerprint", fingerprint("recipient_name"))

    # T13 / J1 / T14 amount in EUR, original kept
    yr = F.col("year").try_cast("int")
    cur_orig = F.col("currency") if (has_currency_col or currency is not None) else F.lit(None).cast("string")
    natl = national_currency(F.col("country"))
    eff_cur = F.coalesce(cur_orig, natl)
    parsed = parse_amount(F.col("amount"))
    rate = rate_to_eur(natl, yr, lookups.rates)
    is_eur = eff_cur == "EUR"
    converted = F.when(is_eur, parsed).otherwise(parsed * rate)
    df = df.withColumns(
        {
            "year": yr,
            "amount_original": to_amount(parsed),
            "currency_original": cur_orig,
            "amount": to_amount(converted),
            "currency": F.lit("EUR"),
            "_amount_text": F.col("amount"),
            "_natl": natl,
            "_rate": rate,
            "_eff_cur": eff_cur,
        }
    )

    # T9 recipient country (blank falls back to the payment country)
    rc_raw = F.col("recipient_country")
    if has_rcountry_col:
        rc = F.when(rc_raw.isNull(), F.col("country")).otherwise(country_code(rc_raw, lookups.countries))
    else:
        rc = F.col("country")
    df = df.withColumns({"_rcountry_raw": rc_raw, "recipient_country": rc})

    # T7 / T8 address
    df = with_address(df, "recipient_address", "recipient_address", ADDRESS_PARTS, "recipient_country", legacy_address_strip, lookups.countries)

    # T16 recipient id
    addr_fp = F.coalesce(fingerprint("recipient_address"), F.col(ANON_COL))
    df = df.withColumn("recipient_id", entity_id("recipient_country", "recipient_fingerprint", addr_fp))

    # T10 scheme text and match, T19 scheme code, T17 scheme id
    joined = F.nullif(F.trim(F.concat_ws(" ", "scheme_name", "scheme_1", "scheme_2")), F.lit(""))
    df = df.withColumn("_scheme", F.coalesce(F.col("scheme"), F.when(has_fingerprint(joined), joined)))
    df = df.withColumn("scheme", collapse_spaces("_scheme"))
    if isinstance(lookups.schemes, DataFrame):
        df = match_schemes(df, "scheme", lookups.schemes, "scheme")
    else:
        df = df.withColumn("scheme", guess_scheme(F.col("scheme"), lookups.schemes or SCHEMES))
    df = df.withColumn("scheme_code", F.col("scheme_code_short") if has_code_short else F.lit(None).cast("string"))
    df = df.withColumn("scheme_id", scheme_id("scheme"))

    # T18 payment key
    df = df.withColumn(
        "pk", entity_id(F.col("year"), "country", "recipient_id", "scheme_id", F.col("amount"))
    )

    # V2 errors (reads the saved inputs: ``currency`` is already "EUR" here)
    is_eur = F.col("_eff_cur") == "EUR"
    errors = F.concat(
        _err(F.col("country").isNull(), ERR_COUNTRY, F.col("_country_raw")),
        _err(F.col("_rcountry_raw").isNotNull() & F.col("recipient_country").isNull(), ERR_COUNTRY, F.col("_rcountry_raw"))
        if has_rcountry_col
        else F.array().cast(ERROR_TYPE),
        _err(~F.coalesce(F.col("_eff_cur").isin(*CURRENCIES), F.lit(False)), ERR_CURRENCY, F.col("_eff_cur")),
        _err(F.col("amount_original").isNull(), ERR_AMOUNT, F.col("_amount_text")),
        _err(
            F.col("amount_original").isNotNull() & ~is_eur & F.col("_natl").isNull() & F.col("country").isNotNull(),
            ERR_COUNTRY,
            F.col("country"),
        ),
        _err(
            F.col("amount_original").isNotNull() & ~is_eur & F.col("_natl").isNotNull() & F.col("_rate").isNull(),
            ERR_CURRENCY,
            F.concat(F.lit("No currency conversion for `"), F.col("_natl"), F.lit("|"), F.col("year").cast("string"), F.lit("`")),
        ),
    )
    df = df.withColumn(ERRORS_COL, errors)

    # J2 region codes
    df = with_geocode(df, geocode)

    # V3 domain / not-null rules; the served list binds the payment country only. The recipient's id and
    # the payment's are there wherever the row's own key is, which stands in for an address (T16): who
    # asks for the rules alone needs no hashes
    valid = (
        F.col(ANON_COL).isNotNull()
        & F.col("country").isin(*[c for c, _n, _x in COUNTRIES])
        & F.col("year").between(YEAR_MIN, YEAR_MAX)
        & F.col("recipient_country").isNotNull()
        & (F.col("currency_original").isNull() | F.col("currency_original").isin(*CURRENCIES))
    )
    if lookups.regions is not None:
        for c in ("nuts1", "nuts2", "nuts3"):
            valid = valid & (F.col(c).isNull() | F.col(c).isin(*sorted(lookups.regions)))
    df = df.withColumn("_valid", F.coalesce(valid, F.lit(False)))

    # the key's bytes are in the order of its digits, and half as long
    df = df.withColumn(ANON_COL, F.unhex(ANON_COL))
    out_cols = PAYMENT_COLUMNS + [FILE_COL, BLOCK_COL, ROW_COL, ERRORS_COL, "_valid", ANON_COL, TOO_LONG_COL]
    return CleanResult(df.select(*out_cols), missing)


def with_address(df: DataFrame, out: str, full: str | None, parts, cc: str, legacy: bool = False, countries=None) -> DataFrame:
    """Column ``out``: the address parts not already contained in the column
    ``full`` joined to it with ``, ``; a trailing ``, CC`` stripped (``legacy`` strips the
    character set of ``", " + CC`` instead); empty or the code alone → country
    name; ``1097.0`` → ``1097``; text inside ``data='…'`` when the value is an
    xpath dump. Every step is a column that the next one reads, so no expression is
    written out more than once."""
    whole = F.nullif(F.trim(F.col(full)), F.lit("")) if full else F.lit(None).cast("string")
    names = [f"_part{i}" for i in range(len(parts))]
    df = df.withColumns({"_full": whole} | {n: F.nullif(F.trim(F.col(p)), F.lit("")) for n, p in zip(names, parts)})
    extra = [F.when(~F.coalesce(F.col("_full").contains(F.col(n)), F.lit(False)), F.col(n)) for n in names]
    df = df.withColumn("_address", F.concat_ws(", ", "_full", *extra))
    code = F.col(cc)
    if legacy:
        stripped = F.rtrim("_address", F.concat(F.lit(", "), F.coalesce(code, F.lit(""))))
    else:
        suffix = F.concat(F.lit(", "), code)
        cut = F.substring("_address", F.lit(1), F.length("_address") - F.length(code) - 2)
        stripped = F.rtrim(F.when(F.endswith("_address", suffix), cut).otherwise(F.col("_address")), F.lit(", "))
    df = df.withColumn("_address", stripped)
    # the code alone says no more than the country
    told = has_fingerprint("_address") & ~F.col("_address").eqNullSafe(code)
    df = df.withColumn("_address", F.when(told, F.col("_address")).otherwise(country_name(code, countries)))
    plain = F.when(F.col("_address").contains("."), F.regexp_replace("_address", r"(\s\d+)\.\d", "$1")).otherwise(F.col("_address"))
    df = df.withColumn("_address", plain)
    dump = F.nullif(F.when(F.col("_address").contains("xpath"), F.regexp_extract("_address", r".*data='([\w.\s]+)'", 1)), F.lit(""))
    return df.withColumn(out, F.coalesce(dump, F.col("_address"))).drop("_full", "_address", *names)


def dedup_first(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The first row of each ``key`` by ``order`` (nulls first). Spark keeps the
    first row per key of every task before the shuffle, so a key that holds a third
    of all rows sends one row per task; only the key and the order are compared. Ids that
    don't order rows go packed."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return unpack_ids(pack_ids(df, but=order).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank"), but=order)


#: Bits of the map of repeated keys (16 MB, broadcast, however many keys there are), and of its rows.
KEY_BITS, _BUCKET = 1 << 27, 32768


def dedup_stored(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """``dedup_first`` of a stored table, which is read three times. The hashes of all keys are
    counted first, and a bitmap of those that come more than once tells the other rows,
    which stay where they are; only rows of its slots are shuffled and compared. Hashes
    or slots that meet, or a full bitmap, send more rows and change no result."""
    keys = [key] if isinstance(key, str) else key
    hashed = F.xxhash64(*keys)
    counted = df.select(hashed.alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slot = F.pmod(F.col("h"), F.lit(KEY_BITS))
    bitmap = counted.groupBy(F.floor(slot / _BUCKET).alias("_bucket")).agg(F.bitmap_construct_agg(F.pmod(slot, F.lit(_BUCKET))).alias("_bitmap"))
    own = F.pmod(hashed, F.lit(KEY_BITS))
    rows = df.withColumns({"_bucket": F.floor(own / _BUCKET), "_bit": F.pmod(own, F.lit(_BUCKET)).cast("int")}).join(F.broadcast(bitmap), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("_bitmap", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    again = F.coalesce(F.getbit(byte, F.pmod("_bit", F.lit(8))) == 1, F.lit(False))
    alone, some = (rows.where(test).select(*df.columns) for test in (~again, again))
    return alone.unionByName(dedup_first(some, keys, order))
