"""Payments table schema and domains (F2, V3)."""

from pyspark.sql import types as T

AMOUNT_TYPE = T.DecimalType(18, 2)
# sum(decimal(18,2)) in Spark is decimal(28,2); we keep that width so totals
# over hundreds of billions of rows cannot overflow.
SUM_TYPE = T.DecimalType(28, 2)

PAYMENT_FIELDS = [
    ("pk", T.StringType(), False),
    ("country", T.StringType(), False),
    ("year", T.IntegerType(), False),
    ("recipient_id", T.StringType(), False),
    ("recipient_name", T.StringType(), True),
    ("recipient_fingerprint", T.StringType(), True),
    ("recipient_address", T.StringType(), True),
    ("recipient_country", T.StringType(), False),
    ("recipient_url", T.StringType(), True),
    ("scheme_id", T.StringType(), True),
    ("scheme", T.StringType(), True),
    ("scheme_code", T.StringType(), True),
    ("scheme_description", T.StringType(), True),
    ("amount", AMOUNT_TYPE, True),
    ("currency", T.StringType(), True),
    ("amount_original", AMOUNT_TYPE, True),
    ("currency_original", T.StringType(), True),
    ("nuts1", T.StringType(), True),
    ("nuts2", T.StringType(), True),
    ("nuts3", T.StringType(), True),
]

PAYMENT_COLUMNS = [name for name, _, _ in PAYMENT_FIELDS]

# Parquet does not keep non-null flags through every writer, so the stored
# schema is all-nullable; not-null is a data-quality check (V3).
PAYMENTS_SCHEMA = T.StructType(
    [T.StructField(name, dtype, True) for name, dtype, _ in PAYMENT_FIELDS]
)

NOT_NULL_COLUMNS = [name for name, _, nullable in PAYMENT_FIELDS if not nullable]

PARTITION_COLUMNS = ["country", "year"]

YEAR_MIN, YEAR_MAX = 2000, 2029

# marks source rows with more cells than their header
TOO_LONG_COL = "_too_long"

# Raw source columns every file may carry (F1); all read as text.
RAW_COLUMNS = [
    "country",
    "year",
    "recipient_name",
    "denumire_beneficiar",
    "recipient_id",
    "cod_unic",
    "recipient_address",
    "recipient_street",
    "recipient_street1",
    "recipient_street2",
    "recipient_location",
    "localitate",
    "recipient_postcode",
    "recipient_county",
    "recipient_country",
    "recipient_url",
    "scheme",
    "masura",
    "scheme_name",
    "scheme_1",
    "scheme_2",
    "scheme_code",
    "scheme_code_short",
    "scheme_description",
    "amount",
    "cuantum",
    "currency",
]
