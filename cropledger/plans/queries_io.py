"""Registered source and sink queries (S1-S17). Files go to a fresh folder
under the session's shared checkpoint folder for every run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cropledger.dims import COUNTRIES, CURRENCIES
from cropledger.errors import InvalidQuery, InvalidRows
from cropledger.operators import summaries as S
from cropledger.operators.clean import clean
from cropledger.operators.load import clean_files
from cropledger.plans import oracle as O
from cropledger.plans import oracle_clean as OC
from cropledger.plans import views as V
from cropledger.plans.registry import present, register
from cropledger.plans.testdata import payments, raw_payments
from cropledger.schema import PAYMENT_COLUMNS
from cropledger.session import ensure_checkpoint_dir, shuffles_dropped
from cropledger.sources import export as X
from cropledger.sources import store
from cropledger.sources.csv_source import list_files, read_sources, remove_path
from cropledger.streaming.ingest import ingest_new_files


def scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_RAW_COLS = [c for c in OC.RAW_PRESENT] + ["_row"]


@register(
    "csv_roundtrip",
    f"WITH {OC.raw_payments_cte()}\nSELECT " + ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in _RAW_COLS) + " FROM raw",
)
def csv_roundtrip(spark, sf_dir):
    """S1 + S11: raw rows written as gzip CSV (quotes, commas, decimal
    commas inside cells) and read back as text by the header-grouped reader."""
    path = scratch(spark, "roundtrip")
    X.write_csv(raw_payments(spark, sf_dir), path)
    rows = read_sources(spark, path).rows
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in _RAW_COLS])


_EXPORT_SQL = O.with_payments(
    "SELECT country, "
    + "coalesce(array_to_string(list_sort(list_transform(array_agg(DISTINCT year) FILTER (WHERE year IS NOT NULL), "
    "lambda v: CAST(v AS VARCHAR))), ';'), '') AS years, "
    "CAST(count(*) AS VARCHAR) AS total_payments, CAST(count(DISTINCT recipient_id) AS VARCHAR) AS total_recipients, "
    "CAST(CAST(sum(amount) AS DECIMAL(28,2)) AS VARCHAR) AS amount_sum, "
    f"CAST({O.avg_sql('amount')} AS VARCHAR) AS amount_avg, "
    "CAST(max(amount) AS VARCHAR) AS amount_max, CAST(min(amount) AS VARCHAR) AS amount_min "
    "FROM payments GROUP BY country"
)


@register("export_csv", _EXPORT_SQL)
def export_csv(spark, sf_dir):
    """Summary exported with list cells sorted and joined by ';', read
    back as text."""
    path = scratch(spark, "export")
    X.write_export(S.CountryQuery(payments(spark, sf_dir)).to_df(), path)
    return X.read_csv_text(spark, path)


_STATEMENTS_SQL = " UNION ALL ".join(
    [
        f"SELECT recipient_id AS id, 'LegalEntity' AS schema, {O.q(p)} AS prop, CAST({c} AS VARCHAR) AS value FROM payments"
        for p, c in X.LEGAL_ENTITY_PROPS.items()
    ]
    + [
        f"SELECT pk AS id, 'Payment' AS schema, {O.q(p)} AS prop, CAST({c} AS VARCHAR) AS value FROM payments"
        for p, c in X.PAYMENT_PROPS.items()
    ]
    + [f"SELECT pk AS id, 'Payment' AS schema, 'programme' AS prop, {O.q(X.PROGRAMME)} AS value FROM payments"]
)


@register(
    "entity_graph",
    O.with_payments(
        "SELECT id, schema, prop, string_agg(DISTINCT value, ';' ORDER BY value) AS value_list FROM ("
        + _STATEMENTS_SQL
        + ") s WHERE value IS NOT NULL AND id IS NOT NULL GROUP BY id, schema, prop"
    ),
)
def entity_graph(spark, sf_dir):
    """LegalEntity and Payment nodes with merged multi-valued
    properties, one row per (entity, property)."""
    g = X.entity_graph(payments(spark, sf_dir))
    e = g.select("id", "schema", F.explode("properties").alias("prop", "values"))
    return e.select("id", "schema", "prop", F.array_join("values", ";").alias("value_list"))


#: Statements by name, each of one ``key`` and one ``total``; the oracle runs them as they are.
_STATEMENTS = {
    "lines and semicolon": "select concat_ws('-', country, year) AS key, CAST(sum(amount) AS DECIMAL(28,2)) AS total\n"
    "from payments where amount > 50000 group by country, year;",
    "cte and subquery": "with big as (select * from payments where amount > 90000), few as (select country from big group by country having count(*) > 2) "
    "select country AS key, max(amount) AS total from payments where country in (select country from few) group by country",
    "window": "select key, total from (select recipient_id AS key, amount AS total, row_number() over (partition by country order by amount desc, pk) AS r "
    "from payments) t where r = 1",
    "join and case": "select a.country AS key, sum(case when a.year = b.year then a.amount else 0 end) AS total from payments a "
    "join (select country, min(year) AS year from payments group by country) b on a.country = b.country group by a.country",
    "closing quote": "select country AS key, min(amount) AS total from payments group by country having country = 'DE'",
}
#: Statements that must be refused: other relations, paths, commands, calls out of SQL.
_REFUSED = {
    "file": "select value AS key, 1 AS total from payments join text.`/etc/hostname`",
    "java call": "select reflect('java.lang.System', 'getProperty', 'user.home') AS key, 1 AS total from payments",
    "file in subquery": "select pk AS key, 1 AS total from payments where pk in (select value from csv.`/etc/passwd`)",
    "other table": "select key, total from customers, payments",
    "hidden by a cte": "with payments as (select * from customers) select key, total from payments",
    "cte out of scope": "select key, total from (with inner_one as (select * from payments) select * from inner_one), inner_one",
    "table function": "select id AS key, 1 AS total from range(10), payments",
    "name at run time": "select key, total from identifier('payments'), payments",
    "no table": "select 1 AS key, 1 AS total",
    "two statements": "select pk AS key, amount AS total from payments; drop table payments",
    "drop": "drop table payments",
    "insert": "insert into payments select * from payments",
}


@register(
    "sql_guarded",
    O.with_payments(
        " UNION ALL ".join(
            f"SELECT {O.q(name)} AS statement, true AS accepted, CAST(key AS VARCHAR) AS key, {O.num('CAST(total AS DECIMAL(28,2))')} AS total FROM ({sql.rstrip(';')}) t"
            for name, sql in _STATEMENTS.items()
        )
        + "".join(f" UNION ALL SELECT {O.q(name)}, false, NULL, NULL" for name in _REFUSED)
    ),
)
def sql_guarded(spark, sf_dir):
    """Statements over the payments view with their results, and statements that
    the guard refuses, each a row without one."""
    p = payments(spark, sf_dir)
    out = None
    for name, sql in (_STATEMENTS | _REFUSED).items():
        try:
            found = X.run_sql(spark, p, sql).select(F.col("key").cast("string").alias("key"), F.col("total").cast("decimal(28,2)").alias("total"))
            rows = found.select(F.lit(name).alias("statement"), F.lit(True).alias("accepted"), "key", "total")
        except InvalidQuery:
            rows = spark.range(1).select(F.lit(name).alias("statement"), F.lit(False).alias("accepted"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("decimal(28,2)").alias("total"))
        out = rows if out is None else out.union(rows)
    return present(out)


_UPSERT_COLS = [c for c in PAYMENT_COLUMNS]
_NEW_AMOUNT = "CAST(amount + 1 AS DECIMAL(18,2))"


def _sel(amount_expr: str) -> str:
    out = []
    for c in _UPSERT_COLS:
        if c == "amount":
            out.append(f"{O.num(amount_expr)} AS amount")
        elif c == "amount_original":
            out.append(f"{O.num('amount_original')} AS amount_original")
        else:
            out.append(c)
    return ", ".join(out)


_KEY = ["country", "year", "recipient_id", "pk"]
_REST = [c for c in _UPSERT_COLS if c not in _KEY]


@register(
    "upsert",
    O.with_payments(
        f"SELECT {_sel('amount')} FROM payments WHERE year < 2013 UNION ALL "
        f"SELECT {_sel('amount')} FROM (SELECT * REPLACE ({_NEW_AMOUNT} AS amount), row_number() OVER ("
        f"PARTITION BY {', '.join(_KEY)} ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in ["country", "year", "recipient_id"] + _REST)
        + ") AS rn FROM payments WHERE year >= 2013) WHERE rn = 1"
    ),
)
def upsert_q(spark, sf_dir):
    """S8 + S9 + S10: create the table, insert the years up to 2013, then
    upsert changed amounts for 2013 onwards; new rows win per key, untouched
    partitions keep their rows."""
    p = payments(spark, sf_dir)
    path = scratch(spark, "table")
    store.init_table(spark, path)
    store.insert(p.filter(F.col("year") <= 2013), path)
    changed = p.filter(F.col("year") >= 2013).withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    store.upsert(spark, changed, path)
    return present(store.read_table(spark, path))


@register(
    "incremental_ingest",
    OC.clean_sql(
        "SELECT country, year, count(*) AS payments, "
        + O.num("CAST(sum(amount) AS DECIMAL(28,2))")
        + " AS amount_sum FROM cleaned WHERE _valid GROUP BY country, year"
    ),
)
def incremental_ingest(spark, sf_dir):
    """Two deliveries of source files, the second with its columns in another
    order; each run cleans and upserts only the files it has not seen, then the
    table is summarised. A third run finds nothing."""
    raw = raw_payments(spark, sf_dir)
    src, table, ckpt = scratch(spark, "incoming"), scratch(spark, "ingested"), scratch(spark, "ingest-ckpt")
    year = F.col("year").cast("int")
    X.write_csv(raw.filter(year < 2013), f"{src}/batch1", mode="overwrite")
    ingest_new_files(spark, src, table, checkpoint=ckpt)
    X.write_csv(raw.filter(year >= 2013).select(*reversed(raw.columns)), f"{src}/batch2", mode="overwrite")
    ingest_new_files(spark, src, table, checkpoint=ckpt)
    if ingest_new_files(spark, src, table, checkpoint=ckpt)["batches"]:
        raise ValueError("files were read twice")
    t = store.read_table(spark, table)
    return present(
        t.groupBy("country", "year").agg(
            F.count(F.lit(1)).alias("payments"), F.sum("amount").cast("decimal(28,2)").alias("amount_sum")
        )
    )


# ---------------------------------------------------------------------------
# Files as they come
# ---------------------------------------------------------------------------

_LINE_HEADER = "recipient_name,recipient_street,amount,currency,country,year"
_STREET = "CASE WHEN c_custkey % 10 = 4 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Upper' || chr(10) || 'Lower ' || c_custkey WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Plain ' || c_custkey END"


def _lines(spark, sf_dir):
    """Source lines of the customers: quoted line breaks, null tokens, short rows, rows
    that are too long, and a header line in every part (more than one in some)."""
    ck = F.col("c_custkey")
    street = (
        F.when(ck % 3 == 0, F.concat(F.lit('"Upper\nLower '), ck, F.lit('"')))
        .when(ck % 7 == 0, F.lit("NULL"))
        .otherwise(F.concat(F.lit("Plain "), ck))
    )
    full = F.concat_ws(",", "c_name", street, ck.cast("string"), F.lit("EUR"), F.lit("DE"), F.lit("2015"))
    line = F.when(ck % 10 == 3, F.concat(full, F.lit(",beyond"))).when(ck % 10 == 4, F.col("c_name")).otherwise(full)
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.pmod(ck, F.lit(8)).alias("part"), F.lit(1).alias("kind"), line.alias("value"))
    heads = spark.range(8).select(F.col("id").alias("part"), F.lit(0).alias("kind"), F.lit(_LINE_HEADER).alias("value"))
    return rows.unionByName(heads).repartition(8, "part").sortWithinPartitions("kind").select("value")


@register(
    "csv_lines",
    f"SELECT c_name AS recipient_name, {_STREET} AS recipient_address, "
    "CASE WHEN c_custkey % 10 <> 4 THEN CAST(c_custkey AS DOUBLE) END AS amount FROM customer WHERE c_custkey % 10 <> 3 "
    "UNION ALL SELECT 'rows too long', CAST(NULL AS VARCHAR), CAST(count(*) AS DOUBLE) FROM customer WHERE c_custkey % 10 = 3",
)
def csv_lines(spark, sf_dir):
    """Line breaks in cells, null tokens, short and long rows, repeated
    headers; a missing country and year of short rows come from the caller."""
    path = scratch(spark, "lines")
    _lines(spark, sf_dir).write.text(path)
    result, src = clean_files(spark, path, year=2015, country="DE")
    street = F.when(F.col("recipient_address") != "Germany", F.col("recipient_address"))
    rows = result.payments.select("recipient_name", street.alias("recipient_address"), F.col("amount_original").cast("double").alias("amount"))
    long = src.skipped.agg(F.sum("rows").cast("double").alias("amount"))
    return rows.union(long.select(F.lit("rows too long"), F.lit(None).cast("string"), "amount"))


#: country, year, file name and columns of files that say little about themselves
_FILES = (
    ("DK", 2013, "dk_2013.csv", ("recipient_name", "recipient_street", "amount", "currency", "scheme_code_short")),
    ("PL", 2015, "pl_Subsidies_2015.csv", ("denumire_beneficiar", "localitate", "cuantum", "masura")),
    ("LT", 2015, "lt_2015.csv", ("amount", "recipient_name", "recipient_street")),
)


def _named_files(spark, df, folder: str, name: str | None = None) -> None:
    """CSV files of that name before the first point and a number, as many as there are
    tasks; without a name, by the column ``name``, a large one split into several files."""
    tmp = f"{folder}-part-{uuid.uuid4().hex}"
    if name is None:
        df.hint("rebalance", "name").write.partitionBy("name").options(**X.CSV_WRITE).option("compression", "none").csv(tmp)
    else:
        X.write_csv(df, tmp, compression="none")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for i, part in enumerate(f for f in list_files(spark, tmp) if f.endswith(".csv")):
        stem = name.split(".")[0] if name else part.rsplit("/", 2)[1].removeprefix("name=")
        fs.rename(path(part), path(f"{folder}/{stem}.{i}.csv"))


#: what the files' columns are made of
_VALUES = {
    "recipient_name": "recipient_name", "denumire_beneficiar": "recipient_name", "recipient_street": "recipient_street",
    "localitate": "recipient_street", "scheme_code_short": "'S1'", "masura": "scheme", "currency": "'DKK'", "amount": "_row", "cuantum": "_row",
}


def _file_sql(country: str, year: int, columns: tuple[str, ...], currency: str, code: str) -> str:
    """The cleaning oracle over the rows of one file, its columns as they are named there."""
    cells = ", ".join(f"CAST({_VALUES[c]} AS VARCHAR) AS {c}" for c in columns if c not in ("currency", "scheme_code_short"))
    raw = (
        f"raw AS (SELECT {O.q(country)} AS country, '{year}' AS year, {O.q(currency)} AS currency, {cells}, _row "
        f"FROM (WITH {OC.raw_payments_cte()} SELECT * FROM raw) WHERE upper(country) = {O.q(country)} AND year = '{year}')"
    )
    present = ["country", "year", "currency", *(c for c in columns if c not in ("currency", "scheme_code_short"))]
    body = f"SELECT country, year, currency_original, {code} AS scheme_code, recipient_address, recipient_name, amount_original FROM c9"
    return OC.clean_sql(body, present).replace(OC.raw_payments_cte(), raw)


@register(
    "csv_files",
    "SELECT country, year, currency_original, scheme_code, count(*) AS rows, count(recipient_address) AS addresses, "
    "count(DISTINCT recipient_name) FILTER (WHERE NOT starts_with(recipient_name, 'Anonymous ')) "
    # every nameless line of a file has a name of its own
    "+ count(*) FILTER (WHERE starts_with(recipient_name, 'Anonymous ')) AS names, CAST(sum(amount_original) AS DOUBLE) AS amount FROM ("
    + " UNION ALL ".join(
        f"SELECT * FROM ({_file_sql(c, y, cols, cur, code)})"
        for (c, y, _n, cols), cur, code in zip(_FILES, ("DKK", "EUR", "LTL"), ("'S1'", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"))
    )
    + ") GROUP BY ALL UNION ALL SELECT 'rejected', 1, NULL, NULL, 0, 0, 0, NULL",
)
def csv_files(spark, sf_dir):
    """Country and year from file names, three headers,
    other column names, a currency from the table of manual fixes, short scheme
    codes, and a file that says no year. All raw rows of the three country-years; those
    of every country and year are in ``csv_files_all``."""
    raw, folder = raw_payments(spark, sf_dir), scratch(spark, "files")
    for country, year, name, columns in _FILES:
        rows = raw.where((F.upper("country") == country) & (F.col("year") == str(year)))
        _named_files(spark, rows.selectExpr(*(f"{_VALUES[c]} AS {c}" for c in columns)), folder, name)
    _named_files(spark, raw.groupBy("country").agg(F.max("amount").alias("amount")).coalesce(1), folder, "whole.csv")
    result, src = clean_files(spark, folder)
    # equal amounts of one recipient can't occur: the amount is the source line's number
    rows = result.rows.groupBy("country", "year", "currency_original", "scheme_code").agg(
        F.count(F.lit(1)).alias("rows"), F.count("recipient_address").alias("addresses"),
        F.count_distinct("recipient_name").alias("names"), F.sum("amount_original").cast("double").alias("amount"),
    )
    gone = spark.range(1).selectExpr("'rejected'", str(len(src.rejected)), "CAST(NULL AS STRING)", "CAST(NULL AS STRING)", "0L", "0L", "0L", "CAST(NULL AS DOUBLE)")
    return rows.union(gone)


@register(
    "csv_files_all",
    OC.clean_sql(
        "SELECT country, year, _valid AS valid, count(*) AS rows, count(DISTINCT recipient_name) AS names, "
        "count(recipient_address) AS addresses, CAST(sum(len(errors)) AS BIGINT) AS error_count, "
        + O.num("CAST(sum(amount) AS DECIMAL(28,2))")
        + " AS amount_sum FROM c9 GROUP BY country, year, _valid"
    ),
)
def csv_files_all(spark, sf_dir):
    """All raw rows as files of every country and year, which only the
    files' names tell; padded, quoted and placeholder names and bad amounts with them."""
    raw, folder = raw_payments(spark, sf_dir), scratch(spark, "all-files")
    named = raw.withColumn("name", F.concat_ws("_", F.lower("country"), "year")).drop("country", "year")
    _named_files(spark, named, folder)
    rows = clean_files(spark, folder)[0].rows
    return present(
        rows.groupBy("country", "year", F.col("_valid").alias("valid")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("recipient_name").alias("names"), F.count("recipient_address").alias("addresses"),
            F.sum(F.size("errors")).alias("error_count"), F.sum("amount").cast("decimal(28,2)").alias("amount_sum"),
        )
    )


@register(
    "csv_headerless",
    "SELECT c_custkey AS row, c_name AS recipient_name, CAST(c_acctbal AS DOUBLE) AS amount FROM customer",
)
def csv_headerless(spark, sf_dir):
    """A header given by the caller, another delimiter."""
    path = scratch(spark, "plain")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", F.col("c_acctbal").cast("string"))
    rows.write.options(sep="|", header=False).csv(path)
    got = read_sources(spark, path, header=["row", "recipient_name", "amount"], delimiter="|").rows
    return got.select(F.col("row").cast("long").alias("row"), "recipient_name", F.col("amount").cast("double").alias("amount"))


@register(
    "same_ids",
    "SELECT count(*) AS rows, 0 AS differing, 0 AS lost FROM customer WHERE c_custkey % 2 = 0",
)
def same_ids(spark, sf_dir):
    """A file of nameless rows gives the same payment keys alone and beside another."""
    base = scratch(spark, "nameless")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.lit("DE").alias("country"), F.lit("2015").alias("year"), F.lit("--").alias("recipient_name"), F.lit("EUR").alias("currency"),
        F.lit("7").alias("amount"), "c_custkey",
    )
    for name, rest in (("a", 0), ("b", 1)):
        X.write_csv(rows.where(F.col("c_custkey") % 2 == rest).drop("c_custkey"), f"{base}/{name}", compression="none")
    alone = clean_files(spark, f"{base}/a")[0].rows.select("pk", "_file")
    beside = clean_files(spark, [f"{base}/a", f"{base}/b"])[0].rows.select("pk", "_file")
    both = alone.select("pk", "_file", F.lit(1).alias("n")).unionByName(
        beside.where(F.col("_file").contains(f"{base.rsplit('/', 1)[-1]}/a/")).select("pk", "_file", F.lit(-1).alias("n"))
    )
    per = both.groupBy("pk", "_file").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("rows"))
    return per.agg(
        F.sum("rows").alias("rows"),
        F.count_if(F.col("n") != 0).cast("int").alias("differing"),
        F.count_if(F.col("rows") == 0).cast("int").alias("lost"),
    )


_EXPORT_SQL_TEXT = (
    "select recipient_id, year, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS total "
    "from payments where country in ('DK', 'SE') group by recipient_id, year"
)


@register(
    "export_sql",
    O.with_payments(
        "SELECT recipient_id, CAST(year AS VARCHAR) AS year, CAST(n AS VARCHAR) AS n, "
        "CAST(total AS VARCHAR) AS total FROM (" + _EXPORT_SQL_TEXT + ") t"
    ),
)
def export_sql_q(spark, sf_dir):
    """A checked query's result written as CSV and read back as text."""
    path = scratch(spark, "sql-export")
    X.export_sql(spark, payments(spark, sf_dir), _EXPORT_SQL_TEXT, path)
    return X.read_csv_text(spark, path)


_EXPORT_PAGE_SQL = (
    "SELECT {how} AS file, * FROM (SELECT country, CAST(count(*) AS VARCHAR) AS total_payments FROM {rows} "
    "GROUP BY country ORDER BY country {cut})"
)
_OLD_ROWS = "(SELECT country FROM payments WHERE year < 2014)"
_NEW_ROWS = "(SELECT country FROM payments WHERE year < 2014 UNION ALL SELECT country FROM (SELECT DISTINCT country, year, recipient_id, pk FROM payments WHERE year >= 2014))"


@register(
    "named_export",
    O.with_payments(
        " UNION ALL ".join(
            _EXPORT_PAGE_SQL.format(how=O.q(how), rows=rows, cut=cut)
            for how, rows, cut in (
                ("page 1", _OLD_ROWS, "LIMIT 3"), ("page 2", _OLD_ROWS, "LIMIT 3 OFFSET 3"), ("full", _OLD_ROWS, ""),
                ("again", _OLD_ROWS, "LIMIT 3"), ("page 1 of new rows", _NEW_ROWS, "LIMIT 3"), ("again of new rows", _NEW_ROWS, "LIMIT 3"),
            )
        )
    ),
)
def named_export_q(spark, sf_dir):
    """S14 through API requests over a stored table: two pages and the full result have
    files of their own, a repeated request reads its first file again, and after an
    upsert the same request gets a new file."""
    p, folder, table = payments(spark, sf_dir), scratch(spark, "named"), scratch(spark, "exported")
    store.insert(p.where("year < 2014"), table)
    stored = store.read_table(spark, table)
    first, second = {"p": 1, "limit": 3}, {"p": 2, "limit": 3}
    out, paths = None, {}
    for how, params in (("page 1", first), ("page 2", second), ("full", {}), ("again", first), ("page 1 of new rows", first), ("again of new rows", first)):
        if how == "page 1 of new rows":
            store.upsert(spark, p.where("year >= 2014"), table)
        path = V.call(stored, "countries", params | {"output": "export"}, export_dir=folder)["path"]
        if (path in paths) != how.startswith("again"):
            raise ValueError(f"{how}: the file of {paths.get(path)}")
        paths.setdefault(path, how)
        rows = X.read_csv_text(spark, path).select(F.lit(how).alias("file"), "country", "total_payments")
        out = rows if out is None else out.union(rows)
    return out


_SERVED = ", ".join(O.q(c) for c, *_ in COUNTRIES)
_KNOWN_CURRENCIES = ", ".join(O.q(c) for c in CURRENCIES)
_RULES_SQL = {
    "recipient_country is null": "recipient_country IS NULL",
    "currency_original is unknown": f"currency_original NOT IN ({_KNOWN_CURRENCIES})",
    "country is unknown": f"country NOT IN ({_SERVED})",
    "nuts1 is unknown": "country = 'PL'",
}


@register(
    "insert_refused",
    OC.clean_sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT {O.q(rule)} AS what, count(*) AS rows FROM cleaned WHERE {test}" for rule, test in _RULES_SQL.items())
        + ") WHERE rows > 0 UNION ALL SELECT 'in the table', count(*) FROM cleaned WHERE _valid AND country <> 'PL'"
    ),
)
def insert_refused(spark, sf_dir):
    """An insert of all cleaned rows, bad ones and codes outside the table of
    regions among them, is refused with its counts and leaves the table empty; the good
    rows then go in."""
    table = scratch(spark, "checked")
    regions = payments(spark, sf_dir).where("country != 'PL'").select("country").distinct()
    path = scratch(spark, "cleaned")
    staged = clean(raw_payments(spark, sf_dir)).staged(f"{path}/every")
    with shuffles_dropped(spark):
        rows = staged.cleaned.withColumn("nuts1", F.col("country")).select(*PAYMENT_COLUMNS, "_valid")
        rows.write.option("compression", "zstd").parquet(f"{path}/first")
    remove_path(spark, f"{path}/every")
    cleaned = spark.read.parquet(f"{path}/first")  # cleaned once, for both inserts
    store.init_table(spark, table)
    try:
        store.insert(cleaned, table, regions=regions)
        counts = {}
    except InvalidRows as e:
        counts = e.counts
    if not store.read_table(spark, table).isEmpty():
        raise ValueError("refused rows are in the table")
    store.insert(cleaned.where(F.col("_valid") & (F.col("country") != "PL")), table, regions=regions)
    bad = spark.createDataFrame(list(counts.items()), "what string, rows long")
    return bad.union(store.read_table(spark, table).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("in the table"), "rows"))
