"""Sources → cleaning → store → streaming, on hand-written raw CSV files
that contain the F1 cases."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cropledger.errors import ImproperlyConfigured, InvalidRows, InvalidSource
from cropledger.operators.clean import clean
from cropledger.operators.load import clean_files
from cropledger.session import ensure_checkpoint_dir
from cropledger.sources import store, versions
from cropledger.sources.csv_source import read_sources
from cropledger.streaming.ingest import ingest_new_files

CZ = """country,year,recipient_name,recipient_id,recipient_street,recipient_location,recipient_postcode,recipient_country,scheme,amount,currency
CZ,2015,Jan Novák,,Main 1,Praha,1097.0,,II.10 storage,"1234,56",CZK
CZ,2015,"  ""Quoted, Name""  ",,Main 2,Brno,,CZ,export,100.5,CZK
CZ,2015,--,ID7,Main 3,Brno,,CZ,,"1.234,56",CZK
CZ,2015,**,,Main 4,Brno,,CZ,,"12,345",CZK
CZ,2015,Anon Minus,,,,,,,-50,CZK
country,year,recipient_name,recipient_id,recipient_street,recipient_location,recipient_postcode,recipient_country,scheme,amount,currency
CZ,2015,Short Row,,Main 5
CZ,2015,Too Long,,Main 6,Brno,,CZ,x,1,CZK,extra
CZ,2015,Euro Payer,,Main 7,Brno,,CZ,,10,EUR
CZ,2015,Dollar Payer,,Main 8,Brno,,CZ,,10,USD
XX,2015,Nowhere,,Main 9,,,,,10,EUR
CZ,2015,Twice,,Main 10,Brno,,CZ,I.1,20,CZK
CZ,2015,Twice,,Main 10,Brno,,CZ,I.1,20,CZK
CZ,2015,--,,,,,,,5,CZK
CZ,2015,--,,,,,,,5,CZK
CZ,2015,Xpath Co,,xpath /a data='Rue 5' /b,,,CZ,,7,CZK
"""

HU = """recipient_name,amount,currency
Bela,1000,HUF
"""

RO = """denumire_beneficiar,cod_unic,localitate,masura,cuantum
Ion Popescu,RO1,Cluj,II.1 x,"100,00"
"""


@pytest.fixture()
def raw_dir(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "cz_2015.csv").write_text(CZ, encoding="utf-8")
    (d / "hu_2016.csv").write_text(HU, encoding="utf-8")
    (d / "ro_2019.csv").write_text(RO, encoding="utf-8")
    return str(d)


def _clean(spark, path):
    src = read_sources(spark, path)
    res = clean(src.rows, year=F.col("_ctx_year"), country=F.col("_ctx_country"))
    return src, res


def test_read_groups_and_bad_rows(spark, raw_dir):
    src = read_sources(spark, raw_dir)
    assert len(src.headers) == 3
    names = {r["recipient_name"] for r in src.rows.select("recipient_name").collect()}
    assert "Too Long" not in names and "Short Row" in names
    assert src.skipped.collect()[0]["rows"] == 1
    ctx = {(r["_ctx_country"], r["_ctx_year"]) for r in src.rows.select("_ctx_country", "_ctx_year").collect()}
    assert ctx == {("cz", "2015"), ("hu", "2016"), ("ro", "2019")}


def test_clean_cases(spark, raw_dir):
    _, res = _clean(spark, raw_dir)
    pay = {r["recipient_name"]: r for r in res.payments.collect()}
    assert "recipient_name" not in pay  # repeated header dropped
    novak = pay["Jan Novák"]
    assert novak["recipient_fingerprint"] == "jan novak"
    assert novak["recipient_country"] == "CZ"  # blank falls back to payment country
    assert novak["recipient_address"] == "Main 1, Praha, 1097"
    assert novak["scheme"] == "II.10 - Storage aid"
    assert novak["amount_original"] == Decimal("1234.56") and novak["currency_original"] == "CZK"
    assert novak["amount"] == Decimal("44.60") and novak["currency"] == "EUR"
    assert pay["Quoted, Name"]["scheme"] == "II.1 - Export refunds"
    assert pay["CZ ID7"]["amount"] is None  # 1.234,56 is invalid
    assert pay["Euro Payer"]["amount"] == Decimal("10.00")
    dollars = res.quarantine.filter("recipient_name = 'Dollar Payer'").first()
    assert dollars["amount"] == Decimal("0.36")  # by the country's rate, but not a known currency
    assert pay["Anon Minus"]["amount"] < 0
    assert pay["Xpath Co"]["recipient_address"] == "Rue 5"
    assert pay["Short Row"]["amount"] is None
    assert pay["Bela"]["amount"] is None and pay["Bela"]["country"] == "HU" and pay["Bela"]["year"] == 2016
    ion = pay["Ion Popescu"]
    assert ion["country"] == "RO" and ion["year"] == 2019 and ion["currency_original"] is None
    assert ion["amount"] == Decimal("21.50") and ion["scheme"] == "II.1 - Export refunds"
    anon = [n for n in pay if n.startswith("Anonymous ")]
    assert len(anon) == 3  # "**" row plus two identical nameless rows, which stay two recipients
    twice = res.payments.filter(F.col("recipient_name") == "Twice").count()
    assert twice == 1  # same payment twice
    quarantine = [r["recipient_name"] for r in res.quarantine.collect()]
    assert sorted(quarantine) == ["Dollar Payer", "Nowhere"]
    errs = {(r["code"], r["value"]) for r in res.errors.collect()}
    assert ("InvalidAmount", "1.234,56") in errs and ("InvalidAmount", "12,345") in errs
    assert ("InvalidCurrency", "USD") in errs and ("InvalidCountry", "XX") in errs
    assert ("InvalidCurrency", "No currency conversion for `HUF|2016`") in errs


def test_clean_is_repeatable(spark, raw_dir):
    _, a = _clean(spark, raw_dir)
    _, b = _clean(spark, raw_dir)
    cols = ["pk", "recipient_id", "recipient_name", "amount"]
    assert sorted(a.payments.select(cols).collect()) == sorted(b.payments.select(cols).collect())


def test_missing_year_rejects_source(spark):
    df = spark.createDataFrame([("x", "1")], "recipient_name string, amount string")
    with pytest.raises(InvalidSource, match="year"):
        clean(df)


def test_store_insert_upsert_idempotent(spark, raw_dir, tmp_path):
    _, res = _clean(spark, raw_dir)
    path = str(tmp_path / "table")
    store.init_table(spark, path)
    n = store.insert(res.payments, path)
    assert n == res.payments.count()
    store.upsert(spark, res.payments, path)
    store.upsert(spark, res.payments, path)
    t = store.read_table(spark, path)
    keys = t.select("country", "year", "recipient_id", "pk")
    assert keys.count() == keys.distinct().count() == n
    changed = res.payments.filter(F.col("country") == "HU").withColumn("amount", F.lit(Decimal("1.00")))
    store.upsert(spark, changed, path)
    hu = store.read_table(spark, path).filter("country = 'HU'").collect()
    assert [r["amount"] for r in hu] == [Decimal("1.00")]
    assert store.read_table(spark, path).count() == n  # other partitions untouched


def test_stream_reads_only_new_files(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    (src / "cz_2015.csv").write_text(CZ, encoding="utf-8")
    table, ckpt = str(tmp_path / "t"), str(tmp_path / "ckpt")
    first = ingest_new_files(spark, str(src), table, checkpoint=ckpt)
    n1 = store.read_table(spark, table).count()
    assert first["batches"] == 1 and n1 > 0
    again = ingest_new_files(spark, str(src), table, checkpoint=ckpt)
    assert again["batches"] == 0
    (src / "cz_2016.csv").write_text(CZ.replace(",2015,", ",2016,"), encoding="utf-8")
    third = ingest_new_files(spark, str(src), table, checkpoint=ckpt)
    assert third["batches"] == 1
    assert store.read_table(spark, table).count() == 2 * n1


def test_clean_files_manual_currency(spark, tmp_path):
    from cropledger.operators.load import clean_files

    d = tmp_path / "lt"
    d.mkdir()
    (d / "lt_2015.csv").write_text("recipient_name,amount\nJonas,100\n", encoding="utf-8")
    res, src = clean_files(spark, str(d))
    r = res.payments.first()
    assert (r["country"], r["year"], r["currency_original"]) == ("LT", 2015, "LTL")
    assert r["amount"] == Decimal("29.00")  # LTL 2015 rate 0.290
    res2, _ = clean_files(spark, str(d), year=2016)
    assert res2.payments.first()["year"] == 2016  # explicit option wins


def test_headers_gzip_delimiter_and_caller_header(spark, tmp_path):
    import gzip

    d = tmp_path / "mixed"
    d.mkdir()
    with gzip.open(d / "de_2019.csv.gz", "wt", encoding="utf-8") as f:
        f.write("﻿recipient_name;amount;currency\nAnna;5;EUR\n")
    src = read_sources(spark, str(d), delimiter=";")
    assert list(src.headers) == [("recipient_name", "amount", "currency")]
    r = src.rows.first()
    assert (r["recipient_name"], r["amount"], r["_ctx_country"], r["_ctx_year"]) == ("Anna", "5", "de", "2019")
    h = tmp_path / "headerless"
    h.mkdir()
    (h / "x.csv").write_text("Bob,7\n", encoding="utf-8")
    rows = read_sources(spark, str(h), header=["recipient_name", "amount"]).rows.collect()
    assert [(r["recipient_name"], r["amount"]) for r in rows] == [("Bob", "7")]


def test_missing_column_groups_reported(spark):
    df = spark.createDataFrame([("2019", "LU", "Anna")], "year string, country string, recipient_name string")
    res = clean(df)
    assert ("amount", "cuantum") in res.missing_columns and ("currency",) in res.missing_columns
    src_errors = [r["value"] for r in res.errors.collect() if r["code"] == "InvalidSource"]
    assert any("amount" in v for v in src_errors) and any("currency" in v for v in src_errors)


def test_init_and_recreate(spark, tmp_path, raw_dir):
    _, res = _clean(spark, raw_dir)
    path = str(tmp_path / "t2")
    store.init_table(spark, path)
    n = store.insert(res.payments, path)
    with pytest.raises(ImproperlyConfigured):
        store.init_table(spark, path)  # exists
    with pytest.raises(ImproperlyConfigured):
        store.insert(res.payments, path)  # the same rows again
    assert store.read_table(spark, path).count() == n
    store.init_table(spark, path, recreate=True)
    assert store.read_table(spark, path).count() == 0


def test_upsert_rows_moved_within_table(spark, raw_dir, tmp_path):
    _, res = _clean(spark, raw_dir)
    path = str(tmp_path / "t3")
    n = store.insert(res.payments, path)
    moved = store.read_table(spark, path).filter("year = 2015").withColumn("year", F.lit(2017))
    store.upsert(spark, moved, path)  # reads 2015 files, writes the new 2017 partition
    t = store.read_table(spark, path)
    assert t.filter("year = 2017").count() == t.filter("year = 2015").count() > 0
    assert t.count() == n + t.filter("year = 2017").count()


def test_clean_files_rejects_file_without_year(spark, tmp_path):
    from cropledger.operators.load import clean_files

    d = tmp_path / "v1"
    d.mkdir()
    (d / "lu_2019.csv").write_text("recipient_name,amount,currency\nAnna,5,EUR\n", encoding="utf-8")
    (d / "nameless.csv").write_text("recipient_name,amount,currency\nBob,7,EUR\n", encoding="utf-8")
    res, src = clean_files(spark, str(d))
    assert [r["recipient_name"] for r in res.payments.collect()] == ["Anna"]
    assert len(src.rejected) == 1 and src.rejected[0][0].endswith("nameless.csv")
    assert "no year" in src.rejected[0][1]


def test_errors_counted_before_dedup_and_foreign_recipients(spark):
    cols = "country string, year string, recipient_name string, recipient_country string, amount string, currency string, _row long"
    rows = [("DE", "2019", "Anna", "Schweiz", "1.234,56", "EUR", i) for i in (1, 2, 3)]
    rows += [("DE", "2019", "Bob", c, "5", "EUR", 10 + i) for i, c in enumerate(("CH", "EL", "uk", "United States", "Nowhereland"))]
    res = clean(spark.createDataFrame(rows, cols))
    errors = {(r["code"], r["value"]): r["rows"] for r in res.errors.collect()}
    assert errors[("InvalidAmount", "1.234,56")] == 3  # one payment key, three bad rows
    assert errors[("InvalidCountry", "Nowhereland")] == 1
    got = {(r["recipient_name"], r["recipient_country"]) for r in res.payments.collect()}
    assert got == {("Anna", "CH"), ("Bob", "CH"), ("Bob", "GR"), ("Bob", "GB"), ("Bob", "US")}


def test_first_row_wins_by_number(spark):
    cols = "country string, year string, recipient_name string, recipient_url string, amount string, currency string, _file string, _row long"
    rows = [("DE", "2019", "Anna", f"url{i}", "5", "EUR", "f", i) for i in range(12, 0, -1)]
    assert [r["recipient_url"] for r in clean(spark.createDataFrame(rows, cols)).payments.collect()] == ["url1"]


def test_upsert_counts_rows_taken_in_and_cleans_up(spark, raw_dir, tmp_path):
    _, res = _clean(spark, raw_dir)
    path = str(tmp_path / "t4")
    n = store.insert(res.payments, path)
    assert store.upsert(spark, res.payments.filter("country = 'HU'"), path) == 1
    assert store.read_table(spark, path).count() == n
    scratch = spark.sparkContext.getCheckpointDir()
    from cropledger.sources.csv_source import list_files

    assert not [f for f in list_files(spark, scratch) if "/upsert-" in f]


def test_stream_reads_each_file_by_its_own_header(spark, tmp_path):
    from cropledger.streaming.ingest import reports

    src = tmp_path / "in2"
    src.mkdir()
    (src / "de_2019.csv").write_text('recipient_name,amount,currency\n"Anna\nMaria",5,EUR\nBob,7,EUR,extra\n', encoding="utf-8")
    (src / "fr_2019.csv").write_text("amount,currency,recipient_name\n9,EUR,Claire\nx,EUR,Dora\n", encoding="utf-8")
    (src / "nothing.csv").write_text("recipient_name,amount,currency\nEve,1,EUR\n", encoding="utf-8")
    table = str(tmp_path / "t5")
    stats = ingest_new_files(spark, str(src), table, checkpoint=str(tmp_path / "c5"))
    got = {r["recipient_name"]: r["amount_original"] for r in store.read_table(spark, table).collect()}
    assert got == {"Anna Maria": Decimal("5.00"), "Claire": Decimal("9.00"), "Dora": None}
    assert stats == {"batches": 1, "rows": 3, "rejected": 1}
    assert reports(spark, table, "skipped").collect()[0]["rows"] == 1
    assert {r["code"] for r in reports(spark, table, "errors").collect()} == {"InvalidAmount"}
    assert reports(spark, table, "rejected").collect()[0]["file"].endswith("nothing.csv")


@pytest.mark.parametrize("write", ["insert", "upsert"])
def test_writes_refuse_bad_rows(spark, ten, write):
    """A write with bad rows tells their counts and changes nothing."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/refused-{uuid.uuid4().hex}"
    store.insert(ten.where("country = 'LU'"), path)
    state = versions.version(store.read_table(spark, path))
    null = F.lit(None).cast("string")
    bad = (
        ten.where("country = 'DE'")
        .withColumn("country", F.when(F.col("pk") == "p05", F.lit("ZZ")).when(F.col("pk") == "p06", null).otherwise(F.col("country")))
        .withColumn("recipient_id", F.when(F.col("pk") == "p06", null).otherwise(F.col("recipient_id")))
        .withColumn("year", F.when(F.col("pk") == "p07", F.lit(1850)).otherwise(F.col("year")))
        .withColumn("currency_original", F.lit("XXX"))
    )
    call = (lambda **more: store.insert(bad, path, **more)) if write == "insert" else (lambda **more: store.upsert(spark, bad, path, **more))
    with pytest.raises(InvalidRows) as e:
        call(regions=spark.createDataFrame([("LU0",)], "code string"))
    assert e.value.counts == {
        "country is null": 1, "country is unknown": 1, "currency_original is unknown": 3, "nuts1 is unknown": 3,
        "recipient_id is null": 1, "year is out of range": 1,
    }
    assert store.read_table(spark, path).count() == 4
    assert versions.version(store.read_table(spark, path)) == state
    with pytest.raises(InvalidRows):
        store.insert(ten.where("country = 'DE'"), path, countries=["LU"])
    assert store.insert(ten.where("country = 'DE'"), path, regions=spark.createDataFrame([("DE1",)], "code string")) == 3


def test_outputs_of_a_staged_result(spark, tmp_path):
    """Errors, quarantine, skipped and payments from one staged cleaning read no
    source again and equal those of the lazy plan."""
    (tmp_path / "de_2015.csv").write_text(
        "recipient_name,recipient_location,amount,currency\nAnna,Bonn,10,EUR\nAnna,Bonn,10,EUR\nBert,Bonn,x,EUR\nCarl,Bonn,1,XXX\n"
        "Dora,Bonn,2,EUR,beyond\nrecipient_name,recipient_location,amount,currency\n"
    )
    lazy, src = clean_files(spark, str(tmp_path))
    staged = lazy.staged(f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}")
    for name in ("rows", "errors", "quarantine", "skipped", "payments"):
        a, b = getattr(lazy, name), getattr(staged, name)
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert "csv" not in b._jdf.queryExecution().executedPlan().toString().lower()
    assert [r["rows"] for r in staged.skipped.collect()] == [1] == [r["rows"] for r in src.skipped.collect()]
    assert sorted(r["recipient_name"] for r in staged.payments.collect()) == ["Anna", "Bert"]
    assert staged.rows.count() == 4 and staged.quarantine.count() == 1
