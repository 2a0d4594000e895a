"""Plans and steps that must not grow faster than their input."""

from __future__ import annotations

import time

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cropledger.functions import packed, unpacked
from cropledger.llm import spelling
from cropledger.operators import clean as clean_module
from cropledger.operators import summaries
from cropledger.operators.clean import clean
from cropledger.operators.lookups import match_schemes
from cropledger.plans import queries_clean, queries_io, queries_summary, testdata
from cropledger.schema import PAYMENT_COLUMNS
from cropledger.session import SHUFFLE_CLEANUP_CONF
from cropledger.sources import csv_source, export
from cropledger.sources.csv_source import path_exists

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scheme_tables_are_not_broadcast(spark, tmp_path):
    """The pieces of the names are many times the table that the planner's estimate sees."""
    schemes = spark.createDataFrame([(1, "P1", "old plate"), (2, "P2", "old plate"), (3, "P3", "hot ring")], "ord int, scheme_id string, scheme_name string")
    schemes.write.parquet(f"{tmp_path}/schemes")
    schemes = spark.read.parquet(f"{tmp_path}/schemes")
    texts = spark.createDataFrame([("ld pla",), ("aid p2 paid",), ("ring",), ("nothing",), ("ho",), (None,)], "text string")
    found = match_schemes(texts, "text", schemes, "out")
    assert {r["text"]: r["out"] for r in found.collect()} == {
        "ld pla": "P1 - old plate", "aid p2 paid": "P2 - old plate", "ring": "P3 - hot ring", "nothing": "nothing", "ho": "P3 - hot ring", None: None
    }
    plan = found._jdf.queryExecution().sparkPlan().toString()
    for key in ("gram", "id"):
        assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and f"[{key}#" in x], plan


def test_cleaning_is_compiled(spark):
    """The pipeline's one method would be interpreted under Spark's default limit."""
    for make in (lambda: clean(testdata.raw_payments(spark, SF)), lambda: queries_clean.scheme_match(spark, SF)):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        make()
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_outputs_of_one_cleaning(spark, monkeypatch):
    """What is read more than once comes from the cleaned rows, not from the sources again."""
    seen = []
    monkeypatch.setattr(queries_io.store, "insert", lambda df, *a, f=queries_io.store.insert, **k: (seen.append(_plan(df)), f(df, *a, **k))[1])
    queries_io.insert_refused(spark, SF)
    assert len(seen) == 2 and not any("l_orderkey" in p for p in seen)
    assert "l_orderkey" not in _plan(queries_clean.scheme_descriptions(spark, SF))
    judged = _plan(queries_clean.domain_violations(spark, SF)).splitlines()
    assert sum("Relation [l_orderkey" in x for x in judged) == 1


def test_recipients_join_orders_before_line_items(spark):
    """Line items are shuffled without the recipients' columns."""
    for view in (testdata.payments, testdata.raw_payments):
        joins = [x for x in _plan(view(spark, SF)).splitlines() if "Join Inner" in x]
        assert "l_orderkey" in joins[0]


def test_filter_on_recipients_joins_orders_first(spark):
    """All line items meet the filtered orders only; those left meet the parts."""
    plan = _plan(queries_summary.view_measure_filter(spark, SF)).splitlines()
    items = [x for x in plan if "Join Inner" in x and ("l_orderkey" in x or "l_partkey" in x)]
    assert items and [("l_partkey" in x) for x in items] == [True, False] * (len(items) // 2)
    rows = [testdata.payments(spark, SF, few).groupBy().agg(F.count("*"), F.sum(F.xxhash64(*PAYMENT_COLUMNS).cast("decimal(38,0)"))).first() for few in (True, False)]
    assert rows[0] == rows[1]


def test_file_names_are_matched_seldom(spark, tmp_path):
    """Country and year of a row's file: few matches, on the name alone (16 in the plan before)."""
    names = ["cz_2015.csv.gz", "pl_Subsidies_2015.csv", "DK_2013.0.csv", "plain.csv", "a_b_1999", "x_Subsidies_20.csv", "_2015.csv", "de_15.csv", ""]
    paths = [(f"file:/data/lv_2001/{n}", n) for n in names] + [(n, n) for n in names] + [(None, None)]
    rows = spark.createDataFrame(paths, "path string, name string")
    country, year = csv_source.context_from_path(F.col("path"))
    for r in rows.select("name", country.alias("c"), year.alias("y")).collect():
        assert (r["c"], r["y"]) == (csv_source.context_from_name(r["name"]) if r["name"] is not None else (None, None)), r
    (tmp_path / "lv_2014.csv").write_text("recipient_name,amount\nAnna,1\n")
    plan = _plan(csv_source.read_sources(spark, f"{tmp_path}/lv_2014.csv").rows)
    assert plan.count("regexp_extract(") <= 6 and "([^/]+)" not in plan, plan


def test_pages_share_the_payments(spark, monkeypatch):
    cached, real = [], queries_summary.V.CountryView
    monkeypatch.setattr(queries_summary.V, "CountryView", lambda p, *a, **k: (cached.append(p.storageLevel.useMemory), real(p, *a, **k))[1])
    assert queries_summary.paging_flags(spark, SF).count() == 4
    assert cached == [True] * 4


def test_spelling_tables_are_not_broadcast(spark):
    """Neighbours, forms and roots grow with the words; the planner sees a compressed file's size or less."""
    words = spark.createDataFrame([(w, 3 + 9 * i) for i, w in enumerate(("plain", "plane", "plains", "other"))], "word string, n long")
    pairs, groups = spelling.near_pairs(words), spelling.spelling_groups(words)
    assert {(r["word"], r["near"]) for r in pairs.collect()} == {(a, b) for a, b in [("plain", "plains"), ("plains", "plain")]}
    assert {r["word"]: r["root"] for r in groups.collect()} == {"plain": "plains", "plane": "plane", "plains": "plains", "other": "other"}
    for made in (pairs, groups):
        assert "Broadcast" not in made._jdf.queryExecution().sparkPlan().toString()


def _jobs_plans(spark, monkeypatch, run) -> list[tuple[str, str]]:
    """(clean-up setting, optimised plan) of each table that ``run`` writes."""
    seen, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append((spark.conf.get(SHUFFLE_CLEANUP_CONF), _plan(self._df))), real(self, *a, **k))[1])
    run()
    monkeypatch.undo()
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "false"
    return seen


def test_packed_ids(spark):
    texts = ["", "0a", "0A", "abc", "da39a3ee5e6b4b0d3255bfef95601890afd80709", "DA39", "r1", "Łódź", "\x01x", None, " "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2).select("t", packed("t").alias("p"), unpacked(packed("t")).alias("u")).collect()
    assert all(r["t"] == r["u"] for r in rows) and len({r["p"] and bytes(r["p"]) for r in rows}) == len(texts)
    assert max(len(r["p"]) for r in rows if r["p"] and len(r["t"]) == 40) == 21


def test_stored_rows_with_a_key_of_their_own_stay(spark, tmp_path, monkeypatch):
    made = [(f"{i % 40:040x}" if i < 60 else None if i < 64 else f"k{i}", i % 7, f"v{i}") for i in range(300)]
    spark.createDataFrame(made, "pk string, at int, v string").repartition(5).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    moved, real = [], clean_module.dedup_first
    monkeypatch.setattr(clean_module, "dedup_first", lambda df, *a: (moved.append(df), real(df, *a))[1])
    got = clean_module.dedup_stored(rows, "pk", ["at", "v"])
    assert sorted(map(str, got.collect())) == sorted(map(str, real(rows, "pk", ["at", "v"]).collect()))
    assert moved[0].count() == 44  # 20 keys that come twice and four rows without one
    monkeypatch.setattr(clean_module, "KEY_BITS", 32768)
    few = clean_module.dedup_stored(rows.where("at = 9"), "pk", ["at", "v"])
    assert few.columns == rows.columns and few.count() == 0


def test_cleaned_rows_are_stored_before_keys_are_compared(spark):
    plan = _plan(queries_clean.clean_all(spark, SF))
    assert "l_orderkey" not in plan and "bitmap_construct_agg" in plan and "unhex" in plan


def test_writes_drop_their_shuffles(spark, ten, monkeypatch):
    assert "unhex" in _plan(queries_io.store.layout(ten))
    for query in (queries_io.upsert_q, queries_io.insert_refused, queries_clean.scheme_descriptions):
        jobs = [p for p in _jobs_plans(spark, monkeypatch, lambda q=query: q(spark, SF)) if "Relation" in p[1]]
        assert len(jobs) > 1 and {on for on, _ in jobs} == {"true"}


def test_entity_graph_shuffles_one_set(spark, ten):
    plan = _plan(export.entity_graph(ten))
    assert plan.count("collect_set(") == 1 and "unhex" in plan
    got = {(r["id"], r["schema"]): r["properties"] for r in export.entity_graph(ten.union(ten)).collect()}
    assert len(got) == 17 and got["r4", "LegalEntity"]["name"] == ["Carla", "Carla GmbH"] and got["p01", "Payment"]["beneficiary"] == ["r1"]


def test_summaries_share_stored_rows_of_recipients(spark, ten):
    seen = []
    with summaries.summaries(ten.withColumn("more", F.lit("x"))) as made:
        for df in made.values():
            seen += [f for f in df.inputFiles()]
            assert "InMemoryRelation" not in _plan(df) and "more#" not in _plan(df)
        assert sum(r["total_payments"] for r in made["country"].collect()) == 10
        rows = {r["id"]: r for r in made["recipient"].collect()}
        assert rows["r4"]["name"] == ["Carla", "Carla GmbH"]
    assert seen and not any(path_exists(spark, f) for f in set(seen))
    for query in (queries_summary.bulk_summaries, queries_summary.kept_summaries):
        assert "Aggregate" not in _plan(query(spark, SF))


def test_file_names_without_a_match_are_searched_once(spark):
    """A pattern that may begin anywhere takes the square of a name's length where none matches (0.2 ms a row)."""
    path = F.concat(F.lit("file:/in/"), F.repeat(F.lit("ab_"), 1000), F.col("id").cast("string"), F.lit(".csv"))
    country, year = csv_source.context_from_path(path)
    begun = time.time()
    assert spark.range(0, 400, 1, 4).select(country.alias("c"), year.alias("y")).where("c IS NOT NULL OR y IS NOT NULL").count() == 0
    assert time.time() - begun < 10
    assert all(p.startswith("^") for p in csv_source.FILENAME_PATTERNS)


def test_rules_alone_need_no_hashes(spark):
    """Country, year, names, addresses, errors and validity of cleaned rows (csv_files_all): one hash a row, of nameless rows' cells."""
    raw = spark.createDataFrame([("DE", "2015", "Anna  B", "1", "EUR", "II.1 x")], "country string, year string, recipient_name string, amount string, currency string, scheme string")
    every = clean(raw).every
    assert _plan(every.select("_valid", "country", "year", "errors")).count("sha1(") == 0
    assert every.select("_valid", "recipient_name").first() == (True, "Anna B")
