"""Benchmark: the reference's workload on the driver's tables.

1. clean the raw source rows (T22) and load the payments table (S9),
2. serve summaries, pages, searches and exports from the stored,
   partitioned table (A1-A11, W5/W6, P10, S15), and one upsert (S10).

Each step runs to completion (``noop`` sink or a small collect). Prints one
JSON line. Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cropledger.operators import summaries as S  # noqa: E402
from cropledger.operators.clean import clean  # noqa: E402
from cropledger.plans import views as V  # noqa: E402
from cropledger.plans.testdata import payments, raw_payments  # noqa: E402
from cropledger.session import ensure_checkpoint_dir, local_session  # noqa: E402
from cropledger.sources import export as X  # noqa: E402
from cropledger.sources import store  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus=cpus, shuffle_partitions=max(8, 2 * cpus), app="cropledger-bench")
    spark.sparkContext.setLogLevel("ERROR")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"
    table = f"{base}/payments"
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # warm-up (JIT, file listing); not counted
    payments(spark, sf_dir).limit(10).collect()

    timed("clean_all", lambda: run(clean(raw_payments(spark, sf_dir)).payments))
    timed("load_table", lambda: (store.init_table(spark, table), store.insert(payments(spark, sf_dir), table)))

    p = store.read_table(spark, table)
    for entity in ("recipient", "recipient_base", "scheme", "country", "year", "location", "nuts1", "nuts2", "nuts3"):
        timed(f"summary_{entity}", lambda e=entity: run(S.SUMMARIES[e](p).to_df()))
    timed("summary_global", lambda: S.AggregationQuery(p).to_df().collect())
    timed(
        "topk_recipients_country",
        lambda: S.RecipientBaseQuery(p).where(country="BE").order_by("amount_sum", ascending=False)[:10].to_df().collect(),
    )
    timed(
        "page_schemes_by_count",
        lambda: V.SchemeView(p, {"p": 3, "limit": 20, "order_by": "-total_payments"}).result()["results"].collect(),
    )
    timed(
        "recipients_year_page",
        lambda: V.RecipientView(p, {"year": 2014, "limit": 50, "order_by": "-amount_sum"}, authenticated=True)
        .to_df()
        .collect(),
    )
    timed(
        "fingerprint_search",
        lambda: V.RecipientView(p, {"recipient_fingerprint__like": "%customer 0000012%"}, authenticated=True)
        .to_df()
        .collect(),
    )
    timed(
        "autocomplete",
        lambda: V.RecipientNameView(p, {"recipient_fingerprint__like": "%CUSTOMER#000001%", "country": "DE"})
        .to_df()
        .collect(),
    )
    timed("entity_graph", lambda: run(X.entity_graph(p)))
    timed(
        "upsert_one_year",
        lambda: store.upsert(
            spark,
            p.filter(F.col("year") == 2015).withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)")),
            table,
        ),
    )
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).replace("sf", ""),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
