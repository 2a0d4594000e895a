"""Print the formatted physical plans of the key queries over a stored,
partitioned payments table (what a reviewer checks for scale: partition
pruning, pushed filters, pruned read schema, partial aggregation, shuffles,
top-k).

    python tools/explain_plans.py [sf_dir] > plans.txt
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cropledger.operators import summaries as S  # noqa: E402
from cropledger.operators.clean import clean  # noqa: E402
from cropledger.plans import views as V  # noqa: E402
from cropledger.plans.testdata import payments, raw_payments  # noqa: E402
from cropledger.session import ensure_checkpoint_dir, local_session  # noqa: E402
from cropledger.sources import export as X  # noqa: E402
from cropledger.sources import store  # noqa: E402

KEEP = ("PartitionFilters", "PushedFilters", "ReadSchema", "Output [")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    lines = [ln for ln in details.splitlines() if ln.startswith("(") or ln.startswith(KEEP)]
    return tree.strip() + "\n\n" + "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/plans-{uuid.uuid4().hex}"
    store.init_table(spark, path)
    store.insert(payments(spark, sf_dir), path)
    p = store.read_table(spark, path)
    cases = {
        "Top 10 recipients of one country since 2014 (A2 + P4 + W5)": S.RecipientBaseQuery(p)
        .where(country="BE", year__gte=2014, amount__gt=1000)
        .order_by("amount_sum", ascending=False)[:10]
        .to_df(),
        "Scheme summary for one country (A4, distinct recipients)": S.SchemeQuery(p).where(country="PL").to_df(),
        "Recipient summary, full (A1)": S.RecipientQuery(p).to_df(),
        "Page 3 of schemes by payment count (W3 + W6)": V.SchemeView(
            p, {"p": 3, "limit": 20, "order_by": "-total_payments"}
        ).to_df(),
        "Fingerprint search (P10, folded constant pattern)": V.RecipientBaseView(
            p, {"recipient_fingerprint__like": "%CUSTOMER#0000012%"}, authenticated=True
        ).to_df(),
        "Entity graph (S15)": X.entity_graph(p),
        "Cleaning raw rows (T22, over the test adapter)": clean(raw_payments(spark, sf_dir)).payments,
    }
    print("# Physical plans of key queries\n")
    print(f"Generated by `tools/explain_plans.py` over a payments table stored with `store.insert` ({sf_dir}).\n")
    for title, df in cases.items():
        print(f"## {title}\n\n```\n{formatted(df)}\n```\n")


if __name__ == "__main__":
    main()
