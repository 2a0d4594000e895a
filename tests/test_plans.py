"""Plan-shape guards for the scale design: no Python row functions, no
cartesian or nested-loop joins in any registered query; pruning and
push-down on the stored table."""

import contextlib
import io
import uuid

import pytest

from conftest import SF_SMALL
from cropledger.operators import summaries as S
from cropledger.plans import registry
from cropledger.plans import views as V
from cropledger.plans.testdata import payments
from cropledger.session import ensure_checkpoint_dir
from cropledger.sources import store

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_rows_or_cross_joins(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_pruning_and_topk_on_stored_table(spark):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/plans-test-{uuid.uuid4().hex}"
    store.insert(payments(spark, SF_SMALL), path)
    p = store.read_table(spark, path)
    plan = plan_of(S.RecipientBaseQuery(p).where(country="BE", amount__gt=1000).order_by("amount_sum", ascending=False)[:10].to_df())
    assert "PartitionFilters: [isnotnull(country" in plan and "(country" in plan
    assert "GreaterThan(amount,1000.00)" in plan
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<recipient_id:string,amount:decimal(18,2)>" in plan
    fp = plan_of(V.RecipientBaseView(p, {"recipient_fingerprint__like": "%CUSTOMER#00000001%"}, authenticated=True).to_df())
    assert "StringContains(recipient_fingerprint,00000001 customer)" in fp
