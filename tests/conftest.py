import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cropledger.schema import PAYMENTS_SCHEMA  # noqa: E402
from cropledger.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="cropledger-tests")
    yield s


def _row(pk, country, year, rid, name, addr, scheme, amount, nuts1=None):
    d = {c.name: None for c in PAYMENTS_SCHEMA.fields}
    d.update(
        pk=pk, country=country, year=year, recipient_id=rid, recipient_name=name,
        recipient_fingerprint=name.lower() if name else None, recipient_address=addr,
        recipient_country=country, scheme_id=(f"s-{scheme}" if scheme else None), scheme=scheme,
        amount=None if amount is None else Decimal(amount), currency="EUR",
        amount_original=None if amount is None else Decimal(amount), currency_original="EUR",
        nuts1=nuts1, nuts2=None, nuts3=None,
    )
    return tuple(d[c.name] for c in PAYMENTS_SCHEMA.fields)


@pytest.fixture(scope="session")
def ten(spark):
    """ten hand-written payments: a null address, a null scheme, a null
    amount, an average tie (10.02 / 10.03 → 10.02 half-even), two recipients
    with one name, one recipient with two names."""
    rows = [
        _row("p01", "LU", 2019, "r1", "Andre", "Weiswampach, LU", "II.1", "10.02", "LU0"),
        _row("p02", "LU", 2019, "r1", "Andre", "Weiswampach, LU", "II.1", "10.03", "LU0"),
        _row("p03", "LU", 2020, "r2", "Andre", "Clervaux, LU", "II.1", "100.00", "LU0"),
        _row("p04", "LU", 2020, "r3", "Bert", None, None, "5.50"),
        _row("p05", "DE", 2019, "r4", "Carla", "Köln, DE", "I.1", "200.00", "DE1"),
        _row("p06", "DE", 2020, "r4", "Carla GmbH", "Köln, DE", "I.1", "300.00", "DE1"),
        _row("p07", "DE", 2021, "r5", "Dora", "Bonn, DE", "I.2", None, "DE1"),
        _row("p08", "HU", 2021, "r6", "Emil", "Pécs, HU", "I.2", "0.01"),
        _row("p09", "HU", 2021, "r6", "Emil", "Pécs, HU", "I.2", "0.02"),
        _row("p10", "HU", 2014, "r7", "Fanni", "Győr, HU", "V.1", "1000.00"),
    ]
    return spark.createDataFrame(rows, PAYMENTS_SCHEMA)
