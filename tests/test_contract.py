"""Every registered query against its SQL on the smallest tables."""

import importlib.util
from pathlib import Path

import pytest
from verification.compare import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent
spec = importlib.util.spec_from_file_location("entry_module", ROOT / "__spark_entry__.py")
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_its_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if sql := contract.oracle_sql().get(name):
        assert mismatch(df, rows, db.sql(sql)) is None


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "event_date", "site_id", "energy_wh_total", "peak_power_w", "avg_temp_c", "uptime_percent", "anomaly_count"
    ]
