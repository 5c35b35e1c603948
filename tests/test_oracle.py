"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01; scripts/check_oracle.py does it locally)."""
import pytest

from lakeops.plans import registry
from lakeops.plans.compare import compare

from conftest import SF_SMALL

registry.load_all()
WITH_SQL = sorted(registry.ORACLE)
WITHOUT_SQL = sorted(set(registry.QUERIES) - set(registry.ORACLE))


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_oracle(spark, duck_small, name):
    r = compare(registry.QUERIES[name](spark, SF_SMALL), duck_small, registry.ORACLE[name])
    assert r["ok"], r


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs(spark, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
