"""Every registered query against its DuckDB oracle (sf 0.001)."""

import os
import sys

import pytest
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from compare import compare  # noqa: E402

from chargepulse.plans import oracle, registry  # noqa: E402

NAMES = sorted(registry.queries())


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(NAMES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "total", "succ", "money", "cost_ms"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)
    assert res[name][0] == "ok", res[name]
