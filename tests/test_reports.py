"""Every report that SQL can state agrees with its SQL, value by value."""

import pytest
from oracle import connect, differences

from purseflow import plans  # noqa: F401
from purseflow.plans.registry import CHECKS, REPORTS


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_report_agrees_with_sql(spark, folder, con, name):
    assert differences(REPORTS[name](spark, folder), con, CHECKS[name]) == []


def test_reports_without_sql_are_few_and_known():
    assert set(REPORTS) - set(CHECKS) == {"file_inventory", "object_etags"}


def test_entry(spark):
    import __spark_entry__ as entry_module

    assert entry_module.entry(spark).count() == 1
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
