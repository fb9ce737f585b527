"""Every plan against its SQL, and the driver's entry points."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from tidelight.plans.catalog import all_entries

ENTRIES = all_entries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_plan_agrees_with_sql(name, spark, con, sf_dir):
    assert difference(spark, con, ENTRIES[name].plan, ENTRIES[name].sql, sf_dir) is None


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if not e.sql])
def test_plan_has_rows(name, spark, sf_dir):
    assert ENTRIES[name].plan(spark, sf_dir).count() > 0


def test_driver_entry_points(spark, sf_dir):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_key_columns_decide_the_rebalance(spark, sf_dir):
    """The wide vectors are neither read nor shuffled to choose the moved rows."""
    plan = ENTRIES["val_rebalance"].plan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "embedding" not in plan.replace("embeddings.parquet", "")
    assert "hashpartitioning(sourcePath" not in plan
