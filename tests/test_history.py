import pytest
from pyspark.sql import functions as F

from tidelight.operators import history


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "fileName string")


@pytest.fixture
def table(spark, tmp_path):
    name = f"names_{tmp_path.name}"
    history.open_history(spark, name, str(tmp_path / "names"), buckets=16)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_increments_are_remembered_once(spark, table, tmp_path):
    landing = names(spark, "a", "b", "c", "c", "d")
    assert history.backlog_since(landing, table).count() == 4
    history.remember(table, names(spark, "a", "a", None), None, spark.range(2))
    history.remember(table, names(spark, "a", "b"))
    assert sorted(r[0] for r in spark.table(table).collect()) == ["a", "b"]
    assert sorted(r[0] for r in history.backlog_since(landing, table).collect()) == ["c", "d"]
    spark.sql(f"DROP TABLE {table}")  # another session knows the folder only
    history.open_history(spark, table, str(tmp_path / "names"), buckets=16)
    assert sorted(r[0] for r in history.backlog_since(landing, table).collect()) == ["c", "d"]


def test_the_history_is_not_shuffled(spark, table):
    history.remember(table, names(spark, *(f"n{k}" for k in range(500))))
    out = history.backlog_since(spark.range(900).select(F.concat(F.lit("n"), "id").alias("fileName")), table)
    assert out.count() == 400
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(n for n, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line)
    above = []  # the operators over the history, up to the join
    while "SortMergeJoin" not in lines[scan]:
        depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
        above.append(lines[scan])
        scan = next(n for n in range(scan - 1, -1, -1) if len(lines[n]) - len(lines[n].lstrip(" :+-")) < depth)
    assert not any("Exchange" in line for line in above), plan


def test_odd_table_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        history.open_history(spark, "a; b", str(tmp_path))
