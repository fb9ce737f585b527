import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelight.operators import kpi, timeline
from tidelight.operators.ordered import STRETCH, ordered_scan, salted_lookup, segmented_previous, with_row_index


@pytest.mark.parametrize("levels, step", [(0, 1), (1, 1), (2, 1), (3, 2**20)])
def test_scan_equals_pandas(spark, levels, step):
    rng = np.random.default_rng(levels)
    positions = np.unique(rng.integers(-3 * STRETCH * step, 3 * STRETCH * step, 500) // step * step)
    frame = pd.DataFrame({"p": positions, "v": rng.integers(-9, 9, len(positions))})
    df = spark.createDataFrame(frame).repartition(5)
    got = ordered_scan(df, "p", step, ["v"], ["p"], ["p"], ["v"], levels=levels).toPandas().sort_values("p")
    assert (got.v_run.to_numpy() == frame.v.cumsum().to_numpy()).all()
    assert (got.p_prev.to_numpy()[1:] == positions[:-1]).all() and pd.isna(got.p_prev.iloc[0])
    assert (got.p_next.to_numpy()[:-1] == positions[1:]).all() and pd.isna(got.p_next.iloc[-1])
    assert set(got.v_all) == {frame.v.sum()}


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(7)
    got = with_row_index(df, "k").toPandas().sort_values("rowIndex")
    assert got.rowIndex.tolist() == list(range(5000))
    assert got.k.is_monotonic_increasing


def test_salted_lookup_with_one_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 5).cast("long").alias("k"))
    table = spark.createDataFrame([(k, k * 10) for k in range(4)], "k long, v long")
    got = salted_lookup(df, table, "k", "id")
    expected = df.join(table, "k")
    assert sorted(got.select("id", "v").collect()) == sorted(expected.select("id", "v").collect())


def frame_of(spark, rows):
    df = spark.createDataFrame(rows, "sourcePath string, d double, p double")
    ts = {"depositedAt": F.timestamp_micros((F.col("d") * 1_000_000).cast("long")),
          "processedAt": F.timestamp_micros((F.col("p") * 1_000_000).cast("long"))}
    return df.withColumns(ts).drop("d", "p")


def random_rows(seed, n=400, span=3000, repeat=True):
    rng = np.random.default_rng(seed)
    d = np.round(rng.uniform(0, span, n), 3)
    if repeat:  # a third of all rows share one instant
        d[: n // 3] = 1234.5
    p = np.round(d + rng.exponential(20, n), 3)
    return [(f"s{k:04d}", float(d[k]), None if k % 37 == 5 else float(p[k])) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_queue_level_equals_pandas(spark, seed):
    rows = random_rows(seed)
    events = timeline.queue_events([frame_of(spark, rows), None, spark.range(1)])
    pdf = pd.DataFrame(rows, columns=["s", "d", "p"])
    steps = pd.concat([pd.DataFrame({"t": pdf.d, "x": 1}), pd.DataFrame({"t": pdf.p, "x": -1})]).dropna()
    steps["t"] = pd.to_datetime((steps.t * 1e6).round().astype("int64"), unit="us")
    levels = steps.groupby("t").x.sum().cumsum()
    got = timeline.queue_changes(events).toPandas().sort_values("t")
    assert got.level.tolist() == levels.tolist()
    grid = levels.resample("1s").last().ffill()
    got = timeline.queue_level(events).toPandas().sort_values("t")
    assert got.level.tolist() == grid.astype(int).tolist()
    assert got.t.tolist() == grid.index.tolist()
    tail = timeline.queue_level(events, last=90).toPandas().sort_values("t")
    assert tail.level.tolist() == grid.astype(int).tolist()[-90:]


def test_queue_level_across_a_long_silence(spark):
    df = frame_of(spark, [("a", 0.0, 500_000.0), ("b", 1.0, 2.0)])
    got = timeline.queue_level(timeline.queue_events([df]))
    assert got.count() == 500_001
    assert {tuple(r) for r in got.groupBy("level").count().collect()} == {(1, 499_999), (2, 1), (0, 1)}


def test_no_usable_frame_gives_nothing(spark):
    assert timeline.queue_events([None, spark.range(1)]) is None


def test_pause_of_exactly_the_gap_does_not_split(spark):
    df = frame_of(spark, [("a", 0.0, 10.0), ("b", 0.0, 70.0), ("c", 0.0, 130.001), ("d", 100.0, 131.0), ("e", 1.0, None)])
    runs = [(r.runId, r.rows) for r in timeline.runs(df).orderBy("runId").collect()]
    assert runs == [(1, 2), (2, 2)]
    assert {r.sourcePath: r.runId for r in timeline.assign_runs(df, spread_by="sourcePath").collect()} == {
        "a": 1, "b": 1, "c": 2, "d": 2}
    facts = timeline.last_run_kpis(df).first()
    assert facts.images == 2 and facts.depositSeconds == 100.0 and facts.totalSeconds == 131.0
    assert facts.medianLatency == (130.0 + 31.0) / 2


def test_runs_equal_pandas(spark):
    rows = random_rows(5, n=120, span=9000)
    proc = pd.Series([p for _, _, p in rows if p is not None]).sort_values()
    expected = (proc.diff() > 60).cumsum().value_counts().sort_index().tolist()
    got = [r.rows for r in timeline.runs(frame_of(spark, rows)).orderBy("runId").collect()]
    assert got == expected


def test_short_run_counts_one_second(spark):
    facts = timeline.last_run_kpis(frame_of(spark, [("a", 5.0, 5.2), ("b", 5.1, 5.4)])).first()
    assert (facts.depositSeconds, facts.totalSeconds, facts.depositRate) == (1.0, 1.0, 2.0)


def test_buckets_are_zero_filled_and_cut(spark):
    df = frame_of(spark, [("a", 0.2, 1.0), ("b", 0.9, 1.0), ("c", 7.0, 1.0)])
    got = timeline.events_per_bucket(df, "depositedAt").toPandas().sort_values("depositedAt")
    assert got.images.tolist() == [2, 0, 0, 0, 0, 0, 0, 1]
    assert timeline.events_per_bucket(df, "depositedAt", last=3).count() == 3
    assert timeline.events_per_bucket(df.limit(0), "depositedAt").count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_summary_equals_pandas(spark, n):
    rows = random_rows(n, n=n)
    df = frame_of(spark, rows).withColumn("predictedLabelId", F.length("sourcePath") % 2)
    pdf = pd.DataFrame(rows, columns=["s", "d", "p"])
    latency = ((pdf.p * 1e6).round() - (pdf.d * 1e6).round()) / 1e6
    got = kpi.kpi_summary(df, df.limit(0)).first()
    assert (got.predictions, got.rejected) == (n, 0)
    assert got.medianLatency == pytest.approx(latency.round(1).median())


def test_summary_of_nothing(spark):
    empty = frame_of(spark, []).withColumn("predictedLabelId", F.lit(1))
    got = kpi.kpi_summary(empty).first()
    assert (got.predictions, got.rejected, got.positiveRate, got.medianLatency) == (0, 0, None, None)


@pytest.mark.parametrize("number", [1, 2, 13, 40, 41, 999])
def test_pages_equal_slices(spark, number):
    rows = random_rows(3)
    df = frame_of(spark, rows)
    order = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    start = (min(number, 40) - 1) * 10
    got = [r.sourcePath for r in kpi.page(df, number, 10, ["sourcePath", "nothing"]).collect()]
    assert got == [r[0] for r in order[start : start + 10]]


def test_limits_and_deltas(spark):
    df = spark.range(5)
    assert [kpi.bounded_total(df, n).first().total for n in (None, 0, -1, 3, 9)] == [5, 5, 5, 3, 5]
    with pytest.raises(Exception, match="No images found"):
        kpi.bounded_total(df.limit(0)).collect()
    shots = spark.createDataFrame([(1, 10, 5), (2, 12, 5), (3, 9, 6)], "at int, n int, m int")
    got = [(r.nDelta, r.mDelta) for r in kpi.kpi_delta(shots, "at", ["n", "m"]).orderBy("at").collect()]
    assert got == [(None, None), (2, None), (-3, 1)]
    assert kpi.page_count(df.limit(0)).first().pages == 1


def test_backlog_ignores_absent_frames(spark):
    landing = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "fileName string")
    done = spark.createDataFrame([("b",), ("b",), (None,)], "fileName string")
    assert sorted(r[0] for r in kpi.backlog(landing, done, None, spark.range(1)).collect()) == ["a", "c"]
    assert kpi.backlog(landing).count() == 3


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours_inside_segments_of_any_size(spark, parts):
    rows = [(None if k % 5 == 4 else 0 if k % 5 else 1 + k, k * 37 % 1_000, k) for k in range(1_000)]
    df = spark.createDataFrame(rows, "view int, at int, n int").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = segmented_previous(df, "view", ["at"], ["n"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = set()
    for view in {r[0] for r in rows}:
        held = sorted((r for r in rows if r[0] == view), key=lambda r: r[1])
        expected |= {(*row, before) for row, before in zip(held, [None, *(r[2] for r in held)])}
    assert {(r.view, r.at, r.n, r.n_prev) for r in got} == expected and len(got) == 1_000
