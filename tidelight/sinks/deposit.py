"""Copying planned files into a landing zone, on the executors."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelight.defaults import STAGING_DIR
from tidelight.functions.storage import locate, qualify
from tidelight.session import work_folder

_CHUNK = 4 * 1024 * 1024


def _staging() -> str:
    """A folder name of this attempt of this task alone."""
    task = TaskContext.get()
    return f"{task.stageId()}-{task.partitionId()}-{task.taskAttemptId()}" if task else uuid.uuid4().hex


def _copy(source: str, dest_fs: fs.FileSystem, root: str, staging: str, target: str) -> int:
    """Copy into the staging folder, then rename; nobody sees a half-written file."""
    source_fs, source_path = locate(source)
    final, staged = f"{root}/{target}", f"{root}/{STAGING_DIR}/{staging}/{target}"
    for path in (final, staged):
        dest_fs.create_dir(path.rpartition("/")[0], recursive=True)
    size = 0
    with source_fs.open_input_stream(source_path) as reader, dest_fs.open_output_stream(staged) as writer:
        while chunk := reader.read(_CHUNK):
            size += writer.write(chunk)
    if dest_fs.get_file_info(final).type != fs.FileType.NotFound:
        dest_fs.delete_file(final)
    dest_fs.move(staged, final)
    return size


def deposit(plan: DataFrame, dest: str, partitions: int | None = None) -> int:
    """Copy every ``(sourcePath, relativeTarget)`` of the plan below ``dest``; returns the number of files.

    Existing targets are replaced, so a retried task does no harm. Staging folders are removed by the task that made them.
    """
    dest = qualify(plan.sparkSession, dest)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = locate(dest)
        root, staging = root.rstrip("/"), _staging()
        try:
            for batch in batches:
                pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                sizes = [_copy(s, system, root, staging, t) for s, t in pairs]
                yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["bytes"])
        finally:
            folder = f"{root}/{STAGING_DIR}/{staging}"
            if system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)

    pairs = plan.select("sourcePath", "relativeTarget")
    spread = pairs.repartition(partitions) if partitions else pairs
    return spread.mapInArrow(stage, "bytes long").agg(F.count("bytes")).first()[0]


def replay(plan: DataFrame, dest: str, interval_seconds: float = 0.0, partitions: int | None = None) -> int:
    """Deposit a :func:`~tidelight.operators.replay.replay_plan` batch by batch at a fixed cadence.

    The plan is written once with a folder per batch, so a step reads its own
    rows only. The driver just keeps time; executors copy.
    """
    spark = plan.sparkSession
    top = plan.agg(F.max("batchNo")).first()[0]
    if top is None:
        raise ValueError("nothing to replay")
    written = work_folder(spark, "replay")
    plan.repartition("batchNo").write.partitionBy("batchNo").parquet(written)
    workers = partitions or spark.sparkContext.defaultParallelism
    emitted = 0
    for number in range(int(top) + 1):
        if number and interval_seconds > 0:
            time.sleep(interval_seconds)
        emitted += deposit(spark.read.parquet(f"{written}/batchNo={number}"), dest, workers)
    return emitted
