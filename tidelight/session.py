"""Session set-up for local runs, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelight.functions.storage import qualify


def small_file_conf(listing_tasks: int = 64) -> dict[str, str]:
    """Settings for jobs that read very many small files.

    Files are packed many to a task, and a batch of a stream is not listed with
    one task per file.
    """
    return {
        "spark.sql.files.openCostInBytes": "65536",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(listing_tasks),
    }


def image_conf(rows_per_arrow_batch: int = 64) -> dict[str, str]:
    """Settings for jobs that carry decoded images through Python workers.

    A decoded image takes megabytes, so the default of 10 000 rows per Arrow
    batch would need tens of gigabytes per task.
    """
    return small_file_conf() | {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_per_arrow_batch)}


#: Files that a stream's source log takes in before it is written anew as a whole.
_FILES_PER_LOG = 200_000


def file_stream_conf(files_per_batch: int, listing_tasks: int) -> dict[str, str]:
    """:func:`small_file_conf` for a file stream, with a source log that is rewritten for every so many files.

    Spark rewrites the log of all files seen so far every ten batches, however small they are, which is quadratic in
    the number of batches. Without a limit per batch that stays as it is.
    """
    interval = max(10, _FILES_PER_LOG // files_per_batch) if files_per_batch > 0 else 10
    return small_file_conf(listing_tasks) | {"spark.sql.streaming.fileSource.log.compactInterval": str(interval)}


#: Files of a local folder that the driver looks up sooner than a job does.
_LOOKED_UP = 1_000


@contextmanager
def file_stream_settings(spark: SparkSession, files_per_batch: int = 0, incoming: str | None = None) -> Iterator[None]:
    """:func:`file_stream_conf` on the session of a file stream while the block runs, one listing task per core at most.

    Where ``incoming`` is a folder on a local file system, the driver looks up the files of a small batch without a job.
    The source reads these settings from the session that its reader was made with, at every batch, so the block must
    hold the start and the end of the query.
    """
    wanted = file_stream_conf(files_per_batch, min(64, max(1, spark.sparkContext.defaultParallelism)))
    if incoming and 0 < files_per_batch <= _LOOKED_UP and re.match("file:", qualify(spark, incoming)):
        wanted["spark.sql.sources.parallelPartitionDiscovery.threshold"] = str(_LOOKED_UP)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cpus: int | str = "*", app: str = "tidelight", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in (settings | small_file_conf() | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folder below which work folders lie while a :func:`scratch` is open.
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def _shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^-]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="tidelight-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint directory.

    The cluster names the directory in ``spark.checkpoint.dir``. Only a session in a single process without that
    setting falls back to a temporary folder, because no other process has to see it.
    """
    return f"{_scratch.get() or _shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, purpose: str = "scratch") -> Iterator[str]:
    """A folder that holds all work folders made inside the block, and is removed at its end.

    Results must be collected or written elsewhere before.
    """
    folder = f"{_shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage, and pins values that depend on how rows were partitioned,
    so a lost executor cannot change them.
    """
    target = work_folder(df.sparkSession, "settled")
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def discard(*settled: DataFrame) -> None:
    """Remove the folders of tables that :func:`settle` returned; nothing may read them, or what was made of them, after that."""
    for df in settled:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            if not folder.rpartition("/")[2].startswith("settled-"):
                raise ValueError(f"not a settled table: {folder}")
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them ends, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark ``df`` for broadcast only after counting that it has at most ``max_rows`` rows."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
