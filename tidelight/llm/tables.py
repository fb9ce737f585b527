"""Reading, naming and sampling shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (in any letter case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_documents(df: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """``df`` with a new text, under the given columns; ``n_chars`` follows the text where it exists."""
    new = {"text": text} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in columns else {})
    return df.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns))


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id written as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


#: Bytes of texts on their way to Python, of which an executor holds several copies for each task; Spark's limit is 64 MB.
SMALL_BATCH = 4 << 20


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Jobs run inside the block send at most about ``most_bytes`` to Python at once, so neither side holds tens of megabytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)
