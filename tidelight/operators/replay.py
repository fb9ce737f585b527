"""Plans for depositing files into a landing zone; :mod:`tidelight.sinks.deposit` carries them out."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelight.defaults import CATEGORIES, IMAGE_EXTENSIONS, SPLITS
from tidelight.functions.paths import keep_images, keep_labeled, relative_target, with_path_columns
from tidelight.operators.ordered import with_row_index


def emissions(
    df: DataFrame,
    mode: str = "train",
    path_col: str = "path",
    splits: Sequence[str] = SPLITS,
    labels: Sequence[str] = CATEGORIES,
    extensions: Sequence[str] = IMAGE_EXTENSIONS,
    unique_names: bool = False,
) -> DataFrame:
    """Files to replay and their place below the landing zone: ``(sourcePath, relativeTarget)``.

    In ``infer`` mode equal names from different folders overwrite each other;
    ``unique_names`` puts a short hash of the path in front.
    """
    files = with_path_columns(df, path_col)
    if mode == "train":
        files = keep_labeled(files, splits, labels, extensions, path_col)
    else:
        files = keep_images(files, extensions, path_col)
    target = relative_target(mode)
    if unique_names and mode == "infer":
        target = F.concat_ws("_", F.substring(F.md5(F.col(path_col)), 1, 8), target)
    return files.select(F.col(path_col).alias("sourcePath"), target.alias("relativeTarget"))


def replay_plan(files: DataFrame, batch_size: int, limit: int | None = None) -> DataFrame:
    """Number the emissions in path order and cut them into batches.

    ``limit`` of ``None``, zero or less takes all.
    """
    numbered = with_row_index(files, "sourcePath", "relativeTarget", name="position")
    if limit is not None and limit > 0:
        numbered = numbered.where(F.col("position") < limit)
    return numbered.withColumn("batchNo", F.floor(F.col("position") / batch_size))


def deposit_plan(
    df: DataFrame,
    n: int,
    subtype: str | None = None,
    folder: str | None = None,
    path_col: str = "path",
    token: str | None = None,
) -> DataFrame:
    """The first ``n`` files in path order under names that no earlier deposit used.

    Names are ``<8 hex>_[subtype_]name``. The hex digits hash the path with a
    token drawn once per plan, so a retried task names its files alike.
    """
    token = token or uuid.uuid4().hex
    chosen = with_path_columns(df, path_col).orderBy(path_col).limit(n)
    prefix = F.substring(F.md5(F.concat(F.lit(token), F.col(path_col))), 1, 8)
    parts = [prefix, *([F.lit(subtype)] if subtype else []), F.col("fileName")]
    name = F.concat_ws("_", *parts)
    target = F.concat_ws("/", F.lit(folder), name) if folder else name
    return chosen.select(F.col(path_col).alias("sourcePath"), target.alias("relativeTarget"))
