"""Columns derived from a file path, and the filters that use them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.defaults import CATEGORIES, IMAGE_EXTENSIONS, SPLITS


def unify_separators(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def strip_scheme(path: Column, scheme: str = "file:") -> Column:
    """Remove every occurrence of the scheme text."""
    return F.replace(path, F.lit(scheme), F.lit(""))


def extension_of(file_name: Column) -> Column:
    """Lower-case text after the last dot; a name without a dot is its own extension."""
    return F.lower(F.substring_index(file_name, ".", -1))


def with_path_columns(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``segments``, ``fileName``, ``label``, ``split`` and ``extension``.

    Paths look like ``.../split/label/file.ext``; columns that a short path does
    not have are NULL.
    """
    segments = F.split(unify_separators(F.col(path_col)), "/")
    from_end = {"fileName": -1, "label": -2, "split": -3}
    return (
        df.withColumn("segments", segments)
        .withColumns({name: F.try_element_at("segments", F.lit(at)) for name, at in from_end.items()})
        .withColumn("extension", extension_of(F.col("fileName")))
    )


def _any_of(words: Sequence[str]) -> str:
    return "|".join(f"\\Q{word}\\E" for word in words)


def is_image(path: Column, extensions: Sequence[str] = IMAGE_EXTENSIONS) -> Column:
    """Whether :func:`extension_of` the file is one of the given, told from the path alone.

    A single pattern over the scanned column: the filter needs none of the
    derived columns, so pushing it below them does not split the path again.
    """
    return path.rlike(rf"(?:^|[./\\])(?i:{_any_of(extensions)})$")


def is_labeled(
    path: Column,
    splits: Sequence[str] = SPLITS,
    labels: Sequence[str] = CATEGORIES,
    extensions: Sequence[str] = IMAGE_EXTENSIONS,
) -> Column:
    """Whether the path ends in ``split/label/file`` with an allowed split, label and extension."""
    folders = rf"(?:^|[/\\])(?:{_any_of(splits)})[/\\](?:{_any_of(labels)})[/\\]"
    return path.rlike(rf"{folders}(?:[^/\\]*\.)?(?i:{_any_of(extensions)})$")


def keep_images(
    df: DataFrame, extensions: Sequence[str] = IMAGE_EXTENSIONS, path_col: str = "path"
) -> DataFrame:
    return df.where(is_image(F.col(path_col), extensions))


def keep_labeled(
    df: DataFrame,
    splits: Sequence[str] = SPLITS,
    labels: Sequence[str] = CATEGORIES,
    extensions: Sequence[str] = IMAGE_EXTENSIONS,
    path_col: str = "path",
) -> DataFrame:
    return df.where(is_labeled(F.col(path_col), splits, labels, extensions))


def has_target(path: Column) -> Column:
    """Whether the folder and the file name lead to a class, told from the path alone (see ``labels.target_label``).

    Filter on this instead of the resolved id: a filter on the id repeats all that the id is made of.
    """
    # The folder names and the words of the subtypes.
    kinds = r"NORMAL[/\\][^/\\]*|PNEUMONIA[/\\][^/\\]*(?i:bacteria|virus)[^/\\]*"
    return path.rlike(rf"(?:^|[/\\])(?:{kinds})$")


def relative_target(mode: str) -> Column:
    """Where a replayed file goes below the landing zone: a tree for ``train``, flat for ``infer``."""
    if mode == "train":
        return F.concat_ws("/", "split", "label", "fileName")
    if mode == "infer":
        return F.col("fileName")
    raise ValueError(f"mode must be 'train' or 'infer', not {mode!r}")


def image_glob(extensions: Sequence[str] = IMAGE_EXTENSIONS) -> str:
    """A file glob that accepts the extensions in any letter case."""

    def any_case(ext: str) -> str:
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)

    return "*.{" + ",".join(any_case(e) for e in extensions) + "}"
