"""From folder and file names to class names and ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.defaults import CLASS_IDS, CLASS_NAMES, UNKNOWN_CLASS


def _has(file_name: Column, word: str) -> Column:
    return F.contains(F.lower(F.trim(file_name)), F.lit(word))


def target_label(label: Column, file_name: Column) -> Column:
    """Class name, or NULL where :func:`label_error` has a text."""
    subtype = F.when(_has(file_name, "bacteria"), "PNEUMONIA_BACTERIA").when(
        _has(file_name, "virus"), "PNEUMONIA_VIRUS"
    )
    return F.when(label == "NORMAL", "NORMAL").when(label == "PNEUMONIA", subtype)


def label_error(label: Column, file_name: Column) -> Column:
    """Why no class could be resolved; NULL when it could."""
    # The message texts.
    no_subtype = F.concat(F.lit("Unable to resolve pneumonia subtype from filename : "), file_name)
    bad_label = F.concat(
        F.lit("Unsupported raw label '"), F.coalesce(label, F.lit("null")), F.lit("' for file: "), file_name
    )
    reason = F.when(label == "PNEUMONIA", no_subtype).otherwise(bad_label)
    return F.when(target_label(label, file_name).isNull(), reason)


def _map_literal(entries: Mapping) -> Column:
    return F.create_map(*[F.lit(part) for pair in sorted(entries.items()) for part in pair])


def class_id(name: Column, class_ids: Mapping[str, int] = CLASS_IDS) -> Column:
    """Id of a class name; NULL when the mapping lacks it."""
    return F.try_element_at(_map_literal(class_ids), name).cast("int")


def class_id_error(name: Column, class_ids: Mapping[str, int] = CLASS_IDS) -> Column:
    missing = name.isNotNull() & class_id(name, class_ids).isNull()
    return F.when(missing, F.concat(F.lit("Missing label mapping for '"), name, F.lit("'")))


def class_name(label_id: Column, names: Mapping[int, str] = CLASS_NAMES) -> Column:
    """Name of a class id, ``UNKNOWN`` when the mapping lacks it."""
    return F.coalesce(F.try_element_at(_map_literal(names), label_id), F.lit(UNKNOWN_CLASS))


def label_table(df: DataFrame, class_ids: Mapping[str, int] = CLASS_IDS) -> DataFrame:
    """The mapping as a two-column table."""
    schema = T.StructType(
        [T.StructField("labelId", T.IntegerType(), False), T.StructField("labelName", T.StringType(), False)]
    )
    return df.sparkSession.createDataFrame([(v, k) for k, v in sorted(class_ids.items())], schema)


def with_label_name(
    df: DataFrame, id_col: str = "labelId", class_ids: Mapping[str, int] = CLASS_IDS
) -> DataFrame:
    """Join form of :func:`class_name`; the mapping is a driver-side dict, so its broadcast is small."""
    names = label_table(df, class_ids).withColumnRenamed("labelId", "_id")
    joined = df.join(F.broadcast(names), df[id_col] == names["_id"], "left").drop("_id")
    return joined.withColumn("labelName", F.coalesce("labelName", F.lit(UNKNOWN_CLASS)))


def with_label_id(
    df: DataFrame, name_col: str = "labelName", class_ids: Mapping[str, int] = CLASS_IDS
) -> DataFrame:
    """Join form of :func:`class_id`."""
    ids = label_table(df, class_ids).withColumnRenamed("labelName", "_name")
    return df.join(F.broadcast(ids), df[name_col] == ids["_name"], "left").drop("_name")


def with_target_class(df: DataFrame, class_ids: Mapping[str, int] = CLASS_IDS) -> DataFrame:
    """Add ``targetLabel``, ``labelId`` and ``labelError`` to rows with ``label`` and ``fileName``.

    ``labelError`` is set exactly where ``labelId`` is NULL. Filter on the id:
    a pushed-down filter repeats what its column is made of, and the error text is long.
    """
    label, name = F.col("label"), F.col("fileName")
    return df.withColumn("targetLabel", target_label(label, name)).withColumns(
        {
            "labelId": class_id(F.col("targetLabel"), class_ids),
            "labelError": F.coalesce(
                label_error(label, name), class_id_error(F.col("targetLabel"), class_ids)
            ),
        }
    )
