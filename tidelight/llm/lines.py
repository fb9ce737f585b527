"""Line dedup: lines that several documents hold stay only in the first of them.

Lines are exploded, normalised and hashed; one aggregation finds the smallest and the largest document of each hash, which
differ exactly when two documents hold the line. Only these hashes go back to the lines, and only the positions to
drop go back to the documents, which are put together again in the order of their own line arrays.

* A null or empty text is one empty line. A null ``doc_id`` comes after all others, and all such rows count as one document.
* Rows that repeat a ``doc_id`` count as one document, each keeping its own text.
* Columns other than ``doc_id``, ``text`` and ``n_chars`` pass through, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.llm.tables import as_documents, fresh
from tidelight.session import settle

WHITE_SPACE = " \t\n\x0b\f\r"
_LAST = 2**63 - 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, with A to Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE_SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def _digest(key: Column) -> list[Column]:
    """128 bits in two columns: one seed would give false matches among many billion lines."""
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit(1), key).alias("_h2")]


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_documents: int = 2) -> DataFrame:
    """``docs`` with deduplicated texts, and the long columns ``n_lines`` (before) and ``n_dropped``.

    Lines of at least ``min_chars`` code points after normalisation that ``min_documents`` or more documents hold are
    dropped from all of them but the one with the smallest ``doc_id``. A column that is already called
    ``n_lines`` or ``n_dropped`` is replaced.
    """
    holder, lines, row_key = (fresh(docs, name) for name in ("_holder", "_lines", "_row_key"))
    held = docs.withColumns(
        {
            holder: F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)),
            row_key: F.xxhash64(F.coalesce("text", F.lit(""))),
            lines: F.split(F.coalesce("text", F.lit("")), "\n", -1),
        }
    )
    found = (
        held.select(F.col(holder).alias("_doc"), F.col(row_key).alias("_row"), F.posexplode(lines).alias("_pos", "_line"))
        .select("_doc", "_row", "_pos", line_key(F.col("_line")).alias("_key"))
        .where(F.char_length("_key") >= min_chars)
        .select("_doc", "_row", "_pos", *_digest(F.col("_key")))
    )
    if min_documents == 2:
        shared = found.groupBy("_h1", "_h2").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
        shared = shared.where("_first < _last")
    else:
        each = found.select("_h1", "_h2", "_doc").distinct()
        shared = each.groupBy("_h1", "_h2").agg(F.min("_doc").alias("_first"), F.count("*").alias("_n"))
        shared = shared.where(F.col("_n") >= min_documents)
    shared = settle(shared.select("_h1", "_h2", "_first"))
    doc, row, drop = (fresh(held, name) for name in ("_doc", "_row", "_drops"))
    drops = (
        found.join(shared, ["_h1", "_h2"])
        .where("_doc > _first")
        .groupBy(F.col("_doc").alias(doc), F.col("_row").alias(row))
        .agg(F.collect_set("_pos").alias(drop))
    )
    joined = held.drop("text").join(drops, (F.col(holder) == F.col(doc)) & (F.col(row_key) == F.col(row)), "left")
    at = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(at, F.col(drop)), lambda p: F.get(F.col(lines), p))
    text = F.array_join(F.when(F.col(drop).isNull(), F.col(lines)).otherwise(kept), "\n")
    counted = joined.withColumns(
        {
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long"),
        }
    )
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return as_documents(counted, text, [*rest, "n_lines", "n_dropped"])
