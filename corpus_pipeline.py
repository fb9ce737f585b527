"""Cleaning a corpus for training, stage by stage.

Every stage takes the session, its predecessor's documents and the folder of the tables. :func:`run` writes what each stage
returns to the shared folder and reads it again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelight.llm import lines, mixing, neardup, pieces, quality
from tidelight.llm.queries import DOMAIN_WEIGHTS, PIECE_MODEL, label_domain
from tidelight.llm.tables import SMALL_BATCH, arrow_batches, table
from tidelight.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or come from a rejected host go."""
    with arrow_batches(spark, SMALL_BATCH):
        return quality.keep_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first of them; no document goes."""
    return lines.dedup_lines(docs).select(*(f"`{c}`" for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one of the smallest id."""
    with arrow_batches(spark, SMALL_BATCH):
        return neardup.keep_first(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are thinned towards the domains' target weights; none is repeated."""
    labels = table(spark, sf_dir, "labels")
    return mixing.mix_documents(docs, labels, label_domain(), DOMAIN_WEIGHTS, max_rate=1.0)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns, their ``ids``, and whether these decode to the text."""
    encoded = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL, to="decoded")
    keep = [c for c in encoded.columns if c != "decoded"]
    return encoded.selectExpr(*(f"`{c}`" for c in keep), "decoded <=> text AS round_trip")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_to_targets", mix_to_targets),
    ("encode_pieces", encode_pieces),
]

# Sampling, classes and encodings are not expressible; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
