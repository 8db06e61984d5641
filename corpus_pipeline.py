"""A pipeline from raw documents to token ids: five stages, each over all that the stage before it kept.

An empty table passes through all stages and gives an empty result. What a stage does with nulls, ties, repeated rows and clashing names its docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import jaccard_join, mixing, pii, quality_rules, sentencepiece_nbest
from vellum.llm.queries import PIECES, table
from vellum.llm.scratch import save

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the trees go. A null or empty text has no words and goes; of repeated rows all stay or go; very long texts are read whole; further columns pass through. Without labels the trees keep
    all that the base rules keep."""
    return quality_rules.keep(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest id, and of rows that are alike one. Documents with null or empty texts all stay; a null id comes last; further columns of any name pass through."""
    return jaccard_join.one_of_each(spark, docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets, and n_chars is counted anew. A null text stays null; repeated rows stay alike; further columns pass through."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights, and all copies shuffled. A null source is one of its own; a null id counts as the empty text; repeated rows are drawn alike; further columns pass through, those named like
    the operator's defaults too (not names that begin with __mix)."""
    return mixing.mix(docs, copy_col="__mix_copy", key_col="__mix_key").select(*[F.col(f"`{c}`") for c in docs.columns])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's best segmentation and the next best ones, as doc_id and digests alone. A null text counts as empty; repeated rows give equal rows."""
    return sentencepiece_nbest.digests(docs, PIECES)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_copies),
    ("PII", privacy),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

#: SQL can express neither the trees nor the segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(spark, stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
