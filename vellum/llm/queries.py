"""The thin queries over the whole of their tables, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gif_media, jaccard_join, langid, mixing, pii, prefix_trie, quality_ordinal, quality_rules, sentencepiece_nbest, site_tree, suffix_dedup, turn_repair, warc_archive

#: The vocabulary of SentencePiece's kind that op5 and the pipeline use.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(spark, table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_shingles")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_nbest.digests(table(spark, sf_dir, "documents"), PIECES)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(spark, table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.score(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_ordinal.train(docs, table(spark, sf_dir, "labels"), quality_ordinal.graded(F.col("quality"), F.col("toxic")))
    return quality_ordinal.score(docs, model)


def op9_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif_media.digests(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive.round_trip(spark, table(spark, sf_dir, "pages"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.main_text(spark, table(spark, sf_dir, "pages"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark, table(spark, sf_dir, "conversations"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(spark, turn_repair.damaged(table(spark, sf_dir, "conversations")), absent=F.col("absent"))


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op1 SQL can state."""
    return op1_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op7 SQL can state."""
    return op7_quality_rules(spark, sf_dir).select("doc_id", *quality_rules.BASE, "base_failed")


def gif_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op9 SQL can state."""
    return op9_gif_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_langid, op3_jaccard_join, op4_source_mixing, op5_sentencepiece, op6_suffix_dedup, op7_quality_rules, op8_quality_classifier, op9_gif_media, op10_warc, op11_html_text, op12_prefix_trie, op13_turn_repair, pii_base, rules_base, gif_payload)
}
ORACLES = {
    "op3_jaccard_join": jaccard_join.ORACLE, "op4_source_mixing": mixing.ORACLE, "op6_suffix_dedup": suffix_dedup.ORACLE, "op10_warc": warc_archive.ORACLE,
    "op11_html_text": site_tree.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE, "op13_turn_repair": turn_repair.ORACLE,
    "pii_base": pii.BASE_ORACLE, "rules_base": quality_rules.BASE_ORACLE, "gif_payload": gif_media.PAYLOAD_ORACLE,
}
