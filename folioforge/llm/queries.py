"""Queries of the text-corpus operators, and SQL where SQL can express them or what must hold for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import encode, mix, scan_noise, sentences, split


def piece_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_stem, id, chars, fits, overlaps) of each block that was cut: the text its pieces make without their overlaps,
    whether none exceeds the limit, and whether each begins with the end of the one before."""
    p = split.block_pieces(spark, sf_dir).select("doc_stem", "id", "piece", "starts", "ends", "text", F.length("text").alias("n"))
    after = p.select("doc_stem", "id", (F.col("piece") - 1).alias("piece"), F.substring("text", 1, split.OVERLAP).alias("led_in"))
    met = p.join(after, ["doc_stem", "id", "piece"], "left")
    shared = F.col("led_in").isNull() | (F.substring("text", -split.OVERLAP, split.OVERLAP) == F.col("led_in"))
    own = F.col("n") - F.when(F.col("piece") > 1, split.OVERLAP).otherwise(0)
    return met.groupBy("doc_stem", "id").agg(F.sum(own).alias("chars"), (F.max("n") <= split.LIMIT).alias("fits"), F.bool_and(shared).alias("overlaps"))


def encoding_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, exact): whether the ids of a document decode to its text."""
    return encode.document_round_trip(spark, sf_dir).select("doc_id", "exact")


def share_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, close): whether a source's actual share is the fitted one up to a tenth of it, or half a percent of the whole."""
    m = mix.mixture_margins(spark, sf_dir).where("axis = 'source'")
    return m.select(F.col("value").alias("source"), (F.abs(F.col("actual") - F.col("fitted")) <= F.greatest(F.col("fitted") * 0.1, F.lit(0.005))).alias("close"))


def queries():
    return {
        "p2_found": scan_noise.noisy_blocks,
        "p2_repaired": scan_noise.repaired_blocks,
        "p3_found": split.oversized_blocks,
        "p3_pieces": split.block_pieces,
        "p3_checks": piece_checks,
        "p7_ids": encode.document_ids,
        "p7_roundtrip": encode.document_round_trip,
        "p7_checks": encoding_checks,
        "p8_mixture": mix.mixture,
        "p8_shares": mix.mixture_shares,
        "p8_margins": mix.mixture_margins,
        "p8_checks": share_checks,
        "p9_found": sentences.sentence_ends,
        "p9_sentences": sentences.sentence_units,
    }


def oracle_sql():
    return {
        "p3_found": "select distinct chunk_id, id from semantic_blocks where length(text) > 3000",
        "p3_checks": "select distinct doc_stem, id, length(text) chars, true fits, true \"overlaps\" from semantic_blocks where length(text) > 3000",
        "p7_checks": "select doc_id, true exact from documents",
        "p8_checks": "select distinct t.source, true as \"close\" from mix_targets t join documents d on d.source = t.source where length(d.text) > 0 and target_share > 0 and max_repeats > 0",
    }
