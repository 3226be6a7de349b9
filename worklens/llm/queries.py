"""One query per operator over its whole table; each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    alignment,
    jaccard,
    leaks,
    neighbours,
    packing,
    pii,
    pitman_yor,
    quality,
    resampling,
    secrets,
    suffixes,
    token_counts,
    token_files,
)
from .common import fresh_path
from .digests import count_of, joined_spans, of_kinds, sha256
from .settings import END_ID, table, vocabulary


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a new ledger."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = fresh_path(spark, "ledger")
    secrets.scan(docs, ledger)
    found = F.col("found")
    return secrets.findings(docs, ledger, ["doc_id"]).select(
        "doc_id",
        *(count_of(found, kind).alias(f"n_{kind}") for kind in secrets.BASE),
        sha256(joined_spans(of_kinds(found, secrets.BASE))).alias("base_sha256"),
        joined_spans(found).alias("spans"),
    )


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold passages of the benchmark."""
    found = leaks.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.size("items").cast("long").alias("n_items"),
        F.col("items").alias("item_ids"),
        "n_tokens",
        F.array_join(
            F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))),
            ",",
        ).alias("spans"),
    )


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity class of every document, and how many others are similar to it."""
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op4_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document, a seventh of them held out of the model."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return pitman_yor.scores(table(spark, sf_dir, "documents"), held_out)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, by patterns and by bootstrapped contexts."""
    found = pii.detect(table(spark, sf_dir, "documents"))
    base, every = F.col("spans"), F.concat("spans", "extra")
    ordered = F.transform(
        F.array_sort(
            F.transform(
                every,
                lambda x: F.struct(
                    pii.kind_rank(x["kind"]).alias("rank"), x["start"], x["end"], x["kind"]
                ),
            )
        ),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
    )
    return found.select(
        "doc_id",
        *(count_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS),
        sha256(joined_spans(base)).alias("base_sha256"),
        joined_spans(ordered).alias("spans"),
    )


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that occur again."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), END_ID)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files and read back."""
    folder = fresh_path(spark, "ids")
    token_files.write(
        table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"), END_ID
    )
    return token_files.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps, with how probably each is bad."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    labels = table(spark, sf_dir, "labels")
    judged = quality.classify(docs, labels, F.col("source"), F.col("lang"))
    return judged.where(quality.KEEP).select(
        "doc_id", "source", "lang", F.col(quality.BAD).alias("bad_probability")
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers."""
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens every document has."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and the rank of those drawn."""
    return resampling.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_leaks": op2_leaks,
    "op3_jaccard": op3_jaccard,
    "op4_scores": op4_scores,
    "op5_pii": op5_pii,
    "op6_suffixes": op6_suffixes,
    "op7_packing": op7_packing,
    "op8_neighbours": op8_neighbours,
    "op9_token_files": op9_token_files,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_token_counts": op12_token_counts,
    "op13_resampling": op13_resampling,
    "pipeline": corpus_pipeline.run,
}

#: The same rows as SQL for DuckDB, where SQL can express them on whole tables.
ORACLE: dict[str, str] = {}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
