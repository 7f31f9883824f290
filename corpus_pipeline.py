"""A corpus from raw documents to token ids, in stages that each work on all their predecessor kept.

Each stage takes (spark, docs, sf_dir).  All but the last return the columns of
``documents``; the last returns ids and what they decode to.  Null, empty and very long
texts pass every stage; rows that repeat a doc_id share that document's decisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sidewise.llm import bpe, decontaminate, line_dedup, near_dedup, toxicity
from sidewise.llm.common import prepare_workers, free_name, stored, table

NEAR_WORDS, NEAR_PERCENT = 5, 80
#: A character that is not white space.
WORD = "[^\\x20\\x09-\\x0D]"


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is among ``ids``; a null doc_id may be, too."""
    gone = free_name(docs, "gone_id")
    ids = ids.select(F.col("doc_id").alias(gone)).distinct().hint("shuffle_hash")
    return docs.join(ids, docs["doc_id"].cast("bigint").eqNullSafe(F.col(gone)), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the limit of the classifier, each row by its own text."""
    prepare_workers(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = toxicity.scored(F.coalesce("text", F.lit("")), model)["score"]
    name = free_name(docs, "score")
    return docs.withColumn(name, score).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows the text.

    A document that loses lines and is left without a word was a copy of others and goes;
    one that had no words to begin with stays.
    """
    prepare_workers(spark)
    name = free_name(docs, "lines")
    cleaned = line_dedup.clean(line_dedup.build(docs), docs, name)
    emptied = (F.col(name)["n_dropped"] > 0) & ~F.coalesce("text", F.lit("")).rlike(WORD)
    cleaned = cleaned.where(~emptied).drop(name)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return cleaned


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare_workers(spark)
    groups = near_dedup.near_duplicates(docs, NEAR_WORDS, NEAR_PERCENT)
    return _without(docs, groups.where(~F.col("kept")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, packed ids, and the digests of the ids and of what they decode to."""
    import public_tokenizers

    prepare_workers(spark)
    rows = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Several stages can't be expressed in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
