"""Corpus pipeline: documents through five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.llm import decontaminate, line_dedup, ngram_join, pieces, toxicity
from leadflow.llm.common import WORD, saved, settle, table
from leadflow.llm.queries import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    Null and empty texts have no evidence and stay; repeated rows share their verdict; at a score of exactly one half a
    document goes.  Without labels of both kinds nothing goes.  Columns of any name pass through.
    """
    ship(spark)
    settle(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match earlier ones go, and documents of which no word is left.

    Null and blank texts have no lines and stay; of repeated rows each keeps the lines of the first; of equal lines the
    one of the smallest id stays.  Columns of any name pass through; ``n_chars`` follows the text.
    """
    ship(spark)
    settle(spark)
    kept = line_dedup.cut_lines(docs).where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("row.n_chars")) \
            .cast(docs.schema["n_chars"].dataType)
    return kept.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays: that of the smallest id, of equal rows any.

    Null and empty texts all stay; a null id counts as the largest.  Columns of any name pass through.
    """
    ship(spark)
    settle(spark)
    return ngram_join.one_of_each(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go.

    Null and empty texts hold none and stay; repeated rows share their verdict; rows of one id go by their own texts.  An
    empty benchmark takes nothing.  Columns of any name pass through.
    """
    ship(spark)
    settle(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and whether they decode to it and are SentencePiece's own.

    Null and empty texts have no ids; repeated rows are encoded each time; other columns are not read.
    """
    ship(spark)
    settle(spark)
    return pieces.encode_texts(docs, verify=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip", "parity")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", tokenize),
]

#: Learnt scores and tokenizer ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
