"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.llm import (collocations, decontaminate, filter_audit, host_rules, html_text, licences, line_dedup, ngram_join,
                          pieces, private, suffix_tree, toxicity, warc)
from leadflow.llm.common import table

_shipped: set[str] = set()


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, for sessions that were not started with it on their path.

    Arrow batches of whole texts are bounded at 4 MB where the session has Spark's own 64 MB: a task holds a batch several
    times over, outside the JVM's heap.
    """
    if spark.conf.get(BATCH_BYTES) in ("67108864b", "64m", "64MB"):
        spark.conf.set(BATCH_BYTES, "4m")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    files = sorted(p for p in root.rglob("*.py"))
    name = hashlib.sha1(b"".join(p.read_bytes() for p in files)).hexdigest()[:12]
    path = os.path.join(tempfile.mkdtemp(prefix="leadflow-"), f"leadflow-{name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for p in files:
            out.write(p, p.relative_to(root.parent).as_posix())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def _on(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return job(spark, sf_dir)
    return run


def _op1(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, d, "documents"), words=3, percent=90).drop("text_key")


def _op2(spark: SparkSession, d: str) -> DataFrame:
    return suffix_tree.suffix_tree_scores(table(spark, d, "documents"))


def _op3(spark: SparkSession, d: str) -> DataFrame:
    return host_rules.judge(table(spark, d, "documents")).drop("host")


def _op4(spark: SparkSession, d: str) -> DataFrame:
    return licences.licence_scan(table(spark, d, "documents")).select(
        "doc_id", "n_sentences", F.array_join("licences", ",").alias("licences"))


def _op5(spark: SparkSession, d: str) -> DataFrame:
    index = warc.write_archives(table(spark, d, "pages"), warc.archive_folder(spark))
    return warc.read_records(index, with_payload=False).drop("payload", "url")


def _op6(spark: SparkSession, d: str) -> DataFrame:
    cut = line_dedup.drop_repeated_lines(table(spark, d, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.char_length("text").cast("bigint").alias("chars_left"),
                      F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _op7(spark: SparkSession, d: str) -> DataFrame:
    coded = pieces.encode_texts(table(spark, d, "documents"), verify=True)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
                        "round_trip", "parity")


def _op8(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "contaminated", F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"),
                        "n_windows")


def _op9(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.scored(table(spark, d, "documents"), table(spark, d, "labels"))


def _op10(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, d, "pages"))


def _op11(spark: SparkSession, d: str) -> DataFrame:
    return private.personal_data(table(spark, d, "documents"))


def _op12(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"))


def _op13(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, d, "documents"), table(spark, d, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": _on(_op1),
    "op2_lm_scoring": _on(_op2),
    "op3_quality_rules": _on(_op3),
    "op4_license_scans": _on(_op4),
    "op5_warc": _on(_op5),
    "op6_line_dedup": _on(_op6),
    "op7_sentencepiece": _on(_op7),
    "op8_decontamination": _on(_op8),
    "op9_toxicity": _on(_op9),
    "op10_html_extraction": _on(_op10),
    "op11_pii": _on(_op11),
    "op12_collocations": _on(_op12),
    "op13_filter_audit": _on(_op13),
}
