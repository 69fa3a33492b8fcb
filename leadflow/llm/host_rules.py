"""Quality rules judged by host.

Each text is measured against five rules.  Rule failures are added up by host; a host's rate of each rule is
shrunk towards all hosts by a beta prior fitted to the hosts by moments, so that a host with few texts is not judged by
them alone:

    rate = (failures + s * m) / (texts + s),   s = m (1 - m) / between - 1

with m the rate of all texts and ``between`` the variance of the hosts' rates beyond what chance gives.  A host is out when a
shrunk rate is over ``limit``; its verdict is joined back to its texts.

Null texts have no words and fail the base rule; a null host is a host of its own.  Repeated rows count each time.  With
one host, or hosts that do not differ beyond chance, all rates become the common one.  No input, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import saved
from leadflow.llm.wordscan import grams, scan

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")
_MEASURED = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *[
    (c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")]])
_MEASURED_SQL = ("doc_id bigint, host string, n_words bigint, word_chars bigint, n_symbols bigint, "
                 "n_dup_lines bigint, n_repeat_words bigint, n_lines bigint")


def _repeat_words(h: np.ndarray) -> int:
    """Words in three-word windows that occur twice or more."""
    if len(h) < 4:
        return 0
    _, which, times = np.unique(grams(h, 3), return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(h), bool)
    for i in range(3):
        covered[i:len(h) - 2 + i] |= again
    return int(covered.sum())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in scan(batch.column("text"), lower=False):
            n = len(s.bounds) - 1
            inside = np.zeros(len(s.data) + 1, np.int64)
            np.add.at(inside, s.starts, 1)
            np.add.at(inside, s.ends, -1)
            point = (np.cumsum(inside)[:-1] > 0) & ((s.data & 0xC0) != 0x80)
            chars = np.concatenate([[0], np.cumsum(point)])[s.offsets]
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[s.data])])[s.offsets]
            lines, dups, repeats = [], [], []
            for i in range(n):
                worded = [x for x in s.data[s.offsets[i]:s.offsets[i + 1]].tobytes().split(b"\n") if x.strip()]
                lines.append(len(worded))
                dups.append(len(worded) - len(set(worded)))
                repeats.append(_repeat_words(s.hashes[s.bounds[i]:s.bounds[i + 1]]))
            rows = batch.slice(s.first, n)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("host"),
                 *[pa.array(np.asarray(x, np.int64)) for x in (
                     np.diff(s.bounds), np.diff(chars), np.diff(symbols), dups, repeats, lines)]], schema=_MEASURED)


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts of each text and which rules it fails."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(host).cast("string").alias("host"),
                       F.coalesce("text", F.lit("")).alias("text"))
    counts = rows.mapInArrow(_measure, _MEASURED_SQL)
    return counts.withColumns({
        "short": F.col("n_words") < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    })


def host_verdicts(rows: DataFrame, limit: float = 0.5) -> DataFrame:
    """``host``, its number of texts, the shrunk rate of each rule and whether it is out."""
    hosts = saved(rows.groupBy("host").agg(F.count("*").alias("n"), *[
        F.count_if(r).alias(r) for r in RULES]), "hosts")
    common = hosts.agg(*[(F.sum(r) / F.sum("n")).alias(r) for r in RULES],
                       F.avg(1 / F.col("n")).alias("per_text"), F.count("*").alias("hosts")).first()
    if not common["hosts"]:
        return hosts.select("host", "n", *[F.lit(0.0).alias(f"{r}_rate") for r in RULES], F.lit(False).alias("host_out"))
    within = {r: common[r] * (1 - common[r]) for r in RULES}
    between = hosts.agg(*[  # five numbers
        (F.sum((F.col(r) / F.col("n") - common[r]) ** 2) / max(common["hosts"] - 1, 1)
         - within[r] * common["per_text"]).alias(r) for r in RULES]).first()
    out = hosts
    for r in RULES:
        if within[r] > 0:
            strength = max(within[r] / max(between[r], within[r] / 1e6) - 1, 0.0)
            rate = (F.col(r) + strength * common[r]) / (F.col("n") + strength)
        else:
            rate = F.lit(float(common[r]))
        out = out.withColumn(f"{r}_rate", rate)
    bad = F.greatest(*[F.col(f"{r}_rate") for r in RULES]) > limit
    return out.select("host", "n", *[f"{r}_rate" for r in RULES], bad.alias("host_out"))


def judge(docs: DataFrame, host: str = "source", limit: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, ``host_out`` and ``kept``."""
    rows = saved(measured(docs, host), "measured")
    verdicts = host_verdicts(rows, limit).select(F.col("host").alias("of"), "host_out")
    joined = rows.join(verdicts, F.col("host").eqNullSafe(F.col("of")))
    base = F.col("short") | F.col("repeats")
    return joined.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "host_out", (~base & ~F.col("host_out")).alias("kept"))
