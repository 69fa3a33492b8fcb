"""The filter audit against its SQL's rules written out, on hand-made texts."""

from __future__ import annotations

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from leadflow.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(250))
TEXTS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (3, LONG, "de"), (4, None, "en"), (5, "", None), (6, "", ""),
    (7, "word " * 250, "en"), (8, "CAPS " * 300, "de"), (9, LONG + " # $", "fr"), (10, LONG + " # $", "fr"), (None, LONG, "en"),
    (None, LONG, "en"), (11, "a b c d é 漢字", "fr"), (12, LONG.upper(), "en"), (13, "x | y", "fr"), (0, LONG + " # $", None),
    (14, "\n\t " + LONG.replace(" ", "\v\f\r "), "en"), (15, "MiXeD " * 5 + LONG, "en"), (16, " ".join(f"t{i}" for i in range(200_000)), "en")]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 1, 0), (3, 0, 1), (7, 0, 1), (8, 1, 1), (9, 1, 0), (10, 1, None), (None, 1, 1), (12, None, 1), (99, 1, 1)]


def by_walking(texts, labels):
    """Every order applied text by text."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    flags = []
    for doc, text, lang in texts:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in texts)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": earlier}
        flags.append((doc, lang or "", {f for f, x in fails.items() if x}))
    out = {}
    for part in {p for _, p, _ in flags}:
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = [(d, f) for d, p, f in flags if p == part], []
            for step, name in enumerate(order, 1):
                here = [(d, f) for d, f in left if name in f]
                left = [(d, f) for d, f in left if name not in f]
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(name in f for _, f in gone),
                    sum(f == {name} for _, p, f in flags if p == part),
                    sum(d in good for d, _ in here), sum(d in toxic for d, _ in here)]
                gone += here
                removed_by[name] += len(here)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(docs, labels):
    got = filter_audit.filter_audit(docs, labels).collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in got}
    assert len(out) == len(got)
    return out


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(*r, n, "x", 7) for n, r in enumerate(TEXTS)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, part int, digest string, n int").repartition(3),
            spark.createDataFrame([(*r, 3) for r in LABELS], "doc_id long, quality int, toxic int, part int"))


def test_against_walking(frames):
    assert run(*frames) == by_walking(TEXTS, LABELS)


def test_without_labels_or_texts(frames):
    docs, labels = frames
    assert run(docs, labels.limit(0)) == by_walking(TEXTS, [])
    assert run(docs.limit(0), labels) == {}


def test_repeated_rows_count_each_time(frames):
    docs, labels = frames
    assert run(docs.union(docs), labels.union(labels)) == by_walking(TEXTS + TEXTS, LABELS)


def test_potential_gives_the_mean_over_orders(spark):
    rows = [("p", s, s * s % 23 + 1, 0, 0) for s in range(32)]
    counts = spark.createDataFrame(rows, "part string, failed int, n long, good long, toxic long")
    got = filter_audit.worths(counts).select("worth", filter_audit.potential(F.col("worth")).alias("p")).first()
    assert len(got.p) == 32 and got.p[0] == 0
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[:order.index(i)])
            total += got.worth[before | 1 << i] - got.worth[before]
        assert 2 * (got.p[31] - got.p[31 - (1 << i)]) == total


def test_a_copied_text_meets_once_a_task(frames):
    plan = filter_audit.filter_audit(*frames)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
