"""What the document operators send through exchanges and leave in the scratch folder."""

import re
from pathlib import Path

import numpy as np
import pytest

from leadflow.llm import decontaminate, line_dedup, ngram_join, suffix_tree
from leadflow.llm.common import split_by


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture()
def few_copies(spark):
    words = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(40)]
    rows = [(i, w) for i, w in enumerate(words)] + [(100, words[0]), (100, words[0]), (None, words[1]), (101, None), (102, " ")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_split_by_loses_no_row(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, i * 31) for i in range(500)], "id long, key long")
    wanted = rows.where("id is null or id % 5 = 0").selectExpr("id as of", "key as bits")
    some, rest = split_by(rows, ["id", "key"], wanted, ["of", "bits"])
    assert sorted(map(str, some.union(rest).collect())) == sorted(map(str, rows.collect()))
    assert rest.where("id is null or id % 5 = 0").count() == 0
    assert rest.count() > 300


def test_whole_texts_take_no_exchange(spark, few_copies):
    cut = line_dedup.cut_lines(few_copies)
    assert "LeftAnti" in _plan(cut)
    got = {(r["row"]["doc_id"], r["text"], r["n_dropped"]) for r in cut.collect()}
    text = dict(few_copies.where("doc_id < 40").collect())
    assert {(i, text[i], 0) for i in range(2, 40)} <= got
    assert (100, "", 1) in got and (1, "", 1) in got and (None, text[1], 0) in got and (101, None, 0) in got


def test_line_dedup_leaves_no_tables_of_its_steps(spark, few_copies):
    line_dedup.cut_lines(few_copies).collect()
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(root.iterdir())
    assert line_dedup.cut_lines(few_copies).count() == few_copies.count()
    left = {re.sub("-[0-9a-f]+$", "", p.name) for p in set(root.iterdir()) - before}
    assert not left & {"lines", "line-firsts", "met-lines", "line-sets", "line-links", "late-sets"}


def test_one_of_each_moves_texts_once(spark, few_copies):
    left = ngram_join.one_of_each(few_copies, 3, 90)
    plan = _plan(left)
    assert "LeftAnti" in plan and "LeftSemi" in plan
    window = re.search(r"Window .*row_number.*windowspecdefinition\((\w+)#\d+L, (\w+)#\d+L", plan)
    assert window and window.groups() == ("known", "key")  # the columns the join has dealt the rows out by
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == [(False, i) for i in range(40)] + [(False, 101), (False, 102)]


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 7])
def test_decontamination_broadcasts_hashes_alone(spark, monkeypatch, block):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(8)]
    bench = spark.createDataFrame([*items, (20, items[3][1]), (21, None), (22, "short one")], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before {text} behind") for i, text in items[:5]] + [(9, "nothing of it"), (10, None)],
                                 "doc_id long, text string")
    broadcast, sent = decontaminate.F.broadcast, []
    monkeypatch.setattr(decontaminate.F, "broadcast", lambda df: sent.append((df.columns, df.count())) or broadcast(df))
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    got = {r.doc_id: (r.item_ids, r.n_windows) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {0: ([0], 5), 1: ([1], 5), 2: ([2], 5), 3: ([3, 20], 10), 4: ([4], 5), 9: ([], 0), 10: ([], 0)}
    assert {tuple(columns) for columns, _ in sent} == {("hash",)}
    assert sum(n for _, n in sent) == 40  # equal windows of two items are one hash
    assert len(sent) == 1 + 40 // block


@pytest.mark.parametrize("values", [
    np.array([], np.uint64), np.array([7], np.uint64), np.array([5, 4, 5, 2**64 - 1, 0, 4], np.uint64),
    np.array([9, 8, 9, 8, 3], np.uint32), np.array([1, 0, 1, 0, 3, 2], np.uint64) + np.uint64(1 << 60),
    np.random.default_rng(1).integers(0, 2**64 - 1, 999, np.uint64).repeat(3)])
def test_distinct_hashes(values):
    keys, first, which = suffix_tree._distinct(values)
    for got, want in zip((keys, first, which), np.unique(values, return_index=True, return_inverse=True)):
        assert (got == want).all() and len(got) == len(want)
    assert (suffix_tree._first(which, len(keys)) == first).all()
