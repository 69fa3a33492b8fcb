"""Under which keys lines meet."""

import random

import numpy as np
import pyarrow as pa
import pytest

from leadflow.llm import line_dedup
from tests.llm.test_crowds import _edited


@pytest.mark.parametrize("sizes", [(9, 14), (18, 24), (30, 42), (176, 215)])
def test_lines_meet_under_the_first_word_they_share(spark, sizes):
    rng = random.Random(sizes[0])
    common = [f"c{i}" for i in range(60)]
    lines = []
    for _ in range(12):
        line = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(*sizes))]
        line[:6] = rng.sample(common, 6)
        lines += [_edited(rng, line, rng.randrange(0, 1 + len(line) // 14), rng.randrange(0, 1 + len(line) // 14)) for _ in range(12)]
    rng.shuffle(lines)
    sets = [frozenset(x) for x in lines]
    expected = [x for i, x in enumerate(lines)
                if not any(100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]) for j in range(i))]
    assert 12 <= len(expected) < len(lines) - 12
    rows = [(k, "\n".join(" ".join(x) for x in lines[k * 6:k * 6 + 6])) for k in range(24)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert [x for r in sorted(got.collect()) for x in r.text.split("\n") if x] == [" ".join(x) for x in expected]


def test_a_later_key_brings_no_pair():
    def met(place):
        rows = {"key": [5, 5], "doc_id": [1, 2], "at": [0, 0], "set": [11, 12], "parity": [0, 0], "shape": [32 << 32 | place] * 2}
        return sum(b.num_rows for b in line_dedup._meet(90)(iter([pa.RecordBatch.from_pydict(rows, line_dedup._KEYED)])))
    assert [met(p) for p in range(4)] == [1, 1, 0, 0]  # 31 of 32 words must be shared


@pytest.mark.parametrize("values", [
    np.array([], np.uint64), np.array([7], np.uint64), np.random.default_rng(1).integers(0, 2**64 - 1, 999, np.uint64),
    np.array([3, 1, 2, 0, 3, 1], np.uint64), np.array([2**64 - 1, 2**64 - 2, 0, 2**64 - 1], np.uint64)])
def test_order(values):
    assert (values[line_dedup._order(values)] == np.sort(values)).all()
