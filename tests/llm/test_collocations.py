"""Collocations against a count of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from leadflow.llm import collocations as c

UPPER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                f.update((lang, *words[i:i + m]) for i in range(len(words) - m + 1))
    return f, n


def by_counting(rows, least, best):
    f, n = counted(rows)
    phrases = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    held = set()
    for q, a in phrases.items():
        words = q[1:]
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                p = (q[0], *words[i:i + size])
                if 100 * a >= 100 * phrases[p]:
                    held.add(p)
    out = []
    for p, a in phrases.items():
        if p in held:
            continue
        lang, words = p[0], p[1:]
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, *words[:k]], f[lang, *words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, n[lang], score))
    rows = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        rows += [(lang, i, *r[1:]) for i, r in enumerate(own[:best], 1)]
    return sorted(rows)


def texts(seed=3):
    rng, rows = random.Random(seed), []
    words = ["the", "The", "of", "a", "naïve", "漢字", "x1", "don't", "#", "word-s", "(in)"] + [f"r{i}" for i in range(40)]
    for i in range(160):
        line = []
        for _ in range(rng.randrange(1, 60)):
            line.append(rng.choice([" ", "  ", "\t", "\n", ", ", ". ", "; ", "!", " \r\n", "\v", "\xa0"]) if rng.random() < 0.2 else " ")
            line.append(rng.choice(["of the", "OF the house", "new york city hall", "a a a a"]) if rng.random() < 0.3
                        else words[min(rng.randrange(len(words)), rng.randrange(len(words)))])
        rows.append(("".join(line), rng.choice(["en", "en", "en", "de", "", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \t\n.,", "de"), ("solo", "it"), ("the " * 3000, "en"), rows[0], rows[0]]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, i, "k", 1) for i, r in enumerate(texts())],
                                 "text string, lang string, n int, key string, rank int").repartition(5)


def run(df, **options):
    return sorted(tuple(r) for r in c.collocations(df, **options).collect())


@pytest.mark.parametrize("sizes", [{}, {"shard_words": 200, "range_words": 300}, {"shard_words": 50, "range_words": 40}])
def test_against_counting(frame, sizes):
    assert run(frame, least=5, best=60, **sizes) == by_counting(texts(), 5, 60)


def test_least_and_best_are_parameters(frame):
    assert run(frame, least=30, best=3, range_words=100) == by_counting(texts(), 30, 3)
    assert run(frame, least=10**6) == []


def test_nothing(frame, spark):
    assert run(frame.limit(0)) == []
    assert run(spark.createDataFrame([(None, None), ("", "en"), ("one two three", "en")], "text string, lang string")) == []


def test_large_products_are_exact(spark):
    """A score beyond doubles: 1000 a n is far over 2**53."""
    rows = [(3 * 10**12 + 7, 9 * 10**12 + 11, 10**9 + 7, 10**9 + 9)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select(
        c._floor_score(*[c.F.col(x) for x in "anlr"]).alias("score")).first().score
    a, n, left, right = rows[0]
    assert got == 1000 * a * n // (left * right)


@pytest.mark.parametrize("size", [30, 9000])  # paths of a large alphabet need two sort keys
def test_automata_unite_and_answer(size):
    rng = np.random.default_rng(5)
    expected, blocks, common = Counter(), [], np.sort(rng.integers(1, 1 << 63, size // 3, dtype=np.uint64))
    for _ in range(4):
        words = np.unique(np.append(rng.integers(1, 1 << 63, size, dtype=np.uint64), common[::2]))
        rows = [rng.integers(1, len(words) + 1, rng.integers(1, 6)) for _ in range(300)]
        columns = [np.array([r[d] if d < len(r) else 0 for r in rows], np.uint32) for d in range(5)]
        automaton = c.CountAutomaton(words, columns, np.ones(300, np.int64))
        coded = automaton.coded(common)
        blocks += [automaton.taken(np.arange(i, len(automaton.weights), 2), coded, len(common)) for i in (0, 1)]
        expected.update(tuple(int(words[x - 1]) for x in r) for r in rows)
    whole = c.CountAutomaton.union(blocks, common)
    asked = np.array([[*p, *[0] * (5 - len(p))] for p in expected] + [[1, 2, 3, 4, 5]], np.uint64)
    assert whole.compose(asked).tolist() == [*expected.values(), 0]
    prefixes = Counter()
    for p, n in expected.items():
        prefixes.update({p[:m]: n for m in range(1, len(p) + 1)})
    found = {}
    for depth, at, weights in whole.states():
        for i, w in zip(at.tolist(), weights.tolist()):
            found[tuple(int(whole.words[whole.columns[d][i] - 1]) for d in range(depth))] = w
    assert found == prefixes
