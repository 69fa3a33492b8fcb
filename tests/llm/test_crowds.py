"""Groups of near copies: every link is found, and work follows the rows and not the pairs."""

import random

import pytest

from leadflow.llm import ngram_join


def _edited(rng, words, swaps, drops=0):
    out = list(words)
    for at in rng.sample(range(len(out)), swaps):
        out[at] = f"n{rng.randrange(10**9)}"
    for _ in range(drops):
        out.pop(rng.randrange(len(out)))
    return out


def _shingles(words, n):
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


@pytest.mark.parametrize("odd", [False, True])
def test_outsiders_of_a_crowd(spark, monkeypatch, odd):
    n, percent = 3, 90
    rng = random.Random(n)
    base = [f"b{i}" for i in range(90)]
    texts = [base, *[_edited(rng, base, 1) for _ in range(80)], *[_edited(rng, base, 2) for _ in range(30)]]
    if odd:
        texts += [*[_edited(rng, base, rng.randrange(1, 7), rng.randrange(3)) for _ in range(10)], *[base[:k] for k in (70, 76, 79, 82, 86)]]
        texts += [_edited(rng, rng.choice(texts[81:111]), 1) for _ in range(5)]  # links among outsiders
        texts += [texts[1][:-k] + [f"t{k}"] for k in range(1, 12)]  # share what the centre has not
    sets = [_shingles(t, n) for t in texts]
    least = list(range(len(texts)))

    def top(i):
        while least[i] != i:
            i = least[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                least[b] = a
    tried, links = [], ngram_join._links

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return links(pairs, *rest)
    monkeypatch.setattr(ngram_join, "_links", counted)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs, n, percent).collect()}
    assert got == {i: top(i) for i in range(len(texts))}
    assert len(set(got.values())) > 10
    assert odd or tried[-1] < 1000  # of some 30 outsiders times 80 members
