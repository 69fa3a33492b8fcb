"""Toxicity with noisy-channel deobfuscation.

1. Deobfuscation: words with digits or symbols between letters (1d10t), letters set apart (i d i o t) and letters drawn
   out (idiooot) become lattices of what each character may stand for.  The Viterbi path under a character bigram model
   and the costs of the channel is the word that was meant.  Other words are left as they are.  The model counts every
   pair of letters in all texts that are not held out, labelled or not; the distinct pairs alone reach the driver.
2. Features: whole words and their first 4 to 7 letters (so that endings do not matter).
3. The classifier is fitted on a bounded sample: at most ``per_class`` labelled texts of each label, picked by a hash of the
   id among those not held out.  Part of it finds features whose share of toxic texts is beyond chance (likelihood
   ratio against the number of features tried), the rest fits a logistic curve over a text's strongest features.
4. Every text is scored whole.

Only the text is read for a score.  Null and empty texts get the score of a text without findings.  A label that is given
more than once for an id counts as its largest.  Without labelled texts of both kinds all scores are 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import fold_of, forget, give_back, saved, thrifty

PER_CLASS = 8000
KEEP = 1 << 17  # words remembered by a task
LONG = 80  # longer words are decoded each time instead of being remembered

# fixed values: what characters stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
_SIGNS = "0-9@$!|+(€£"
_MIXED = re.compile(rf"(?<!\S)[^\W\d_]*(?:[{_SIGNS}]+[^\W\d_]+)+[{_SIGNS}]*(?=[^\w\s]*(?!\S))")
_MIXED_HINT = re.compile(rf"[{_SIGNS}][^\W\d_]")
_APART = re.compile(rf"(?<!\S)(?:[^\W_]|[@$!|+])(?:([ .\-_*])(?:[^\W_]|[@$!|+])(?:\1(?:[^\W_]|[@$!|+]))+)(?!\w)")
_DRAWN = re.compile(r"(?<![^\W\d_])[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*")
_WORD = re.compile(r"[^\W\d_]+")
SUBSTITUTED, DROPPED, PAIRED = 1.5, 1.0, 4.0  # costs of the channel, in nats; two of a letter are meant more often than drawn out


class CharacterModel:
    """Bigrams of letters in words, with the word's bounds."""

    def __init__(self, counts: dict[str, int]):
        self.pairs = counts
        self.first: Counter[str] = Counter()
        for pair, n in counts.items():
            self.first[pair[0]] += n
        self.size = len(self.first) + 1

    def cost(self, a: str, b: str) -> float:
        return -np.log((self.pairs.get(a + b, 0) + 0.1) / (self.first[a] + 0.1 * self.size))

    def decode(self, word: str) -> str:
        """The word most likely meant by these characters; work and memory are linear in its length."""
        settled: list[str] = []  # letters that all ways share
        states: dict[str, tuple[float, tuple | None]] = {"^": (0.0, None)}  # by last letter: cost, letters since, last first
        runs = [n for _, run in groupby(word) for n in [sum(1 for _ in run)] for _ in range(n)]
        for i, c in enumerate(word):
            options = [(c, 0.0)] if c.isalpha() else [(x, SUBSTITUTED) for x in LEET.get(c, "")]
            repeated = i > 0 and c == word[i - 1]
            following: dict[str, tuple[float, tuple | None]] = {}
            for last, (cost, letters) in states.items():
                moves = [(x, cost + extra + self.cost(last, x), (letters, x)) for x, extra in options]
                if not options or repeated:
                    moves.append((last, cost + (PAIRED if options and runs[i] == 2 else DROPPED), letters))
                for x, total, out in moves:
                    if x not in following or total < following[x][0]:
                        following[x] = (total, out)
            states = following
            if len(states) == 1:
                (last, (cost, letters)), = states.items()
                settled.append(_spelt(letters))
                states = {last: (cost, None)}
        return "".join(settled) + min((cost + self.cost(last, "$"), _spelt(out)) for last, (cost, out) in states.items())[1]


def _spelt(letters: tuple | None) -> str:
    out = []
    while letters:
        letters, x = letters
        out.append(x)
    return "".join(reversed(out))


def restore(text: str, model: CharacterModel, known: dict[str, str] | None = None) -> str:
    """Lower-cased text with disguised words written out."""
    known = {} if known is None else known

    def meant(word: str) -> str:
        if len(word) > LONG:
            return model.decode(word)
        if word not in known:
            if len(known) > KEEP:
                known.clear()
            known[word] = model.decode(word)
        return known[word]

    text = text.lower()
    if any(s in text for s in (" ", ".", "-", "_", "*")):
        text = _APART.sub(lambda m: meant(m[0].replace(m[1], "")), text)
    if _MIXED_HINT.search(text):
        text = _MIXED.sub(lambda m: meant(m[0]), text)
    return _DRAWN.sub(lambda m: meant(m[0]), text)


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in range(4, 8) if len(word) >= n)]


class Lexicon(dict):
    """Weight of each word: that of its strongest feature."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > KEEP:
            self.clear()
        get = self.weights.get
        value = self[word] = max(get(f, 0.0) for f in features(word))
        return value


def signals(text: str, characters: CharacterModel, lexicon: Lexicon, known: dict[str, str]) -> list[float]:
    """A text's evidence: strongest and second strongest word, their number, their share."""
    words = _WORD.findall(restore(text, characters, known))
    found = sorted((w for w in map(lexicon.__getitem__, words) if w > 0), reverse=True)
    top = (found + [0.0, 0.0])[:2]
    return [*top, np.log1p(len(found)), min(1.0, 10 * len(found) / (len(words) + 1)), 1.0]


_LOW = 0x300  # codes below are counted in a table, pairs with others by sorting
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """For each code point whether ``_WORD`` takes it."""
    if not _LETTERS:
        table = np.zeros(0x110000, bool)
        for m in _WORD.finditer("".join(map(chr, range(len(table))))):
            table[m.start():m.end()] = True
        _LETTERS.append(table)
    return _LETTERS[0]


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    letters, low, high = _is_letter(), np.zeros(_LOW * _LOW, np.int64), Counter()

    def count(texts: list[str]) -> None:
        codes = np.frombuffer("\n".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(letters[codes], codes, 0).astype(np.int64)  # 0 bounds a word
        a, b = codes[:-1], codes[1:]
        dense = (a < _LOW) & (b < _LOW)
        low[:] += np.bincount(a[dense] * _LOW + b[dense], minlength=len(low))
        pairs, n = np.unique((a[~dense] << 21) | b[~dense], return_counts=True)
        for pair, k in zip(pairs.tolist(), n.tolist()):
            high[pair] += k

    for batch in batches:
        some, size = [], 0
        for text in batch.column("text"):
            some.append(text.as_py() or "")
            size += len(some[-1])
            if size > 1 << 20:
                count(some)
                some, size = [], 0
        count(some)
    seen = np.flatnonzero(low)
    counts = {(int(i) // _LOW, int(i) % _LOW): int(low[i]) for i in seen if i}  # 0 is no letter beside no letter
    counts.update({(pair >> 21, pair & 0x1FFFFF): k for pair, k in high.items()})
    yield pa.RecordBatch.from_pydict({
        "pair": pa.array([(chr(a) if a else "^") + (chr(b) if b else "$") for a, b in counts], pa.string()),
        "n": pa.array(list(counts.values()), pa.int64())})
    del low, high, counts, seen
    give_back()


def letter_pairs(docs: DataFrame) -> dict[str, int]:
    """Counts of letter pairs in all texts not held out; as many as their alphabets have, whatever the number of texts."""
    rows = docs.where(fold_of(F.col("doc_id").cast("bigint")) != 0).select(F.col("text").cast("string").alias("text")) \
        .mapInArrow(_letter_counts, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r.pair: r.n for r in rows.collect()}


def _feature_counts(characters):
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = CharacterModel(characters.value), {}
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = set(_WORD.findall(restore(text.as_py() or "", model, known)))
                for f in {f for w in words for f in features(w)}:
                    counts.setdefault(f, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(list(counts), pa.string()),
            "clean": pa.array([c for c, _ in counts.values()], pa.int64()),
            "toxic": pa.array([t for _, t in counts.values()], pa.int64())})
    return run


def _signals_of(characters, weights):
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lexicon, known = CharacterModel(characters.value), Lexicon(weights.value), {}
        for batch in batches:
            rows = [signals(t.as_py() or "", model, lexicon, known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["toxic", "x"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression whose classes weigh the same."""
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[dict, dict, np.ndarray]:
    """Character model of all texts not held out; feature weights and curve from at most ``per_class`` labelled texts of each
    label."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("id is not null and toxic in (0, 1)").where(fold_of(F.col("id")) != 0) \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    by_hash = F.xxhash64("id")
    picked = known.where("toxic = 1").orderBy(by_hash).limit(per_class).union(
        known.where("toxic = 0").orderBy(by_hash).limit(per_class))
    picked = F.broadcast(saved(picked, "labelled"))  # at most 2 * per_class rows of 12 bytes
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    sample = saved(texts.join(picked, "id").withColumn("half", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(3)) == 0),
                   "labelled-texts")
    spark = docs.sparkSession
    characters = letter_pairs(docs)
    shared = spark.sparkContext.broadcast(characters)
    learn = sample.where("not half").select("text", "toxic")
    toxic, clean = learn.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not toxic or not clean:
        return characters, {}, np.array([0.0, 0.0, 0.0, 0.0, -30.0])
    counts = learn.mapInArrow(_feature_counts(shared), "feature string, clean bigint, toxic bigint") \
        .groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where("t >= 3")
    # likelihood ratio of "more often in toxic texts" against "equally often"
    both = F.col("t") + F.col("c")
    expected_t, expected_c = both * (toxic / (toxic + clean)), both * (clean / (toxic + clean))
    ratio = 2 * (F.col("t") * F.log(F.col("t") / expected_t)
                 + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / expected_c)).otherwise(0.0))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    counts = saved(counts.select("feature", "t", ratio.alias("ratio"), odds.alias("odds")), "features")
    tried = counts.count()
    least = 8.0 + 2 * np.log(max(tried, 100) / 100)
    chosen = counts.where((F.col("ratio") >= least) & (F.col("odds") >= 1.5)).collect()  # of the bounded sample
    weights = {r.feature: r.odds for r in chosen}
    rows = sample.where("half").select("toxic", "text").mapInArrow(
        _signals_of(shared, spark.sparkContext.broadcast(weights)), "toxic int, x array<double>").collect()
    y = np.array([r.toxic for r in rows], float)
    if not 0 < y.sum() < len(y):
        return characters, weights, np.array([1.0, 0.5, 0.0, 0.0, -3.0])
    return characters, weights, _logistic(np.array([r.x for r in rows]), y)


def _score(characters, weights, curve):
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lexicon, known = CharacterModel(characters.value), Lexicon(weights.value), {}
        for batch in batches:
            x = np.array([signals(t.as_py() or "", model, lexicon, known) for t in batch.column("text")]).reshape(-1, len(curve))
            score = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
            at = batch.schema.get_field_index("text")
            rest = batch.remove_column(at)
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(score)], names=[*rest.schema.names, "score"])
    return run


def scored(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    characters, weights, curve = fit(docs, labels, per_class)
    share = docs.sparkSession.sparkContext.broadcast
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (fold_of(F.col("doc_id")) == 0).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_score(share(characters), share(weights), curve),
                          "doc_id bigint, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    characters, weights, curve = fit(docs, labels, per_class)
    share = docs.sparkSession.sparkContext.broadcast

    shared = share(characters), share(weights)

    # the text alone goes to Python, a verdict comes back, and Spark filters its own rows
    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        model, lexicon, known = CharacterModel(shared[0].value), Lexicon(shared[1].value), {}
        for texts in batches:
            x = np.array([signals(t.as_py() or "", model, lexicon, known) for t in texts]).reshape(-1, len(curve))
            yield pa.array(x @ curve < 0)
        del model, lexicon, known
        give_back()

    return docs.where(clean(F.col("text").cast("string")))
