"""Phrase collocations by weighted acyclic automata over words.

Texts are lowered (A-Z), split at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into words.  Every
position of a piece is the path of the words that follow it, five at most; a state of the automaton of all paths is a
phrase, and its weight, the number of paths through it, is the phrase's count.

1. Survey: words a language, and hashed counters of fixed size of words and of path prefixes.  Counters only overstate,
   so a word counted less than ``least`` times by them is in no phrase of ``least`` occurrences: paths end before it.
2. Shards: each task sorts the paths of half a million words at a time, builds their automaton (a path shares the states
   of its common prefix with the path before) and cuts it by prefix range.  The most common words go by short codes.
3. Ranges: a range's automata are united, weights of equal paths added.  A path belongs to the range of its shortest
   prefix that is not heavy (or of all of it), so a heavy word or pair is spread over many ranges; weights of heavy
   prefixes are then added up over the ranges.  The number of ranges follows the number of words.
4. Part lookups: the distinct first and last parts of all candidates are composed with the automata of their ranges.
5. Scores, in exact decimals, containment (a phrase's longer phrases of equal count go through those one word longer,
   as counts only fall with length) and the best of each language.

Words and phrases are told apart by 64-bit hashes, those of different languages as well.  Null texts are empty; a null
language is ``und``.  Repeated rows count each time.  Ids are not read, nor any column besides ``text`` and ``lang``.
No words or no candidate: no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm import rarity
from leadflow.llm.common import saved
from leadflow.llm.wordscan import _column, _words, mix

LONGEST = 5
LEAST = 100
BEST = 2000
SHARD_WORDS = 1 << 19
RANGE_WORDS = 1 << 20
SLICE = 1 << 18
PREFIX_BITS = 22
COMMON = 3 << 14  # words with a code of two bytes; it bounds a broadcast and decides on sizes alone
_STEP = np.uint64(0xD6E8FEB86659FD93)

_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[list(b".,;:!?")] = 0x0A  # ends a piece, as line ends do


def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def words_of(texts: pa.Array, langs: list[str]) -> Iterator[tuple]:
    """For slices of texts: word hashes (a language's own), whether a piece starts with the word, the text of each word
    counted from the first of all, and a function that gives the words at some indices as text."""
    data, offsets = _column(texts)
    salts = np.array([_salt(x) for x in langs], np.uint64)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = min(max(int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1, at + 1), n)
        piece = _BYTES[data[offsets[at]:offsets[to]]]
        hashes, starts, ends, bounds, _, _ = _words(piece, offsets[at:to + 1] - offsets[at])
        of = np.repeat(np.arange(at, to), np.diff(bounds))
        ends_piece = np.zeros(len(piece) + 1, np.int32)
        np.cumsum((piece >= 0x0A) & (piece <= 0x0D), out=ends_piece[1:])
        first = np.ones(len(starts), bool)
        first[1:] = (ends_piece[starts[1:]] > ends_piece[ends[:-1]]) | (of[1:] != of[:-1])

        def spelt(some: np.ndarray, piece=piece, starts=starts, ends=ends) -> list[str]:
            return [piece[starts[i]:ends[i]].tobytes().decode("utf-8", "replace") for i in some.tolist()]
        yield mix(hashes + salts[of]), first, of, spelt
        at = to


def _follow(first: np.ndarray) -> list[np.ndarray]:
    """For 1 to ``LONGEST - 1`` words more, whether the piece has them."""
    after = np.zeros(len(first), bool)
    after[:-1] = ~first[1:]
    out = [after]
    for d in range(1, LONGEST - 1):
        out.append(out[-1] & np.append(after[d:], np.zeros(min(d, len(first)), bool)))
    return out


def _chain(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a phrase with one word more."""
    return mix(key * _STEP + word)


# -- the survey ----------------------------------------------------------------

_SURVEY = pa.schema([("kind", pa.string()), ("lang", pa.string()), ("word", pa.int64()), ("n", pa.int64()), *rarity.PART])


def _most(often: dict[int, int]) -> dict[int, int]:
    """The ``COMMON`` words met most often."""
    return dict(sorted(often.items(), key=lambda x: (-x[1], x[0]))[:COMMON])


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    words, prefixes, totals, often = rarity.Counter(), rarity.Counter(PREFIX_BITS), {}, {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        per_text = np.zeros(len(langs), np.int64)
        for h, first, of, _ in words_of(batch.column("text"), langs):
            per_text += np.bincount(of, minlength=len(langs))
            words.add(h)
            prefixes.add(h)
            some, times = np.unique(h, return_counts=True)
            for word, n in zip(some[times > 1].tolist(), times[times > 1].tolist()):
                often[word] = often.get(word, 0) + n
            if len(often) > 8 * COMMON:
                often = _most(often)
            key, at = h, np.arange(len(h))
            for d, have in enumerate(_follow(first)[:-1], 1):
                more = have[at]
                at = at[more]
                key = _chain(key[more], h[at + d])
                prefixes.add(key)
        for lang, n in zip(langs, per_text.tolist()):
            totals[lang] = totals.get(lang, 0) + n
    partition = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_pylist([{"kind": "lang", "lang": k, "n": n} for k, n in totals.items()], _SURVEY)
    often = _most(often)
    yield pa.RecordBatch.from_pydict({
        "kind": ["common"] * len(often), "lang": [None] * len(often), "word": pa.array(np.array(list(often), np.uint64).view(np.int64)),
        "n": list(often.values()), **{f.name: [None] * len(often) for f in rarity.PART}}, _SURVEY)
    for kind, counter in (("word", words), ("prefix", prefixes)):
        for row in counter.rows(partition):
            yield pa.RecordBatch.from_pylist([{"kind": kind, **row}], _SURVEY)


def _at_least(levels: np.ndarray, count: int) -> np.ndarray:
    """Bits of the counters that may have reached a count."""
    level = 0 if count < 2 else min(255, 1 + int(np.floor(rarity.STEPS * np.log2(count / 2))))
    return np.packbits(levels >= level)


def _is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)).astype(np.int64)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0


# -- automata ------------------------------------------------------------------

class CountAutomaton:
    """Paths of up to ``LONGEST`` words with weights, sorted; states are shared by common prefix.

    ``words`` is the alphabet; ``columns`` hold, per depth, each path's word (1-based, 0 beyond its end); ``fresh`` is the
    depth from which a path has states of its own.
    """

    def __init__(self, words: np.ndarray, columns: list[np.ndarray], weights: np.ndarray):
        keys = self._keys(columns, len(words))
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        at = np.flatnonzero(new)
        self.words = words
        self.columns = [c[order[at]] for c in columns]
        self.weights = np.add.reduceat(weights[order], at) if len(at) else weights[:0]
        self.keys = [k[at] for k in keys]
        self.fresh = np.zeros(len(at), np.uint8)
        same = np.ones(max(len(at) - 1, 0), bool)
        for c in self.columns[:-1]:
            same &= c[1:] == c[:-1]
            self.fresh[1:] += same

    @staticmethod
    def _keys(columns: list[np.ndarray], size: int) -> list[np.ndarray]:
        """The columns packed into as few sort keys as they need."""
        bits = int(size).bit_length()
        fit = max(1, 63 // max(bits, 1))
        keys = []
        for i in range(0, LONGEST, fit):
            key = columns[i].astype(np.uint64)
            for c in columns[i + 1:i + fit]:
                key = (key << np.uint64(bits)) | c.astype(np.uint64)
            keys.append(key)
        return keys

    def coded(self, common: np.ndarray) -> np.ndarray:
        """For each word of the alphabet its place among the common ones (sorted), or none (-1)."""
        at = np.minimum(np.searchsorted(common, self.words), max(len(common) - 1, 0))
        return np.where(common[at] == self.words, at, -1) if len(common) else np.full(len(self.words), -1)

    def taken(self, some: np.ndarray, coded: np.ndarray, n_common: int) -> bytes:
        """The automaton of some of the paths (in order), as bytes: common words by their code, others spelt as hashes."""
        columns = [c[some] for c in self.columns]
        used = np.unique(np.concatenate(columns))
        used = used[used > 0] - 1
        own = used[coded[used] < 0]
        kind = np.uint16 if n_common + len(own) < 65535 else np.uint32
        code = np.zeros(len(self.words) + 1, kind)
        code[1:] = coded + 1
        code[own + 1] = np.arange(n_common + 1, n_common + len(own) + 1, dtype=kind)
        fresh = np.zeros(len(some), np.uint8)
        same = np.ones(max(len(some) - 1, 0), bool)
        for c in columns[:-1]:
            same &= c[1:] == c[:-1]
            fresh[1:] += same
        body = [self.words[own].tobytes(), fresh.tobytes(), self.weights[some].astype(np.uint32).tobytes()]
        body += [code[c[fresh <= d]].tobytes() for d, c in enumerate(columns)]
        packed = pa.Codec("zstd").compress(b"".join(body), asbytes=True)
        return struct.pack("<IIBI", len(own), len(some), np.dtype(kind).itemsize, sum(map(len, body))) + packed

    @staticmethod
    def read(block: bytes) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Words without code, columns of codes and weights of an automaton's bytes."""
        n_words, n, width, size = struct.unpack_from("<IIBI", block)
        body = pa.Codec("zstd").decompress(block[13:], size, asbytes=True)
        at = 8 * n_words
        words = np.frombuffer(body, np.uint64, n_words)
        fresh = np.frombuffer(body, np.uint8, n, at)
        weights = np.frombuffer(body, np.uint32, n, at + n).astype(np.int64)
        at += 5 * n
        columns = []
        for d in range(LONGEST):
            own = fresh <= d
            labels = np.frombuffer(body, np.dtype(f"<u{width}"), int(own.sum()), at)
            at += labels.nbytes
            columns.append(labels[np.cumsum(own) - 1] if n else labels)
        return words, columns, weights

    @classmethod
    def union(cls, blocks: list[bytes], common: np.ndarray) -> CountAutomaton:
        """One automaton of all paths, weights of equal ones added."""
        parts = [cls.read(b) for b in blocks]
        words = np.unique(np.concatenate([common, *[w for w, _, _ in parts]]))
        ids = lambda w: (np.searchsorted(words, w) + 1).astype(np.uint32)
        known = np.append(np.uint32(0), ids(common))
        columns = [np.concatenate([np.append(known, ids(w))[c[d]] for w, c, _ in parts]) for d in range(LONGEST)]
        return cls(words, columns, np.concatenate([x for _, _, x in parts]))

    def states(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By depth: for each state one path through it, and its weight."""
        for d in range(LONGEST):
            at = np.flatnonzero(self.fresh <= d)
            weights = np.add.reduceat(self.weights, at) if len(at) else self.weights[:0]
            there = self.columns[d][at] > 0
            yield d + 1, at[there], weights[there]

    def compose(self, paths: np.ndarray) -> np.ndarray:
        """Weights of whole paths (rows of word hashes, 0 beyond their end); 0 where the automaton has no such path."""
        found = np.searchsorted(self.words, paths)
        found = np.minimum(found, max(len(self.words) - 1, 0))
        known = (paths == 0) | ((self.words[found] == paths) if len(self.words) else False)
        ids = np.where(paths == 0, 0, found + 1)
        keys = self._keys([ids[:, d] for d in range(LONGEST)], len(self.words))
        if len(keys) == 1:
            ours, theirs = self.keys[0], keys[0]
        else:
            both = [np.concatenate(k) for k in zip(self.keys, keys)]
            order = np.lexsort(both[::-1])
            new = np.zeros(len(order), np.int64)
            new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in both])
            codes = np.empty(len(order), np.int64)
            codes[order] = np.cumsum(new)
            ours, theirs = codes[:len(self.weights)], codes[len(self.weights):]
        if not len(ours):
            return np.zeros(len(paths), np.int64)
        at = np.minimum(np.searchsorted(ours, theirs), len(ours) - 1)
        return np.where(known.all(axis=1) & (ours[at] == theirs), self.weights[at], 0)


class Ranges:
    """Which range of its language a path belongs to."""

    def __init__(self, heavy: np.ndarray, n_ranges: dict[str, int]):
        self.heavy, self.n_ranges = heavy, n_ranges

    def of(self, lang: str, words: list[np.ndarray], there: list[np.ndarray]) -> np.ndarray:
        """``words`` by depth as hashes, ``there`` whether the path has them."""
        n = self.n_ranges.get(lang, 1)
        if n == 1 or not len(words[0]):
            return np.zeros(len(words[0]), np.int32)
        key = cut = words[0]
        going = _is_set(self.heavy, key)
        for word, has in zip(words[1:], there[1:]):
            going = going & has
            if not going.any():
                break
            key = np.where(going, _chain(key, word), key)
            cut = np.where(going, key, cut)
            going &= _is_set(self.heavy, key)
        return (mix(cut) % np.uint64(n)).astype(np.int32)


# -- shards, ranges, lookups ---------------------------------------------------

_SHARD = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("block", pa.binary()), ("words", pa.binary())])


def _shards(frequent, ranges, common, shard_words: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, dealt, seen = frequent.value, ranges.value, set()
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        spellings: dict[int, str] = {}
        codes: dict[str, int] = {}
        size = 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            coded = np.array([codes.setdefault(x, len(codes)) for x in langs], np.int32)
            for h, first, of, spelt in words_of(batch.column("text"), langs):
                kept = np.flatnonzero(_is_set(bits, h))
                if not len(kept):
                    continue
                starts = first[kept]
                starts[1:] |= np.diff(kept) > 1
                starts[0] = True
                h, of = h[kept], of[kept]
                some, at = np.unique(h, return_index=True)
                fresh = [(x, i) for x, i in zip(some.tolist(), at.tolist()) if x not in seen]
                if len(seen) > 1 << 19:
                    seen.clear()
                seen.update(x for x, _ in fresh)
                where = np.array([i for _, i in fresh], np.int64)
                spellings.update(zip((x for x, _ in fresh), spelt(kept[where])))
                parts.append((h, starts, coded[of]))
                size += len(h)
                if size >= shard_words:
                    yield _blocks(parts, list(codes), dealt, common.value)
                    yield _spellings(spellings, buckets)
                    parts, size, spellings = [], 0, {}
        if parts:
            yield _blocks(parts, list(codes), dealt, common.value)
            yield _spellings(spellings, buckets)
    return run


def _spellings(words: dict[int, str], buckets: int) -> pa.RecordBatch:
    """Words by their hash, packed by bucket."""
    hashes = np.array(list(words), np.uint64).view(np.int64)
    bucket, texts, rows = hashes % buckets, list(words.values()), []
    for b in np.unique(bucket).tolist():
        at = np.flatnonzero(bucket == b)
        body = hashes[at].tobytes() + "\n".join([texts[i] for i in at.tolist()]).encode()
        rows.append({"range": b, "words": struct.pack("<II", len(at), len(body)) + pa.Codec("zstd").compress(body, asbytes=True)})
    return pa.RecordBatch.from_pylist(rows, _SHARD)


def _spell(packed: pa.Table, asked: pa.Table) -> pa.Table:
    """The words of the hashes that are asked for."""
    wanted, out = np.unique(asked["hash"].to_numpy()), {}
    for block in packed["words"] if len(wanted) else ():
        block = block.as_buffer().to_pybytes()
        n, size = struct.unpack_from("<II", block)
        body = pa.Codec("zstd").decompress(block[8:], size, asbytes=True)
        hashes = np.frombuffer(body, np.int64, n)
        at = np.flatnonzero(np.isin(hashes, wanted)).tolist()
        texts = body[8 * n:].decode().split("\n") if at else []
        out.update((int(hashes[i]), texts[i]) for i in at)
    return pa.table({"hash": pa.array(list(out), pa.int64()), "word": pa.array(list(out.values()), pa.string())})


def _blocks(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], langs: list[str], ranges: Ranges,
            common: np.ndarray) -> pa.RecordBatch:
    """The automaton of a shard, cut by language and range."""
    h, first, lang = (np.concatenate(x) for x in zip(*parts))
    words, where, ids = np.unique(h, return_index=True, return_inverse=True)
    ids = (ids + 1).astype(np.uint32)
    columns = [ids]
    for d, have in enumerate(_follow(first), 1):
        column = np.zeros(len(ids), np.uint32)
        at = np.flatnonzero(have)
        column[at] = ids[at + d]
        columns.append(column)
    automaton = CountAutomaton(words, columns, np.ones(len(ids), np.int64))
    lang = lang[where][automaton.columns[0] - 1]
    coded = automaton.coded(common)
    rows = []
    padded = np.append(np.uint64(0), words)
    for code in np.unique(lang).tolist():
        paths = np.flatnonzero(lang == code)
        own = [c[paths] for c in automaton.columns]
        dealt = ranges.of(langs[code], [padded[c] for c in own], [c > 0 for c in own])
        order = np.argsort(dealt, kind="stable")
        cuts = np.flatnonzero(np.diff(dealt[order])) + 1
        for some in np.split(order, cuts):
            rows.append({"lang": langs[code], "range": int(dealt[some[0]]), "block": automaton.taken(paths[some], coded, len(common))})
    return pa.RecordBatch.from_pylist(rows, _SHARD)


_STATE = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("key", pa.int64()), ("f", pa.int64()), ("path", pa.list_(pa.int64())),
                    ("part_ranges", pa.list_(pa.int32())), ("part_keys", pa.list_(pa.int64())), ("partial", pa.bool_())])
_STATE_SQL = ("lang string, range int, key bigint, f bigint, path array<bigint>, part_ranges array<int>, part_keys array<bigint>, "
              "partial boolean")


def _phrase_keys(words: list[np.ndarray]) -> np.ndarray:
    key = words[0]
    for w in words[1:]:
        key = _chain(key, w)
    return key


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width, pa.int32()), pa.array(rows.reshape(-1)))


def _states(ranges, common, least: int):
    """States of a range's united automaton that reach ``least``, and heavy ones with their share of the weight."""
    def run(table: pa.Table) -> pa.Table:
        dealt: Ranges = ranges.value
        lang = table["lang"][0].as_py()
        automaton = CountAutomaton.union([b.as_buffer().to_pybytes() for b in table["block"]], common.value)
        padded = np.append(np.uint64(0), automaton.words)
        out = []
        for depth, at, weights in automaton.states():
            words = [padded[automaton.columns[d][at]] for d in range(depth)]
            shared = np.full(len(at), dealt.n_ranges.get(lang, 1) > 1)
            if shared.any():
                key = words[0]
                shared &= _is_set(dealt.heavy, key)
                for w in words[1:]:
                    if not shared.any():
                        break
                    key = _chain(key, w)
                    shared &= _is_set(dealt.heavy, key)
            kept = np.flatnonzero(shared | (weights >= least))
            words = [w[kept] for w in words]
            if not len(kept):
                continue
            always = [np.ones(len(kept), bool)] * depth
            parts = [p for k in range(1, depth) for p in (words[:k], words[k:])]
            part_ranges = np.stack([dealt.of(lang, p, always) for p in parts], 1) if parts else np.zeros((len(kept), 0), np.int32)
            part_keys = np.stack([_phrase_keys(p) for p in parts], 1) if parts else np.zeros((len(kept), 0), np.uint64)
            out.append(pa.Table.from_arrays([
                pa.array([lang] * len(kept), pa.string()), pa.array(dealt.of(lang, words, always)),
                pa.array(_phrase_keys(words).view(np.int64)), pa.array(weights[kept]), _lists(np.stack(words, 1).view(np.int64)),
                _lists(part_ranges), _lists(part_keys.view(np.int64)), pa.array(shared[kept])], schema=_STATE))
        return pa.concat_tables(out) if out else _STATE.empty_table()
    return run


def _paths(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of words as rows of ``LONGEST``, 0 beyond their end."""
    out = np.zeros((len(column), LONGEST), np.uint64)
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    depth = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, depth] = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return out


def _lookup(states: pa.Table, parts: pa.Table) -> pa.Table:
    """Parts composed with the automaton of their range's states."""
    paths = _paths(states["path"])
    words = np.unique(paths)
    words = words[words > 0]
    ids = np.where(paths == 0, 0, np.searchsorted(words, paths) + 1).astype(np.uint32)
    automaton = CountAutomaton(words, [ids[:, d] for d in range(LONGEST)], states["f"].to_numpy().astype(np.int64))
    return pa.table({"key": parts["key"].combine_chunks(), "f": pa.array(automaton.compose(_paths(parts["path"])))})


def frequent_phrases(docs: DataFrame, least: int = LEAST, shard_words: int = SHARD_WORDS,
                     range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of one to five words that occur ``least`` times: ``lang, range, key, f, path`` and their parts' ranges and
    keys (first part, last part, by the number of words in the first); packed spellings; number of words by language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    survey = saved(texts.mapInArrow(
        _survey, "kind string, lang string, word bigint, n bigint, chunk int, share int, slots binary, counts binary"), "survey")
    counts = saved(survey.where("kind = 'lang'").groupBy("lang").agg(F.sum("n").alias("n")), "words-by-lang")
    parts = lambda kind: survey.where(F.col("kind") == kind).select("chunk", "share", "slots", "counts")
    frequent = _at_least(rarity.levels(parts("word")), least)  # 2 MB whatever the input
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # heavy: a quarter of a range, and well above what shares a counter by chance
    heavy = _at_least(rarity.levels(parts("prefix"), PREFIX_BITS), max(range_words // 4, 16 * 4 * total >> PREFIX_BITS))
    large = counts.where(F.col("n") > range_words).collect()  # total / range_words languages at most
    ranges = Ranges(heavy, {r.lang: -(-r.n // range_words) for r in large})
    share = spark.sparkContext.broadcast
    dealt = share(ranges)
    top = survey.where("kind = 'common'").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(COMMON)
    common = share(np.sort(np.array([r.word for r in top.collect()], np.int64).view(np.uint64)))
    shards = saved(texts.mapInArrow(_shards(share(frequent), dealt, common, shard_words, _buckets(total, range_words)),
                                    "lang string, range int, block binary, words binary"), "shards")
    states = saved(shards.where("block is not null").select("lang", "range", "block").groupBy("lang", "range")
                   .applyInArrow(_states(dealt, common, least), _STATE_SQL), "states")
    same = ["lang", "range", "key", "path", "part_ranges", "part_keys"]
    whole = states.where("not partial").select(*same, "f").unionByName(
        states.where("partial").groupBy(*same).agg(F.sum("f").alias("f")).where(F.col("f") >= least))
    return saved(whole, "phrases"), shards.where("words is not null").select("range", "words"), counts


def _buckets(total: int, range_words: int) -> int:
    return max(8, total // range_words)


def _floor_score(a: Column, n: Column, first: Column, rest: Column) -> Column:
    """``floor(1000 a n / (l r))`` in whole numbers of up to 38 digits."""
    over = (1000 * a).cast("decimal(19,0)") * n.cast("decimal(18,0)")
    return F.call_function("div", over, first.cast("decimal(18,0)") * rest.cast("decimal(18,0)"))


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, shard_words: int = SHARD_WORDS,
                 range_words: int = RANGE_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each language."""
    phrases, spellings, counts = frequent_phrases(docs, least, shard_words, range_words)
    longer = phrases.where(F.size("path") > 1)
    cuts = longer.select("lang", "key", "path", F.col("f").alias("a"), "part_ranges", "part_keys",
                         F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("k"))
    size, k = F.size("path"), F.col("k")
    part = lambda name, last: F.element_at(name, 2 * k - (0 if last else 1))
    asked = [cuts.select("lang", part("part_ranges", last).alias("range"), part("part_keys", last).alias("key"),
                         (F.slice("path", k + 1, size - k) if last else F.slice("path", F.lit(1), k)).alias("path"))
             for last in (False, True)]
    asked = asked[0].union(asked[1]).distinct()
    found = phrases.select("lang", "range", "path", "f").groupBy("lang", "range").cogroup(
        asked.groupBy("lang", "range")).applyInArrow(_lookup, "key bigint, f bigint")
    found = saved(found, "parts")
    cut = cuts.select("lang", "key", size.alias("m"), "a", "k", part("part_keys", False).alias("first"), part("part_keys", True).alias("rest")) \
        .join(found.select(F.col("key").alias("first"), F.col("f").alias("l")), "first") \
        .join(found.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest")
    cut = saved(cut, "cuts")
    inside = cut.where("m > 2 and k = m - 1 and l = a").select(F.col("first").alias("key")).union(
        cut.where("m > 2 and k = 1 and r = a").select(F.col("rest").alias("key"))).distinct()
    scored = cut.join(counts, "lang").select("lang", "key", "a", "n", F.struct(
        _floor_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut")) \
        .groupBy("lang", "key", "a", "n").agg(F.min("cut").alias("cut")).join(inside, "key", "left_anti") \
        .select("lang", "key", "a", "n", "cut.score", "cut.l", "cut.r")
    # ties beyond the best are settled by spelling, so all that tie with the last one are spelt out
    near = scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))) \
        .where(F.col("place") <= best).drop("place")
    near = saved(near.join(longer.select("key", "path"), "key"), "best")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    asked = near.select(F.explode("path").alias("hash")).distinct().withColumn(
        "range", F.pmod("hash", F.lit(_buckets(total, range_words))).cast("int"))
    words = spellings.groupBy("range").cogroup(asked.groupBy("range")).applyInArrow(_spell, "hash bigint, word string")
    spelt = near.select("*", F.posexplode("path").alias("at", "hash")) \
        .join(words, "hash").groupBy("lang", "key", "a", "l", "r", "n", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelt.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
