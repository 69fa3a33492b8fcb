"""Language-model scoring with a probabilistic suffix tree over words.

Symbols are a text's lower-cased words and one end.  States are word contexts of up to ``depth`` words; the root is the
add-half unigram distribution over all training texts.  With c the training counts and parent the longest shorter
suffix in the tree, a state s predicts

    P(x | s) = (c(s x) + k P(x | parent)) / (c(s) + k),   k = c(s) ** 0.75

A context seen at least twice becomes a state if the leave-one-out log-likelihood of what followed it is better
under s than under its parent by ``gain`` nats (a divergence test that a context with accidental followers fails).
A text is scored with the longest suffix state at each position.

The counts of all word runs that the tests need are gathered from all training texts, none left out; those of single words
are exact, and those of longer runs but for the few that share a key (below).  Contexts end at ``depth`` words whatever
the test would say of longer ones; each word more is one more round.  How:
texts lie in blocks of some megabytes (by a hash of the row).  In each round a block sends its distinct words
or word runs, sorted and cut into ranges, to one task per range; that task adds up what all blocks sent and answers each
block in the order it asked, so an answer is a plain array.  A frequent word is one entry per block.  Runs of two words
and more travel as 32 bits beside the number of their range; two that fall together (about one in ten thousand) share
a count.  Single words use 64 bits.  Nothing but the two totals (tokens, distinct tokens) reaches the driver.

Null texts count as empty: one token, the end.  Repeated rows count each time.  No input, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import fold_of, saved
from leadflow.llm.wordscan import mix, scan

END = np.uint64(0x5BD1E9955BD1E995)
BLOCK_BYTES = 12 << 20
RANGE_TOKENS = 1 << 20

_PACKED = "block int, texts binary"
_SENT = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()),
                   ("values", pa.binary())])
_SENT_SQL = "part int, block int, kind int, keys binary, values binary"
_REPLY = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("data", pa.binary()),
                    ("owner", pa.binary()), ("tokens", pa.int64()), ("distinct", pa.int64())])
_REPLY_SQL = "block int, kind int, part int, data binary, owner binary, tokens bigint, `distinct` bigint"
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_SCORED_SQL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
GAIN = 100  # kinds: n for counts of n-word runs, GAIN + n for tests of n-word contexts


def _shut(data: bytes) -> bytes:
    """Mostly small numbers, which compress well."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _opened(value: pa.Scalar) -> bytes:
    data = value.as_py()
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch that go to one block as one compressed value."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        cuts = np.flatnonzero(np.diff(blocks[order])) + 1
        for rows in np.split(order, cuts):
            if not len(rows):
                continue
            part = batch.select(["doc_id", "held_out", "text"]).take(pa.array(rows))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                writer.write_batch(part)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([int(blocks[rows[0]])], pa.int32()),
                "texts": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct hashes, where each occurs first, and the index of each value among them.

    The leading bits are sorted as plain numbers with the place in the bits behind them, which costs a part of sorting places
    by value.  Different hashes of equal leading bits may then stand wrong; where that is so, places are sorted by value.
    """
    bits = np.uint64(len(values).bit_length())
    wide = values.astype(np.uint64) << np.uint64(64 - 8 * values.itemsize)
    packed = np.sort(wide >> bits << bits | np.arange(len(values), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ranked = values[order]
    if (ranked[1:] < ranked[:-1]).any():
        order = np.argsort(values, kind="stable")
        ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], order[new], which


def _first(which: np.ndarray, n: int) -> np.ndarray:
    """Where each of the indices 0 .. n - 1 occurs first; all of them occur."""
    first = np.empty(n, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]  # of equal ones the last written stays
    return first


class _Block:
    """Token stream of a block, with what is known so far from earlier answers."""

    def __init__(self, packed: pa.Table, replies: pa.Table | None, depth: int):
        self.ids, held, parts, lengths = [], [], [], []
        blobs = sorted(x.as_py() for x in packed["texts"])  # the order of arrival must not matter
        for blob in blobs:
            for batch in pa.ipc.open_stream(blob):
                self.ids += batch.column(0).to_pylist()
                held += batch.column(1).to_pylist()
                for s in scan(batch.column(2)):
                    n = np.diff(s.bounds)
                    lengths.append(n + 1)
                    parts.append(np.insert(s.hashes, s.bounds[1:], END))
        self.block = packed["block"][0].as_py()
        self.held = np.array(held, bool)
        self.lengths = np.concatenate(lengths)
        self.tokens = np.concatenate(parts)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.train = ~self.held[self.doc]
        self.is_end = np.zeros(len(self.tokens), bool)
        self.is_end[np.cumsum(self.lengths) - 1] = True
        self.replies: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if replies is not None and replies.num_rows:
            self._take(replies)
        # keys[k]: sorted distinct k-word runs; at[k]: where they end in the stream; which[k]: index into keys[k]
        self.keys, self.at, self.which = {}, {}, {}
        self._add_level(1, self.tokens, np.arange(len(self.tokens)))
        for k in range(2, depth + 2):
            if k - 1 not in self.replies:
                break
            # runs whose first k-1 words are a context: seen twice in training, without an end inside
            often = self.counts(k - 1)[self.which[k - 1]] >= 2
            last = self.at[k - 1][often]
            hashes = self.keys[k - 1][self.which[k - 1][often]]
            inside = ~self.is_end[last]
            last, hashes = last[inside] + 1, hashes[inside]
            self._add_level(k, mix(hashes * np.uint64(0xD6E8FEB86659FD93) + self.tokens[last] + np.uint64(k)), last)

    def _take(self, replies: pa.Table) -> None:
        rows = sorted(zip(replies["kind"].to_pylist(), replies["part"].to_pylist(), range(replies.num_rows)))
        data, owner = replies["data"], replies["owner"]
        for kind in {k for k, _, _ in rows}:
            mine = [i for k, _, i in rows if k == kind]
            dtype = np.bool_ if kind >= GAIN else np.int64
            self.replies[kind] = (
                np.concatenate([np.frombuffer(_opened(data[i]), dtype) for i in mine]),
                np.concatenate([np.frombuffer(_opened(owner[i]), np.bool_) for i in mine]))

    def _add_level(self, k: int, hashes: np.ndarray, at: np.ndarray) -> None:
        self.keys[k], _, self.which[k] = _distinct(hashes)
        self.at[k] = at

    def counts(self, k: int) -> np.ndarray:
        """Training counts of all blocks for ``keys[k]``."""
        return self.replies[k][0] if k in self.replies else np.zeros(0, np.int64)

    def _send(self, kind: int, k: int, pick: np.ndarray | slice, values: np.ndarray, range_bits: int) -> list[dict]:
        keys = self.keys[k][pick]
        parts = (keys >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(keys), np.int64)
        cuts = np.searchsorted(parts, np.arange((1 << range_bits) + 1))
        short = keys if k == 1 else (keys >> np.uint64(32 - range_bits)).astype(np.uint32)
        return [{"part": p, "block": self.block, "kind": kind, "keys": short[i:j].tobytes(),
                 "values": _shut(values[i:j].tobytes())}
                for p, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]

    def send_counts(self, k: int, range_bits: int) -> list[dict]:
        mine = np.bincount(self.which[k], weights=self.train[self.at[k]], minlength=len(self.keys[k]))
        return self._send(k, k, slice(None), mine.astype(np.int64), range_bits)

    def contexts(self, k: int) -> np.ndarray:
        """Which of ``keys[k]`` can be contexts."""
        usable = self.counts(k) >= 2
        ends = np.zeros(len(usable), bool)
        ends[self.which[k][self.is_end[self.at[k]]]] = True
        return usable & ~ends

    def send_gains(self, k: int, totals: tuple[int, int], range_bits: int) -> list[dict]:
        """What this block's own runs of k+1 words say for their k-word contexts."""
        owner = self.replies[k + 1][1]
        first = _first(self.which[k + 1], len(self.keys[k + 1]))  # a position of each run
        mine = owner & (self.counts(k + 1) > 0)
        at = self.at[k + 1][first[mine]]
        n = self.counts(k + 1)[mine].astype(float)
        context = self._index(k, at - 1)
        c = self.counts(k)[context].astype(float)
        parent = self.probability(at, k - 1, totals)
        weight = c ** 0.75
        gains = n * np.log((n - 1 + weight * parent) / (c - 1 + weight) / parent)
        total = np.bincount(context, weights=gains, minlength=len(self.keys[k]))
        pick = self.contexts(k)
        return self._send(GAIN + k, k, pick, total[pick], range_bits)

    def _index(self, k: int, at: np.ndarray) -> np.ndarray:
        """Index into ``keys[k]`` of the run that ends at each position, -1 where there is none."""
        where = np.full(len(self.tokens) + 1, -1, np.int64)
        where[self.at[k]] = self.which[k]
        return where[at]

    def probability(self, at: np.ndarray, depth: int, totals: tuple[int, int]) -> np.ndarray:
        """Probability of the tokens at these positions under states of at most ``depth`` words."""
        tokens, distinct = totals
        p = (self.counts(1)[self._index(1, at)] + 0.5) / (tokens + 0.5 * (distinct + 1))
        begin = np.cumsum(self.lengths) - self.lengths
        room = at - begin[self.doc[at]]
        for k in range(1, depth + 1):
            if GAIN + k not in self.replies:
                break
            states = np.zeros(len(self.keys[k]) + 1, bool)  # the last stands for "no such run"
            states[np.flatnonzero(self.contexts(k))] = self.replies[GAIN + k][0]
            context = np.where(room >= k, self._index(k, at - 1), -1)
            use = states[context]
            c = self.counts(k)[context[use]].astype(float)
            run = self._index(k + 1, at[use])
            n = np.where(run >= 0, self.counts(k + 1)[run] if len(self.counts(k + 1)) else 0, 0)
            weight = c ** 0.75
            p[use] = (n + weight * p[use]) / (c + weight)
        return p

    def scores(self, depth: int, totals: tuple[int, int]) -> pa.Table:
        at = np.arange(len(self.tokens))
        begin = np.cumsum(self.lengths) - self.lengths
        known = (self.counts(1)[self.which[1]] > 0).astype(np.int64)
        return pa.table({
            "doc_id": pa.array(self.ids, pa.int64()), "held_out": pa.array(self.held),
            "n_tokens": pa.array(self.lengths.astype(np.int64)),
            "n_known": pa.array(np.add.reduceat(known, begin)),
            "base_score": pa.array(np.add.reduceat(np.log10(self.probability(at, 0, totals)), begin)),
            "score": pa.array(np.add.reduceat(np.log10(self.probability(at, depth, totals)), begin))}, schema=_SCORED)


def _sender(round_: int, depth: int, totals: tuple[int, int] | None, range_bits: int):
    def first(packed: pa.Table) -> pa.Table:
        return run(packed, None)

    def run(packed: pa.Table, replies: pa.Table | None) -> pa.Table:
        if not packed.num_rows:
            return _SENT.empty_table()
        block, rows = _Block(packed, replies, depth), []
        if round_ <= depth + 1:
            rows += block.send_counts(round_, range_bits)
        if 1 <= round_ - 2 <= depth:
            rows += block.send_gains(round_ - 2, totals, range_bits)
        return pa.Table.from_pylist(rows, _SENT)
    return first if round_ == 1 else run


def _answer(gain: float):
    """Adds up what all blocks sent for a range of keys, and answers each block in its own order."""
    def run(sent: pa.Table) -> pa.Table:
        rows = []
        kinds, blocks = sent["kind"].to_pylist(), sent["block"].to_pylist()
        part = sent["part"][0].as_py()
        for kind in sorted(set(kinds)):
            mine = sorted((i for i, k in enumerate(kinds) if k == kind), key=lambda i: blocks[i])
            word = kind % GAIN == 1
            keys = [np.frombuffer(sent["keys"][i].as_buffer(), np.uint64 if word else np.uint32) for i in mine]
            values = [np.frombuffer(_opened(sent["values"][i]), np.float64 if kind >= GAIN else np.int64)
                      for i in mine]
            distinct, first, which = _distinct(np.concatenate(keys))
            total = np.bincount(which, weights=np.concatenate(values))
            owner = np.zeros(len(which), bool)
            owner[first] = True
            data = (total > gain if kind >= GAIN else np.rint(total).astype(np.int64))[which]
            tokens = int(np.rint(total.sum())) if kind == 1 else 0
            seen = int((total > 0).sum()) if kind == 1 else 0
            at = 0
            for i, k in zip(mine, keys):
                rows.append({"block": blocks[i], "kind": kind, "part": part, "data": _shut(data[at:at + len(k)].tobytes()),
                             "owner": _shut(owner[at:at + len(k)].tobytes()), "tokens": tokens, "distinct": seen})
                tokens = seen = 0  # counted once
                at += len(k)
        return pa.Table.from_pylist(rows, _REPLY)
    return run


def _scorer(depth: int, totals: tuple[int, int]):
    def run(packed: pa.Table, replies: pa.Table) -> pa.Table:
        return _Block(packed, replies, depth).scores(depth, totals) if packed.num_rows else _SCORED.empty_table()
    return run


def suffix_tree_scores(docs: DataFrame, held_out: Column | None = None, depth: int = 2, gain: float = 2.0) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row; scores are log10.

    Rows with ``held_out`` (by default: crc32 of the id modulo 5 is 1) are scored but not learnt from.
    """
    held = fold_of(F.col("doc_id")) == 1 if held_out is None else F.coalesce(held_out, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"),
                        F.coalesce("text", F.lit("")).alias("text"))
    size, rows = texts.agg(F.sum(F.octet_length("text").cast("bigint")), F.count("*")).first()
    blocks = 1 + ((size or 0) + 16 * rows) // BLOCK_BYTES
    range_bits = max(0, int(((size or 0) // 6 + rows) // RANGE_TOKENS).bit_length())
    packed = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")) \
        .mapInArrow(_pack, _PACKED).repartition(blocks, "block").persist(StorageLevel.DISK_ONLY)
    replies, totals = None, None
    for round_ in range(1, depth + 3):
        sender = _sender(round_, depth, totals, range_bits)
        if replies is None:
            sent = packed.groupBy("block").applyInArrow(sender, _SENT_SQL)
        else:
            sent = packed.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(sender, _SENT_SQL)
        answers = saved(sent.groupBy("part").applyInArrow(_answer(gain), _REPLY_SQL), f"answers-{round_}")
        if round_ == 1:
            tokens, distinct = answers.agg(F.sum("tokens"), F.sum("distinct")).first()
            totals = (tokens or 0, distinct or 0)
        replies = answers if replies is None else replies.union(answers)
    scored = saved(packed.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _scorer(depth, totals), _SCORED_SQL), "scores")
    packed.unpersist()
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals[0]).cast("bigint").alias("train_tokens"),
                         "base_score", "score")
