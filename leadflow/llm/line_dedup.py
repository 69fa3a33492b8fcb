"""Line dedup by an exact set-similarity join.

A line is the set of its distinct lower-cased words.  A line goes when an earlier line (smaller doc_id, then smaller line
number) has ``100 * |A and B| >= percent * |A or B|``; whether that earlier line goes itself does not matter.  The operator
finds every such line, of any length.  Lines without words stay.

1. Rarity: hashed counts of each word over all texts.
2. Signatures: a line's words ordered rare first.  Two matching lines share at least two of their first
   ``n - ceil(t n) + 2`` words.  If the rarest shared word is rare, it is a key alone; if not, the two rarest shared are a key
   together, so that common words do not bring unrelated lines together.  Lines of ``LONG`` words and more, and those
   that can match them, also use each of their first ``n - ceil(t n) + 1`` words as a key.  Words of a single line are
   left out, as are keys that occur once.  Of its keys two matching lines need to meet under the first alone, the words before
   which are not shared.  A set of less than ``t / (1 - t)`` words (9 at 90 %) matches equal sets alone,
   which need no keys.
3. Equal sets: the earliest line of a set stands for it.  The rows of a key are read in order.  The first ``SMALL`` sets
   of a key are paired with each other, each further one with the closest of them, all under the length, positional
   and parity filters.  What passes is verified on the sets themselves.
4. Sets of larger keys that are not found yet are joined with the earlier sets of their keys, under the same filters, and
   verified.  In a large group of near copies nearly all go in step 3, at ``SMALL`` tests per line and key.

Null and blank texts have no lines.  Rows repeated with id and text are one occurrence; different texts under one id
are ordered by a hash of the text after the line number.  A null id sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm import rarity
from leadflow.llm.common import discard, saved, split_by, thrifty
from leadflow.llm.wordscan import Scan, mix, scan

LONG = 200
RARE = 1 + 4 * rarity.STEPS  # level of a word in 32 lines
SMALL = 64

_LINES = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("set", pa.int64()), ("parity", pa.int64()),
                    ("n", pa.int32()), ("keys", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])
_LINES_SQL = "doc_id bigint, at bigint, `set` bigint, parity bigint, n int, keys array<bigint>, places array<int>"
_KEYED_SQL = "key bigint, doc_id bigint, at bigint, `set` bigint, parity bigint, shape bigint"  # shape: n << 32 | place
_KEYED = pa.schema([(c, pa.int64()) for c in ("key", "doc_id", "at", "set", "parity", "shape")])
_MET = pa.schema([(c, pa.int64()) for c in (
    "set", "doc_id", "at", "of", "odoc_id", "oat", "key", "parity", "shape")])
_MET_SQL = "`set` bigint, doc_id bigint, at bigint, of bigint, odoc_id bigint, oat bigint, key bigint, parity bigint, shape bigint"


def _order(values: np.ndarray) -> np.ndarray:
    """As ``argsort``: numbers with their places in the lowest bits sort faster; where what is left of them does not tell
    all apart that differ, ``argsort`` itself."""
    low = np.uint64(max(1, len(values).bit_length()))
    packed = np.sort((values >> low << low) | np.arange(len(values), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    there = values[order]
    return order if (there[1:] >= there[:-1]).all() else np.argsort(values)


def _by_line(s: Scan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words by line: unit of each, hash, and for each unit its text and line number."""
    breaks = np.flatnonzero(s.data == 10)
    text = np.repeat(np.arange(len(s.bounds) - 1), np.diff(s.bounds))
    before = np.searchsorted(breaks, s.starts)
    unit = before + text
    units, first = np.unique(unit, return_index=True)
    where = text[first]
    line = before[first] - np.searchsorted(breaks, s.offsets[where])
    unit = np.repeat(np.arange(len(units)), np.diff(np.append(first, len(unit))))
    bits = max(1, int(len(units)).bit_length())
    order = _order((unit.astype(np.uint64) << np.uint64(64 - bits)) | (s.hashes >> np.uint64(bits)))
    unit, h = unit[order], s.hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (h[1:] != h[:-1])
    return unit[new], h[new], where, line


@thrifty
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = rarity.Counter()
    for batch in batches:
        for s in scan(batch.column("text")):
            counter.add(s.hashes)
    yield from counter.batches()


@thrifty
def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = rarity.Counter()
    for batch in batches:
        counter.add(batch.column("keys").flatten().to_numpy().view(np.uint64))
    yield from counter.batches()


def _ats(s: Scan, where: np.ndarray, line: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Line number, and 32 bits of the text's hash behind it."""
    return (line.astype(np.int64) << 32) | (keys[s.first + where] & 0xFFFFFFFF)


def _sign(percent: int, levels):
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 30  # a smaller set matches no other than itself

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, {}
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text_key").to_numpy()
            for s in scan(batch.column("text")):
                if len(s.hashes):
                    yield from _rows(s, ids, texts, level, seen)

    def _rows(s, ids, texts, level, seen: dict) -> Iterator[pa.RecordBatch]:
        unit, h, where, line = _by_line(s)
        n = np.bincount(unit, minlength=len(where))
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        scrambled = mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A))
        whole = mix(np.add.reduceat(scrambled, begin) + n.astype(np.uint64))
        parity = np.bitwise_xor.reduceat(np.uint64(1) << (h & np.uint64(63)), begin)
        # copies inside a task do not bring their keys again
        new = np.fromiter((seen.setdefault(x, i) == i and not i < 0 for i, x in enumerate(whole.tolist())), bool, len(n))
        for x in whole[new].tolist():
            seen[x] = -1
        new &= n >= least
        lv = rarity.level_of(level, h)
        bits = max(1, int(len(n)).bit_length())
        order = _order((unit.astype(np.uint64) << np.uint64(64 - bits))
                       | (lv.astype(np.uint64) << np.uint64(56 - bits)) | (h >> np.uint64(8 + bits)))
        h, lv = h[order], lv[order]
        place = np.arange(len(h)) - begin[unit]
        spare = n - -(-percent * n // 100)
        out_unit, out_key, out_place = [], [], []
        # one word: rare ones of shorter lines, any of long ones
        short, long_ = n < LONG, 100 * n >= percent * LONG
        head = (place < (spare + 2)[unit]) & (short & new)[unit] & (lv > 0)
        first = place < (spare + 1)[unit]  # where the rarer of two shared words is
        for chosen, salt in ((head & first & (lv <= RARE), 1), (first & (long_ & new)[unit] & (lv > 0), 2)):
            out_unit.append(unit[chosen])
            out_key.append(mix(h[chosen] + np.uint64(salt)))
            out_place.append(place[chosen])
        # two words, none of them rare
        rest = head & (lv > RARE)
        ru, rh, rp = unit[rest], h[rest], place[rest]
        step = 1
        while step < len(ru):
            same = ru[step:] == ru[:-step]
            if not same.any():
                break
            i = np.flatnonzero(same)
            out_unit.append(ru[i])
            out_key.append(mix(rh[i] * np.uint64(0x9E3779B97F4A7C15) + rh[i + step] + np.uint64(3)))
            out_place.append(rp[i + step] - 1)  # of all words before the second one no more than the first is shared
            step += 1
        out_unit = np.concatenate(out_unit)
        by = np.argsort(out_unit, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(out_unit, minlength=len(n)))]).astype(np.int32)
        keys = np.concatenate(out_key)[by].view(np.int64)
        places = np.concatenate(out_place)[by].astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            ids.take(pa.array(s.first + where)), pa.array(_ats(s, where, line, texts)),
            pa.array(whole.view(np.int64)), pa.array(parity.view(np.int64)), pa.array(n.astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(places))], schema=_LINES)
    return run


def _live(levels):
    """A row for each key that may occur twice."""
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for b in batches:
            keys = b.column("keys")
            flat = keys.flatten().to_numpy()
            live = rarity.level_of(level, flat.view(np.uint64)) > 0
            parent = np.repeat(np.arange(len(keys)), keys.value_lengths().to_numpy())[live]
            place = b.column("places").flatten().to_numpy()[live].astype(np.int64)
            rows = b.select(["doc_id", "at", "set", "parity"]).take(pa.array(parent))
            shape = (b.column("n").to_numpy().astype(np.int64)[parent] << 32) | place
            yield pa.RecordBatch.from_arrays([pa.array(flat[live]), *rows.columns, pa.array(shape)], schema=_KEYED)
    return run


def _apart(percent: int, x: dict, i: np.ndarray, y: dict, j: np.ndarray, first: bool) -> np.ndarray:
    """Differing parity bits of rows i of x and rows j of y; 99 for pairs the length, positional or parity filter rules out.
    With ``first``, also for pairs that match only if they share rarer words as well: they meet under the key of those."""
    n, m = x["shape"][i] >> 32, y["shape"][j] >> 32
    p, q = x["shape"][i] & 0xFFFFFFFF, y["shape"][j] & 0xFFFFFFFF
    least = -(-percent * (n + m) // (100 + percent))
    bits = np.bitwise_count((x["parity"][i] ^ y["parity"][j]).view(np.uint64))
    ok = ((x["set"][i] != y["set"][j])
          & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
          & ((0 if first else np.minimum(p, q)) + np.minimum(n - p, m - q) >= least)
          & (bits <= n + m - 2 * least))
    return np.where(ok, bits, 99)


def _columns(batch: pa.RecordBatch) -> dict:
    out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "doc_id"}
    return out | {"doc_id": batch.column("doc_id")}


def _distinct(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The first row of each key and set."""
    key, set_ = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "set"))
    _, first = np.unique(mix(key + mix(set_)), return_index=True)
    return batch.take(pa.array(np.sort(first)))


def _pairs(x: dict, i: np.ndarray, y: dict, j: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(i), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(x["set"][i]), x["doc_id"].take(pa.array(i)), pa.array(x["at"][i]), pa.array(y["set"][j]),
         y["doc_id"].take(pa.array(j)), pa.array(y["at"][j]), none, none, none], schema=_MET)


def _members(x: dict) -> pa.RecordBatch:
    none = pa.nulls(len(x["key"]), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(x["set"]), x["doc_id"], pa.array(x["at"]), none, none, none,
         pa.array(x["key"]), pa.array(x["parity"]), pa.array(x["shape"])], schema=_MET)


def _meet(percent: int):
    """Pairs of sets under one key that may match, and the members of larger keys; rows come ordered by key and position."""
    def within(rows: dict, begin: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All pairs of the rows begin .. begin + size of each key."""
        for step in range(1, int(size.max(initial=0))):
            some = size > step
            count = size[some] - step
            j = np.repeat(begin[some], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            ok = _apart(percent, rows, j + step, rows, j, first=True) < 99
            yield _pairs(rows, j[ok] + step, rows, j[ok])

    def with_heads(rows: dict, heads: dict) -> Iterator[pa.RecordBatch]:
        """Each row with the closest head."""
        k = len(heads["key"])
        for at in range(0, len(rows["key"]), 4096):
            i = np.arange(at, min(at + 4096, len(rows["key"])))
            bits = _apart(percent, rows, np.repeat(i, k), heads, np.tile(np.arange(k), len(i)), first=False).reshape(-1, k)
            best = bits.argmin(axis=1)
            ok = bits.min(axis=1, initial=99) < 99
            yield _pairs(rows, i[ok], heads, best[ok])

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = heads = None  # the last key so far: its rows while they are few, else its first rows
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = _distinct(pa.concat_batches([rest, batch]) if rest is not None else batch)
            rest = None
            key = batch.column("key").to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(begin, len(key)))
            if heads is not None:
                if key[0] == heads.column("key")[0].as_py():
                    more = _columns(batch.slice(0, size[0]))
                    yield _members(more)
                    yield from with_heads(more, _columns(heads))
                    begin, size = begin[1:], size[1:]
                if len(begin):
                    heads = None
            if not len(begin):
                continue
            if size[-1] <= SMALL:
                rest = batch.slice(begin[-1])
                begin, size = begin[:-1], size[:-1]
            else:
                heads = batch.slice(begin[-1], SMALL)
            yield from within(_columns(batch), begin, np.minimum(size, SMALL))
            for b, n in zip(begin[size > SMALL], size[size > SMALL]):
                yield _members(_columns(batch.slice(b, n)))
                yield from with_heads(_columns(batch.slice(b + SMALL, n - SMALL)), _columns(batch.slice(b, SMALL)))
        if rest is not None:
            yield from within(_columns(rest), np.array([0]), np.array([rest.num_rows]))
    return run


@thrifty
def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = rarity.Counter()
    for batch in batches:
        h = _position(batch.column("doc_id"), batch.column("at").to_numpy())
        for marks in (h, _position(batch.column("doc_id"), _of_text(batch.column("at").to_numpy()))):
            counter.add(marks)
            counter.add(marks)  # twice, as the level of a single one is zero
    yield from counter.batches()


def _of_text(at: np.ndarray) -> np.ndarray:
    """Stands for the text a position is in."""
    return (at & 0xFFFFFFFF) | (1 << 62)


def _position(ids: pa.Array, at: np.ndarray) -> np.ndarray:
    numbers = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return mix(mix(numbers) + at.view(np.uint64))


def _sets(levels):
    """Word sets of marked lines (and of a few others that share a mark)."""
    schema = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("words", pa.binary())])

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            whole = _position(batch.column("doc_id"), _of_text(batch.column("text_key").to_numpy()))
            batch = batch.filter(pa.array(rarity.level_of(level, whole) > 0))
            ids = batch.column("doc_id")
            texts = batch.column("text_key").to_numpy()
            for s in scan(batch.column("text")):
                if not len(s.hashes):
                    continue
                unit, h, where, line = _by_line(s)
                at = _ats(s, where, line, texts)
                owners = ids.take(pa.array(s.first + where))
                marked = np.flatnonzero(rarity.level_of(level, _position(owners, at)) > 0)
                if not len(marked):
                    continue
                begin = np.searchsorted(unit, marked)
                end = np.searchsorted(unit, marked, "right")
                yield pa.RecordBatch.from_arrays([
                    owners.take(pa.array(marked)), pa.array(at[marked]),
                    pa.array([h[i:j].tobytes() for i, j in zip(begin, end)], pa.binary())], schema=schema)
    return run


WIDE = [f"p{i}" for i in range(4)]


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """256 parity bits of each word set."""
    for b in batches:
        out = np.zeros((b.num_rows, len(WIDE)), np.uint64)
        for i, words in enumerate(b.column("words")):
            h = np.frombuffer(words.as_buffer(), np.uint64)
            bit = np.uint64(1) << ((h >> np.uint64(8)) & np.uint64(63))
            for part in range(len(WIDE)):
                out[i, part] = np.bitwise_xor.reduce(bit[(h >> np.uint64(14)) & np.uint64(3) == part], initial=np.uint64(0))
        yield pa.RecordBatch.from_arrays(
            [b.column("set"), b.column("words"), *[pa.array(out[:, i].view(np.int64)) for i in range(len(WIDE))]],
            names=["set", "words", *WIDE])


def _match(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("wx"), b.column("wy")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["set", "of"]).filter(pa.array(keep, pa.bool_()))
    return run


def _filters(percent: int) -> Column:
    """Length, positional and parity filters of the columns of a set against those named ``o*``, with wide parity."""
    n, m = F.shiftright("shape", 32), F.shiftright("oshape", 32)
    p, q = F.expr("shape & 4294967295"), F.expr("oshape & 4294967295")
    least = F.ceil((n + m) * percent / (100 + percent))
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"o{c}"))) for c in WIDE), F.lit(0))
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.least(n - p, m - q) >= least)  # the first key they share
            & (apart <= n + m - 2 * least))


def _word_sets(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """``set, words`` of the given lines (``set, doc_id, at``)."""
    # any line of a set will do; numbers alone are added up by hash, a struct would be sorted
    wanted = saved(wanted.select("set", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "at").groupBy("set").agg(
        F.first(F.col("doc_id")).alias("doc_id"), F.first(F.col("at")).alias("at")), "wanted-lines")
    places = wanted.select("doc_id", "at")
    wanted = wanted.select("set", F.struct("doc_id", "at").alias("line"))
    marks = wanted.sparkSession.sparkContext.broadcast(
        rarity.levels(places.mapInArrow(_mark, rarity.PART_SCHEMA)))
    found = texts.mapInArrow(_sets(marks), "doc_id bigint, at bigint, words binary").select(
        F.struct(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "at").alias("line"), "words")
    found = found.join(wanted, "line").groupBy("set").agg(F.first("words").alias("words"))
    return saved(found.mapInArrow(_wide, "`set` bigint, words binary, " + ", ".join(f"{c} bigint" for c in WIDE)), "line-sets")


def _verified(tries: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``set, of`` that match."""
    x = words.select("set", F.col("words").alias("wx"))
    y = words.select(F.col("set").alias("of"), F.col("words").alias("wy"))
    return tries.distinct().join(x, "set").join(y, "of").mapInArrow(_match(percent), "`set` bigint, of bigint")


def repeated_lines(docs: DataFrame, percent: int = 90) -> DataFrame:
    """``doc_id, text_bits, line`` of every line that goes (lines counted from 0, by line feed)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("text_key", F.xxhash64("text"))
    levels = spark.sparkContext.broadcast(
        rarity.levels(texts.select("text").mapInArrow(_count, rarity.PART_SCHEMA)))
    lines = saved(texts.mapInArrow(_sign(percent, levels), _LINES_SQL), "lines")
    often = spark.sparkContext.broadcast(rarity.levels(lines.select("keys").mapInArrow(_count_keys, rarity.PART_SCHEMA)))
    # of each set the earliest line, which stands for the others
    position = F.struct("doc_id", "at")
    sets = saved(lines.groupBy("set").agg(F.min(position).alias("first"), F.count("*").alias("size")), "line-firsts")
    copies = lines.join(sets.where("size > 1").select("set", "first"), "set").where(position > F.col("first")) \
        .select("doc_id", "at")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    met = saved(lines.where(F.size("keys") > 0).mapInArrow(_live(often), _KEYED_SQL).repartition(width, "key")
                .sortWithinPartitions("key", "doc_id", "at").mapInArrow(_meet(percent), _MET_SQL), "met-lines")
    words = _word_sets(
        met.select("set", "doc_id", "at").union(met.where("key is null").select("of", "odoc_id", "oat")), texts)
    # the few sets that meet another: all that the following needs to know of
    known = saved(sets.select("set", "first").join(words.select("set"), "set", "left_semi"), "met-sets")
    links = saved(_verified(met.where("key is null").select("set", "of"), words, percent), "line-links")

    def later(pairs: DataFrame) -> DataFrame:
        """The sets that have an earlier match."""
        mine = known.select("set", F.col("first").alias("mine"))
        other = known.select(F.col("set").alias("of"), F.col("first").alias("other"))
        both = pairs.join(mine, "set").join(other, "of")
        return both.select(F.when(F.col("mine") > F.col("other"), F.col("set")).otherwise(F.col("of")).alias("set"))

    done = saved(later(links).distinct(), "late-sets")
    # larger keys: sets not found yet against all others of the key
    members = met.where("key is not null").groupBy("key", "set").agg(F.first("shape").alias("shape")) \
        .join(words.select("set", *WIDE), "set").join(known, "set")
    asking = members.join(done, "set", "left_anti")
    asked = members.select("key", *[F.col(c).alias("of" if c == "set" else f"o{c}") for c in ("set", "shape", "first", *WIDE)])
    pairs = asking.join(asked, "key").where("ofirst < first").where(_filters(percent))
    more = _verified(pairs.select("set", "of"), words, percent)
    late = done.union(later(more)).distinct()
    near = known.join(late, "set").select("first.doc_id", "first.at")
    gone = saved(copies.union(near).distinct().select(
        "doc_id", F.expr("at & 4294967295").alias("text_bits"), F.shiftright("at", 32).cast("int").alias("line")), "late-lines")
    discard(lines, sets, met, words, known, links, done)
    return gone


def cut_lines(docs: DataFrame, percent: int = 90) -> DataFrame:
    """``row`` (all columns of ``docs`` in one, so that no name can clash), ``text`` without the repeated lines, ``n_lines``
    and ``n_dropped``; rows without any are as they were."""
    late = repeated_lines(docs, percent)
    gone = late.groupBy("doc_id", "text_bits").agg(F.collect_set("line").alias("gone")) \
        .withColumnsRenamed({"doc_id": "of", "text_bits": "bits"})
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"), F.col("doc_id").cast("bigint").alias("id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF)).alias("key"))
    # texts that lose no line stay where they are
    cut, whole = split_by(keyed, ["id", "key"], late, ["doc_id", "text_bits"])
    joined = cut.join(gone, [F.col("id").eqNullSafe(F.col("of")), F.col("key") == F.col("bits")], "left").select("row", "text", "gone") \
        .unionByName(whole.select("row", "text", F.lit(None).cast("array<int>").alias("gone"))) \
        .withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))  # a column, so that it is split once and not for each line
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")  # by hash, in order
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return joined.select("row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
                         F.size("lines").cast("bigint").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame, percent: int = 90) -> DataFrame:
    """``docs`` without the repeated lines, with ``n_lines`` and ``n_dropped`` beside (in place of columns of these names)."""
    counts = ("n_lines", "n_dropped")
    return cut_lines(docs, percent).select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c not in counts], *counts)
