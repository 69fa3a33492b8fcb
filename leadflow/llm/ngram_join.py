"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles; two link when ``100 * |A and B| >= percent * |A or B|``.  The result names for each
document the component it belongs to, without writing all pairs of a group.

1. Equal sets become one node (a 64-bit hash of the sorted shingle hashes).
2. Groups: nodes that share a minimum shingle in one of four parts of the hash range are held against one node met
   there, the one whose shingles are the most frequent: among copies of a text that is the text itself rather than a
   changed copy.  Those that really link to it are grouped with it.  A group of any size costs one test a member.
3. Token-group matrix: for each group the union of its members' prefix shingles, each with the members' size range.  In any
   fixed order, the first ``n - ceil(t n) + l`` shingles of the larger and ``n - ceil(2t/(1+t) n) + l`` of the smaller of two
   linking sets share at least l.  The order is
   frequent shingles last, rare words first (hashed counts over all texts); a shingle with a word of one text only cannot
   be shared.
4. A query node counts how many of its prefix shingles a foreign group's union holds; only groups that reach l and fit in
   size are opened.  The smaller group asks the larger, each pair of groups once.  The query node first meets two
   members that hold each of the shared shingles; groups found linked by then are one and need no more.
   A member of an opened group of more than ``FEW`` is met in one of two ways only.  Both are held against one centre of the
   group: shingles beyond the centre's are either shared, and bring the two together, or what is shared is within the
   centre, at most what the one with less of it has.  The latter is tested for all members of one size and one number
   of shingles beyond at once.
5. Members so met pass an exact bound first (parity bitmaps: differing bits never exceed differing shingles), then the
   sets themselves are compared.
6. Components over the links of 2, 4 and 5.

Nulls and blank texts have no shingles and stay alone.  Repeated rows share their set and so their component.  A null
id counts as absent: the component is named after its smallest id that is not null.  No input, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm import rarity
from leadflow.llm.common import saved, split_by, thrifty
from leadflow.llm.graph import components
from leadflow.llm.wordscan import grams, scan, shingles

PARTS = 4
LEAST_BITS = 512
GRAM_BITS = 22
FEW = 16

_SIGNED = pa.schema([
    ("kind", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
    ("keys", pa.list_(pa.int64())), ("parity", pa.binary()),
    ("chunk", pa.int32()), ("share", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary())])
_SIGNED_SQL = ("kind int, doc_id bigint, text_key bigint, n bigint, node bigint, keys array<bigint>, parity binary, "
               "chunk int, share int, slots binary, counts binary")


def _signed64(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _node(sh: np.ndarray) -> int:
    return int.from_bytes(blake2b(sh.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parity(sh: np.ndarray) -> bytes:
    """Per slot whether an odd number of shingles falls in it; at least half a bit a shingle."""
    bits = max(LEAST_BITS, 1 << (len(sh) // 2).bit_length())
    odd = np.bincount((sh & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _differing(x: bytes, y: bytes) -> int:
    """Bits in which two parity maps differ, the longer one folded."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    na, nb = 8 * len(x), 8 * len(y)
    while na > nb:
        na //= 2
        a = (a >> na) ^ (a & ((1 << na) - 1))
    while nb > na:
        nb //= 2
        b = (b >> nb) ^ (b & ((1 << nb) - 1))
    return (a ^ b).bit_count()


def _sign(words: int):
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counters = {1: rarity.Counter(), 2: rarity.Counter(GRAM_BITS)}  # of words, of shingles
        edges = np.array([0] + [i << (64 - PARTS.bit_length() + 1) for i in range(1, PARTS)], np.uint64)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text_key")
            for s in scan(batch.column("text")):
                rows = []
                for i in range(len(s.bounds) - 1):
                    h = s.hashes[s.bounds[i]:s.bounds[i + 1]]
                    sh = shingles(h, words)
                    if len(h):
                        counters[1].add(np.unique(h))
                        counters[2].add(sh)
                    at = np.searchsorted(sh, edges)
                    ends = np.append(at[1:], len(sh))
                    rows.append({
                        "kind": 0, "doc_id": ids[s.first + i].as_py(), "text_key": texts[s.first + i].as_py(),
                        "n": len(sh), "node": _node(sh), "keys": sh[at[at < ends]].view(np.int64).tolist(),
                        "parity": _parity(sh)})
                yield pa.RecordBatch.from_pylist(rows, _SIGNED)
        context = TaskContext.get()
        for kind, counter in counters.items():
            for row in counter.rows(context.partitionId()):
                yield pa.RecordBatch.from_pylist([{"kind": kind, **row}], _SIGNED)
    return run


_PREFIX = pa.schema([("node", pa.int64()), ("common", pa.int64()), ("short", pa.int32()),
                     ("tokens", pa.list_(pa.int64()))])


def slack(n: int) -> int:
    """How many prefix shingles two linking sets must share."""
    return 1 if n < 20 else 2


def _prefixes(words: int, percent: int, levels, gram_levels):
    """Prefix shingles of each set that can link with another, and how frequent its shingles are on average."""
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, gram_level = levels.value, gram_levels.value
        usual = int(np.median(gram_level)) + rarity.STEPS  # twice what chance puts into a counter
        for batch in batches:
            for s in scan(batch.column("text")):
                every = rarity.level_of(level, s.hashes)
                rows = []
                for i in range(len(s.bounds) - 1):
                    h, lv = (x[s.bounds[i]:s.bounds[i + 1]] for x in (s.hashes, every))
                    k = min(words, len(h))
                    if not k:
                        continue
                    g = grams(h, k)
                    lv = lv.astype(np.int32)
                    cut = len(g)
                    rank = sum(lv[j:cut + j] for j in range(k))
                    alone = np.minimum.reduce([lv[j:cut + j] for j in range(k)]) == 0
                    sh, first = np.unique(g, return_index=True)
                    n = len(sh)
                    if 100 * n < percent * (n + 1):
                        continue  # links with equal sets only
                    overlap = -(-percent * n // 100)
                    often = rarity.level_of(gram_level, sh).astype(np.int32)
                    order = np.argsort((np.maximum(often - usual, 0) << 16) + np.minimum(rank[first], 65535), kind="stable")
                    order = order[:n - overlap + slack(n)]
                    shared = ~alone[first[order]]
                    take = order[shared]
                    # as the smaller of two sets it needs no more than these
                    least = n - -(-2 * percent * n // (100 + percent)) + slack(n)
                    rows.append({"node": _node(sh), "common": int(1000 * often.mean()), "short": int(shared[:least].sum()),
                                 "tokens": sh[take].view(np.int64).tolist()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _PREFIX)
    return run


_TOKEN = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("grp", pa.int64()), ("size", pa.int64()),
                    ("short", pa.bool_())])
_TOKEN_SQL = "token bigint, node bigint, n bigint, grp bigint, size bigint, short boolean"


@thrifty
def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = rarity.Counter()
    for batch in batches:
        h = batch.column("token").to_numpy().view(np.uint64)
        counter.add(h)
        counter.add(h)  # twice, as the level of a single one is zero
    yield from counter.batches()


def _marked(marks):
    """A row for each prefix shingle that is marked (and a few others that share a mark)."""
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = marks.value
        for b in batches:
            lists = b.column("tokens")
            flat = lists.flatten().to_numpy()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            parent = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = np.flatnonzero(rarity.level_of(level, flat.view(np.uint64)) > 0)
            rows = b.select(["node", "n", "grp", "size"]).take(pa.array(parent[at]))
            short = place[at] < b.column("short").to_numpy()[parent[at]]
            yield pa.RecordBatch.from_arrays([pa.array(flat[at]), *rows.columns, pa.array(short)], schema=_TOKEN)
    return run


def _close(percent: int):
    """Pairs whose parity maps allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column("px").to_pylist(), b.column("py").to_pylist()
            total = b.column("nx").to_numpy() + b.column("ny").to_numpy()
            most = total - 2 * -(-percent * total // (100 + percent))
            keep = [_differing(p, q) <= m for p, q, m in zip(x, y, most)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("sx"), b.column("sy")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _sets(words: int):
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            for s in scan(batch.column("text")):
                rows = [{"node": nodes[s.first + i],
                         "set": shingles(s.hashes[s.bounds[i]:s.bounds[i + 1]], words).tobytes()}
                        for i in range(len(s.bounds) - 1)]
                yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the node pairs ``a, b`` that really link."""
    x = nodes.select(F.col("node").alias("a"), F.col("n").alias("nx"), F.col("parity").alias("px"))
    y = nodes.select(F.col("node").alias("b"), F.col("n").alias("ny"), F.col("parity").alias("py"))
    close = saved(
        pairs.join(x, "a").join(y, "b").where(f"100 * least(nx, ny) >= {percent} * greatest(nx, ny)")
        .mapInArrow(_close(percent), "a bigint, b bigint"), "close-pairs")
    sets = _shingle_sets(close.select(F.col("a").alias("node")).union(close.select("b")), nodes, texts, words)
    return (close.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sx")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sy")), "b")
            .mapInArrow(_linked(percent), "a bigint, b bigint"))


def _shingle_sets(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``node, set`` of the wanted nodes."""
    wanted = wanted.select("node").distinct()
    where = saved(nodes.join(wanted, "node").select("node", "doc_id", "text_key"), "wanted-texts")
    # most texts are in no pair and stay where they are
    some, _ = split_by(texts, ["text_key"], where, ["text_key"])
    found = some.join(where, [some.doc_id.eqNullSafe(where.doc_id), some.text_key == where.text_key])
    return saved(found.select("node", "text").mapInArrow(_sets(words), "node bigint, set binary")
                 .dropDuplicates(["node"]), "shingle-sets")


_BEYOND = pa.schema([("node", pa.int64()), ("of", pa.int64()), ("asks", pa.bool_()), ("n", pa.int64()), ("beyond", pa.int64()),
                     ("extra", pa.list_(pa.int64()))])
_BEYOND_SQL = "node bigint, of bigint, asks boolean, n bigint, beyond bigint, extra array<bigint>"


@thrifty
def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set the shingles that the centre beside it has not."""
    for b in batches:
        sets = [[np.frombuffer(v.as_buffer(), np.uint64) for v in b.column(c)] for c in ("set", "within")]
        extra = [np.setdiff1d(x, y, assume_unique=True).view(np.int64) for x, y in zip(*sets)]
        yield pa.RecordBatch.from_arrays(
            [*b.select(["node", "of", "asks"]).columns, pa.array([len(x) for x in sets[0]], pa.int64()),
             pa.array([len(x) for x in extra], pa.int64()), pa.array(extra, pa.list_(pa.int64()))], schema=_BEYOND)


def _of_crowds(asking: DataFrame, members: DataFrame, prefixes: DataFrame, nodes: DataFrame, texts: DataFrame, words: int,
               percent: int) -> DataFrame:
    """Pairs ``a, b`` of the nodes that ask and members of the groups ``of`` they ask, all that may link among them."""
    inside = members.select("node", "n", F.col("grp").alias("of")).join(asking.select("of").distinct(), "of")
    # any set will do; the more frequent shingles it has, the less is beyond it that many share
    centres = saved(inside.join(prefixes.select("node", "common"), "node").groupBy("of").agg(
        F.max(F.struct(F.col("common") * F.col("n"), "node")).alias("most")).select("of", F.col("most.node").alias("centre")), "centres")
    held = saved(asking.select("node", "of", F.lit(True).alias("asks")).union(inside.select("node", "of", F.lit(False).alias("asks")))
                 .join(centres, "of"), "beside-centres")
    sets = _shingle_sets(held.select("node").union(centres.select("centre")), nodes, texts, words)
    within = sets.select(F.col("node").alias("centre"), F.col("set").alias("within"))
    beyond = saved(held.join(sets, "node").join(within, "centre").select("node", "of", "asks", "set", "within")
                   .mapInArrow(_beyond, _BEYOND_SQL), "beyond-centres")
    x = beyond.where("asks").select(F.col("node").alias("a"), "of", "n", "beyond", "extra")
    y = beyond.where("not asks").select(F.col("node").alias("b"), "of", F.col("n").alias("m"), F.col("beyond").alias("more"), "extra")
    kinds = x.drop("extra").join(y.select("of", "m", "more").distinct(), "of") \
        .where(f"100 * least(n, m) >= {percent} * greatest(n, m)") \
        .where(f"{100 + percent} * least(n - beyond, m - more) >= {percent} * (n + m)")
    alike = kinds.join(y.drop("extra"), ["of", "m", "more"]).select("a", "b")
    sharing = x.select("a", "of", "n", F.explode("extra").alias("token")).join(
        y.select("b", "of", "m", F.explode("extra").alias("token")), ["of", "token"])
    return alike.union(sharing.where(f"100 * least(n, m) >= {percent} * greatest(n, m)").select("a", "b"))


def ngram_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key`` (a hash of the text), ``n_shingles``, ``component_id``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("text_key", F.xxhash64("text"))
    signed = saved(texts.mapInArrow(_sign(words), _SIGNED_SQL), "signed")
    levels, gram_levels = (spark.sparkContext.broadcast(rarity.levels(
        signed.where(F.col("kind") == kind).select("chunk", "share", "slots", "counts"), bits))
        for kind, bits in ((1, rarity.BITS), (2, GRAM_BITS)))
    rows = signed.where("kind = 0").select("doc_id", "text_key", "n", "node", "keys", "parity")
    nodes = saved(
        rows.where("n > 0").groupBy("node").agg(
            F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("least_id"),
            F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("parity").alias("parity"))
        .select("node", "first.doc_id", "first.text_key", "least_id", "n", "keys", "parity"), "nodes")

    prefixes = saved(texts.select("text").mapInArrow(
        _prefixes(words, percent, levels, gram_levels), "node bigint, common bigint, short int, tokens array<bigint>")
        .groupBy("node").agg(*[F.first(c).alias(c) for c in ("common", "short", "tokens")]), "prefixes")

    met = nodes.join(prefixes, "node").select("node", "common", F.explode("keys").alias("key"))
    heads = met.groupBy("key").agg(F.max(F.struct("common", "node")).alias("most"), F.count("*").alias("size")) \
        .where("size > 1").select("key", F.col("most.node").alias("head"))
    tries = met.join(heads, "key").where("node <> head") \
        .select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    stars = saved(_links(tries, nodes, texts, words, percent), "star-links")
    grouped = saved(components(stars), "groups")

    sizes = grouped.groupBy("label").agg(F.count("*").alias("size"))
    grouped = grouped.join(sizes, "label")
    members = nodes.select("node", "n").join(grouped, "node", "left").select(
        "node", "n", F.coalesce("label", "node").alias("grp"), F.coalesce("size", F.lit(1)).alias("size"))
    members = saved(members, "members")
    held = saved(prefixes.join(members, "node").select("node", "n", "grp", "size", "short", "tokens"), "grouped-prefixes")
    # only shingles that two groups hold go on: found in one pass over token and group, then picked out at the source
    shared = saved(held.select(F.explode("tokens").alias("token"), "grp").groupBy("token").agg(
        F.min("grp").alias("g0"), F.max("grp").alias("g1")).where("g0 < g1").select("token"), "shared-tokens")
    marks = spark.sparkContext.broadcast(rarity.levels(shared.mapInArrow(_mark, rarity.PART_SCHEMA)))
    tokens = saved(held.mapInArrow(_marked(marks), _TOKEN_SQL).join(shared, "token", "left_semi"), "tokens")
    matrix = saved(tokens.groupBy("token", "grp", "size").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min(F.when(F.col("short"), F.col("n"))).alias("short_lo"),
        F.min("node").alias("first"), F.max("node").alias("last")), "matrix")
    asked = matrix.select("token", F.col("grp").alias("of"), F.col("size").alias("of_size"), "lo", "hi", "short_lo",
                          "first", "last")
    # a shared shingle counts if it is in the short prefix of the smaller and the long prefix of the larger set
    opened = saved(tokens.join(asked, "token")
              .where("size < of_size or (size = of_size and grp < of)")
              .where("(short and hi >= n) or short_lo <= n")
              .where(f"100 * hi >= {percent} * n and 100 * n >= {percent} * lo")
              .groupBy("node", "n", "of", "of_size").agg(F.count("*").alias("met"), F.min("lo").alias("lo"), *[
                  F.collect_set(c).alias(c) for c in ("first", "last")])  # one node each for a prefix shingle
              .where("met >= 2 or n < 20 or lo < 20"), "opened")
    # first against a few members that hold the shared shingles: most groups that belong together are one after that
    some = opened.select(F.col("node").alias("a"), F.explode(F.array_union("first", "last")).alias("b")).distinct()
    links = saved(_links(some, nodes, texts, words, percent), "first-links")
    joined = saved(components(stars.union(links)), "joined-groups")
    opened = opened.select("node", "n", "of", "of_size").join(joined.select("node", F.col("label").alias("own")), "node", "left") \
        .join(joined.select(F.col("node").alias("of"), F.col("label").alias("theirs")), "of", "left") \
        .where(F.coalesce("own", "node") != F.coalesce("theirs", "of")).select("node", "n", "of", "of_size")
    opened = saved(opened, "still-open")
    inside = members.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("grp").alias("of"))
    pairs = opened.where(f"of_size <= {FEW}").join(inside, "of").where(f"100 * least(n, m) >= {percent} * greatest(n, m)") \
        .select(F.col("node").alias("a"), "b")
    crowded = opened.where(f"of_size > {FEW}")
    if not crowded.isEmpty():
        pairs = pairs.union(_of_crowds(crowded, members, prefixes, nodes, texts, words, percent))
    more = _links(pairs.distinct(), nodes, texts, words, percent)
    labels = components(stars.union(links).union(more))

    named = nodes.select("node", "least_id").join(labels, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "label").select("node", "component_id")
    return rows.select("doc_id", "text_key", "n", "node").join(named, "node", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents left when one row of each component stays: that of the smallest id, among its texts that of the
    smallest hash, of equal rows any.  Empty texts all stay.  Texts without any id in their component have no smallest id;
    they group by equal texts only.
    """
    from pyspark.sql import Window

    # the input's columns travel in one, so that none of their names can clash; of equal rows one stays
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("text")).withColumn("blank", F.col("text").rlike(r"^[\x20\x09-\x0D]*$")).drop("text")
    named = saved(ngram_components(docs, words, percent).where("n_shingles > 0").select(
        "doc_id", "text_key", F.coalesce("component_id", F.col("text_key")).alias("group"), F.col("component_id").isNull().alias("nameless")),
        "named-rows")
    groups = saved(named.groupBy("group", "nameless").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "text_key")).alias("first"), F.count("*").alias("size")), "row-groups")
    chosen = groups.select(F.col("first.col1").alias("of"), F.col("first.text_key").alias("of_key"))
    # rows that are a group of their own stay where they are
    crowded = named.join(groups.where("size > 1").select("group", "nameless"), ["group", "nameless"])
    some, alone = split_by(keyed.where("not blank"), ["id", "key"], crowded, ["doc_id", "text_key"])
    some = some.withColumn("known", F.coalesce("id", F.lit(2**63 - 1)))
    found = some.join(chosen, [F.col("known") == F.col("of"), F.col("key") == F.col("of_key")])
    first = Window.partitionBy("known", "key").orderBy(F.lit(0))  # rows of one id and text, all that is left here
    found = found.withColumn("place", F.row_number().over(first)).where("place = 1").select("row")
    return found.unionByName(alone.select("row")).unionByName(keyed.where("blank").select("row")).select("row.*")
