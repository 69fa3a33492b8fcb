"""Personal data: base rules, and a bootstrap from them over the contexts of what they find.

1. Base rules find e-mail addresses, IPv4 addresses, card and phone numbers in each whole text.  They are the seeds.
2. Identifier-shaped runs that no base rule takes are candidates: addresses written out ("jo at host dot net"), runs of 7 to
   19 digits, colon-separated hexadecimals.  A shape allows some kinds only.
3. Seeds and candidates induce lexical patterns: the two and three tokens before, and one before with one behind.  Patterns
   and instances (values, wherever they occur) form a graph.
4. Round by round, a pattern is as sure of a kind as the share of its instances that are of it, smoothed,

       sure(p, kind) = mass of instances of the kind / (number of instances + 1),

   and counts with at least ``least_seeds`` of mass and ``least_sure``.  A candidate is of a kind by ``1 - product of (1 - sure)``
   over its patterns; from ``accept`` on, it is an instance of that mass in the next round, and in the end personal data
   wherever it occurs.

Each round is two sums and two joins over the distinct edges; a hot pattern or value meets as one row per edge, pre-added.
The texts are read once; the spans, values and patterns found are written to the shared folder.

Null and empty texts have no spans.  Repeated rows are answered each time and count once in the graph.  Ids may be null
or repeated; other columns are not read.  No input, no rows.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import saved

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ROUNDS = 3
LEAST_SEEDS = 10.0
LEAST_SURE = 0.75
ACCEPT = 0.6

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT_HINTS = ("(at)", "[at]", "{at}", " at ", "(AT)", "[AT]", "{AT}", " AT ")
_DOT_HINTS = ("dot", "DOT", ".")
_WRITTEN = re.compile(
    r"(?<![\w.%+-])[\w.%+-]++(?:\s?[(\[{]at[)\]}]\s?|\sat\s)[\w-]++(?:(?:\.|\s?[(\[{]dot[)\]}]\s?|\sdot\s)[\w-]++)++", re.IGNORECASE)
_NUMBER = re.compile(r"(?<![\w.+-])\(?[0-9][0-9\x20()./-]{5,}[0-9](?!\w)")
_COLON_HINT = re.compile(r":[0-9A-Fa-f]{0,4}:")
_COLONS = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])")
#: The kinds that a candidate of each shape can be.
SHAPES = {"written": (EMAIL,), "number": (CARD, PHONE), "colons": (IP,)}
_TOKEN = re.compile(r"\w+|[^\w\s]")
_BEFORE, _BEHIND = 64, 32  # code points looked at for context

_FOUND_SQL = ("array<struct<start:int,end:int,kind:int,shape:string,value:bigint,patterns:array<string>>>")
_ROW_SQL = f"row bigint, doc_id bigint, found {_FOUND_SQL}"
_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("shape", pa.string()),
                             ("value", pa.int64()), ("patterns", pa.list_(pa.string()))]))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ back over the local part and on over the domain, which takes each character once."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, end)):
            end = last = m.end()
            yield start, end
        else:
            last = max(last, end)
        at = text.find("@", end)


def _is_card(digits: str) -> bool:
    if not 12 <= len(digits) <= 19:
        return False
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of what the base rules find, in order."""
    out = [(s, EMAIL, e) for s, e in _emails(text)]
    if "." in text:
        out += [(m.start(), IP, m.end()) for m in _IP.finditer(text) if _is_ip(m[0])]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12 and _is_card(m[0].replace(" ", "").replace("-", "")):
            out.append((m.start(), CARD, m.end()))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((at, PHONE, m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """``start, end, shape`` of identifier-shaped runs that touch no base span nor each other, leftmost first."""
    found = []
    if any(h in text for h in _AT_HINTS) and any(h in text for h in _DOT_HINTS):
        found += [(m.start(), m.end(), "written") for m in _WRITTEN.finditer(text)]
    for m in _NUMBER.finditer(text):
        if 7 <= sum("0" <= c <= "9" for c in m[0]) <= 19:
            found.append((m.start(), m.end(), "number"))
    if _COLON_HINT.search(text):
        found += [(m.start(), m.end(), "colons") for m in _COLONS.finditer(text)]
    out, last, i = [], 0, 0
    ends = sorted((s, e) for s, _, e in taken)
    for start, end, shape in sorted(found):
        while i < len(ends) and ends[i][1] <= start:
            i += 1
        if start >= last and not (i < len(ends) and ends[i][0] < end):
            out.append((start, end, shape))
            last = end
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """Contexts of a span: tokens in lower case, numbers as 0, the span as ``_``."""
    def tokens(part: str) -> list[str]:
        return [re.sub(r"\d+", "0", t.lower()) for t in _TOKEN.findall(part)]
    before = tokens(text[max(0, start - _BEFORE):start])[-3:]
    behind = tokens(text[end:end + _BEHIND])[:1]
    out = [" ".join(before[-n:]) + " _" for n in (2, 3) if len(before) >= n]
    if before and behind:
        out.append(f"{before[-1]} _ {behind[0]}")
    return out


def _value(text: str, shape: str) -> int:
    """The identifier itself, however it is spaced."""
    plain = "".join(c for c in text if c.isdigit()) if shape == "number" else "".join(text.lower().split())
    return int.from_bytes(hashlib.blake2b(f"{shape}:{plain}".encode(), digest_size=8).digest(), "little", signed=True)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            spans = [(s, e, k, KINDS[k]) for s, k, e in base]
            spans += [(s, e, None, shape) for s, e, shape in candidates(text, base)]
            rows.append([{"start": s, "end": e, "kind": k, "shape": shape, "patterns": patterns(text, s, e),
                          "value": _value(text[s:e], "number" if k in (CARD, PHONE) else shape)} for s, e, k, shape in spans])
        yield pa.RecordBatch.from_arrays([pa.array(range(row, row + len(rows)), pa.int64()), batch.column("doc_id"),
                                          pa.array(rows, _FOUND)], names=["row", "doc_id", "found"])
        row += len(rows)


def found_in(docs: DataFrame) -> DataFrame:
    """Each text's seeds (with a kind) and candidates (without), with values and patterns; ``row`` tells rows apart."""
    return saved(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .mapInArrow(_find, _ROW_SQL), "found")


def bootstrap(found: DataFrame, rounds: int = ROUNDS, least_seeds: float = LEAST_SEEDS, least_sure: float = LEAST_SURE,
              accept: float = ACCEPT) -> tuple[DataFrame | None, DataFrame | None]:
    """Candidates that are personal data (``value, kind, mass``) and the patterns that say so; none if no pattern does.

    A value that is a seed somewhere is one everywhere, so candidates of it need no pattern.
    """
    spans = found.select(F.explode("found").alias("f")).select("f.*")
    values = spans.groupBy("value", "shape", "kind").agg(F.count("*").alias("times"))
    seeds = values.where("kind is not null").groupBy("value").agg(F.min("kind").alias("seed"))
    edges = spans.select("value", F.explode("patterns").alias("pattern")).distinct()
    shapes = values.where("kind is null").select("value", "shape").distinct()
    edges = saved(edges.join(seeds, "value", "left").join(shapes, "value", "left"), "edges")
    allowed = F.lit(False)
    for shape, kinds in SHAPES.items():
        allowed = allowed | ((F.col("shape") == shape) & F.col("kind").isin(*kinds))
    masses = sure = None
    for _ in range(rounds):
        known = edges.withColumns({"kind": F.col("seed"), "mass": F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0)})
        if masses is not None:
            known = edges.join(masses.withColumnsRenamed({"kind": "found_kind", "mass": "found_mass"}), "value", "left").withColumns({
                "kind": F.coalesce("seed", "found_kind"),
                "mass": F.when(F.col("seed").isNotNull(), 1.0).otherwise(F.coalesce("found_mass", F.lit(0.0)))})
        sums = known.groupBy("pattern").agg(F.count("*").alias("n"), *[
            F.round(F.sum(F.when(F.col("kind") == k, F.col("mass")).otherwise(0.0)), 9).alias(name) for k, name in enumerate(KINDS)])
        sure = saved(sums.select("pattern", "n", F.explode(F.array(*[
            F.struct(F.lit(k).alias("kind"), F.col(name).alias("mass")) for k, name in enumerate(KINDS)])).alias("of"))
            .select("pattern", "of.kind", "of.mass", (F.col("of.mass") / (F.col("n") + 1)).alias("sure"))
            .where((F.col("mass") >= least_seeds) & (F.col("sure") >= least_sure)), "patterns")
        if sure.isEmpty():
            break
        said = edges.where("seed is null").select("value", "shape", "pattern").join(sure, "pattern").where(allowed)
        scored = said.groupBy("value", "kind").agg(F.round(1 - F.exp(F.sum(F.log1p(-F.col("sure")))), 9).alias("mass"))
        masses = saved(scored.where(F.col("mass") >= accept).groupBy("value").agg(
            F.max(F.struct("mass", -F.col("kind"))).alias("b")).select("value", (-F.col("b.col2")).alias("kind"), "b.mass"), "masses")
    copies = edges.where("seed is not null and shape is not null").select(
        "value", F.col("seed").alias("kind"), F.lit(1.0).alias("mass"), "shape").where(allowed).drop("shape").distinct()
    return (copies if masses is None else masses.unionByName(copies)), sure


def _spans_text(spans):
    """``kind:start:end`` by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, numbers of base spans by kind, ``base_sha256`` of them and ``spans``: all, base and discovered."""
    found = found_in(docs)
    masses, _ = bootstrap(found, **options)
    as_span = lambda f, kind: F.struct(f["start"].alias("start"), kind.alias("kind"), f["end"].alias("end"))
    base = F.transform(F.filter("found", lambda f: f["kind"].isNotNull()), lambda f: as_span(f, f["kind"]))
    rows = found.select("row", "doc_id", base.alias("base"))
    more = found.select("row", F.explode(F.filter("found", lambda f: f["kind"].isNull())).alias("f")).select(
        "row", F.col("f.value").alias("value"), "f") \
        .join(masses, "value").groupBy("row").agg(F.collect_list(as_span(F.col("f"), F.col("kind"))).alias("more"))
    out = rows.join(more, "row", "left").withColumn("more", F.coalesce("more", F.expr("filter(base, b -> false)")))
    count = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("bigint")
    return out.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_spans_text(F.col("base")), 256).alias("base_sha256"), _spans_text(F.concat("base", "more")).alias("spans"))
