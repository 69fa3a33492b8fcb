"""Benchmark decontamination by template windows, with DataFrame functions only.

1. Template: a text's words (letters and digits, lower case) in order, with numbers, units after a number and names
   (capitalised words inside a sentence) replaced by typed placeholders.
2. Windows of ``WINDOW`` template words are hashed.  Of the benchmark only the distinct hashes are broadcast, at most about
   ``BLOCK`` of them at a time; the texts' windows that have one of them are written down, and only these are joined with the
   benchmark's windows.  Windows with fewer than half their words literal (arithmetic, lists of names) would match too much
   as templates; they are hashed by their words and match verbatim only.
3. Slots: on each alignment of a text with an item (same distance of positions), a benchmark value must stand for
   one value of the text throughout, so that a question with other numbers is caught and a chance mixture is not.
4. A text is contaminated by an item if ``LEAST`` of the item's windows (or all, if it has fewer) match, templates on
   consistent alignments, or if ``LEAST`` of its template windows (or all of them) do.

Items of fewer words than a window cannot be matched.  Null and empty texts match nothing.  Repeated rows get the same
answer, repeated items count as items of their own id.  An empty benchmark leaves everything clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import saved

WINDOW, LEAST = 8, 3
BLOCK = 3 << 20  # hashes: some 80 bytes each where they are broadcast
# as many placeholders as make a window verbatim may lie in one window
CROWDED = rf"(?:<(?:num|name|unit)>(?: [^< ]+){{0,{WINDOW // 2 - 1}}} ){{{WINDOW // 2}}}<"
NAME = "\ue001"  # marks a capitalised word inside a sentence

# fixed values: units of measure
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hours minutes seconds days weeks months years percent "
         "usd eur dollars euros cents meters metres kilometers kilometres miles feet inches grams kilograms pounds liters "
         "litres watts volts degrees").split()


def _words(text: Column) -> Column:
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), r"([0-9])[.,]([0-9])", "$1$2")
    named = F.regexp_replace(joined, r"([^.!?:\s]\s+)(\p{Lu})", f"$1{NAME}$2")
    return F.split(F.trim(F.regexp_replace(F.lower(named), rf"[^\p{{L}}\p{{N}}{NAME}]+", " ")), " ")


def _template(words: Column) -> Column:
    def canonical(word: Column, at: Column) -> Column:
        before = F.get(words, at - 1)
        digit = (word >= "0") & (word < ":")  # by the first byte, before the costlier test
        return (F.when(digit & word.rlike("^[0-9]+$"), F.lit("<num>"))
                .when(word.startswith(NAME), F.lit("<name>"))
                .when(word.isin(UNITS) & before.rlike("^[0-9]+$"), F.lit("<unit>"))
                .otherwise(word))
    return F.transform(words, canonical)


def _windows(template: Column) -> Column:
    """Hash of the window from each position on."""
    last = F.size(template) - WINDOW
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(template, i + 1, WINDOW)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _literal(template: Column) -> Column:
    return F.size(F.filter(template, lambda w: ~w.isin("<num>", "<name>", "<unit>")))


def _keys(words: Column, template: Column) -> Column:
    """Hash of the window from each position on: of its template, or of its words where few of them are literal."""
    last = F.size(template) - WINDOW
    mixed = F.transform(F.sequence(F.lit(0), last), lambda i: F.when(
        _literal(_cut(template, i)) * 2 >= WINDOW, F.xxhash64(_cut(template, i))).otherwise(F.xxhash64(_cut(words, i), F.lit(1))))
    crowded = F.array_join(template, " ").rlike(CROWDED)  # rare in prose, which is spared the test of each window
    return F.when((last >= 0) & crowded, mixed).otherwise(_windows(template))


def _cut(words: Column, at: Column) -> Column:
    return F.slice(words, at + 1, WINDOW)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id, of, of_words, of_template, hash, verbatim, n_windows, n_templates`` of each window."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), _words(F.col("text")).alias("w"))
    items = items.withColumn("t", _template(F.col("w")))
    rows = items.select("item_id", "w", "t", F.posexplode(_keys(F.col("w"), F.col("t"))).alias("of", "hash"))
    rows = rows.select("item_id", "of", _cut(F.col("w"), F.col("of")).alias("of_words"),
                       _cut(F.col("t"), F.col("of")).alias("of_template"), "hash")
    rows = rows.withColumn("verbatim", _literal(F.col("of_template")) * 2 < WINDOW)
    size = rows.groupBy(F.col("item_id").alias("sized")).agg(
        F.count("*").alias("n_windows"), F.count_if(~F.col("verbatim")).alias("n_templates"))
    return rows.join(size, F.col("item_id").eqNullSafe(F.col("sized"))).drop("sized")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, item_id, n_windows`` of every text and item that match."""
    known = saved(benchmark_windows(benchmark), "benchmark-windows")
    hashes = saved(known.select("hash").distinct(), "benchmark-hashes")
    blocks = 1 + hashes.count() // BLOCK
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), _words(F.col("text")).alias("words"))
    texts = texts.withColumn("template", _template(F.col("words")))
    # The windows are made ahead of the explode, which then runs in generated code and carries the word lists along
    # without copying them for each window; the slice keeps Spark from testing the list ahead, making it twice.
    texts = texts.withColumn("hashes", _keys(F.col("words"), F.col("template")))
    rows = texts.select("doc_id", "text_key", "words", "template",
                        F.posexplode(F.slice("hashes", 1, 2**31 - 1)).alias("at", "hash"))
    held = None
    for block in range(blocks):  # each by a pass of its own, so that one block is held at a time
        some = hashes.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == block)  # about BLOCK hashes at most
        part = saved(rows.join(F.broadcast(some), "hash", "left_semi").select(
            "doc_id", "text_key", "at", "hash", _cut(F.col("words"), F.col("at")).alias("words"),
            _cut(F.col("template"), F.col("at")).alias("template")), "held-windows")
        held = part if held is None else held.union(part)
    met = held.join(known, "hash").select(
        "doc_id", "text_key", "item_id", "n_windows", "n_templates", "verbatim", "of", (F.col("at") - F.col("of")).alias("shift"),
        "of_words", "of_template", "words", "template")
    met = met.where(F.when(F.col("verbatim"), F.col("words") == F.col("of_words"))
                    .otherwise(F.col("template") == F.col("of_template")))
    slots = F.filter(
        F.zip_with(F.arrays_zip("of_template", "of_words"), F.col("words"), lambda x, y: F.struct(
            x["of_template"].alias("kind"), x["of_words"].alias("theirs"), y.alias("ours"))),
        lambda s: s["kind"].isin("<num>", "<name>", "<unit>"))
    keys = ["doc_id", "text_key", "item_id", "n_windows", "n_templates"]
    met = met.select(*keys, "shift", "of", "verbatim", F.when(~F.col("verbatim"), slots).alias("slots"))
    lines = met.groupBy(*keys, "shift").agg(
        F.collect_set(F.when(~F.col("verbatim"), F.col("of"))).alias("ofs"),
        F.collect_set(F.when(F.col("verbatim"), F.col("of"))).alias("same"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    bound = F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["theirs"])))
    steady = lines.withColumn("ofs", F.when(F.size(bound) == F.size("slots"), F.col("ofs")).otherwise(
        F.array().cast("array<int>")))

    def distinct(column: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(column)))).cast("bigint")

    hits = steady.groupBy(*keys).agg(distinct("ofs").alias("of_templates"), distinct("same").alias("of_same"))
    total = F.col("of_templates") + F.col("of_same")
    return hits.where((total >= F.least(F.lit(LEAST), F.col("n_windows"))) | (F.col("of_templates") > 0)
                      & (F.col("of_templates") >= F.least(F.lit(LEAST), F.col("n_templates")))).select(
        "doc_id", "text_key", "item_id", total.alias("n_windows"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, item_ids, n_windows`` of every row of ``docs``."""
    found = saved(leaks(docs, benchmark), "leaks").groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.sum("n_windows").alias("n_windows"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    found = found.withColumnRenamed("doc_id", "of")
    joined = rows.join(found, [rows.doc_id.eqNullSafe(found.of), F.col("key") == F.col("text_key")], "left")
    return joined.select("doc_id", F.col("n_windows").isNotNull().alias("contaminated"),
                         F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
                         F.coalesce("n_windows", F.lit(0)).cast("bigint").alias("n_windows"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates."""
    found = saved(leaks(docs, benchmark).select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_key")).distinct(),
                  "leaks")
    # the input's columns travel in one, so that none of their names can clash
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    return keyed.join(found, [F.col("id").eqNullSafe(F.col("of")), F.col("key") == F.col("of_key")], "left_anti").select("row.*")
