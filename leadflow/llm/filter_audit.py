"""What each of five filters removes, in every order: the Hart-Mas-Colell potential of the removal game.

A text fails some of five filters (A under 200 words, B few distinct words, C many capitals, D symbols, E same text as
a smaller id's).  In the removal game the worth ``v(S)`` of a set of filters is the number of texts that fail one of
them; there are 32 sets.  The potential is worked out set by set,

    P(S) = (v(S) + sum of P(S - i) over i in S) / |S|,   P({}) = 0,

a filter's Shapley value is ``P(all) - P(all - i)``, and a step of an order removes ``v(before + i) - v(before)``.
``60 P`` is a whole number (60 is divided by 1 to 5), so everything is exact.

Texts are read once and leave a digest, an id, a part and four flags; whether a text is the first of its copies is found
by the smallest id of each digest, joined back by id, so a group of copies meets as one row a task.  Equal texts are
equal SHA-256 digests.  What is left after that are 32 counts a part.

Null texts are empty (they fail A only, 0 of 0 words; and E beside another empty text).  A null language is the part ``''``.
A null id is smaller and larger than nothing: it never fails E and makes nothing fail it.  Repeated rows count each time;
rows of one id and text do not fail E by each other.  An id labelled more than once counts as good or toxic if one label
says so; without labels nothing is.  No input, no rows.  Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import saved

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
SCALE = 60  # the least number that 1 to 5 divide
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LEAST_WORDS = 200


def failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 0 to 3."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    counted = F.struct(F.size(words).cast("bigint").alias("n"), F.size(F.array_distinct(words)).cast("bigint").alias("d"))
    # through a one-element array, so that the words are cut once for both counts
    short_or_same = F.transform(F.array(counted), lambda c: F.when(c["n"] < LEAST_WORDS, 1).otherwise(0)
                                + F.when(100 * c["d"] < 50 * c["n"], 2).otherwise(0))[0]
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return (short_or_same
            + F.when(100 * capitals.cast("bigint") > 3 * F.char_length(text).cast("bigint"), 4).otherwise(0)
            + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)).cast("int")


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, n, good, toxic``: number of texts of each part by the set of filters that they fail (a bit each)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    # a digest and four bits a row; rows that agree in all meet in their task already
    rows = saved(rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), failures(F.col("text")).alias("failed"))
                 .groupBy("id", "part", "digest", "failed").agg(F.count("*").alias("n")), "failures")
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id is not null") \
        .select(F.col("id").alias("of"), F.col("digest").alias("same"))
    marks = labels.select(F.col("doc_id").cast("bigint").alias("about"), F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0)).alias("good"),
                          F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0)).alias("toxic")) \
        .where("about is not null").groupBy("about").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    known = rows.where("id is not null")
    known = known.join(first, (F.col("id") == F.col("of")) & (F.col("digest") == F.col("same")), "left") \
        .join(marks, F.col("id") == F.col("about"), "left") \
        .select("part", (F.col("failed") + F.when(F.col("of").isNull(), 16).otherwise(0)).alias("failed"), "n",
                F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    nameless = rows.where("id is null").select("part", "failed", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.unionByName(nameless).groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def worths(counts: DataFrame) -> DataFrame:
    """A row a part: ``n``, and arrays over the 32 sets of how many, good and toxic texts fail one of their filters."""
    def over_sets(what: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("failed").bitwiseAND(F.lit(s)) != 0, F.col(what))), F.lit(0)).cast("bigint")
                         for s in range(SETS)])
    return counts.groupBy("part").agg(F.sum("n").alias("n"), *[over_sets(c).alias(c) for c in ("good", "toxic")],
                                      over_sets("n").alias("worth"))


def potential(worth: Column) -> Column:
    """``60 P(S)`` for all 32 sets, from their worths; smaller sets come first, so each finds those it needs."""
    def of(found: Column, s: Column) -> Column:
        parts = [F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.element_at(found, s - (1 << i) + 1)).otherwise(0)
                 for i in range(len(FILTERS))]
        total = F.element_at(worth, s + 1) * SCALE
        for p in parts:
            total = total + p
        return F.concat(found, F.array(F.call_function("div", total, F.bit_count(s).cast("bigint"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(SETS - 1)), F.array(F.lit(0).cast("bigint")), of)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, as the module says."""
    parts = worths(counted(docs, labels)).withColumn("p", potential(F.col("worth")))
    orders = parts.select("*", F.explode(F.split(F.lit(",".join(ORDERS)), ",")).alias("filter_order")) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, step, 1)) - 1)")
    before = F.expr(f"aggregate(sequence(0, step - 1), 0, (s, i) -> s + if(i = 0, 0, "
                    f"shiftleft(1, instr('{FILTERS}', substring(filter_order, i, 1)) - 1)))")
    rows = orders.withColumns({"bit": bit, "before": before})

    def gain(what: str, base: Column) -> Column:
        return F.element_at(what, base + F.col("bit") + 1) - F.element_at(what, base + 1)
    alone = F.lit(SETS - 1) - F.col("bit")
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("n") - F.element_at("worth", F.col("before") + F.col("bit") + 1)).alias("kept"),
        gain("worth", F.col("before")).alias("removed"),
        (F.element_at("worth", F.col("bit") + 1) - gain("worth", F.col("before"))).alias("redundant"),
        gain("worth", alone).alias("unique_fails"),
        gain("good", F.col("before")).alias("good_lost"), gain("toxic", F.col("before")).alias("toxic_lost"),
        (gain("p", alone) * (120 // SCALE)).alias("shapley"))
