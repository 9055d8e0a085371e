"""Mixing sources to target weights by entropy balancing.

A document's rate says how often the mix takes it. Among all rates from 0 to ``most`` that give every source its target of words, the
wanted ones are closest to 1 in relative entropy. Their dual has one multiplier per source and is convex: the rates are exponential
tilts ``min(most, exp(multiplier * size / mean size))``, and each multiplier is found by Newton steps on the source's word total, kept
inside a shrinking bracket. A step is one aggregation over all documents, counted by source and size first, as rates depend on
nothing else; multipliers stay in a table. Rates are then rounded to whole copies: a document gets the whole part, and the fractions
of a source are added up in order of size; wherever the sum passes a whole number (from one of ``starts`` starting points, the one
whose total comes closest to the target) a document gets one more copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import free_name, null_safe_key, picked, written

WORD = r"[^\x20\x09-\x0D]+"
BAND = 64


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", salts: int = 32) -> DataFrame:
    """doc_id, rid, source, size in words, and a salt that splits documents of one source and size. Written: texts are read once."""
    rows = picked(docs, doc_id=id_col, text=text_col, source=source_col).select("doc_id", F.monotonically_increasing_id().alias("rid"), "source", F.xxhash64("text").alias("th"),
                                                                               F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return written(rows.withColumn("key", null_safe_key("source")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "th"), F.lit(salts)).cast("int")), "sizes")


def targets(by_size: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source: its size and target.

    The sources, by code point with null last, have the weights in turn and share ``share`` times all words; no target is above ``most``
    times its source's size. Sources are filled in order of the level at which they are full: below the common level all are full,
    the others take their weight times the level, so that nothing is left to share out anew.
    """
    sources = by_size.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(turn) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    full = sources.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("cap")).withColumn("full_at", F.col("cap") / F.col("weight"))
    everything, order = Window.partitionBy(F.lit(1)), Window.partitionBy(F.lit(1)).orderBy("full_at", "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # ``level``: were all sources before this one full, this and all later ones not. It rises up to the right source and falls from there.
    return (full.withColumn("level", level).withColumn("common", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything))
            .select("key", "source", "source_size", "n_docs", F.when(F.col("common").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("common"))).alias("target")))


def tilt(most: float) -> Column:
    return F.when(F.col("full"), F.lit(most)).otherwise(F.least(F.lit(most), F.exp(F.least(F.lit(50.0), F.col("multiplier") * F.col("size") / F.col("mean")))))


def multipliers(by_size: DataFrame, wanted: DataFrame, most: float = 2.0, near: float = 1e-6, most_steps: int = 60) -> DataFrame:
    """Per source: the multiplier that gives its target. A source whose target is its cap needs none: all its rates are ``most``."""
    start = wanted.select("*", (F.col("source_size") / F.col("n_docs")).alias("mean"), F.lit(0.0).alias("multiplier"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
                          (F.col("target") >= F.col("source_size") * most * (1 - 1e-12)).alias("full"))
    now = written(start, "multipliers")
    for _ in range(most_steps):
        rate = tilt(most)
        slope = F.when(rate < most, F.col("n") * F.col("size") * rate * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (by_size.where("size > 0").join(now.select("key", "multiplier", "mean", "full"), "key").groupBy("key")
                .agg(F.sum(F.col("n") * F.col("size") * rate).alias("total"), F.sum(slope).alias("slope")))
        found = now.join(sums, "key", "left").fillna({"total": 0.0, "slope": 0.0})
        off = F.when(F.col("full") | (F.col("source_size") == 0), 0.0).otherwise(F.abs(F.col("total") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0)))
        low, high = F.when(F.col("total") < F.col("target"), F.col("multiplier")).otherwise(F.col("low")), F.when(F.col("total") > F.col("target"), F.col("multiplier")).otherwise(F.col("high"))
        # Newton on the logarithm of the total; a step that leaves the bracket, or has no slope, becomes a bisection, doubling while a side is open.
        step = F.col("multiplier") - F.log(F.col("total") / F.col("target")) * F.col("total") / F.col("slope")
        middle = F.when(F.col("new_high") >= 1e6, F.greatest(F.col("new_low") * 2, F.lit(1.0))).when(F.col("new_low") <= -1e6, F.least(F.col("new_high") * 2, F.lit(-1.0))).otherwise((F.col("new_low") + F.col("new_high")) / 2)
        moved = found.select("*", off.alias("off"), low.alias("new_low"), high.alias("new_high"), F.when((F.col("slope") > 0) & (F.col("total") > 0) & (F.col("target") > 0), step).alias("step"))
        good = F.col("step").isNotNull() & (F.col("step") > F.col("new_low")) & (F.col("step") < F.col("new_high"))
        now = written(moved.select("key", "source", "source_size", "n_docs", "target", "mean", F.when(F.col("off") <= near, F.col("multiplier")).when(good, F.col("step")).otherwise(middle).alias("multiplier"),
                                   F.col("new_low").alias("low"), F.col("new_high").alias("high"), "full", "off"), "multipliers")
        if (now.agg(F.max("off")).first()[0] or 0.0) <= near:
            break
        now = now.drop("off")
    else:
        raise RuntimeError(f"a source did not come near its target in {most_steps} steps")
    return now.drop("off", "low", "high")


def extra_copies(by_size: DataFrame, solved: DataFrame, most: float = 2.0, starts: int = 32) -> DataFrame:
    """For every source, size and salt: the whole part of the rate, and how many of its documents get one more copy."""
    rated = by_size.where("size > 0").join(solved, "key").withColumn("rate", tilt(most)).withColumn("whole", F.floor(F.col("rate") + 1e-9)).withColumn(
        "part", F.greatest(F.lit(0.0), F.col("rate") - F.col("whole")) * F.col("n"))
    # In two steps, so that a source of many sizes is not one task: sizes in bands, running sums inside a band, and sums of whole bands before it.
    # Parts are whole billionths: then sums do not depend on how they are grouped.
    rated = rated.withColumn("part", F.round(F.col("part") * 1e9).cast("decimal(38,0)")).withColumn("band", F.floor(F.col("size") / BAND))
    inside = Window.partitionBy("key", "band").orderBy(F.desc("size"), "salt").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("key").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = rated.groupBy("key", "band").agg(F.sum("part").alias("in_band")).select("key", "band", F.coalesce(F.sum("in_band").over(ahead), F.lit(0)).alias("ahead"))
    summed = rated.withColumn("inside", F.sum("part").over(inside)).join(bands, ["key", "band"])
    summed = summed.withColumn("upto", (F.col("ahead") + F.col("inside")).cast("double") / 1e9).withColumn("before", (F.col("ahead") + F.col("inside") - F.col("part")).cast("double") / 1e9)

    def given(start) -> Column:
        return F.least(F.col("n"), F.floor(F.col("upto") + start) - F.floor(F.col("before") + start))

    totals = summed.groupBy("key").agg(F.first("target").alias("target"), *[F.sum(F.col("size") * (F.col("n") * F.col("whole") + given(F.lit((j + 0.5) / starts)))).alias(f"t{j}") for j in range(starts)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{j}") - F.col("target")).alias("off"), F.lit((j + 0.5) / starts).alias("start")) for j in range(starts)]))
    return summed.join(totals.select("key", best["start"].alias("start")), "key").select("key", "size", "salt", "whole", given(F.col("start")).alias("extra"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often the mix takes each document.

    Result, one row per document: doc_id, rid, key (of the source), th (hash of the text), size, source_size, target, copies, taken (copies times size). Null text has no words; null
    is a source of its own; documents without words get no copy; repeated rows are documents of their own; an empty table gives an empty
    result. Which documents of equal source and size get a copy more is decided by hashes of doc_id and text, so that reruns agree under any partitioning;
    only rows equal in both may change places.
    """
    rows = sizes(docs, id_col, text_col, source_col)
    by_size = written(rows.groupBy("key", "source", "size", "salt").agg(F.count("*").alias("n")), "by-size")
    solved = multipliers(by_size, targets(by_size, weights, share, most), most)
    extra = extra_copies(by_size, solved, most)
    place = F.row_number().over(Window.partitionBy("key", "size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id", "th", "rid"))
    counted = rows.where("size > 0").withColumn("place", place).join(extra, ["key", "size", "salt"]).select("doc_id", "rid", "key", "th", "size", (F.col("whole") + (F.col("place") <= F.col("extra")).cast("long")).alias("copies"))
    everything = counted.unionByName(rows.where("size = 0").select("doc_id", "rid", "key", "th", "size", F.lit(0).cast("long").alias("copies")))
    return everything.join(solved.select("key", "source_size", "target"), "key").select("doc_id", "rid", "key", "th", "size", "source_size", "target", "copies",
                                                                                                                      (F.col("copies") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whatever their names, each as often as the mix takes it. The copies of rows equal in identifier, text and
    source are added up; null text has no words and is never taken; an empty table stays empty."""
    def key(identifier, text_hash, source):
        return F.concat_ws(":", F.coalesce(identifier.cast("string"), F.lit("-")), F.coalesce(text_hash.cast("string"), F.lit("-")), source)

    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).where("copies > 0")
    row, copy, times = (free_name(docs.columns, n) for n in ("row_key", "copy_number", "copy_count"))
    copies = taken.groupBy(key(F.col("doc_id"), F.col("th"), F.col("key")).alias(row)).agg(F.sum("copies").alias(times))
    source = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`")), F.lit("-"))
    marked = docs.withColumn(row, key(F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`")), source)).dropDuplicates([row])
    names = [F.col(f"`{c}`") for c in docs.columns]
    return marked.join(copies, row).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*names)
