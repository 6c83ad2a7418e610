"""Mixing sources to target weights by systematic sampling.  DataFrame functions only.

A source's share of all words follows its weight, but never more than ``most`` times
its own words; what is cut off is shared again by weight among the others.  Within a
source the documents stand in order of size, each expects target / source size copies,
and the running sum of these expectations plus one random offset per source emits a
copy whenever it passes a whole number.  As the order is by size, each stretch of
similar sizes gives its share and the words taken come close to the target.

Nulls and edges: a null text has size 0 and is mixed like any document; a null source
is a source of its own, last in order; rows that repeat are documents of their own; an
empty table gives an empty mix; if all sizes are 0, every target is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrolume.llm.common import WORD, running, stored

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source, source_size, target.

    With t = min(most * size, w * level) the level is found by order of size / weight:
    the first source that need not be cut off sets it.
    """
    totals = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running(totals, [F.col("source").asc_nulls_last()], {"rank": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    ratio = F.col("cap").cast("double") / F.col("weight")
    summed = stored(
        running(capped.withColumn("ratio", ratio), [F.col("ratio"), F.col("rank")], {"caps": F.col("cap"), "weights": F.col("weight")}),
        "summed",
    )
    # One row beside the sources: the sums of all, then the source that sets the level.
    every = summed.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all_sizes"), F.sum("weight").alias("all_weights"))
    left = F.col("all_sizes") - F.col("caps") + F.col("cap")
    shared = F.col("all_weights") - F.col("weights") + F.col("weight")
    leveled = summed.join(F.broadcast(every)).withColumns({"left": left, "shared": shared})
    fits = F.col("left").cast("double") * F.col("weight") / F.col("shared") <= F.col("cap")
    first = leveled.where(fits).agg(F.min(F.struct("ratio", "rank", "left", "shared")).alias("level"))
    target = F.least(
        F.col("cap").cast("double"),
        F.coalesce(F.col("level.left").cast("double") * F.col("weight") / F.col("level.shared"), F.lit(0.0)),
    )
    return stored(summed.join(F.broadcast(first)).select("source", "source_size", target.alias("target")), "targets")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, text_hash, source_size, target, copies, taken of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = stored(
        docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("text_hash")),
        "sizes",
    )
    targets = source_targets(sized, weights, most)
    placed = running(
        sized,
        [F.desc("size"), F.asc_nulls_last("doc_id"), F.asc("text_hash")],
        {"place": F.lit(1).cast("long")},
        by=F.col("source"),
    )
    named = targets.withColumnRenamed("source", "of_source")
    joined = placed.join(named, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    offset = (
        F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("source", F.lit(""))).cast("binary")), 1, 5), 16, 10).cast("double")
        / 2**20
    )
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(expected * F.col("place") + offset) - F.floor(expected * (F.col("place") - 1) + offset)
    return joined.withColumn("copies", copies.cast("long")).select(
        "doc_id", "source", "size", "text_hash", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the plan takes it.

    Rows that agree in doc_id, source, size and text share out their copies.
    """
    planned = (
        plan(docs, weights, most, seed)
        .groupBy("doc_id", "source", "text_hash")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    )
    nested = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    keyed = nested.select(
        "doc", F.col("doc.doc_id").alias("a"), F.col("doc.source").alias("b"), F.xxhash64(F.coalesce("doc.text", F.lit(""))).alias("c")
    )
    same = F.col("a").eqNullSafe(F.col("doc_id")) & F.col("b").eqNullSafe(F.col("source")) & (F.col("c") == F.col("text_hash"))
    turn = F.row_number().over(Window.partitionBy("doc_id", "source", "text_hash").orderBy("doc_id"))
    taken = keyed.join(planned, same).where("copies > 0")
    share = taken.withColumn("turn", F.when(F.col("rows") > 1, turn).otherwise(1)).withColumn(
        "times", (F.floor(F.expr("copies * turn / rows")) - F.floor(F.expr("copies * (turn - 1) / rows"))).cast("int")
    )
    return share.where("times > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("doc.*")
