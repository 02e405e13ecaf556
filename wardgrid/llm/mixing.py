"""Mixing sources to target weights by capped water-filling.

A source's words are the sizes of its documents, added up. The mix has ``share`` times all words. Sources share it by weight;
a source whose part exceeds ``epochs`` times its words is clamped there, and what it can't take goes to the others by weight, until
no part is above. Each round sends one row (clamped words, free weight) to the driver, whatever the number of sources.

A source whose target is f times its words is taken floor(f) times as a whole; for the rest its documents are drawn in the order of a
seeded hash of doc_id and text until the words are reached. The last one drawn is taken in part, from its first word on; rows equal in
doc_id and text take the same part. So a source's words miss its target by less than one word per row equal to the last one drawn.

The order is never sorted as a whole: sizes are added up per source and first four digits of the hash (65,536 stretches at most), and only
the stretch in which the words run out is put in order.

Defined cases: a null text and one without words have size 0 and are taken 0 times; a null source is one source, the last; a null
doc_id is drawn by its text; repeated rows are documents of their own; an empty table gives no rows; a table without words has targets
0; other columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import with_position
from .repeats import staged

WEIGHTS, SHARE, EPOCHS, SEED = (5, 2, 1), 1.5, 2, 1
WORD = r"[^\x20\x09-\x0D]+"
#: Digits of the hash that name a stretch.
_DIGITS = 4


def sized(docs: DataFrame, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size in words, draw (the seeded hash) and the columns to carry."""
    draw = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.sha2(draw, 256).alias("draw"), *carry)


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """source, source_size, weight, target of each source of ``rows`` (source, size); weights go round in the order of sources."""
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_position(found, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = staged(placed.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(epochs))).alias("most")), "sources")
    wanted = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most")
        row = sources.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, F.col("most")).otherwise(0.0)).alias("full"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if row["n"] == clamped or not row["free"]:
            break
        clamped, level = row["n"], (wanted - row["full"]) / row["free"]
    target = F.when(above, F.col("most")).otherwise(F.least(F.col("weight") * F.lit(level), F.col("most")))
    return sources.select("source", "source_size", "weight", target.alias("target"))


def _ran_out(sums: DataFrame, key: str, wanted: str) -> DataFrame:
    """Per source the ``key`` at which the words ``wanted`` run out, the words left for it, and its rows."""
    before = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    so_far = sums.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return so_far.where(f"before <= {wanted} and {wanted} < before + size").withColumn("left", F.col(wanted) - F.col("before"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every document with source_size and target of its source, ``whole`` (times it is taken as a whole) and ``part`` (words of one more time)."""
    rows = staged(sized(docs, seed, carry), "sized")
    wanted = targets(rows, weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    wanted = wanted.withColumn("whole", whole.cast("int"))
    wanted = staged(wanted.withColumn("more", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")), "targets")

    stretch = F.substring("draw", 1, _DIGITS)
    drawn = rows.where("size > 0")
    per_stretch = drawn.groupBy("source", stretch.alias("stretch")).agg(F.sum("size").alias("size"))
    need = wanted.select(F.col("source").alias("of"), "more")
    ends = _ran_out(per_stretch.join(need, F.col("source").eqNullSafe(F.col("of"))), "stretch", "more")
    ends = staged(ends.select(F.col("source").alias("of"), F.col("stretch").alias("last"), F.col("left").alias("rest")), "stretches")
    last = drawn.join(ends, F.col("source").eqNullSafe(F.col("of")) & (stretch == F.col("last")))
    equal = last.groupBy("source", "draw", "rest").agg(F.sum("size").alias("size"), F.count("*").alias("mates"))
    ends = _ran_out(equal, "draw", "rest").select(F.col("source").alias("of"), F.col("draw").alias("cut"), F.floor(F.col("left") / F.col("mates")).cast("long").alias("share"))
    plan = wanted.withColumnRenamed("source", "_source").join(ends, F.col("_source").eqNullSafe(F.col("of")), "left").drop("of", "more", "weight")
    plan = staged(plan, "plan")
    part = F.when(F.col("draw") < F.col("cut"), F.col("size")).when(F.col("draw") == F.col("cut"), F.least("share", "size")).otherwise(0)
    mixed = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "whole", part.cast("long").alias("part"), *carry)


def copies(mixed: DataFrame, text: str = "text") -> DataFrame:
    """One row per copy of a document that the mix takes (``mixed`` carries ``text``): at most one more than the epochs of each. A copy in
    part has its words joined by one space."""
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("part").cast("int"))
    rest = F.when(F.col("part") == F.col("size"), F.col(text)).otherwise(F.array_join(words, " "))
    taken = F.concat(F.array_repeat(F.col(text), F.col("whole")), F.when(F.col("part") > 0, F.array(rest)).otherwise(F.array().cast("array<string>")))
    return mixed.where("size > 0").withColumn(text, F.explode(taken)).drop("whole", "part")
