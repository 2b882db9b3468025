"""Mixing sources to target weights.

Words are counted per source, each source gets a target, and a document is taken
``floor(rate)`` times plus once more if a number drawn from its own hash is below
the fraction, where rate is target over size of its source. Draws depend on the
document alone, so a rerun, a retry or another partitioning takes the same copies.

Only sizes and rates meet the documents: one small row a source, written to the
shared scratch folder, so that Spark knows its size and broadcasts it only if it is
small; otherwise a shuffle join follows whose hot sources adaptive execution splits.

Null text counts no word. A null source is a source of its own, last in the order.
Repeated rows draw alike. An empty table gives no row. Columns named like the
results (``size``, ``source_size``, ``target``, ``rate``, ``taken``, ``copies``, ``copy``)
are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.session import scratch_dir

from .arrays import WORD, free_name, without

DRAW_DIGITS = 13
RESULTS = ("size", "source_size", "target", "rate", "copies", "taken", "copy")


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str) -> Column:
    """A number in [0, 1) from the id and the text of a document."""
    key = F.concat(
        F.lit(f"{seed}:"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit(":"),
        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")),
    )
    digits = F.conv(F.substring(F.md5(key.cast("binary")), 1, DRAW_DIGITS), 16, 10)
    return digits.cast("double") / F.lit(float(16**DRAW_DIGITS))


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """One row a source: its size and its target.

    ``share`` of all sizes is dealt by the weights, which repeat over the sources in
    code point order. No target is over ``cap`` times the source; what is cut off goes
    to the others by weight, until none is above. That is the level at which
    ``sum(min(weight * level, cap * size))`` reaches the total: with the sources in
    order of ``cap * size / weight`` the first ones are full, and the level follows
    from what they leave. Windows run over one row a source.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*(F.lit(weight) for weight in weights))
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    limit = F.col("source_size") * F.lit(float(cap))
    ranked = by_source.withColumn("weight", F.element_at(cycle, place)).withColumn("limit", limit)
    filling = Window.orderBy(
        F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source")
    )
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)
    fits = F.when(F.col("weight") * F.col("level") <= F.col("limit"), F.col("level"))
    dealt = ranked.withColumn("level", level).withColumn("level", F.max(fits).over(everything))
    target = F.coalesce(F.least("limit", F.col("weight") * F.col("level")), F.col("limit"))
    return dealt.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """Each document with its size, rate, copies and the words taken."""
    kept = without(docs.columns, RESULTS)
    other = free_name("_source", kept)
    sized = docs.select(*kept, words().alias("size"))
    path = scratch_dir(docs.sparkSession)
    source_targets(sized, weights, share, cap).write.parquet(path)
    targets = docs.sparkSession.read.parquet(path).withColumnRenamed("source", other)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    whole = F.floor("rate")
    extra = (draw(seed) < F.col("rate") - whole).cast("long")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col(other)), "left")
    return (
        joined.drop(other)
        .withColumn("rate", F.coalesce(rate, F.lit(0.0)))
        .withColumn("copies", whole + extra)
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def emit_copies(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes."""
    return mixed.where("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
