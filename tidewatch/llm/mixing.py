"""Mixing sources to target weights along a time-varying curriculum (operator 5).

All steps are DataFrame expressions. Sizes are words. Sources in code point order weigh 3, 1, 2,
repeating, and share 150 % of all sizes; no source takes more than twice its size, and what it
cannot take is shared anew among the others by weight. That sharing has a closed form: with sources
in order of cap / weight, the capped ones come first.

Inside a source documents stand in the order of their id's MD5, as often as needed, and the mix
takes the words from 0 up to the target; the document in which the target falls is taken in part.
The weight of a source changes over the training from ``1 - slope`` to ``1 + slope`` times its
average. The integral of that schedule, times the target, is the source's token demand up to a
time; inverting it gives the time at which a document's first word is due, and documents are
range-sorted by it.

A source may hold a third of all rows: running totals come from buckets of the order (about
``ROWS_PER_BUCKET`` rows each), so no task sees a whole source. Rows that agree in id, source and
size are counted first and spread out again after.

Defined cases: NULL or empty texts have size 0 and take 0; a NULL source comes last; a NULL id
sorts first in its source; repeated rows each take their turn; a source of size 0 has target 0; an
empty table gives an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import ROWS_PER_BUCKET, cut, numbered, running_totals, word_count

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
#: Change of a source's weight over the training, repeating like the weights.
SLOPES = (0.5, 0.0, -0.5)


def by_place(place: Column, values: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), ((place - 1) % len(values) + 1).cast("int"))


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: its place, weight, size, rows and target.

    ``sizes`` has (source, n_rows, source_size); there is one row per source, whatever the number
    of documents.
    """
    placed = sizes.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", by_place(F.col("place"), WEIGHTS))
    cap = F.col("source_size") * float(MAX_REPEATS)
    order = Window.orderBy(cap / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * TOTAL_SHARE
    capped = F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    # What a unit of weight gets if all earlier sources are capped. A source is capped if its cap
    # is not above that; the level of the first uncapped source holds for all uncapped ones, and
    # later sources' levels are lower, as they take their predecessors for capped.
    level = (total - capped) / weight_left
    levels = placed.withColumns({"level": level, "cap": cap})
    open_level = F.max(
        F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    ).over(everything)
    return levels.withColumn(
        "target",
        F.coalesce(F.least(F.col("cap"), open_level * F.col("weight")), F.col("cap")),
    ).select("source", "place", "weight", "n_rows", "source_size", "target")


def due(words: Column, target: Column, slope: Column) -> Column:
    """Training time from 0 to 1 at which a source has asked for so many of its words.

    The weight 1 + slope * (2t - 1) has the integral t + slope * (t * t - t).
    """
    share = F.when(target > 0, F.least(words / target, F.lit(1.0))).otherwise(F.lit(0.0))
    linear = 1 - slope
    root = (F.sqrt(linear * linear + 4 * slope * share) - linear) / (2 * slope)
    return F.when(slope == 0, share).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), root)))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """Per row its id, size, source's size and target, words taken, and training positions.

    ``position`` is when the first reading is due and ``second_position`` when the second one is;
    NULL where the mix does not come to it. Rows are range-sorted by the first position, those that
    the mix does not take come last; ties stand in the order of the rest of the row.
    """
    placed = plan(docs, doc_id, text, source)
    order = [F.col("position").asc_nulls_last(), "second_position", "doc_id", "source", "size", "copy"]
    return placed.orderBy(*order).select(
        "doc_id", "size", "source_size", "target", "taken", "position", "second_position"
    )


def plan(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """The mix with its keys: rows that agree in id, source and size are told apart by ``copy``."""
    sized = docs.select(
        docs[doc_id].alias("doc_id"),
        docs[source].alias("source"),
        word_count(docs[text]).alias("size"),
    )
    counted = cut(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")))
    goals = cut(
        targets(
            counted.groupBy("source").agg(
                F.sum("copies").alias("n_rows"),
                F.sum(F.col("size") * F.col("copies")).alias("source_size"),
            )
        )
    )
    goal = goals.select(F.col("source").alias("goal_source"), F.struct("*").alias("goal"))
    digest = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))
    buckets = F.ceil(F.col("goal.n_rows") / ROWS_PER_BUCKET)
    high = F.coalesce(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(0))
    placed = (
        counted.join(goal, counted["source"].eqNullSafe(goal["goal_source"]))
        .withColumn("digest", digest)
        .withColumn("bucket", F.floor(high * buckets / 2**32))
        .withColumn("words", F.col("size") * F.col("copies"))
    )
    placed = running_totals(
        placed.select("source", "doc_id", "size", "copies", "digest", "bucket", "words", "goal"),
        ["source"],
        ["digest", "doc_id", "size"],
        "bucket",
        {"start": "words"},
    )
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).withColumn(
        "start", F.col("start") + (F.col("copy") - 1) * F.col("size")
    )
    target = F.col("goal.target")
    whole = F.floor(target)
    second = F.col("start") + F.col("goal.source_size")
    part = [
        F.greatest(F.lit(0), F.least(F.col("size"), whole - start)) for start in (F.col("start"), second)
    ]
    slope = by_place(F.col("goal.place"), SLOPES)
    return each.select(
        "doc_id",
        "source",
        "size",
        "copies",
        (F.col("copy") - 1).alias("copy"),
        F.col("goal.source_size").alias("source_size"),
        target.alias("target"),
        (part[0] + part[1]).cast("long").alias("taken"),
        *[
            ((words > 0) & (2 * words >= F.col("size"))).alias(name)
            for words, name in zip(part, ("read", "read_again"), strict=True)
        ],
        *[
            F.when(words > 0, due(start, target, slope)).alias(name)
            for words, start, name in zip(
                part, (F.col("start"), second), ("position", "second_position"), strict=True
            )
        ],
    )


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The documents themselves in training order, those read twice twice, all columns as they are.

    Documents stay whole: a reading counts if the mix takes at least half of its words.
    """
    readings = cut(
        plan(docs, doc_id, text, source).where("read or read_again").select(
            F.struct("doc_id", "source", "size").alias("mix_key"),
            "copies",
            "copy",
            F.array_compact(
                F.array(F.when(F.col("read"), F.col("position")),
                        F.when(F.col("read_again"), F.col("second_position")))
            ).alias("positions"),
        )
    )
    row = F.struct(*[docs[name] for name in docs.columns]).alias("row")
    key = (docs[doc_id], docs[source], word_count(docs[text]))
    keyed = docs.select(row, *[k.alias(name) for k, name in zip(key, ("k1", "k2", "k3"), strict=True)])
    same = (
        F.col("k1").eqNullSafe(F.col("mix_key.doc_id"))
        & F.col("k2").eqNullSafe(F.col("mix_key.source"))
        & (F.col("k3") == F.col("mix_key.size"))
    )
    single = keyed.join(readings.where("copies = 1"), same).select("row", "positions")
    several = readings.where("copies > 1")
    shared = keyed.join(several.select("mix_key", "copies").distinct(), same)
    told_apart = numbered(shared.select("row", "k1", "k2", "k3", "copies"), ["k1", "k2", "k3"], "copies", "number")
    again = told_apart.drop("copies").join(several, same & (F.col("number") == F.col("copy")))
    read = single.union(again.select("row", "positions"))
    return (
        read.select("row", F.explode("positions").alias("position"))
        .orderBy("position")
        .select("row.*")
    )
