"""Continuous periods of overlapping intervals, and the gaps between them.

Intervals are half open.  One counts if both bounds are there and 0 <= start < end;
touching intervals belong to one period; nothing is clipped.  Rows with a null in any key
form the entity of that null.  An empty input gives an empty result; repeated rows change
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.shared import materialised, settings

#: Width of a slice of an entity's timeline.  Slices are what a task handles at once, so
#: an entity that holds a large share of all rows is spread over many tasks.
SLICE = 1 << 22


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join on null-safe equality; `right` adds its other columns."""
    renamed = right.withColumnsRenamed({c: f"__r{i}" for i, c in enumerate(on)})
    cond = F.lit(True)
    for i, c in enumerate(on):
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r{i}"))
    return left.join(renamed, cond, "left").drop(*[f"__r{i}" for i in range(len(on))])


def periods(df: DataFrame, keys: list[str], start: str, end: str, slice_width: int = SLICE) -> DataFrame:
    """(keys, period_start, period_end) of the merged intervals of each entity.

    session_window with the row's own length as the gap merges the intervals of one
    entity and slice.  Slices are then joined up through one summary row each: the
    furthest end before a slice tells whether its first periods go on from earlier ones.
    """
    s, e = F.col(start).cast("long"), F.col(end).cast("long")
    names = [f"__k{i}" for i in range(len(keys))]
    rows = df.where((s >= 0) & (s < e)).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.timestamp_micros(s).alias("__t"),
        F.concat((e - s).cast("string"), F.lit(" microseconds")).alias("__gap"),
        F.floor(s / slice_width).alias("__slice"),
    )
    session = F.session_window("__t", F.col("__gap"))
    local = rows.groupBy(*names, "__slice", session.alias("__w")).agg(F.count(F.lit(1)).alias("__n"))
    local = local.select(*names, "__slice", F.unix_micros(F.col("__w.start")).alias("__s"), F.unix_micros(F.col("__w.end")).alias("__e"))

    # sessions of a partition are merged before they are shuffled, so copies and nested intervals don't cross it
    with settings(df.sparkSession, spark__sql__sessionWindow__merge__sessions__in__local__partition="true"):
        local = materialised(local, "sessions")

    in_slice = Window.partitionBy(*names, "__slice").orderBy("__s")
    across = Window.partitionBy(*names).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = local.groupBy(*names, "__slice").agg(F.max("__e").alias("__e"))
    ends = ends.select(*names, "__slice", F.max("__e").over(across).alias("__carry"))
    on = [*names, "__slice"]
    joined = _joined(local, ends, on)
    reached = F.greatest(F.coalesce("__carry", F.lit(-1)), F.coalesce(F.max("__e").over(in_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)))
    flagged = joined.withColumn("__new", F.when(F.col("__s") > reached, F.col("__s")))
    opened = flagged.groupBy(*on).agg(F.max("__new").alias("__new"))
    opened = opened.select(*on, F.max("__new").over(across).alias("__open"))
    island = F.coalesce(F.max("__new").over(in_slice.rowsBetween(Window.unboundedPreceding, 0)), F.col("__open"))
    placed = _joined(flagged, opened, on).withColumn("__island", island)
    return placed.groupBy(*names, "__island").agg(F.max("__e").alias("period_end")).select(*[F.col(n).alias(k) for k, n in zip(keys, names)], F.col("__island").alias("period_start"), "period_end")


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, slice_width: int = SLICE) -> DataFrame:
    """(keys, span_kind, span_start, span_end): a row for each period and each gap between two of one entity.

    The start after a period is found with lead inside a slice; the last period of a slice
    looks at the first start of the next slice that has one.
    """
    found = materialised(periods(df, keys, start, end, slice_width).withColumn("__slice", F.floor(F.col("period_start") / slice_width)), "periods")
    on = [*keys, "__slice"]
    firsts = found.groupBy(*on).agg(F.min("period_start").alias("__first"))
    firsts = firsts.select(*on, F.lead("__first").over(Window.partitionBy(*keys).orderBy("__slice")).alias("__after"))
    here = F.lead("period_start").over(Window.partitionBy(*on).orderBy("period_start"))
    both = _joined(found, firsts, on).withColumn("__next", F.coalesce(here, F.col("__after")))
    spans = F.array(
        F.struct(F.lit("period").alias("span_kind"), F.col("period_start").alias("span_start"), F.col("period_end").alias("span_end")),
        F.when(F.col("__next").isNotNull(), F.struct(F.lit("gap").alias("span_kind"), F.col("period_end").alias("span_start"), F.col("__next").alias("span_end"))),
    )
    return both.select(*keys, F.inline(F.array_compact(spans)))
