"""Joins that account for every row.

A verified join carries its own evidence: the rows of either side that have no partner or
several are counted in the same plan, and a join that must be complete can be made to fail
the job, not just report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest side, in bytes of Spark's own estimate, that a join broadcasts by request.
BROADCAST_BYTES = 8 << 20


def small(df: DataFrame) -> DataFrame:
    """`df` with a broadcast hint if Spark's size estimate proves it small; otherwise as it is."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= BROADCAST_BYTES else df


def with_count(df: DataFrame, key: str, name: str = "__n") -> DataFrame:
    """One row per key: its first row's columns and how many rows the key has."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name), *([F.min(F.struct(*others)).alias("__row")] if others else []))


def verified_join(left: DataFrame, right: DataFrame, key: str, coverage: str = "left", strict: bool = False) -> DataFrame:
    """`left` with `right` as a struct column `matched`, 1:1 on `key`.

    coverage: left (right may lack rows), exact (neither side may).  Rows of right that
    repeat a key, or, with exact, rows without a partner, show in the column `problem`
    (duplicate, missing, unexpected); with `strict` they fail the job.  Clashing column
    names don't matter, as right's columns stay inside the struct.  Null keys match nothing.
    """
    once = right.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*right.columns)).alias("matched")).withColumnRenamed(key, "__key")
    how = "full" if coverage == "exact" else "left"
    joined = left.withColumn("__left", F.lit(True)).join(once, F.col(key) == F.col("__key"), how)
    problem = F.when(F.col("__n") > 1, "duplicate")
    if coverage == "exact":
        problem = problem.when(F.col("__left").isNull(), "unexpected").when(F.col("__n").isNull(), "missing")
    out = joined.withColumn("problem", problem)
    if strict:
        out = out.withColumn("problem", F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("join problem: "), F.col("problem")))).otherwise(None).cast("string"))
    return out.select(*left.columns, "matched", "problem")


def annotated(base: DataFrame, annotation: DataFrame, key: str, fields: list[str], ok: Column) -> DataFrame:
    """`base` with a struct `annotation`; its payload is null unless `ok`."""
    payload = F.when(ok, F.struct(*fields)).alias("result")
    made = annotation.select(F.col(key).alias("__key"), F.struct("status", payload).alias("annotation"))
    return base.join(made, F.col(key) == F.col("__key"), "left").drop("__key")


def latest_ok(rows: DataFrame, key: str, time: str = "finished_at") -> DataFrame:
    """One row per key of an attempt log: an ok row if there is one, then the latest; repeated deliveries count once."""
    order = F.struct((F.col("status") == "ok").cast("int").alias("ok"), F.col(time).alias("at"), F.struct(*[F.col(c) for c in rows.columns if c not in (key, time)]).alias("row"))
    best = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("__b"))
    return best.select(key, F.col("__b.at").alias(time), "__b.row.*").select(*rows.columns)


def merge_features(tables: dict[str, DataFrame], key: str, same: list[str]) -> DataFrame:
    """Inner join of feature tables on `key`, columns prefixed by table name but for key and `same`.

    mismatched lists the columns of `same` in which the tables disagree.
    """
    names = list(tables)
    prepared = []
    for k, (name, df) in enumerate(tables.items()):
        keep = [F.col(c).alias(f"{name}_{c}") for c in df.columns if c != key]
        prepared.append(df.select(F.col(key), *keep))
    joined = reduce(lambda a, b: a.join(b, key), prepared)
    odd = [F.when(reduce(lambda x, y: x | y, [~F.col(f"{names[0]}_{c}").eqNullSafe(F.col(f"{n}_{c}")) for n in names[1:]]), c) for c in same]
    dropped = [f"{n}_{c}" for n in names[1:] for c in same]
    return joined.withColumn("mismatched", F.array_compact(F.array(*odd))).drop(*dropped).withColumnsRenamed({f"{names[0]}_{c}": c for c in same})


def merge_accounting(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """(source, error_code, n_rows): failures of each table, and the ids that any table fails."""
    failed = [df.where(F.col("status").isNull() | (F.col("status") != "ok")).select(F.lit(n).alias("source"), F.col(key).alias("__id"), F.coalesce("error_code", F.lit("none")).alias("error_code")) for n, df in tables.items()]
    rows = reduce(DataFrame.unionByName, failed)
    by_code = rows.groupBy("source", "error_code").agg(F.count(F.lit(1)).alias("n_rows"))
    total = rows.select("__id").distinct().agg(F.lit("any").alias("source"), F.lit("excluded").alias("error_code"), F.count(F.lit(1)).alias("n_rows"))
    return by_code.unionByName(total)


def shared_keys(df: DataFrame, group: str, key: str) -> DataFrame:
    """(group_a, group_b, n_keys): distinct keys that two groups have in common.

    Each key's groups are first made distinct, so only the groups of one key are paired; a
    key has at most as many as there are groups.
    """
    once = df.select(group, key).where(F.col(key).isNotNull() & F.col(group).isNotNull()).distinct()
    a, b = once.select(F.col(key), F.col(group).alias("group_a")), once.select(F.col(key), F.col(group).alias("group_b"))
    return a.join(b, key).where("group_a < group_b").groupBy("group_a", "group_b").agg(F.count(F.lit(1)).alias("n_keys"))


def reusable(old: DataFrame, new: DataFrame, key: str, same: list[str], task: str) -> DataFrame:
    """(task, n_rows, reusable): new targets whose old result is ok and agrees in all of `same`."""
    once = old.groupBy(key).agg(F.max(F.when(F.col("status") == "ok", F.struct(*same))).alias("__old")).withColumnRenamed(key, "__key")
    fits = reduce(lambda a, b: a & b, [F.col(f"__old.{c}").eqNullSafe(F.col(c)) for c in same]) & F.col("__old").isNotNull()
    return new.join(once, F.col(key) == F.col("__key"), "left").groupBy(task).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(fits).alias("reusable"))


def interval_overlaps(df: DataFrame, keys: list[str], who: str, start: str, end: str, width: int = 1 << 20) -> DataFrame:
    """(keys, overlap_start, overlap_end): stretches where intervals of different owners overlap, merged.

    A sweep over the boundaries replaces the range join: +1 and -1 events per owner give the
    number of owners speaking at each point.  Cost grows with the intervals, not with the
    pairs.  Events are swept per slice of the timeline; each slice starts with the owners
    that are open at its border.
    """
    from corpusloom.operators.intervals import periods

    own = periods(df, [*keys, who], start, end)
    cut = own.select(*keys, F.col("period_start").alias("s"), F.col("period_end").alias("e"), F.explode(F.expr(f"sequence(floor(period_start / {width}), floor((period_end - 1) / {width}))")).alias("slice"))
    inside = cut.select(*keys, "slice", F.greatest("s", F.col("slice") * width).alias("s"), F.least("e", (F.col("slice") + 1) * width).alias("e"))
    events = inside.select(*keys, "slice", F.inline(F.array(F.struct(F.col("s").alias("at"), F.lit(1).alias("step")), F.struct(F.col("e").alias("at"), F.lit(-1).alias("step")))))
    steps = events.groupBy(*keys, "slice", "at").agg(F.sum("step").alias("step"))
    w = Window.partitionBy(*keys, "slice").orderBy("at")
    open_now = steps.withColumns({"n": F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)), "until": F.lead("at").over(w)})
    pieces = open_now.where("n >= 2 and until > at").select(*keys, F.col("at").alias("a"), F.col("until").alias("b"))
    return periods(pieces, keys, "a", "b").withColumnsRenamed({"period_start": "overlap_start", "period_end": "overlap_end"})
