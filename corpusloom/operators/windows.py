"""Ranking, bucketing and island computations.

Windows are partitioned by a key; where a global order is needed, partitions are totalled
first and only those totals are ordered.  Ties are broken by a unique column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.digests import rank_hash
from corpusloom.shared import materialised


def topk_by_hash(df: DataFrame, key: str, unique: str, k: int, seed: str) -> DataFrame:
    """Up to k rows per key, chosen and ordered by a hash of seed and `unique`.

    Rows are first cut to k per key and salt, so that a key with a large share of the rows
    is thinned by many tasks before its last k are ranked.  Null keys are one key.
    """
    ranked = df.withColumns({"__h": rank_hash(seed, F.col(unique)), "__salt": F.pmod(F.xxhash64(unique), F.lit(64))})
    order = [F.col("__h"), F.col(unique)]
    first = ranked.withColumn("__r", F.row_number().over(Window.partitionBy(key, "__salt").orderBy(*order))).where(F.col("__r") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k).drop("__h", "__salt", "__r")


def running_offsets(df: DataFrame, part: str) -> DataFrame:
    """(part, n_rows, offset): rows of each part and of all parts before it, in order of the part.

    Ordered are only the parts (files or fragments), of which there is one row each.
    """
    sizes = df.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("offset", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))


def placed(df: DataFrame, part: str, *order: str) -> DataFrame:
    """`df` with place: each row's place within its part, from 0, in order of `order` (nulls first, null parts are one part).

    Rows are range-partitioned and sorted once, so that a part with any share of them is
    ranked by many tasks; counted are the rows of a part in each partition, and only those
    counts are added up.
    """
    rows = df.repartitionByRange(part, *order).sortWithinPartitions(part, *order).withColumn("__id", F.monotonically_increasing_id())
    rows = materialised(rows, "placed")
    task = F.shiftright("__id", 33)
    counts = rows.groupBy(F.col(part).alias("__part"), task.alias("__task")).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__part").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__part", "__task", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    joined = rows.withColumn("__of", task).join(counts, F.col(part).eqNullSafe(F.col("__part")) & (F.col("__of") == F.col("__task")))
    return joined.withColumn("place", F.col("__id") + F.col("__shift")).drop("__id", "__of", "__part", "__task", "__shift")


def slices(df: DataFrame, part: str, position: str, size: int) -> DataFrame:
    """`df` with slice_no: consecutive rows of each part in slices of `size`."""
    return placed(df, part, position).withColumn("slice_no", F.floor(F.col("place") / size).cast("long")).drop("place")


def islands(df: DataFrame, part: str, start: str, end: str) -> DataFrame:
    """(part, island, first, last, n): runs of rows in which each starts where the one before ends."""
    w = Window.partitionBy(part).orderBy(start, end)
    fresh = F.when(F.lag(end).over(w).eqNullSafe(F.col(start)), 0).otherwise(1)
    marked = df.withColumn("__fresh", fresh).withColumn("island", F.sum("__fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(part, "island").agg(F.min(start).alias("first"), F.max(end).alias("last"), F.count(F.lit(1)).alias("n"))


def mask_runs(df: DataFrame, key: str, position: str, flag: Column) -> DataFrame:
    """(key, run_start, run_end): maximal runs of consecutive positions whose flag is true, half open."""
    rows = df.where(flag).select(key, position)
    group = F.col(position) - F.row_number().over(Window.partitionBy(key).orderBy(position))
    return rows.withColumn("__g", group).groupBy(key, "__g").agg(F.min(position).alias("run_start"), (F.max(position) + 1).alias("run_end")).drop("__g")


def length_batches(df: DataFrame, length: str, unique: str, padded: Column, size: Column, groups: int = 64) -> DataFrame:
    """`df` with bucket, batch_size and batch_no: rows of one padded length in batches of its size.

    Batches are formed within a bucket and a salt, so that a common length isn't one task.
    """
    rows = df.withColumn("bucket", padded).where("bucket is not null").withColumns({"batch_size": size, "salt": F.pmod(F.xxhash64(unique), F.lit(groups)).cast("int")})
    at = F.row_number().over(Window.partitionBy("bucket", "salt").orderBy(length, unique)) - 1
    return rows.withColumn("batch_no", F.floor(at / F.col("batch_size")).cast("long"))


def interleaved(df: DataFrame, source: str, order: str) -> DataFrame:
    """`df` with turn: the row's place within its source, from 1, so that ordering by turn takes sources in rotation."""
    return placed(df, source, order).withColumn("turn", F.col("place") + 1).drop("place")


def spread_sample(df: DataFrame, part: str, order: str, n: int) -> DataFrame:
    """First, middle and last parts, and of each the n rows in its middle."""
    parts = df.groupBy(part).agg(F.count(F.lit(1)).alias("__rows"))
    w = Window.orderBy(part)
    ranked = parts.withColumns({"__at": F.row_number().over(w) - 1, "__all": F.count(F.lit(1)).over(Window.partitionBy())})
    chosen = ranked.where(F.col("__at").isin(0) | (F.col("__at") == F.floor(F.col("__all") / 2)) | (F.col("__at") == F.col("__all") - 1))
    rows = df.join(F.broadcast(chosen.select(F.col(part).alias("__chosen"), "__rows")), F.col(part) == F.col("__chosen"))  # three rows
    begin = F.floor(F.greatest(F.col("__rows") - n, F.lit(0)) / 2)
    return placed(rows, part, order).where((F.col("place") >= begin) & (F.col("place") < begin + n)).drop("__chosen", "__rows", "place")


def window_energy(df: DataFrame, key: str, position: str, value: str, width: int) -> DataFrame:
    """(key, window_no, n, energy): mean square of each stretch of `width` values; the last one by its own length."""
    return df.groupBy(key, F.floor(F.col(position) / width).alias("window_no")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(value) * F.col(value)).alias("energy"))


def loud_edges(df: DataFrame, key: str, position: str, value: str, relative: float) -> DataFrame:
    """(key, first_loud, last_loud): outermost positions above a share of the key's peak."""
    peaks = df.groupBy(key).agg(F.max(F.abs(value)).alias("__peak")).withColumnRenamed(key, "__key")
    rows = df.join(peaks, F.col(key) == F.col("__key"))
    return rows.where(F.abs(value) > F.col("__peak") * relative).groupBy(key).agg(F.min(position).alias("first_loud"), F.max(position).alias("last_loud"))


def budget_batches(df: DataFrame, length: str, unique: str, budget: int, group_rows: int = 4096) -> DataFrame:
    """`df`'s (unique, length) with salt and batch_no: greedy batches in order of length whose padded total is within a budget.

    A sequential fold, so it runs per salt of about `group_rows` rows; there are as many
    salts as the number of rows asks for.
    """
    import pandas as pd

    groups = max(1, round(df.where(F.col(length).isNotNull()).count() / group_rows))

    kind = df.schema[unique].dataType.simpleString()
    rows = df.select(F.col(unique), F.col(length).cast("long").alias("length"), F.pmod(F.xxhash64(unique), F.lit(groups)).cast("int").alias("salt")).where("length is not null")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", unique])
        out, no, count = [], 0, 0
        for n in pdf["length"].tolist():
            if count and (count + 1) * n > budget:
                no, count = no + 1, 0
            count += 1
            out.append(no)
        return pdf.assign(batch_no=out)

    return rows.groupBy("salt").applyInPandas(run, f"`{unique}` {kind}, length bigint, salt int, batch_no bigint")


def byte_batches(files: DataFrame, group: str, path: str, size: str, most: int) -> DataFrame:
    """(group, path, size, batch_no): files of a group in order of their paths, in batches that hold at most `most` bytes, or one larger file.

    A sequential fold over a listing, of which there is one row per file.
    """
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(path)
        no, held, out = 0, 0, []
        for n in pdf[size].tolist():
            if held and held + n > most:
                no, held = no + 1, 0
            held += n
            out.append(no)
        return pdf.assign(batch_no=out)

    rows = files.select(group, path, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias(size)).where(F.col(path).isNotNull())
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.groupBy(group).applyInPandas(run, ", ".join(f"`{n}` {k}" for n, k in kinds.items()) + ", batch_no bigint")


def threshold_tasks(sizes: DataFrame, part: str, size: str, most: int) -> list[tuple[str, int, int]]:
    """(part, size, task) of files in order: a task closes once it holds `most`.

    A driver-side plan over one row per file, as file listings are.
    """
    out, task, held = [], 0, 0
    for row in sizes.select(part, size).orderBy(part).toLocalIterator():
        out.append((row[0], row[1], task))
        held += row[1]
        if held >= most:
            task, held = task + 1, 0
    return out
