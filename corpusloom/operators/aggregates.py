"""Summaries, audits and digests of tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, width: float, *by: str) -> DataFrame:
    """(by, bin, n): counts in bins of a width; nulls and NaN are in none."""
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return rows.groupBy(*by, F.floor(F.col(value) / width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_summary(bins: DataFrame, width: float, quantiles: list[float], *by: str) -> DataFrame:
    """(by, n, mean, q…): mean by bin centres, quantiles by the bin that reaches them.

    Works on the bins, which are as many as the value range allows, not on the rows.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(*by)
    cumulated = bins.withColumns({"__c": F.sum("n").over(w), "__t": F.sum("n").over(total)})
    marks = [F.min(F.when(F.col("__c") >= F.ceil(F.lit(q) * F.col("__t")), F.col("bin") * width)).alias(f"q{round(q * 100)}") for q in quantiles]
    return cumulated.groupBy(*by).agg(F.sum("n").alias("n"), (F.sum(F.col("n") * (F.col("bin") + 0.5)) * width / F.sum("n")).alias("mean"), *marks)


def null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_rows, nulls, blanks) of each column in one pass over the table; blanks count strings only."""
    kinds = dict(df.dtypes)
    counts = [F.count(F.lit(1)).alias("__n")]
    for c in columns:
        counts += [F.count_if(F.col(c).isNull()).alias(f"n_{c}"), (F.count_if(F.col(c).rlike(r"(?U)^\s*$")) if kinds[c] == "string" else F.lit(0).cast("long")).alias(f"b_{c}")]
    one = df.agg(*counts)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("__n").alias("n_rows"), F.col(f"n_{c}").alias("nulls"), F.col(f"b_{c}").alias("blanks")) for c in columns])))


def cross_check(df: DataFrame, row: str, kind: str, kinds: list[str]) -> DataFrame:
    """Counts of each row value by kind, as columns."""
    return df.groupBy(row).agg(*[F.count_if(F.col(kind) == k).alias(k) for k in kinds])


def numeric_summary(df: DataFrame, value: str, low: float, high: float, *by: str) -> DataFrame:
    """(by, n_rows, known, least, most, mean, out_of_range)."""
    v = F.col(value)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("known"), F.min(v).alias("least"), F.max(v).alias("most"), F.avg(v).alias("mean"), F.count_if(~v.between(low, high)).alias("out_of_range"))


def array_histogram(df: DataFrame, array: str, *by: str) -> DataFrame:
    """(by, item, n) of the elements of an array column."""
    return df.select(*by, F.explode(array).alias("item")).groupBy(*by, "item").agg(F.count(F.lit(1)).alias("n"))


def coverage(df: DataFrame, status: str, *by: str) -> DataFrame:
    """(by, total, ok, failed, skipped, other, balanced): statuses that must add up."""
    s = F.col(status)
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(s == "ok").alias("ok"), F.count_if(s == "failed").alias("failed"), F.count_if(s == "skipped").alias("skipped"), F.count_if(s.isNull() | ~s.isin("ok", "failed", "skipped")).alias("other"))
    return out.withColumn("balanced", F.col("total") == F.col("ok") + F.col("failed") + F.col("skipped") + F.col("other"))


def gate(df: DataFrame, status: str, least_rows: int, *by: str) -> DataFrame:
    """(by, n_rows, ok, failed, stop): whether a task of this outcome must stop: no ok row at all, or failures en masse."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(status) == "ok").alias("ok"), F.count_if(F.col(status) == "failed").alias("failed"))
    return out.withColumn("stop", ((F.col("n_rows") >= least_rows) & (F.col("ok") == 0)) | (F.col("failed") > F.greatest(F.lit(16), F.floor(F.col("n_rows") / 4))))


def error_rate(df: DataFrame, reference: Column, hypothesis: Column, *by: str) -> DataFrame:
    """(by, texts, chars, edits, rate): character errors of a corpus, as the sum of edits over the sum of lengths.

    Edits are counted within a narrow band first, and within a wider one only where that
    wasn't enough, so the cost of a pair grows with its edits.
    """
    both = df.select(*by, reference.alias("__a"), hypothesis.alias("__b")).where("__a is not null and __b is not null")
    within = lambda k: F.nullif(F.expr(f"levenshtein(__a, __b, {k})"), F.lit(-1))
    rows = both.select(*by, F.length("__a").alias("__n"), F.coalesce(within(8), within(64), within(512), F.levenshtein("__a", "__b")).alias("__d"))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("texts"), F.sum("__n").alias("chars"), F.sum("__d").alias("edits")).withColumn("rate", F.try_divide(F.col("edits").cast("double"), F.col("chars")))


def ordered_digest(df: DataFrame, part: str, position: str, value: str) -> DataFrame:
    """(part, n_rows, sha256): digest of a column in row order, for parts of bounded size (tasks, slices).

    Null values count as empty.
    """
    items = F.sort_array(F.collect_list(F.struct(position, F.coalesce(value, F.lit("")).alias("v"))))
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.array_join(F.transform(items, lambda x: x["v"]), "\n"), 256).alias("sha256"))


def set_digest(df: DataFrame, value: str, buckets: int = 256) -> DataFrame:
    """(bucket, n, low, high): an order-free fingerprint of a set by hash bucket.

    Two sets are equal only if all buckets are; sums of two independent hashes make the
    fingerprint, so nothing is sorted or collected.
    """
    h = F.xxhash64(value)
    return df.select(F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"), h.cast("decimal(38,0)").alias("a"), F.xxhash64(F.lit("second"), F.col(value)).cast("decimal(38,0)").alias("b")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("low"), F.sum("b").alias("high"))


def sorted_set_sha256(df: DataFrame, value: str) -> str:
    """SHA-256 over the sorted distinct values, streamed partition by partition; repeated values are an error."""
    state, last = hashlib.sha256(), None
    for (v,) in df.select(value).orderBy(value).toLocalIterator():
        if v == last:
            raise ValueError(f"repeated value {v!r}")
        state.update(v.encode() + b"\n")
        last = v
    return state.hexdigest()


def throughput(states: DataFrame, by: str, status: str, began: str, ended: str, rows: str) -> DataFrame:
    """(by, units, finished, failed, open, n_rows, busy_seconds, rows_per_second) of the units of a run; a unit without an end is open."""
    done = (F.col(status) == "ok") & F.col(ended).isNotNull()
    took = F.when(done, (F.unix_micros(F.col(ended).cast("timestamp")) - F.unix_micros(F.col(began).cast("timestamp"))) / 1e6)
    out = states.groupBy(by).agg(F.count(F.lit(1)).alias("units"), F.count_if(done).alias("finished"), F.count_if(F.col(status) == "failed").alias("failed"), F.count_if(F.col(ended).isNull()).alias("open"), F.coalesce(F.sum(F.when(done, F.col(rows))), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(took), F.lit(0.0)).alias("busy_seconds"))
    return out.withColumn("rows_per_second", F.try_divide("n_rows", "busy_seconds"))


def shard_gaps(df: DataFrame, shard: str, total: str, *by: str) -> DataFrame:
    """(by, missing): numbers of shards that a set of files of known total lacks."""
    have = df.groupBy(*by).agg(F.max(total).alias("__t"))
    wanted = have.select(*by, F.explode(F.sequence(F.lit(0), F.col("__t") - 1)).alias("missing"))
    seen = df.select(*by, F.col(shard).alias("missing")).distinct()
    return wanted.join(seen, [*by, "missing"], "left_anti")
