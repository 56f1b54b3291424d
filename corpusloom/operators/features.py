"""Feature tables: row validation, merge checks, references, metadata and publication order."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import digests
from corpusloom.functions import text as tx, frames


def violations(*checks: tuple[str, Column]) -> Column:
    """Names of the checks that a row fails; a null check counts as failed."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks]))


def payload_violations(payload: str, status: str = "status") -> list[tuple[str, Column]]:
    """The convention of status rows: a payload if and only if ok, an error code if and only if not."""
    ok = F.coalesce(F.col(status) == "ok", F.lit(False))
    return [("payload_by_status", F.col(payload).isNotNull() == ok), ("error_by_status", F.col("error_code").isNull() == ok)]


def vector_violations(vector: str, size: int, sha256: str | None = None) -> Column:
    """What is wrong with a stored vector: size, values, norm and, if stored, its digest."""
    checks = [("size", F.size(vector) == size), ("finite", frames.all_finite(F.col(vector))), ("valid", frames.valid_vector(F.col(vector), size))]
    if sha256:
        checks.append(("digest", digests.vector_digest(F.col(vector)) == F.col(sha256)))
    return violations(*checks)


def codec_violations(codes: str, rate: str, native: str, encoder_input: str, books: int = 16, size: int = 2048) -> Column:
    """What is wrong with a codec row: frame counts, tolerance of the resampled length, code ranges."""
    expected = frames.resampled_length(F.col(native), F.col(rate), 24000)
    return violations(
        ("resampled_length", frames.within_tolerance(F.col(encoder_input) - expected, F.lit(24000))),
        ("codes", frames.valid_codes(F.col(codes), frames.codec_frames(F.col(encoder_input)), books, size)),
    )


def attach_references(rows: DataFrame, codec: DataFrame, key: str, seed: int, same: list[str], prefix: bool = False) -> DataFrame:
    """`rows` with a reference span of the codec row of the same target; `problem` names a missing row or a differing field.

    Spans are deterministic in key and seed; a target without a possible span has a null.
    """
    made = codec.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*[c for c in codec.columns if c != key])).alias("__c")).withColumnRenamed(key, "__key")
    joined = rows.join(made, F.col(key) == F.col("__key"), "left")
    odd = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__c.{c}")), c) for c in same]))
    problem = F.when(F.col("__n").isNull(), "missing").when(F.col("__n") > 1, "repeated").when(F.size(odd) > 0, F.concat(F.lit("differs:"), F.array_join(odd, ",")))
    span = digests.reference_spans(F.col("__c.end_frame"), F.col("__c.native_sample_rate"), F.col(key), seed, prefix)
    return joined.withColumns({"problem": problem, "__s": span}).withColumn("reference", F.when(F.col("problem").isNull() & F.col("__s.start_step").isNotNull(), F.col("__s"))).select(*rows.columns, "reference", "problem")


def selected_metadata(decisions: DataFrame, base: DataFrame, key: str = "sample_id", normalization: str = "strip") -> DataFrame:
    """(key, text, language, text_revision) of selected rows: overrides where there are any, else the base values."""
    own = base.select(F.col(key).alias("__key"), F.col("text").alias("__text"), F.col("language").alias("__language"))
    rows = decisions.where("selection_reason = 0").join(own, F.col(key) == F.col("__key"))
    text = F.coalesce("selected_text", tx.strip(F.col("__text")))
    return rows.select(key, text.alias("text"), F.coalesce("selected_language", "__language").alias("language"), digests.text_revision(F.col("__text"), normalization).alias("text_revision"))


def relabelled(rows: DataFrame, identity: dict[str, Column]) -> DataFrame:
    """Copied payloads under another identity."""
    return rows.withColumns(identity)


def split_reuse(targets: DataFrame, published: DataFrame, key: str, same: list[str]) -> tuple[DataFrame, DataFrame]:
    """(copied, to do): targets with a published ok row that agrees in `same`, and the others."""
    old = published.where("status = 'ok'").groupBy(key, *same).agg(F.max(F.struct(*published.columns)).alias("__old"))
    joined = targets.join(old, [key, *same], "left")
    return joined.where("__old is not null").select("__old.*"), joined.where("__old is null").select(*targets.columns)


def chained_digest(df: DataFrame, part: str, position: str, *columns: str) -> DataFrame:
    """(part, n_rows, sha256): digest over the rows of each bounded part in order, of which `chain` makes one."""
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    items = F.sort_array(F.collect_list(F.struct(F.col(position), line.alias("__l"))))
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.array_join(F.transform(items, lambda x: x["__l"]), "\n"), 256).alias("sha256"))


def chain(parts: DataFrame, part: str) -> str:
    """One digest over the parts' digests in order; a driver-side fold over one row per part."""
    state = hashlib.sha256()
    for row in parts.select(part, "n_rows", "sha256").orderBy(part).toLocalIterator():
        state.update(f"{row[0]}\t{row[1]}\t{row[2]}\n".encode())
    return state.hexdigest()


def restored_order(copied: DataFrame, computed: DataFrame, position: str) -> DataFrame:
    """Both parts as one table in the order of their positions."""
    return copied.unionByName(computed, allowMissingColumns=True).orderBy(position)


def ordered_difference(a: DataFrame, b: DataFrame, position: str, key: str) -> DataFrame:
    """(position, left, right): places at which two ordered tables hold different keys."""
    x, y = a.select(F.col(position).alias("position"), F.col(key).alias("left")), b.select(F.col(position).alias("position"), F.col(key).alias("right"))
    return x.join(y, "position", "full").where(~F.col("left").eqNullSafe(F.col("right")))


def task_order(df: DataFrame, source: str, seconds: str) -> DataFrame:
    """`df` with start_order: longest tasks first within a source, sources in rotation."""
    turn = F.row_number().over(Window.partitionBy(source).orderBy(F.col(seconds).desc(), source))
    return df.withColumn("start_order", turn)
