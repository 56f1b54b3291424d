"""Exact duplicates across a corpus, competing candidates of one id, and reference pools.

Groups are reduced by partial aggregation to one small row before anything is joined back,
so a group may hold any share of the rows; no group is collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.rules import BIT, present

#: Rank of a source that the priority list doesn't name: after all that it names.
UNRANKED = 1 << 20


def source_rank(priority: list[str]) -> Column:
    rank = F.lit(UNRANKED)
    for k, name in reversed(list(enumerate(priority))):
        rank = F.when(F.col("dataset_id") == name, k).otherwise(rank)
    return rank


def duplicate_groups(decided: DataFrame, priority: list[str], annotated: Column | None = None) -> DataFrame:
    """One row per audio hash with several members: size, conflict, held-out and the winner.

    decided: (sample_id, dataset_id, audio_sha256, reason, selected_text, selected_language).
    Members with reason 0 are eligible; those with annotated text are preferred.  A group
    conflicts if its preferred members differ in text or its eligible ones in language.  Null
    and empty hashes form no group.  min and max stand for "more than one value", which keeps
    the aggregate small.
    """
    eligible = F.col("reason") == 0
    preferred = eligible & (annotated if annotated is not None else F.lit(False))
    rows = decided.where(F.coalesce("audio_sha256", F.lit("")) != "").withColumns({"__e": eligible, "__p": preferred, "__text": F.sha2(F.coalesce("selected_text", F.lit("")), 256), "__lang": F.coalesce("selected_language", F.lit(""))})
    spread = lambda c, when: (F.min(F.when(F.col(when), F.col(c))), F.max(F.when(F.col(when), F.col(c))))
    (p0, p1), (e0, e1), (l0, l1) = spread("__text", "__p"), spread("__text", "__e"), spread("__lang", "__e")
    best = lambda when: F.min(F.when(F.col(when), F.struct(source_rank(priority).alias("rank"), F.col("sample_id").alias("sample_id"))))
    grouped = rows.groupBy("audio_sha256").agg(
        F.count(F.lit(1)).alias("members"), F.count_if("__e").alias("eligible"), p0.alias("p0"), p1.alias("p1"), e0.alias("e0"), e1.alias("e1"), l0.alias("l0"), l1.alias("l1"),
        best("__p").alias("bp"), best("__e").alias("be"), F.max(F.col("reason") == 7001).alias("held"),
    )
    texts_differ = F.when(F.col("p0").isNotNull(), F.col("p0") != F.col("p1")).otherwise(present(F.col("e0") != F.col("e1")))
    return grouped.where("members > 1").select(
        "audio_sha256", "members", "eligible", (texts_differ | present(F.col("l0") != F.col("l1"))).alias("conflict"), F.col("held"), F.coalesce(F.col("bp.sample_id"), F.col("be.sample_id")).alias("winner")
    )


def resolve_duplicates(decided: DataFrame, priority: list[str], annotated: Column | None = None, keep_variants: bool = False) -> DataFrame:
    """`decided` with reason and flags after duplicates: held out, conflicting and lower-ranked members drop out."""
    groups = duplicate_groups(decided, priority, annotated).withColumnRenamed("audio_sha256", "__hash")
    # rows without a hash get keys of their own, so that they don't meet in one task
    key = F.when(F.coalesce("audio_sha256", F.lit("")) != "", F.col("audio_sha256")).otherwise(F.concat(F.lit("none:"), "sample_id"))
    rows = decided.join(groups, key == F.col("__hash"), "left")
    member = F.col("members").isNotNull()
    flags = F.col("flags").bitwiseOR(F.when(member, BIT["duplicate_member"]).otherwise(0)).bitwiseOR(F.when(present(F.col("conflict")), BIT["duplicate_conflict"]).otherwise(0))
    lost = F.lit(not keep_variants) & (F.col("winner") != F.col("sample_id"))
    reason = F.when(~member | (F.col("reason") != 0), F.col("reason")).when(F.col("held"), 7001).when(F.col("conflict"), 4002).when(lost, 4001).otherwise(0)
    return rows.withColumns({"flags": flags.bitwiseOR(F.when(member & (F.col("reason") == 0) & present(F.col("held")), BIT["held_out"]).otherwise(0)), "reason": reason}).drop("__hash", "eligible", "held")


def reference_pool(resolved: DataFrame, speaker: str, utterance: str, seconds: str, least: float, held_out: list[str] = (), salts: int = 16) -> DataFrame:
    """Selected rows without a speaker get 5001, those of a speaker without two different long utterances 5002, the speaker as a whole; held-out speakers 7001.

    Rows meet only the speakers that fail, and by speaker and salt, so that one with a large
    share of the rows is spread over many tasks; rows without a speaker meet none.
    """
    known = present(F.trim(F.col(speaker)) != "")
    long = (F.col("reason") == 0) & (F.col(seconds) >= least)
    pools = resolved.where(known).groupBy(F.col(speaker).alias("__speaker")).agg(F.min(F.when(long, F.col(utterance))).alias("__u0"), F.max(F.when(long, F.col(utterance))).alias("__u1"))
    failed = pools.where(~present(F.col("__u0") != F.col("__u1"))).select("__speaker", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__part"))
    salt = F.when(known & (F.col("reason") == 0), F.pmod(F.xxhash64(*[c for c in ("sample_id", utterance) if c in resolved.columns]), F.lit(salts)).cast("int"))
    rows = resolved.withColumn("__salt", salt).join(failed, (F.col(speaker) == F.col("__speaker")) & (F.col("__salt") == F.col("__part")), "left")
    code = F.when(F.col("reason") != 0, None).when(~known, 5001).when(F.col(speaker).isin(list(held_out)), 7001).when(F.col("__speaker").isNotNull(), 5002)
    flag = F.when(code == 7001, BIT["held_out"]).when(code.isNotNull(), BIT["reference_policy"]).otherwise(0)
    return rows.withColumn("__code", code).withColumns({"flags": F.col("flags").bitwiseOR(flag), "reason": F.coalesce("__code", "reason")}).drop("__speaker", "__part", "__salt", "__code")


def priority_candidates(candidates: DataFrame, key: str = "short_id") -> DataFrame:
    """One row per id: candidates, valid ones, conflict, the winner and its error.

    A valid candidate beats an invalid one, then the smaller priority (null last), then the
    earlier arrival (archive, row number).  Repeated deliveries of a candidate count once.
    """
    error = F.when(F.trim("error") != "", F.trim("error"))
    once = candidates.groupBy(key, "archive", "row_number").agg(F.min("semantic_hash").alias("h0"), F.max("semantic_hash").alias("h1"), F.min("priority").alias("priority"), F.max(error).alias("error"))
    order = F.struct(F.col("error").isNotNull().alias("bad"), F.coalesce(F.col("priority").cast("int"), F.lit(UNRANKED)).alias("priority"), "archive", "row_number", "error")
    return once.groupBy(key).agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("error").isNull()).alias("valid"), present(F.min("h0") != F.max("h1")).alias("conflict"), F.min(order).alias("w")).select(
        key, "candidates", "valid", "conflict", F.col("w.archive").alias("archive"), F.col("w.row_number").alias("row_number"), F.col("w.error").alias("error")
    )


def candidate_audit(resolved: DataFrame) -> DataFrame:
    """One row of totals that must add up: selected + redundant + conflicting + invalid = candidates."""
    fine = (F.col("error").isNull()) & ~F.col("conflict")
    return resolved.agg(
        F.coalesce(F.sum("candidates"), F.lit(0)).alias("candidates"), F.count(F.lit(1)).alias("ids"), F.count_if(F.col("candidates") > 1).alias("repeated_ids"), F.count_if("conflict").alias("conflicts"),
        F.count_if(~F.col("conflict") & F.col("error").isNotNull()).alias("invalid"), F.count_if(fine).alias("selected"), F.coalesce(F.sum(F.when(fine, F.col("candidates") - 1)), F.lit(0)).alias("redundant"),
        F.coalesce(F.sum(F.when(~fine, F.col("candidates"))), F.lit(0)).alias("dropped"),
    )


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n) of the keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def identity_audit(df: DataFrame, key: str, within: str) -> DataFrame:
    """One row: rows, distinct keys, repeated keys, extra rows, and keys repeated within one part."""
    by_part = df.groupBy(key, within).agg(F.count(F.lit(1)).alias("n"))
    by_key = by_part.groupBy(key).agg(F.sum("n").alias("n"), F.max(F.col("n") > 1).alias("inside"))
    return by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"), F.count_if("inside").alias("repeated_inside"))
