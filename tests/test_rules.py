import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.dedup import candidate_audit, duplicate_groups, identity_audit, priority_candidates, reference_pool, resolve_duplicates
from corpusloom.plans.rules import BIT, Evidence, Rules, decide, revision_text, text_override
from corpusloom.plans.selection import DOCUMENT, decision_columns, select

ROW = "sample_id string, dataset_id string, audio_sha256 string, text string, language string, duration_seconds double, sample_rate int, num_frames long, metadata_json string, source_config string"


def rows(spark, *changes):
    base = dict(sample_id="s", dataset_id="alpha", audio_sha256="h", text="hello there you", language="en", duration_seconds=2.0, sample_rate=16000, num_frames=32000, metadata_json=None, source_config=None)
    return spark.createDataFrame([tuple({**base, "sample_id": f"s{k:02d}", **c}.values()) for k, c in enumerate(changes)], ROW)


def rules(**more):
    doc = dict(reason_priority=[103, 101, 1003, 1001, 2001, 2002, 1007, 1005, 1006, 3001, 3002, 7001], duration=[1, 120], supported_languages=["en", "zh"], language_aliases={"en-US": "en", "zh-CN": "zh"})
    return Rules.from_json(json.dumps({**doc, **more}))


def reasons(df, r, e=Evidence()):
    return {x.sample_id: x for x in decide(df, r, e).collect()}


def test_duration_bounds_are_inclusive(spark):
    got = reasons(rows(spark, *[{"duration_seconds": d} for d in (0.999, 1.0, 120.0, 120.001)]), rules())
    assert [got[k].reason for k in sorted(got)] == [3001, 0, 0, 3002]


def test_flags_accumulate_and_priority_decides(spark):
    df = rows(spark, {"text": " ", "duration_seconds": 0.5}).withColumn("audio_excluded", F.lit(True))
    (row,) = decide(df, rules(), Evidence(audio_exclusion=True)).collect()
    assert row.reason == 103 and row.selected_text == ""
    assert row.flags == BIT["audio_issue"] | BIT["confirmed_exclusion"] | BIT["missing_text"] | BIT["duration_policy"]


def test_a_hit_outside_the_priority_leaves_the_row_selected(spark):
    got = reasons(rows(spark, {"duration_seconds": 0.5}), rules(reason_priority=[1001]))["s00"]
    assert got.reason == 0 and got.flags == BIT["duration_policy"]


def test_language_aliases_and_missing_languages(spark):
    got = reasons(rows(spark, *[{"language": v} for v in ("en-US", "zh-CN", "zh-Hant", None, "")]), rules())
    assert [(got[k].selected_language, got[k].reason) for k in sorted(got)] == [("en", 0), ("zh", 0), ("zh-Hant", 2002), (None, 2001), ("", 2001)]


def test_density_and_markup(spark):
    r = rules(min_effective_characters=1, markup_characters="<>{}[]^\\", dense_languages=["zh"], seconds_per_character={"dense": [0.04, 1.0], "other": [0.015, 0.75]})
    cases = [{"language": "zh", "text": "好" * n, "duration_seconds": 2.0} for n in (50, 51)] + [{"language": "en", "text": "ab", "duration_seconds": d} for d in (1.5, 1.51)] + [{"text": f"plain words {c}"} for c in "<}^[\\"] + [{"text": "…!? "}]
    got = reasons(rows(spark, *cases), r)
    assert [got[k].reason for k in sorted(got)] == [0, 1005, 0, 1006, 1007, 1007, 1007, 1007, 1007, 1001]


def test_annotation_replaces_text(spark):
    asr = "struct<status string, text string, language string, language_mismatch boolean, candidate_text string, candidate_response string>"
    df = rows(spark, {}, {}, {}, {}, {})
    values = [("ok", " heard ", "English", False, None, None), ("failed", None, None, None, None, None), ("ok", "x y z", "French", False, None, None), ("ok", "a\nb c", "English", False, None, None), ("ok", "abc d", "English", False, "x", None)]
    joined = df.join(spark.createDataFrame([(f"s{k:02d}", v) for k, v in enumerate(values)], f"sample_id string, asr {asr}"), "sample_id")
    r = rules(reason_priority=[1003, 1001, 2003, 1008], asr_labels={"English": "en"})
    got = {x.sample_id: x for x in decide(joined.withColumn("text_variants", F.array()), r, Evidence(asr=True)).collect()}
    assert [got[k].reason for k in sorted(got)] == [0, 1003, 2003, 1008, 2003]
    assert got["s00"].selected_text == "heard" and got["s01"].selected_text == "" and got["s01"].flags & BIT["missing_text"]


def test_documents_are_checked():
    for bad in ({"reason_priority": [77]}, {"reason_priority": [3001, 3001]}, {"duration": [3, 1]}, {"speed": 1}, {"required_speakers": 1}):
        with pytest.raises(ValueError):
            rules(**bad)
    assert rules().version() == 2 and rules(sample_rates={"a": 1}, reason_priority=[3003]).version() == 7


def test_empty_table(spark):
    assert select(rows(spark), Rules.from_json(DOCUMENT)).collect() == []


def corpus(spark):
    cols = "sample_id string, dataset_id string, audio_sha256 string, reason int, flags int, selected_text string, selected_language string"
    data = [
        ("a0", "alpha", "h1", 0, 0, "hello", "en"), ("b0", "beta", "h1", 0, 0, "hello", "en"), ("a1", "alpha", "h2", 0, 0, "x", "en"), ("b1", "beta", "h2", 0, 0, "y", "en"),
        ("a4", "alpha", "h3", 1001, 2, "", "en"), ("b4", "beta", "h3", 0, 0, "z", "en"), ("a5", "alpha", "", 0, 0, "q", "en"), ("b5", "beta", "", 0, 0, "q", "en"), ("a6", "alpha", None, 0, 0, "q", "en"), ("a7", "alpha", "h7", 0, 0, "w", "en"),
    ]
    return spark.createDataFrame(data, cols)


def test_duplicates(spark):
    groups = {g.audio_sha256: g for g in duplicate_groups(corpus(spark), ["alpha", "beta"]).collect()}
    assert {h: (g.members, g.conflict, g.winner) for h, g in groups.items()} == {"h1": (2, False, "a0"), "h2": (2, True, "a1"), "h3": (2, False, "b4")}
    got = {r.sample_id: r for r in resolve_duplicates(corpus(spark), ["alpha", "beta"]).collect()}
    assert {k: r.reason for k, r in got.items()} == {"a0": 0, "b0": 4001, "a1": 4002, "b1": 4002, "a4": 1001, "b4": 0, "a5": 0, "b5": 0, "a6": 0, "a7": 0}
    assert got["a4"].flags == 2 | BIT["duplicate_member"] and got["a1"].flags == BIT["duplicate_member"] | BIT["duplicate_conflict"]


def test_held_out_spreads_over_the_group(spark):
    df = corpus(spark).withColumn("reason", F.when(F.col("sample_id") == "b0", 7001).otherwise(F.col("reason")))
    got = {r.sample_id: r.reason for r in resolve_duplicates(df, ["alpha", "beta"]).collect()}
    assert got["a0"] == 7001 and got["b0"] == 7001


def test_reference_pool(spark):
    df = spark.createDataFrame([("a", "u1", 4.0, 0, 0), ("a", "u2", 4.0, 0, 0), ("b", "u1", 4.0, 0, 0), ("b", "u1", 5.0, 0, 0), ("c", "u1", 4.0, 0, 0), ("c", "u2", 1.0, 0, 0), (None, "u1", 4.0, 0, 0)], "speaker string, u string, s double, reason int, flags int")
    got = {(r.speaker, r.reason) for r in reference_pool(df, "speaker", "u", "s", 3.0).collect()}
    assert got == {("a", 0), ("b", 5002), ("c", 5002), (None, 5001)}


def test_candidates(spark):
    cols = "short_id string, semantic_hash string, archive int, row_number long, priority int, error string"
    data = [("x", "h", 1, 1, 4, None), ("x", "h", 2, 1, 2, " "), ("x", "h", 0, 1, 0, None), ("x", "h", 0, 1, 0, None), ("y", "h", 1, 1, 0, "bad"), ("y", "h", 2, 1, 4, ""), ("z", "h", 1, 1, 0, None), ("z", "g", 2, 1, 0, None), ("w", "h", 1, 2, 0, "bad"), ("n", None, 1, 1, None, None)]
    found = priority_candidates(spark.createDataFrame(data, cols))
    got = {r.short_id: (r.candidates, r.conflict, r.archive, r.error) for r in found.collect()}
    assert got == {"x": (3, False, 0, None), "y": (2, False, 2, None), "z": (2, True, 1, None), "w": (1, False, 1, "bad"), "n": (1, False, 1, None)}
    audit = candidate_audit(found).first()
    assert audit.candidates == 9 and audit.selected + audit.redundant + audit.dropped == 9
    assert candidate_audit(priority_candidates(spark.createDataFrame([], cols))).first().candidates == 0


def test_identity_audit(spark):
    df = spark.createDataFrame([("a", "p"), ("a", "p"), ("b", "p"), ("b", "q"), ("c", "q")], "k string, part string")
    assert tuple(identity_audit(df, "k", "part").first()) == (5, 3, 2, 2, 1)


def test_overrides(spark):
    df = spark.createDataFrame([("a", "a"), (" a", "a"), (None, ""), (None, "b")], "raw string, chosen string")
    assert [r[0] for r in df.select(text_override(F.col("raw"), F.col("chosen"), F.lit(False))).collect()] == [None, "a", None, None]
    assert [r[0] for r in df.select(text_override(F.col("raw"), F.col("chosen"), F.lit(True))).collect()] == [None, "a", "", "b"]
    acts = spark.createDataFrame([("ok", "keep"), ("ok", "replace"), ("failed", "odd")], "status string, action string")
    assert [r[0] for r in acts.select(revision_text(F.lit("base"), F.col("status"), F.col("action"), F.lit("new"))).collect()] == ["base", "new", None]
    with pytest.raises(Exception, match="unknown action"):
        acts.select(revision_text(F.lit("base"), F.lit("ok"), F.col("action"), F.lit("new"))).collect()
    out = decision_columns(select(rows(spark, {"text": " padded text ", "language": "en-US"}), rules(source_priority=["alpha"]))).first()
    assert (out.selected_text, out.selected_language, out.selection_reason) == ("padded text", "en", 0)
