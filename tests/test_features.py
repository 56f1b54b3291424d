import json

from pyspark.sql import functions as F

from corpusloom.functions import paths
from corpusloom.operators import features as ft
from corpusloom.sources import carriers
from test_functions import wav


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_payload_checks(spark):
    df = spark.createDataFrame([("a", "ok", None, [1.0, 2.0]), ("b", "failed", "e", None), ("c", "ok", "e", None), ("d", "failed", None, [0.0, 0.0])], "k string, status string, error_code string, v array<float>")
    got = rows(df.select("k", ft.violations(*ft.payload_violations("v"))))
    assert got == [("a", []), ("b", []), ("c", ["payload_by_status", "error_by_status"]), ("d", ["payload_by_status", "error_by_status"])]
    assert rows(df.select("k", ft.vector_violations("v", 2))) == [("a", []), ("b", ["size", "finite", "valid"]), ("c", ["size", "finite", "valid"]), ("d", ["valid"])]


def test_codec_tolerance(spark):
    data = [(d, 16000, 160000, 240000 + d, [[1] * 16] * (-(-(240000 + d) // 1920))) for d in (0, 1, 2, 156, 312, 480, 481, -481)]
    df = spark.createDataFrame(data, "d int, rate int, native long, enc long, codes array<array<int>>")
    bad = {r.d: r.v for r in df.select("d", ft.codec_violations("codes", "rate", "native", "enc").alias("v")).collect()}
    assert {d for d, v in bad.items() if v} == {481, -481}


def test_references(spark):
    targets = spark.createDataFrame([("t1", "h1"), ("t2", "h2"), ("t3", "h3"), ("t4", "h4"), (None, "h")], "target_id string, audio_sha256 string")
    codec = spark.createDataFrame([("t1", "h1", 48000, 16000), ("t2", "hX", 48000, 16000), ("t4", "h4", 100, 16000)], "target_id string, audio_sha256 string, end_frame long, native_sample_rate int")
    got = {r.target_id: r for r in ft.attach_references(targets, codec, "target_id", 7, ["audio_sha256"]).collect()}
    assert got["t1"].problem is None and got["t1"].reference.end_frame > 0 and got["t2"].problem == "differs:audio_sha256" and got["t3"].problem == got[None].problem == "missing" and got["t4"].reference is None


def test_metadata_reuse_and_order(spark):
    decisions = spark.createDataFrame([("a", 0, None, None), ("b", 0, "new", "fr"), ("c", 1001, None, None)], "sample_id string, selection_reason int, selected_text string, selected_language string")
    base = spark.createDataFrame([("a", " old ", "en"), ("b", "x", "en"), ("c", "y", "en")], "sample_id string, text string, language string")
    assert [r[:3] for r in rows(ft.selected_metadata(decisions, base))] == [("a", "old", "en"), ("b", "new", "fr")]
    targets = spark.createDataFrame([("t1", "h1"), ("t2", "h2"), ("t3", "h3")], "id string, hash string")
    old = spark.createDataFrame([("t1", "h1", "ok", 5), ("t2", "hX", "ok", 6), ("t3", "h3", "failed", 7)], "id string, hash string, status string, v int")
    copied, todo = ft.split_reuse(targets, old, "id", ["hash"])
    assert [r.id for r in copied.collect()] == ["t1"] and rows(todo) == [("t2", "h2"), ("t3", "h3")]
    pos = spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "c", "q")], "pos int, v string, part string")
    parts = ft.chained_digest(pos, "part", "pos", "v")
    assert ft.chain(parts, "part") == ft.chain(ft.chained_digest(pos.repartition(3), "part", "pos", "v"), "part")
    swapped = pos.withColumn("v", F.when(F.col("pos") == 2, "z").otherwise(F.col("v")))
    assert rows(ft.ordered_difference(pos, swapped, "pos", "v")) == [(2, "b", "z")]
    assert [r.pos for r in ft.restored_order(pos.where("pos = 2"), pos.where("pos != 2"), "pos").collect()] == [1, 2, 3]


def test_carriers(spark):
    piece = lambda i, a, b, **k: {"id": i, "rel_start_samples": a, "rel_end_samples": b, "text": "hi", "language": "en", "speaker": "s", **k}
    meta = lambda kind, shorts, **k: json.dumps({"type": kind, "id": "c", "recording_id": "r", "frames": 100, "sample_rate": 16000, "short": shorts, **k})
    data = [("m1", meta("long", [piece("x", 0, 50), piece("y", -1, 5), piece("z", 90, 101)])), ("m2", meta("short", [piece("c", 0, 100)])), ("m3", meta("short", [piece("c", 0, 99)])), ("m4", meta("short", [piece("other", 0, 100)])), ("m5", meta("video", [])), ("m6", meta("dialogue", None)), ("m7", "{broken"), ("m8", None), ("m9", meta("long", [piece("w", 0, 5, text=" hi ")], frames=0))]
    got = {(r.member, r.short_id): (r.priority, r.error, r.carrier_error) for r in carriers.candidates(spark.createDataFrame(data, "member string, metadata_json string")).collect()}
    assert got == {
        ("m1", "x"): (2, None, None), ("m1", "y"): (2, "invalid_short_bounds", None), ("m1", "z"): (2, "invalid_short_bounds", None), ("m2", "c"): (0, None, None), ("m3", "c"): (0, "standalone_short_not_full_carrier", None),
        ("m4", None): (0, None, "standalone_mismatch"), ("m5", None): (None, None, "unknown_carrier_type"), ("m6", None): (4, None, None), ("m7", None): (None, None, "unknown_carrier_type"), ("m8", None): (None, None, "unknown_carrier_type"), ("m9", None): (2, None, "invalid_timeline"),
    }


def test_crops_and_indexes(spark):
    audio = spark.createDataFrame([("m1", wav([0.1, 0.2, 0.3, 0.4])), ("m2", None)], "member string, audio binary")
    wanted = spark.createDataFrame([("m1", "a", 1, 3), ("m1", "b", 3, 9), ("m2", "c", 0, 1), ("m3", "d", 0, 1)], "member string, short_id string, start long, end long")
    cut = carriers.crops(audio, wanted)
    got = {r.short_id: (r.audio, r.error) for r in cut.collect()}
    assert bytes(got["a"][0]) == wav([0.2, 0.3]) and got["b"][1] == "bounds_outside_audio" and got["c"][1] == got["d"][1] == "missing_carrier"
    assert rows(carriers.reject_budget(cut.withColumn("archive", F.lit("x")))) == [("x", 4, 3, False)]
    members = spark.createDataFrame([("x", "a", 5), ("x", "b", 6), ("x", "d", 1)], "archive string, member string, n_bytes long")
    index = spark.createDataFrame([("x", "a", 5), ("x", "b", 7), ("x", "c", 1)], "archive string, member string, n_bytes long")
    assert rows(carriers.index_differences(members, index)) == [("x", "b", "size_differs"), ("x", "c", "only_in_index"), ("x", "d", "not_in_index")]


def test_paths(spark):
    cases = [
        ("genshin", "r/d/g/zh/Paimon/1.wav", "genshin:zh:Paimon"), ("expresso", "a/b/c/d/e/ex01-ex02/x_channel1_1.wav", "expresso:ex01"), ("expresso", "a/b/c/d/e/ex01-ex02/x_channel2_1.wav", "expresso:ex02"), ("expresso", "a/b/c/d/e/ex03/x.wav", "expresso:ex03"),
        ("debatts", "a/b_c_d.wav", "debatts:b_c"), ("emotion", "a/b/CREMA-D/1001_X.wav", "CREMA-D:1001"), ("emotion", "a/b/IEMOCAP/Ses03/Ses03M_impro05b_M029.wav", "IEMOCAP:Ses03-M"), ("emotion", "a/b/MELD/x.wav", None), ("other", "a", None), (None, None, None),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "s string, p string")
    assert [r[0] for r in df.select(paths.speaker_of(F.col("s"), F.col("p"))).collect()] == [c[2] for c in cases]
    texts = spark.createDataFrame([("teh cat",), ("fine",), (" ",), (None,)], "t string")
    assert [tuple(r[0]) for r in texts.select(paths.repaired(F.col("t"), {"teh": "the"})).collect()] == [("the cat", "replace"), ("fine", "keep"), (None, "skip"), (None, "skip")]
    assert [r[0] for r in texts.select(paths.mentions(F.col("t"), ["CAT", "dog"])).collect()] == [True, False, False, False]
