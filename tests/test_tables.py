import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import aggregates as agg
from corpusloom.operators import joins, sets
from corpusloom.operators import windows as win
from corpusloom.sources import base, files, sinks
from corpusloom.sources.registry import SOURCES, source
from corpusloom.streaming import events as st
from test_functions import wav


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_verified_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", 9, "x"), ("b", 8, "y"), ("b", 8, "y"), ("z", 7, "w"), (None, 1, "n")], "k string, v int, matched string")
    got = {r.k: r for r in joins.verified_join(left, right, "k").collect()}
    assert got["a"].matched.v == 9 and got["a"].problem is None and got["b"].problem == "duplicate" and got[None].matched is None
    exact = rows(joins.verified_join(left, right, "k", "exact").select("k", "problem"))
    assert exact == sorted([("a", None), ("b", "duplicate"), (None, "missing"), (None, "unexpected"), (None, "unexpected")], key=str)
    with pytest.raises(Exception, match="join problem"):
        joins.verified_join(left, right, "k", strict=True).collect()
    assert joins.verified_join(left.limit(0), right, "k").collect() == []


def test_latest_ok(spark):
    data = [("a", "failed", 3, None), ("a", "ok", 1, "x"), ("a", "ok", 2, "y"), ("b", "failed", 1, None), ("b", "failed", 1, None), (None, "ok", 1, "z")]
    got = rows(joins.latest_ok(spark.createDataFrame(data, "k string, status string, finished_at int, text string"), "k"))
    assert got == [("a", "ok", 2, "y"), ("b", "failed", 1, None)]


def test_feature_merge(spark):
    a = spark.createDataFrame([("t1", "ok", "h1", 1), ("t2", "failed", "h2", 2), ("t3", "ok", "h3", 3)], "id string, status string, hash string, x int").withColumn("error_code", F.when(F.col("status") != "ok", "e1"))
    b = spark.createDataFrame([("t3", "ok", "hX", 4), ("t1", "ok", "h1", 5), ("t2", None, "h2", 6)], "id string, status string, hash string, x int").withColumn("error_code", F.lit(None).cast("string"))
    merged = {r.id: r for r in joins.merge_features({"codec": a, "speaker": b}, "id", ["hash"]).collect()}
    assert merged["t1"].mismatched == [] and merged["t3"].mismatched == ["hash"] and merged["t1"].speaker_x == 5
    assert rows(joins.merge_accounting({"codec": a, "speaker": b}, "id")) == [("any", "excluded", 1), ("codec", "e1", 1), ("speaker", "none", 1)]


def test_shared_keys(spark):
    df = spark.createDataFrame([("p", "a"), ("q", "a"), ("q", "a"), ("r", "a"), ("p", "b"), ("q", "b"), (None, "b"), ("p", None)], "g string, k string")
    assert rows(joins.shared_keys(df, "g", "k")) == [("p", "q", 2), ("p", "r", 1), ("q", "r", 1)]


def test_topk_is_stable_and_skew_safe(spark):
    df = spark.createDataFrame([("hot", f"s{i:04d}") for i in range(500)] + [("x", "s1"), (None, "n1")], "speaker string, id string")
    a = rows(win.topk_by_hash(df, "speaker", "id", 3, "seed"))
    assert a == rows(win.topk_by_hash(df.repartition(7), "speaker", "id", 3, "seed")) and len(a) == 5
    import hashlib

    want = sorted((f"s{i:04d}" for i in range(500)), key=lambda s: (hashlib.sha256(f"seed:{s}".encode()).hexdigest(), s))[:3]
    assert [r[1] for r in sorted((r for r in a if r[0] == "hot"), key=lambda r: r[2])] == want


def test_window_shapes(spark):
    spans = spark.createDataFrame([("p", 0, 5), ("p", 5, 9), ("p", 10, 12)], "f string, a int, b int")
    assert rows(win.islands(spans, "f", "a", "b")) == [("p", 1, 0, 9, 2), ("p", 2, 10, 12, 1)]
    mask = spark.createDataFrame([("k", i, v) for i, v in enumerate([1, 1, 0, 1])], "k string, pos int, v int")
    assert rows(win.mask_runs(mask, "k", "pos", F.col("v") == 1)) == [("k", 0, 2), ("k", 3, 4)]
    assert rows(win.running_offsets(mask, "v")) == [(0, 1, 0), (1, 3, 1)]
    assert win.threshold_tasks(spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "p string, n int"), "p", "n", 5) == [("a", 3, 0), ("b", 3, 0), ("c", 1, 1)]
    made = win.budget_batches(spark.createDataFrame([(f"s{i}", n) for i, n in enumerate([5, 5, 5, 9, None])], "id string, n int"), "n", "id", 12).collect()
    assert sorted((r.length, r.batch_no) for r in made) == [(5, 0), (5, 0), (5, 1), (9, 2)]
    energy = rows(win.window_energy(mask.withColumn("v", F.col("v").cast("double")), "k", "pos", "v", 3))
    assert energy == [("k", 0, 3, 2 / 3), ("k", 1, 1, 1.0)]


def test_rotation_takes_every_row(spark):
    from corpusloom import queries

    data = [("hot", f"{k * 7919 % 5000:04d}") for k in range(2000)] + [("b", "01"), ("b", None), ("b", "é"), ("b", "0"), (None, "7"), (None, "3")]
    made = win.interleaved(spark.createDataFrame(data, "s string, id string").repartition(7), "s", "id")
    want = [(s, i, n) for group in ("hot", "b", None) for n, (s, i) in enumerate(sorted((d for d in data if d[0] == group), key=lambda d: (d[1] or "").encode()), 1)]
    assert rows(made) == sorted(want, key=str)
    numbers = spark.createDataFrame([("a", n) for n in (30, 4, 17, 8)], "s string, n int")
    assert rows(win.interleaved(numbers, "s", "n")) == [("a", 17, 3), ("a", 30, 4), ("a", 4, 1), ("a", 8, 2)]
    folder = "/root/testdata/sf0.001"
    every = queries.QUERIES["source_rotation"](spark, folder)
    assert every.count() == spark.read.parquet(f"{folder}/selection.parquet").select("sample_id").distinct().count() > 42


def test_summaries(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.3), ("a", 0.9), ("a", None), ("b", float("nan"))], "g string, v double")
    bins = agg.histogram(df, "v", 0.5, "g")
    assert rows(bins) == [("a", 0, 2), ("a", 1, 1)]
    assert rows(agg.histogram_summary(bins, 0.5, [0.5, 0.95], "g")) == [("a", 3, (2 * 0.25 + 0.75) / 3, 0.0, 0.5)]
    audit = spark.createDataFrame([("x", 1), (" ", None), (None, 2), ("　", 3)], "t string, n int")
    assert rows(agg.null_audit(audit, ["t", "n"])) == [("n", 4, 1, 0), ("t", 4, 1, 2)]
    assert rows(agg.null_audit(audit.limit(0), ["t"])) == [("t", 0, 0, 0)]
    status = spark.createDataFrame([("d", "ok"), ("d", "failed"), ("d", None)], "d string, s string")
    assert rows(agg.coverage(status, "s", "d")) == [("d", 3, 1, 1, 0, 1, True)]
    gates = spark.createDataFrame([("bad", "failed")] * 40 + [("fine", "ok")], "d string, s string")
    assert rows(agg.gate(gates, "s", 32, "d")) == [("bad", 40, 0, 40, True), ("fine", 1, 1, 0, False)]
    texts = spark.createDataFrame([("abcd", "abxd"), ("ab", None), ("", "x")], "r string, h string")
    assert agg.error_rate(texts, F.col("r"), F.col("h")).first()[:3] == (2, 4, 2)
    shards = spark.createDataFrame([("d", 0, 4), ("d", 2, 4)], "d string, n int, total int")
    assert rows(agg.shard_gaps(shards, "n", "total", "d")) == [("d", 1), ("d", 3)]
    ids = spark.createDataFrame([("b",), ("a",)], "v string")
    assert agg.sorted_set_sha256(ids, "v") == agg.sorted_set_sha256(ids.orderBy("v"), "v")
    with pytest.raises(ValueError):
        agg.sorted_set_sha256(ids.union(ids), "v")


def test_sets(spark):
    a, b = spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], "k string, v int"), spark.createDataFrame([("x", 1), ("z", 2)], "k string, v int")
    assert rows(sets.set_difference(a, b, "k")) == [("y", "missing"), ("z", "unexpected")]
    assert rows(sets.bag_difference(a, b)) == [("x", 1, 1), ("y", None, 1), ("z", 2, -1)]
    assert sets.bag_difference(a, a.repartition(3)).collect() == []
    assert rows(sets.inherited(a, b, "k").select("k")) == [("x",), ("y",), ("z",)]
    assert rows(sets.covered([a.select("k"), b.select("k")], spark.createDataFrame([("x",), ("y",), ("w",)], "k string"), "k")) == [("w", 0, "missing"), ("x", 3, "repeated"), ("z", 1, "unexpected")]


def tar_bytes(members, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_archives_pair_in_any_order(spark, tmp_path):
    meta = lambda i, **k: json.dumps({"id": i, "text": f"text {i}", "language": "en", "speaker": "p1", **k}).encode()
    members = [("x/a.json", meta("a")), ("x/b.mp3", wav([0.1] * 10)), ("x/a.mp3", wav([0.2] * 20)), ("x/c.mp3", b"1"), ("x/b.json", meta("b")), ("x/d.json", meta("d")), ("../evil.mp3", b"2")]
    (tmp_path / "one.tar").write_bytes(tar_bytes(members))
    (tmp_path / "two.tar").write_bytes(b"no archive")
    found = files.archive_members(spark, str(tmp_path), "tar", "*.tar")
    assert {(r.member, r.problem) for r in found.where("problem is not null").collect()} == {("../evil.mp3", "unsafe_path"), ("", "broken_archive:ReadError")}
    pairs = files.paired(found, {"audio": ".mp3", "meta": ".json"})
    assert rows(pairs.select("stem", "problem")) == [("x/a", None), ("x/b", None), ("x/c", "missing_meta"), ("x/d", "missing_audio")]
    got = {r.source_key: r for r in source("emilia").read(spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b"} and got["a"].text == "text a" and got["a"].speaker_id == "emilia:p1" and (got["a"].num_frames, got["a"].sample_rate) == (20, 1000)
    assert rows(source("emilia").problems(spark, str(tmp_path)).select("member", "problem")) == [("x/c", "missing_meta"), ("x/d", "missing_audio")]


def flac(rate, channels, frames):
    """Header of a FLAC file."""
    return b"fLaC" + bytes([128, 0, 0, 34]) + bytes(10) + (rate << 44 | (channels - 1) << 41 | 15 << 36 | frames).to_bytes(8) + bytes(16)


def test_manifests_and_lists(spark, tmp_path):
    for name in ("h", "m", "w", "s", "f"):
        (tmp_path / name).mkdir()
    said = {"audio_filepath": "audio/92_clean/8_book/x_01.flac", "text": "hi", "text_no_preprocessing": "Hi.", "text_normalized": "hi"}
    (tmp_path / "h/hifi.tar.gz").write_bytes(tar_bytes([("hi_fi/audio/92_clean/8_book/x_01.flac", flac(44100, 1, 441)), ("hi_fi/92_manifest_clean_dev.json", (json.dumps(said) + "\n").encode()), ("hi_fi/audio/92_clean/8_book/alone.flac", flac(44100, 1, 1))], "w:gz"))
    (r,) = source("hifitts").read(spark, str(tmp_path / "h")).collect()
    assert (r.source_key, r.text, r.speaker_id, r.group_id, r.num_frames, [v.kind for v in r.text_variants]) == (said["audio_filepath"], "Hi.", "hifitts:92", "hifitts:book:8_book", 441, ["source_preprocessed", "source_normalized"])
    assert json.loads(r.metadata_json)["original_split"] == "dev" and json.loads(r.metadata_json)["upstream"]["text"] == "hi"
    assert rows(source("hifitts").problems(spark, str(tmp_path / "h")).select("member", "problem")) == [("hi_fi/audio/92_clean/8_book/alone.flac", "missing_manifest")]

    (tmp_path / "m/german").mkdir()
    (tmp_path / "m/german/dev-0001.tar.gz").write_bytes(tar_bytes([("1_2_3.metadata.json", json.dumps({"id": "1_2_3", "speaker_id": 1, "transcript": "ja"}).encode()), ("1_2_3.flac", flac(24000, 1, 24)), ("9_9_9.flac", flac(24000, 1, 24)), ("9_9_9.metadata.json", b'{"id": "8"}')], "w:gz"))
    (r,) = source("mls_sidon").read(spark, str(tmp_path / "m"), config="german").collect()
    assert (r.source_key, r.text, r.language, r.speaker_id, r.source_config, r.sample_rate) == ("german:1_2_3", "ja", "de", "mls_sidon:german:1", "german", 24000) and json.loads(r.metadata_json)["original_split"] == "valid"

    for folder in ("Premium", "filelists", "DNSMOS_P808Scores"):
        (tmp_path / "w" / folder).mkdir()
    key, prefix = "X1_S00001", "WenetSpeech4TTS_Premium_0"
    (tmp_path / f"w/Premium/{prefix}.tar.gz").write_bytes(tar_bytes([(f"{prefix}/wavs/{key}.wav", wav([0.1] * 8)), (f"{prefix}/txts/{key}.txt", f"{key}\t你好\n1,2".encode())], "w:gz"))
    (tmp_path / "w/filelists/Basic_filelist.lst").write_text(f"{key}\t../Premium/{prefix}/wavs/{key}.wav\t../Premium/{prefix}/txts/{key}.txt\nX2\ta/X2.wav\tb\n")
    (tmp_path / "w/DNSMOS_P808Scores/Basic_DNSMOS.lst").write_text(f"{key} 3.25\nX2 2\n")
    (r,) = source("wenetspeech4tts").read(spark, str(tmp_path / "w"), config="Premium").collect()
    assert (r.source_key, r.text, r.recording_id, r.num_frames, json.loads(r.metadata_json)["upstream_dnsmos_p808"]) == (key, "你好", "wenetspeech4tts:X1", 8, 3.25)
    assert ("X2", "missing_audio") in rows(source("wenetspeech4tts").problems(spark, str(tmp_path / "w")).select("member", "problem"))

    clip = "SMIIP_NV_Up/MIC-0001/高兴/MIC-0001_0001"
    with zipfile.ZipFile(tmp_path / "s/SMIIP_NV.zip", "w") as z:
        z.writestr(f"{clip}.wav", wav([0.1] * 6))
        z.writestr("SMIIP_NV_Up/MIC-0001/高兴/annotation.txt", "MIC-0001_0001.wav\t<crying/>好</crying>\t[0, 1]\nMIC-0001_0001.wav\t好<crying>\t[0.5, 1]\n")
    with zipfile.ZipFile(tmp_path / "s/SMIIP_NV_SPK_finetune.zip", "w") as z:
        z.writestr("SMIIP_NV_SPK_finetune/spk_test/MIC-0001_0001.wav", wav([0.1] * 6))
    (r,) = source("smiip_nv").read(spark, str(tmp_path / "s")).collect()
    meta = json.loads(r.metadata_json)
    assert (r.source_key, r.text, r.speaker_id, [v.kind for v in r.text_variants]) == ("MIC-0001_0001", "好<crying>", "smiip_nv:MIC-0001", ["source_transcript_paralinguistic_span"])
    assert (meta["emotion"], meta["original_split_group"], meta["annotations"][0]["intervals"]) == ("happy", "test", [{"start": 0.5, "end": 1.0}])

    for folder in ("resolved_json", "audio/emilia/EN"):
        (tmp_path / "f" / folder).mkdir(parents=True)
    (tmp_path / "f/audio/emilia/EN/a.wav").write_bytes(wav([0.1] * 9))
    (tmp_path / "f/resolved_json/emilia_en_ds.json").write_text(json.dumps([{"wav_path": "audio/emilia/EN/a.wav", "text": "Hi", "instruction": "calm"}, {"wav_path": "audio/../x.wav", "text": "no", "instruction": None}, {"wav_path": "audio/emilia/EN/b.wav", "text": " ", "instruction": None}]))
    (r,) = source("flexivoice").read(spark, str(tmp_path / "f"), config="emilia_en_ds").collect()
    assert (r.source_key, r.text, r.language, r.num_frames, r.group_id) == ("emilia_en_ds:0", "Hi", "en", 9, "flexivoice:audio:audio/emilia/EN/a.wav")
    assert [p for _, p in rows(source("flexivoice").problems(spark, str(tmp_path / "f")).select("member", "problem"))] == ["unsafe_path", "missing_audio"]


def test_table_in_an_archive(spark, tmp_path):
    lines = "LJ1-1|Hello, Dr. X|Hello, Doctor X\nLJ1-2|Gone|Gone\nLJ1-3||\n"
    members = [("LJ/metadata.csv", lines.encode()), ("LJ/wavs/LJ1-1.wav", wav([0.1] * 5)), ("LJ/wavs/LJ1-3.wav", wav([0.1] * 7))]
    (tmp_path / "LJ.tar.bz2").write_bytes(tar_bytes(members, "w:bz2"))
    lj = source("ljspeech")
    got = {r.source_key: r for r in lj.read(spark, str(tmp_path)).collect()}
    assert set(got) == {"LJ1-1", "LJ1-3"} and got["LJ1-1"].text_variants[0].text == "Hello, Doctor X" and got["LJ1-1"].group_id == "ljspeech:LJ1"
    assert got["LJ1-3"].text is None and got["LJ1-3"].text_kind is None
    assert rows(lj.problems(spark, str(tmp_path)).select("member", "problem")) == [("LJ/wavs/LJ1-2.wav", "missing_audio")]
    made = lj.read(spark, str(tmp_path))
    assert made.schema == base.SCHEMA or [f.name for f in made.schema] == [f.name for f in base.SCHEMA]
    assert [r.v for r in made.select(base.violations(made).alias("v")).collect()] == [[], []]


def test_zip_names_and_parquet_sources(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "v.zip", "w") as z:
        for mic in (1, 2):
            z.writestr(f"VCTK/wav48_silence_trimmed/p225/p225_001_mic{mic}.flac", flac(48000, 1, 96000))
        z.writestr("VCTK/wav48_silence_trimmed/p315/p315_007_mic1.flac", flac(48000, 1, 48000))
        z.writestr("VCTK/txt/p225/p225_001.txt", "Please call Stella.\n")
        z.writestr("VCTK/speaker-info.txt", "ID AGE GENDER\np225 23 F English\n")
    got = {r.source_key: r for r in source("vctk").read(spark, str(tmp_path)).collect()}
    assert {k: (r.text, r.speaker_id, r.group_id, r.sample_rate, r.num_frames) for k, r in got.items()} == {
        "p225_001_mic1": ("Please call Stella.", "vctk:p225", "vctk:p225_001", 48000, 96000), "p225_001_mic2": ("Please call Stella.", "vctk:p225", "vctk:p225_001", 48000, 96000), "p315_007_mic1": (None, "vctk:p315", "vctk:p315_007", 48000, 48000),
    }
    assert json.loads(json.loads(got["p225_001_mic2"].metadata_json)["upstream_speaker_info"]) == ["23", "F", "English"]
    with pytest.raises(ValueError):
        source("vctk").read(spark, str(tmp_path), config="mic9")
    with pytest.raises(ValueError):
        source("unheard_of")
    shard = str(tmp_path / "pq")
    voice = "audio struct<bytes binary, path string>, language string, speaker string, transcription string"
    spark.createDataFrame([((wav([0.1] * 3), "a/b.wav"), "English(US)", "Jo Ann", "Hi"), ((wav([0.2] * 3), None), "Klingon", " ", " ")], voice).coalesce(1).write.parquet(shard)
    got = sorted(source("genshin_voice").read(spark, shard).collect(), key=lambda r: r.source_key)
    assert [(g.language, g.speaker_id, g.text) for g in got] == [("en", "genshin_voice:en:Jo%20Ann", "Hi"), (None, None, None)]
    excluded = files.parquet_rows(spark, shard).where("_row = 0").select("_path", "_row")
    assert files.parquet_rows(spark, shard, excluded=excluded).count() == 1
    assert len(SOURCES) == 23


def test_lists_and_names(spark, tmp_path):
    path = tmp_path / "list.tsv"
    path.write_text("sample_id\treason\na\t1\nb\t2\n")
    assert files.pinned_list(spark, str(path), rows=2).count() == 2
    for bad in ({"rows": 3}, {"sha256": "0" * 64}):
        with pytest.raises(ValueError):
            files.pinned_list(spark, str(path), **bad)
    df = spark.createDataFrame([("[1.5, 2],[3,4]",), ("",), ("[2,1]",), ("[1,2",), ("x",)], "v string")
    assert [[(i.start, i.end) for i in r[0]] if r[0] is not None else None for r in df.select(files.interval_list(F.col("v"))).collect()] == [[(1.5, 2.0), (3.0, 4.0)], [], None, None, None]
    names = spark.createDataFrame([("x/train-00003-of-00010.parquet",), ("other.parquet",)], "p string").select(files.shard_of(F.col("p")).alias("s")).select("s.*").collect()
    assert [tuple(n) for n in names] == [("train", 3, 10), (None, None, None)]
    array = tmp_path / "cfg.json"
    array.write_text('[{"a": 1}, {"a": 2}]')
    assert [(r._row, r.a) for r in files.json_array(spark, str(array), "a int").collect()] == [(0, 1), (1, 2)]


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(f"s{i}", i, None if i else "x") for i in range(20)], "id string, n int, t string")
    root = str(tmp_path)
    one, two = sinks.publish(df, root, "t", "id"), sinks.publish(df.limit(5), root, "t", "id")
    assert (one.manifest["version"], two.manifest["version"]) == (1, 2) and one.read(spark).count() == 20
    assert sinks.open_snapshot(spark, root, "t").manifest["rows"] == 5 and sinks.open_snapshot(spark, root, "t", 1).manifest == one.manifest
    assert sinks.uncommitted(spark, root) == []
    with pytest.raises(ValueError):
        sinks.Snapshot(one.path, {**one.manifest, "rows": 7}).read(spark)
    tasks = df.withColumn("task", F.col("n") % 4)
    assert sinks.remaining_tasks(spark, f"{root}/out", tasks, "task").count() == 20
    sinks.write_tasks(tasks.where("task < 2"), f"{root}/out", "task")
    sinks.write_tasks(tasks.where("task = 1").withColumn("t", F.lit("again")), f"{root}/out", "task")
    assert {r.task for r in sinks.remaining_tasks(spark, f"{root}/out", tasks, "task").collect()} == {2, 3}
    assert spark.read.parquet(f"{root}/out").where("t = 'again'").count() == 5 and spark.read.parquet(f"{root}/out").count() == 10
    fails = spark.createDataFrame([("a", "e", "s"), ("a", "e", "s"), ("b", "e", "s")], "target string, code string, stage string")
    sinks.journal(fails.limit(2), f"{root}/journal")
    assert sinks.journal(fails, f"{root}/journal").count() == 2


def test_sessions_open_at_the_end(spark):
    from corpusloom import queries

    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    want = events.groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", "w.start", "w.end", "n")
    assert rows(queries.QUERIES["stream_sessions"](spark, folder)) == rows(want)
    assert want.where(F.col("end") > events.agg(F.max("ts")).first()[0]).count() > 0


def test_streams(spark, tmp_path):
    path = str(tmp_path / "ev")
    data = [(i, f"u{i % 2}", f"2026-01-01 {h:02d}:{m:02d}:00") for i, (h, m) in enumerate([(0, 0), (0, 5), (0, 10), (0, 15), (3, 0), (9, 0)])]
    df = spark.createDataFrame(data + data[:2], "id int, user string, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(path)
    stream = st.stream_table(spark, path)
    assert st.run_available(st.once(stream, "ts", "1 day", "id"), "once").count() == 6
    counts = {(str(r.window_start), r.n) for r in st.run_available(st.tumbling_counts(stream, "ts", "1 hour", "1 minute"), "counts").collect()}
    assert ("2026-01-01 00:00:00", 6) in counts
    sessions = rows(st.run_available(st.sessions(stream, "ts", "30 minutes", "1 minute", "user"), "sessions").select("user", "n"))
    assert ("u0", 3) in sessions and ("u1", 3) in sessions
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("one\ntwo\n")
    assert rows(st.run_available(st.tail_lines(spark, str(logs)).select("line"), "tail")) == [("one",), ("two",)]
    stalled = {r.user for r in st.run_available(st.stalls(stream, "user", "ts", 3600, "1 minute"), "stalls").collect()}
    assert "u0" in stalled
    log = spark.createDataFrame([("a", "ok"), ("a", "failed"), ("b", "failed"), ("b", None)], "k string, status string")
    assert rows(st.unfinished(log, "k")) == [("b", 2)]
    assert rows(st.missing_from(log.select("k").distinct(), log.where("status = 'ok'"), "k")) == [("b",)]


def test_selection_is_published_as_a_whole(spark, tmp_path):
    from corpusloom.plans import publication
    from corpusloom.plans import selection as plan
    from corpusloom.plans.rules import Rules

    rules = Rules(reason_priority=[1001, 3001, 3002], duration=(1.0, 30.0))
    data = [(f"s{k}", "d", "h" * 63 + str(k // 2), "text", "en", 2.0 if k else 0.5, "{}", 24000) for k in range(6)]
    base_rows = spark.createDataFrame(data, "sample_id string, dataset_id string, audio_sha256 string, text string, language string, duration_seconds double, metadata_json string, sample_rate int")
    selected, pinned = plan.select(base_rows, rules), sinks.pin(base_rows, "sample_id")
    first = publication.publish_selection(selected, str(tmp_path), "x", rules, pinned)
    again = publication.publish_selection(selected, str(tmp_path), "x", rules, pinned)
    assert first["parts"]["decisions"]["fingerprint"] == again["parts"]["decisions"]["fingerprint"] and again["parts"]["decisions"]["version"] == 2
    assert again["coverage"] == {"d": {"rows": 6, "selected": 3, "seconds": 6.0}} and sinks.pin(base_rows.repartition(5), "sample_id") == pinned
    opened = publication.open_selection(spark, str(tmp_path), "x")
    assert set(opened) == set(publication.PARTS) and opened["duplicates"].read(spark).count() == 6 and opened["exclusions"].read(spark).count() == 0
    with pytest.raises(ValueError):
        publication.publish_selection(selected, str(tmp_path), "x", rules, {**pinned, "rows": 7})


def test_exclusions_hold_for_their_text(spark):
    from corpusloom.functions.digests import digest
    from corpusloom.plans import selection as plan

    base_rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "sample_id string, text string")
    revision = lambda t: digest(["selected-text-v1", t, "strip"])
    schema = "sample_id string, reason int, text_revision string"
    listed = spark.createDataFrame([("a", 105, None), ("a", 1002, revision("x")), ("c", 105, None), ("zz", 105, revision("q"))], schema)
    got = {r.sample_id: sorted(r.exclusion_reasons) for r in plan.with_exclusions(base_rows, listed).collect()}
    assert got == {"a": [105, 1002], "b": [], "c": [105]}
    for stale in ([("a", 105, revision("other"))], [("a", 105, revision("x")), ("a", 1002, revision("other"))]):
        with pytest.raises(Exception, match="another text"):
            plan.with_exclusions(base_rows, spark.createDataFrame(stale, schema)).collect()


def test_batches_runs_and_styles(spark):
    files_ = spark.createDataFrame([("c", f"p{k}", n) for k, n in enumerate([5, 5, 1, 20, 3, None])] + [("d", "q", 1)], "config string, path string, n int")
    assert rows(win.byte_batches(files_, "config", "path", "n", 10).select("config", "path", "batch_no")) == [("c", "p0", 0), ("c", "p1", 0), ("c", "p2", 1), ("c", "p3", 2), ("c", "p4", 3), ("c", "p5", 3), ("d", "q", 0)]
    from corpusloom.functions import digests, frames, paths

    runs = [("20260102T030405-x", "2026-01-02T03:04:06+08:00", None), ("20260102T030405", "2026-01-02T03:04:04+08:00", "finished_before_start"), ("20260102T030405", "2026-01-01T20:04:06Z", "other_offset"), ("run", "2026-01-02T03:04:06+08:00", "unreadable_run_id"), ("20260102T030405", "2026-01-02", "unreadable_time"), (None, None, "unreadable_run_id")]
    assert [r[0] for r in spark.createDataFrame(runs, "a string, b string, c string").select(frames.run_problem(F.col("a"), F.col("b"))).collect()] == [r[2] for r in runs]
    styles = [("ears", "audio/ears/p001/emo_anger_freeform.wav", "emotion: anger"), ("ears", "audio/ears/p001/rainbow_01_whisper.wav", "whisper"), ("expresso", "audio/expresso/read/ex01/happy/base/a.wav", "happy"), ("expresso", "audio/expresso/conversational/ex01-ex02/laughing/a.wav", "laughing"), ("l2", "a/b/c.wav", None), (None, None, None)]
    assert [r[0] for r in spark.createDataFrame(styles, "a string, b string, c string").select(paths.recording_style(F.col("a"), F.col("b"))).collect()] == [r[2] for r in styles]
    import hashlib

    (r,) = spark.createDataFrame([("happy", 'say "hi"\n', None)], "a string, b string, c string").select(digests.generation_unit(F.col("a"), F.col("b")).alias("k"), digests.generation_unit(F.col("a"), F.col("c")).alias("n")).collect()
    assert r.k == hashlib.sha256(json.dumps(["happy", 'say "hi"\n'], ensure_ascii=False).encode()).hexdigest() and r.n == hashlib.sha256(b'["happy", null]').hexdigest()
    terms = spark.createDataFrame([("a C++ voice", True), ("aCb", False), (None, False), ("voice.", False), ("x.y", True), ("xzy", False)], "t string, w boolean")
    assert all(r[0] == r[1] for r in terms.select(paths.mentions(F.col("t"), ["C++", "x.y"]), "w").collect())
