import hashlib
import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import audio, digests, frames, models, tags
from corpusloom.functions import text as tx
from corpusloom.functions.hashes import digest64, filled


def one(spark, values, schema, *columns):
    return [r[0] if len(columns) == 1 else tuple(r) for r in spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema).select(*columns).collect()]


def test_strip_takes_every_white_space(spark):
    values = ["　a b ", "\x1cx\x1f", "\t\n y \r", "", None, "z"]
    assert one(spark, values, "t string", tx.strip(F.col("t"))) == [None if v is None else v.strip() for v in values]
    assert one(spark, ["　", " a", None], "t string", tx.blank_to_null(F.col("t"))) == [None, " a", None]
    assert one(spark, [" ", "a", None], "t string", filled(F.col("t"))) == [False, True, False]


def test_letters_and_digits(spark):
    values = ["Hi, 你好！ 42…", "…!? ", "é", None, ""]
    assert one(spark, values, "t string", tx.effective_characters(F.col("t"))) == ["Hi你好42", "", "é", None, ""]


def test_hash_spellings(spark):
    h = "ab" * 32
    values = [h, h.upper(), f"sha256:{h}", f" {h}\n", "0" * 64, "", None, "xyz", h[:-1]]
    assert one(spark, values, "t string", digest64(F.col("t"))) == [h, h, h, h, None, None, None, None, None]


def test_ngram_coverage_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        units = [rng.choice("abc") for _ in range(rng.randint(0, 25))]
        n, least = rng.randint(1, 4), rng.randint(1, 3)
        best = 0
        for g in {tuple(units[i : i + n]) for i in range(len(units) - n + 1)}:
            at = [i for i in range(len(units) - n + 1) if tuple(units[i : i + n]) == g]
            if len(at) >= least:
                best = max(best, len({i + k for i in at for k in range(n)}))
        assert tx.ngram_coverage(units, n, least) == (best / len(units) if units else 0.0)


RULE = {"char_languages": ["zh"], "word_min_units": 20, "word_n": 4, "char_min_units": 30, "char_n": 10, "min_count": 3}


def test_repetition_paths(spark):
    values = [("go on now then " * 5, "en"), ("too short", "en"), ("好" * 30, "zh"), ("好" * 28, "zh"), (None, "en"), ("", None)]
    got = one(spark, values, "t string, l string", tx.repetition(F.col("t"), F.col("l"), RULE).alias("r"))
    assert [(r.path, r.coverage) for r in got] == [("word", 1.0), (None, None), ("char", 1.0), (None, None), (None, None), (None, None)]


def test_script_share(spark):
    rule = {"expected": {"ja": ["han", "kana"], "ru": ["CYRILLIC"], "default": ["latin"]}}
    values = [("plain words", "en"), ("слова here", "ru"), ("漢字かな", "ja"), ("123", "en"), (None, "en")]
    assert one(spark, values, "t string, l string", tx.script_share(F.col("t"), F.col("l"), rule)) == [1.0, 0.5, 1.0, None, None]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_within_a_limit(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abé好") for _ in range(rng.randint(0, 9)))
    cases = [(word(), word(), rng.randint(0, 6)) for _ in range(400)]
    got = one(spark, cases, "a string, b string, k int", tx.edits_within(F.col("a"), F.col("b"), F.col("k")))
    assert got == [min(distance(a, b), k + 1) for a, b, k in cases]


def test_verification(spark):
    variants = "array<struct<kind string, text string, language string>>"
    ref = [("book", "The colour of Café, it’s fine", "en")]
    values = [("the color of cafe its fine", ref), ("something else altogether", ref), ("x", []), ("x", None), (None, ref), ("x", [("book", "…", "en")])]
    got = one(spark, values, f"t string, v {variants}", tx.verify_text(F.col("t"), F.col("v"), "book", (1, 100), {"colour": "color"}))
    assert got == ["agree", "disagree", "no_reference", "no_reference", "disagree", "no_reference"]


def test_labels_and_replies(spark):
    assert one(spark, ["zh yue", "iw", "other", "en x", "<unk>", "", None], "t string", tx.spoken_language(F.col("t"))) == ["yue", "he", "und", "en", None, None, None]
    replies = ["language English<asr_text>hi", "language English<asr_text>a language French<asr_text>b", "language None<asr_text>", "<|nospeech|>", " ", "odd", None]
    got = one(spark, replies, "t string", tx.parse_transcript(F.col("t")).alias("p"))
    assert [(p and (p.language, p.text, p.valid)) for p in got] == [("English", "hi", True), ("English,French", "a \nb", True), ("", "", True), ("", "", True), ("", "", True), (None, None, False), None]
    assert one(spark, ["a b/c"], "t string", tx.quoted(F.col("t"))) == ["a%20b%2Fc"]
    assert one(spark, ["广 guang3 州 zhou1"], "t string", tx.alternate(F.col("t")), tx.alternate(F.col("t"), False)) == [("广州", "guang3 zhou1")]
    assert one(spark, ["Hi [Laughter] There!", None], "t string", tx.utterance_key(F.col("t"))) == ["hithere", None]


# Published examples of each dialect's markup and its conversion.
GOLDEN_TAGS = [
    ("angled", "孤单<crying>。", "孤单[Crying]。", ["Crying"], []), ("angled", "对象<<crying>。", "对象[Crying]。", ["Crying"], ["doubled_open_bracket"]), ("angled", "照片<laughter>>求", "照片[Laughter]求", ["Laughter"], ["doubled_close_bracket"]),
    ("angled", "沉痛crying>仿佛", "沉痛[Crying]仿佛", ["Crying"], ["missing_open_bracket"]), ("angled", "目标儿<aughter>，", "目标儿[Laughter]，", ["Laughter"], ["misspelled_laughter"]), ("angled", "嗯<laughter><但只写了", "嗯[Laughter]但只写了", ["Laughter"], ["stray_open_bracket"]),
    ("bracketed", "[throatclearing]<B>是</B>你", "[Throat-clearing]是你", ["Throat-clearing"], ["removed_region_markup"]), ("bracketed", "[sniff]母后", "[Sniff]母后", ["Sniff"], []),
    ("emoji", "So, Mom, 🌬️ how 🐖 are 👃 you? \ufe0f", "So, Mom, [Breathing] how [Dissatisfaction-hnn] are [Sniff] you?", ["Breathing", "Dissatisfaction-hnn", "Sniff"], ["orphan_variation_selector"]),
    ("dialogue", "{F Oh, } {D well, } [ They're, + {F uh, } they're ] fine <Lipsmack>. -", "Oh, well, They're, uh, they're fine [Mouth-noise].", ["Mouth-noise"], []), ("dialogue", "[ is it, + {A {F oh } goodness } it's, ] (( he )) <throat_clearing> -- ok", "is it, oh goodness it's, he [Throat-clearing] ok", ["Throat-clearing"], []),
    ("dialogue", "{D you know, that's", "you know, that's", [], ["unbalanced_brace"]), ("canonical", "[Uhm]嗯。[Question-ei]", "[Uhm]嗯。[Question-ei]", ["Uhm", "Question-ei"], []),
]


@pytest.mark.parametrize("dialect,source,text,target,repairs", GOLDEN_TAGS)
def test_tag_dialects(dialect, source, text, target, repairs):
    got = tags.CONVERTERS[dialect](source)
    assert (got[0], got[2], got[3]) == (text, target, repairs)


@pytest.mark.parametrize("dialect,source", [("bracketed", "[hiccup]你好"), ("emoji", "Hi 🙂 there"), ("dialogue", "ok <hiccup>"), ("canonical", "[Sniff]嗯"), ("angled", "好<sneeze>的"), ("angled", "a</laughter>"), ("angled", "crying>>"), ("bracketed", "<B>a"), ("dialogue", "a[b")])
def test_unknown_markup(dialect, source):
    with pytest.raises(tags.UnknownMarkup):
        tags.CONVERTERS[dialect](source)


def test_spans_are_drawn_from_all_legal_ones():
    """Every legal span, and no other, can come out."""
    for rate, n in ((8000, 9000), (11027, 11200), (22050, 26460), (16000, 12800), (44100, 50000)):
        least, most = max(-(-rate // 2), -(-n // 10)), n // 2
        steps = n * 25 // (2 * rate)
        legal = {(a, b) for a in range(steps) for b in range(a + 1, steps + 1) if least <= digests.grid_frame(b, rate) - digests.grid_frame(a, rate) <= most}
        found = {s[:2] for k in range(600) if (s := digests.reference_span(n, rate, str(k), 1))}
        assert found == legal


def test_tags(spark):
    cases = [
        ("a [Laughter] b", "canonical", "a [Laughter] b", ["Laughter"], "keep", None), ("a <laughter>  b", "angled", "a [Laughter] b", ["Laughter"], "replace", None),
        ("<<cough> x", "angled", "[Cough] x", ["Cough"], "replace", None), ("x <aughter>", "angled", "x [Laughter]", ["Laughter"], "replace", None), ("x laughter> y", "angled", "x [Laughter] y", ["Laughter"], "replace", None),
        ("<B>so [sniff]</B>", "bracketed", "so [Sniff]", ["Sniff"], "replace", None), ("<B>so", "bracketed", None, None, "skip", "unknown_markup"), ("well 🤣️ no️", "emoji", "well [Laughter] no", ["Laughter"], "replace", None),
        ("{F uh, } [ I, + I ] ((think)) -- <laughter> so, , yes", "dialogue", "uh, I, I think [Laughter] so, yes", ["Laughter"], "replace", None), ("a [Nope]", "canonical", None, None, "skip", "unknown_markup"),
        (None, "angled", None, None, "skip", "missing_text"), ("x", "klingon", None, None, "skip", "unknown_dialect"),
    ]
    got = one(spark, [(c[0], c[1]) for c in cases], "t string, d string", tags.convert_tags(F.col("t"), F.col("d")).alias("r"))
    assert [(r.text, r.target_tags, r.action, r.error) for r in got] == [c[2:] for c in cases]


def test_digests(spark):
    want = hashlib.sha256(b'["a","\xc3\xa9\\u001f",null]').hexdigest()
    assert digests.digest(["a", "é\x1f", None]) == want
    assert one(spark, [("a", "é\x1f", None)], "a string, b string, c string", digests.digest_of(F.col("a"), F.col("b"), F.col("c"))) == [want]
    assert one(spark, [("a", "b")], "a string, b string", digests.digest_strings(F.col("a"), F.col("b"))) == [digests.digest(["a", "b"])]
    with pytest.raises(ValueError):
        digests.digest([float("nan")])
    row = F.struct("a", "b", F.lit("r").alias("record_revision"))
    assert one(spark, [("x", None)], "a string, b string", digests.record_revision(row)) == [digests.digest({"a": "x", "b": None})]
    assert digests.array_digest(np.array([1, 2], "<i2"), "t") != digests.array_digest(np.array([1, 2], "<i4"), "t")


@pytest.mark.parametrize("rate", [8000, 11027, 16000, 22050, 24000, 44100, 48000])
def test_reference_spans(rate):
    for seconds in (0.8, 1.0, 1.1, 2.5, 7.77, 60, 300):
        n = int(rate * seconds)
        found = digests.reference_span(n, rate, "id", 7)
        assert found == digests.reference_span(n, rate, "id", 7)
        least, most = max(-(-rate // 2), -(-n // 10)), n // 2
        steps = n * 25 // (2 * rate)
        possible = any(least <= digests.grid_frame(b, rate) - digests.grid_frame(a, rate) <= most for a in range(min(26, steps)) for b in range(a + 1, steps + 1))
        assert (found is not None) == possible
        if found:
            a, b, x, y = found
            assert 0 <= a < b <= steps and (x, y) == (digests.grid_frame(a, rate), digests.grid_frame(b, rate)) and least <= y - x <= most


def test_spans_in_columns(spark):
    values = [("i", 48000, 16000), ("i", 0, 16000), (None, 48000, 16000), ("i", None, 16000), ("i", 48000, 11027)]
    got = one(spark, values, "i string, n long, r int", digests.reference_spans(F.col("n"), F.col("r"), F.col("i"), 7).alias("s"), digests.reference_spans(F.col("n"), F.col("r"), F.col("i"), 7, True).alias("p"))
    assert got[0][0].start_step is not None and got[0][1].start_frame == 0 and got[0][1].end_frame == got[0][0].end_frame - got[0][0].start_frame
    assert [g[0].start_step for g in got[1:4]] == [None] * 3 and got[4][1].start_step is None
    spans = one(spark, [("a", 100), ("b", 15), ("c", None)], "i string, n long", digests.patch_span(F.col("i"), F.col("n")).alias("s"))
    h = hashlib.sha256(b"codec-grid-reference-v1:a").digest()
    length = 4 + int.from_bytes(h[:8]) % 9
    assert (spans[0].start, spans[0].end - spans[0].start) == (int.from_bytes(h[8:16]) % (25 - length + 1), length) and spans[1] is None and spans[2] is None


def test_frames(spark):
    assert one(spark, [(16001, 16000)], "n long, r int", frames.resampled_length(F.col("n"), F.col("r"), 24000), frames.codec_frames(F.col("n")), frames.ceil_div(F.col("n"), 2)) == [(24002, 9, 8001)]
    assert one(spark, [1, 2, 480, 481, -480], "d long", frames.within_tolerance(F.col("d"), F.lit(24000))) == [True, True, True, False, True]
    assert one(spark, [0, 1, 48000, 48001, 2_880_000, 2_880_001], "n long", frames.batch_frames(F.col("n"))) == [None, 48000, 48000, 96000, 2_880_000, None]
    assert one(spark, [48000, 96000, 2_880_000], "n long", frames.batch_size(F.col("n"))) == [64, 64, 4]
    assert one(spark, [[1.0, 2.0], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [1.0], None], "v array<float>", frames.valid_vector(F.col("v"), 2)) == [True, False, False, False, False, False]
    assert one(spark, [[1, 2, 3, 4, 5], [], None], "v array<int>", frames.lower_percentile(F.col("v"), 0.9)) == [4, None, None]
    assert one(spark, [([[1, 2], [3, 0]], 2), ([[1, 2]], 2), ([[1]], 1), ([[1, 9]], 1), (None, 1)], "c array<array<int>>, n int", frames.valid_codes(F.col("c"), F.col("n"), 2, 5)) == [True, False, False, False, False]
    assert one(spark, [([1.0], [1.1]), ([1.0], [1.3]), ([1.0], []), (None, None)], "a array<double>, b array<double>", frames.equivalent(F.col("a"), F.col("b"), 0.1, 0.1)) == [True, False, False, False]
    times = one(spark, ["2026-01-02T03:04:05+08:00", "2026-01-02T03:04:05Z", "2026-01-02T03:04:05", "soon", None], "t string", F.date_format(frames.utc_time(F.col("t")), "yyyy-MM-dd HH:mm:ss"))
    assert times == ["2026-01-01 19:04:05", "2026-01-02 03:04:05", None, None, None]


def test_json_scores(spark):
    values = ['{"a":{"s":3.5}}', '{"a":{"s":2}}', '{"a":{"s":true}}', '{"a":{"s":"3"}}', '{"a":{}}', '{"a":{"s":null}}', "{broken", "", None]
    got = one(spark, values, "m string", frames.json_score(F.col("m"), "$.a.s").alias("s"))
    assert [(s.score, s.status, s.error_code) for s in got] == [(3.5, "ok", None), (2.0, "ok", None), (None, "failed", "invalid_score"), (None, "failed", "invalid_score"), (None, "skipped", "missing_score"), (None, "skipped", "missing_score"), (None, "failed", "invalid_json"), (None, "skipped", "missing_score"), (None, "skipped", "missing_score")]


def wav(values, rate=1000, channels=1):
    data = (np.asarray(values) * 32768).clip(-32768, 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * 2 * channels, 2 * channels, 16) + b"data" + struct.pack("<I", len(data)) + data


def test_audio(spark):
    t = np.arange(2000) / 1000
    tone = np.concatenate([np.zeros(100), 0.5 * np.sin(2 * np.pi * 100 * t[:800]), np.zeros(50), 0.5 * np.sin(2 * np.pi * 100 * t[:800]), np.zeros(60)])
    data = [("tone", wav(tone)), ("none", None), ("junk", b"junk"), ("empty", wav([])), ("flac", b"fLaC1234")]
    df = spark.createDataFrame(data, "k string, b binary")
    got = {r.k: r for r in audio.audio_statistics(df, "k", "b").collect()}
    assert {k: r.error_code for k, r in got.items()} == {"tone": None, "none": "missing_audio", "junk": "unsupported_container", "empty": "empty", "flac": "unsupported_container"}
    r = got["tone"]
    assert (r.n_frames, r.sample_rate) == (1810, 1000) and abs(r.peak - 0.5) < 0.03 and abs(r.lead_silence - 0.1) < 1e-9 and 0.04 <= r.trail_silence <= 0.07 and r.longest_zero_run >= 99
    assert 90 <= r.bandwidth_hz <= 140 and 0.03 <= r.longest_inner_quiet <= 0.06
    assert [x[0] for x in df.select(audio.container(F.col("b"))).collect()] == ["wav", None, "unknown", "wav", "flac"]
    assert audio.lower_quantile(np.array([5, 1, 4, 2, 3]), 0.9) == 4
    assert audio.mask_runs(np.array([1, 1, 0, 1], bool)) == [(0, 2), (3, 4)]
    inner = b"RIFF" + struct.pack("<I", 20) + b"WAVEdata" + struct.pack("<I", 8) + b"caff1234"
    assert audio.embedded_caf(inner) == 20 and audio.embedded_caf(wav([0.1])) is None


def test_models(spark):
    def make():
        def predict(values):
            if "bad" in values:
                raise RuntimeError
            return [float(len(v)) for v in values]

        return predict

    df = spark.createDataFrame([("a", "xx"), ("b", None), ("c", "bad"), ("d", "")], "k string, v string")
    got = {r.k: (r.status, r.error_code, r.result) for r in models.annotate(df, "k", "v", make, "double").collect()}
    assert got == {"a": ("ok", None, 2.0), "b": ("skipped", "missing_input", None), "c": ("failed", "RuntimeError", None), "d": ("ok", None, 0.0)}
    assert json.loads(json.dumps(models.hashed_embedding(2)()(["x"])))[0] == models.hashed_embedding(2)()(["x"])[0]


def test_headers_of_containers():
    flac = b"fLaC" + bytes([0, 0, 0, 34]) + bytes(10) + (44100 << 44 | 1 << 41 | 15 << 36 | 1234).to_bytes(8) + bytes(16)
    assert audio.header(flac) == (44100, 2, 1234)
    frame = bytes([0xFF, 0xFB, 0x90, 0xC0]) + bytes(413)  # version 1, layer 3, 128 kbit/s, 44.1 kHz, mono: 417 bytes
    assert audio.header(frame * 3) == (44100, 1, 3 * 1152)
    tag = b"ID3" + bytes([4, 0, 0, 0, 0, 0, 5]) + bytes(5)
    info = bytearray(frame)
    info[21:25] = b"Info"
    info[28] = 1
    info[33:37] = b"LAME"
    info[33 + 21 : 33 + 24] = (576 << 12 | 1000).to_bytes(3)
    assert audio.header(tag + bytes(info) + frame * 3) == (44100, 1, 3 * 1152 - 1576)
    low = bytes([0xFF, 0xF3, 0x40, 0xC0]) + bytes(140)  # version 2, 32 kbit/s, 22.05 kHz
    size = 72 * 32000 // 22050
    assert audio.header((low + bytes(200))[:size] * 4) == (22050, 1, 4 * 576)
    page = lambda granule, body: b"OggS" + bytes(2) + granule.to_bytes(8, "little") + bytes(12) + bytes([1, len(body)]) + body
    vorbis = b"\x01vorbis" + bytes(4) + bytes([2]) + (48000).to_bytes(4, "little") + bytes(14)
    opus = b"OpusHead" + bytes([1, 1]) + (312).to_bytes(2, "little") + bytes(7)
    assert audio.header(page(0, vorbis) + page(960, b"x")) == (48000, 2, 960) and audio.header(page(0, opus) + page(1272, b"x")) == (48000, 1, 960)
    for bad in (b"", b"fLaC", b"RIFF", b"OggS", b"ID3", b"xyz", frame[:2]):
        with pytest.raises(audio.BadAudio):
            audio.header(bad)
