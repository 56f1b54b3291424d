import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import script_of
from corpusloom.llm import languages, leakage, repetition, survivors, truncation

SAMPLES = {
    "en": ["the people of the village opened the heavy door before anyone could answer", "when did she lend you the blue notebook near the bakery", "after the storm they repaired the old radio under the bridge", "because nobody had asked about the broken lamp"],
    "fr": ["les gens du village ouvraient la lourde porte avant que personne ne réponde", "quand vous a-t-elle prêté le cahier bleu près de la boulangerie", "après la tempête ils réparaient la vieille radio sous le pont", "parce que personne n'avait demandé la lampe cassée"],
    "de": ["die leute des dorfes öffneten die schwere tür bevor jemand antworten konnte", "wann hat sie dir das blaue heft bei der bäckerei geliehen", "nach dem sturm reparierten sie das alte radio unter der brücke", "weil niemand nach der kaputten lampe gefragt hatte"],
    "ru": ["жители деревни открыли тяжёлую дверь прежде чем кто-то ответил", "когда она одолжила тебе синюю тетрадь рядом с пекарней", "после бури они чинили старое радио под мостом", "потому что никто не спросил про сломанную лампу"],
    "ja": ["村の人々は重い扉を開けました", "青いノートをいつ借りましたか", "嵐のあとで古いラジオを直しました", "だれも聞かなかったからです"],
}


@pytest.fixture(scope="module")
def tables(spark):
    samples = spark.createDataFrame([(k, t) for k, ts in SAMPLES.items() for t in ts * 3], "language string, text string")
    aliases = spark.createDataFrame([("en", "en"), ("English", "en"), ("en_gb", "en"), ("fr", "fr"), ("de", "de"), ("ru", "ru"), ("ja", "ja")], "alias string, language string")
    return samples, aliases


EN = "The people of the village repaired the old radio before the storm. When did they open the heavy door near the bridge?"
FR = "Les gens du village réparaient la vieille radio avant la tempête. Quand ouvraient ils la lourde porte près du pont ?"


def test_labels_and_mixed_texts(spark, tables):
    data = [
        ("ok", EN, "en-GB"), ("wrong", FR, " EN "), ("missing", FR, "xx"), ("null", EN, None), ("mixed", f"{EN} {FR} {EN}", "en"), ("short", "The door.", None), ("blank", "  ", None), ("none", None, "en"), ("empty", "", None), ("marks", "…!? 123", None),
        ("aside", f"{EN} (Жители деревни открыли тяжёлую дверь.)", "en"), ("ja", "村の人々は古いラジオを直しました。", "en"), ("upper", EN.upper(), "fr"), ("lines", f"{EN}\n{'после бури они открыли тяжёлую дверь'}", "en"), ("long", f"{EN} " * 200, "en"),
    ]
    df = spark.createDataFrame([*data, data[1]], "sample_id string, text string, language string").withColumn("segment_no", F.lit("x"))
    found = languages.identify(df, "sample_id", "text", "language", *tables)
    got = sorted(tuple(r) for r in languages.label_issues(found, "sample_id").collect())
    assert got == sorted([("wrong", "wrong", 0, "fr"), ("missing", "missing", 0, "fr"), ("null", "missing", 0, "en"), ("mixed", "mixed", 1, "en"), ("mixed", "mixed", 2, "fr"), ("mixed", "mixed", 3, "en"), ("ja", "wrong", 0, "ja"), ("upper", "wrong", 0, "en"), ("lines", "mixed", 1, "en"), ("lines", "mixed", 2, "ru")])
    assert all(0 < r.confidence <= 1 for r in found.collect())
    assert found.where("sample_id in ('none', 'blank', 'empty', 'marks')").collect() == []
    assert languages.identify(df.limit(0), "sample_id", "text", "language", *tables).collect() == []


@pytest.mark.parametrize("times", [1, 2, 6])
def test_mixed_lines_without_marks_of_any_length(tables, times):
    """A change inside a sentence depends on what it saves, not on how long the sentence is."""
    samples, _ = tables
    known = languages.Identifier(languages.bounded(samples, ["language", "text"], 1000))
    mixed = " ".join([SAMPLES["en"][0]] * times + [SAMPLES["de"][0]] * times)
    assert [r[0] for r in known.runs([mixed])[0]] == ["en", "de"]
    assert [r[0] for r in known.runs([" ".join(SAMPLES["en"] * times)])[0]] == ["en"]


def test_stretches_that_save_most():
    rng = np.random.default_rng(5)
    sizes = np.array([1, 7, 30, 2, 60])
    bits, opens = rng.normal(5, 2, (sizes.sum(), 3)), np.cumsum(sizes) - sizes
    best = np.add.reduceat(bits, opens).argmin(1)
    got = languages._gain_inside(bits, opens, best)
    for k, (a, n) in enumerate(zip(opens, sizes)):
        rows = bits[a : a + n]
        want = max(max(0, (rows[i:j, best[k]] - rows[i:j, l]).sum()) for l in range(3) for i in range(n) for j in range(i + 1, n + 1))
        assert abs(got[k] - want) < 1e-6
    raw = "ab cd、ef 中文".encode()
    assert languages._block_starts(np.frombuffer(raw, np.uint8), np.array([0])).tolist() == [0, 3, 5, 8, 11, 14]


def test_loops_and_long_runs(spark, tables):
    import time

    assert languages.without_loops("ab ab ab cd  cd x") == "ab cd  cd x" and languages.without_loops("hahahahaha no") == "haha no"
    for text in ("\u6751\u306e\u4eba" * 40_000, "a" * 100_000, "x " * 50_000):
        began = time.perf_counter()
        languages.without_loops(text)
        assert time.perf_counter() - began < 1
    many = spark.range(6).selectExpr("'x' as alias", "'en' as language")
    assert len(languages.bounded(many, ["alias", "language"], 6)) == 6
    with pytest.raises(ValueError):
        languages.bounded(many, ["alias", "language"], 5)


def test_code_lengths_are_exact():
    """Costs looked up by window equal a walk through the context tree."""
    import math
    from collections import Counter, defaultdict

    ppm = languages.Ppm([("x", "abracadabra"), ("y", "banana bandana")], 3)
    trees = {}
    for name, text in (("x", "abracadabra"), ("y", "banana bandana")):
        tree = trees[name] = defaultdict(Counter)
        raw = b"\n" * 3 + text.encode()
        for i in range(3, len(raw)):
            for o in range(4):
                tree[raw[i - o : i]][raw[i]] += 1

    def bits(tree, context, symbol):
        total = 0.0
        for o in range(3, -1, -1):
            seen = tree.get(context[3 - o :])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                if symbol in seen:
                    return total + math.log2((n + kinds) / seen[symbol])
                total += math.log2((n + kinds) / kinds)
        return total + 8

    text = b"bananabra zz"
    table, window, _ = ppm.bits([text])
    padded = b"\n" * 3 + text
    for k in range(len(text)):
        for j, name in enumerate(ppm.names):
            assert abs(table[window[k], j] - bits(trees[name], padded[k : k + 3], text[k])) < 1e-3


def test_held_out_accuracy():
    train = [(k, t) for k, ts in SAMPLES.items() for t in ts[:3]]
    test = [(k, ts[3]) for k, ts in SAMPLES.items()]
    found = languages.Identifier(train).runs([t for _, t in test])
    assert [f[0][0] for f in found] == [k for k, _ in test]


def brute_share(units, run):
    covered, seen = set(), set()
    for k in range(len(units) - run + 1):
        gram = tuple(units[k : k + run])
        if gram in seen:
            covered |= set(range(k, k + run))
        seen.add(gram)
    return len(covered) / len(units) if units else 0.0


def test_repeated_share(spark):
    rng = random.Random(2)
    for _ in range(300):
        units = [rng.choice("abcd") for _ in range(rng.randint(0, 40))]
        assert repetition.repeated_share(units, 3) == brute_share(units, 3) == repetition.repeated_share("".join(units), 3)
    words = "one two three four five six seven eight nine ten "
    data = [("twice", words * 2), ("once", words * 1), ("three", words * 3), ("zh", "一二三四五六七八九十" * 5), ("few", "ab " * 10), ("none", None), ("blank", " \n"), ("case", (words + words.upper()) * 1), ("marks", words + "One, two; three - four: five! SIX seven? eight… nine “ten”"), ("long", "word " * 50000)]
    df = spark.createDataFrame(data, "sample_id string, text string").withColumn("unit", F.lit(1))
    got = {r.sample_id: (r.unit, None if r.repeated_share is None else round(r.repeated_share, 3)) for r in repetition.repetition(df, "sample_id", "text").collect()}
    assert got == {"twice": ("word", 0.5), "once": (None, None), "three": ("word", 0.667), "zh": ("char", 0.8), "few": (None, None), "none": (None, None), "blank": (None, None), "case": ("word", 0.5), "marks": ("word", 0.5), "long": ("word", 1.0)} | {"once": got["once"]}
    assert repetition.repetition(df.limit(0), "sample_id", "text").collect() == []


def test_divergence(spark, tables):
    df = spark.createDataFrame([("a", " ".join(SAMPLES["fr"])), ("b", None), ("c", "x"), ("d", "dog " * 40)], "sample_id string, text string")
    got = {r.sample_id: r for r in repetition.divergence(df, "sample_id", "text", tables[0]).collect()}
    assert got["a"].language == "fr" and got["a"].js_words < 0.3 < got["d"].js_words and got["b"].language is None and got["c"].js_chars is None
    assert repetition.js_distance([1, 0], [0, 1]) == 1.0 and repetition.js_distance([1, 2], [2, 4]) == 0.0 and repetition.js_distance([], []) == 1.0


def test_truncation(spark):
    full = "they opened the heavy door behind the mill and repaired the radio near the pond"
    corpus = [(f"c{k}", "ok", "src", f"Before noon {full}{' again' * (k // 5)}. The old radio was repaired near the pond.") for k in range(15)]
    data = corpus + [
        ("cut", "ok", "src", "Before noon they opened the heavy door beh"), ("bare", "ok", "src", f"Before noon {full}"), ("trail", "ok", "src", "Before noon they opened the heavy…"), ("noline", "ok", "src", "before noon they opened the heavy door behind the m"),
        ("failed", "failed", "src", None), ("null", "ok", "src", None), ("blank", "ok", "src", " "), ("broken", "ok", "src", "Before noon they opened the hea�"), ("cut", "ok", "src", "Before noon they opened the heavy door beh"), ("comma", "ok", "src", "Before noon they opened the heavy door,"),
    ] + [(f"lim{k}", "ok", "lim", (f"take {k} " + f"{full} " * 3)[:60]) for k in range(8)]
    asr = spark.createDataFrame(data, "sample_id string, status string, dataset_id string, text string").withColumn("line", F.lit("clash"))
    lines = [(s, f"Before noon {full}.") for s in ("cut", "bare", "broken", "comma")] + [("trail", "Before noon they opened the heavy…")] + [(d[0], d[3]) for d in corpus]
    base = spark.createDataFrame([*lines, ("cut", None), ("null", None)], "sample_id string, text string")
    judged = truncation.truncated(asr, base)
    assert {r.sample_id for r in judged.where("cut").collect()} == {"cut", "noline", "broken", "comma", *(f"lim{k}" for k in range(8))}
    rates = {r.dataset_id: r for r in truncation.truncation_rates(judged).collect()}
    assert rates["lim"].cut_samples == rates["lim"].at_limit_samples == 8 and rates["src"].samples == 15 + 6
    assert truncation.truncated(asr.limit(0), base).collect() == []


def test_the_method_decides_and_the_line_only_confirms(spark):
    full = "they opened the heavy door behind the mill and repaired the radio near the pond"
    data = [(f"c{k}", "ok", "src", f"Before noon {full}.") for k in range(5)] + [("cut", "ok", "src", "Before noon they opened the heavy door beh"), ("word", "ok", "src", "Before noon they opened"), ("same", "ok", "src", "Then they opened the hea"), ("alone", "ok", "src", "Then they opened the hea")]
    asr = spark.createDataFrame(data, "sample_id string, status string, dataset_id string, text string")
    lines = spark.createDataFrame([("cut", f"Before noon {full}."), ("word", f"Before noon {full}."), ("same", "Then they opened the hea")], "sample_id string, text string")
    got = {r.sample_id: (r.line, r.suspect, r.cut) for r in truncation.truncated(asr, lines).collect() if not r.sample_id.startswith("c") or r.sample_id == "cut"}
    assert got == {"cut": ("short", True, True), "word": (None, False, False), "same": ("same", True, False), "alone": ("none", True, True)}


def test_a_word_is_unknown_after_the_word_before_it(spark):
    data = [("a", "ok", "s", "They sat by the frozen pond. The p was silent. They sold the pond and the pan.")] * 2 + [("b", "ok", "s", "They walked to the frozen p"), ("c", "ok", "s", "They sold the p")]
    asr = spark.createDataFrame(data, "sample_id string, status string, dataset_id string, text string")
    got = {r.sample_id: r.unknown_prefix for r in truncation.truncated(asr, spark.createDataFrame([], "sample_id string, text string")).collect()}
    assert got == {"a": False, "b": True, "c": False}


def test_dots_tell_nothing_of_a_word():
    found = truncation.count_words(["They sang for the choi... And for the choir. They sang on."])
    assert ("", "choi") not in found and found["", "choir"] == [0, 1] and found["", "sang"] == [2, 0]


def test_last_words_are_whole():
    long = "wordstart" + "q" * 200
    assert truncation.last_words(f"So they said {long}") == (("", long), ("said", long))
    assert truncation.last_words("one") == (("", "one"), ("", "one")) and truncation.last_words("") == (("", ""), ("", "")) and truncation.last_words("村の人々は") == (("", "の人々は"), ("", "々は"))
    assert truncation.closed("He said “so.”" + '"' * 100) and not truncation.closed("so" + '"' * 100) and not truncation.closed("")


def test_keys_of_prefixes_are_those_of_words():
    rng = random.Random(3)
    tokens = ["".join(rng.choice("abc\u4e00\U0001f600") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    befores = [rng.choice(["", "a", "ab"]) for _ in tokens]
    keys = truncation.Keys(befores, tokens)
    which = np.array([k for k, t in enumerate(tokens) for _ in t])
    length = np.array([n for t in tokens for n in range(1, len(t) + 1)])
    made = truncation.Keys([befores[k] for k in which], [tokens[k][:n] for k, n in zip(which, length)]).whole()
    assert keys.of(which, length).tolist() == made.tolist()
    assert len({*keys.whole().tolist()}) == len({*zip(befores, tokens)})


def test_field_limits_beside_longer_texts(spark):
    line = "the old radio was repaired near the pond by the people of the village"
    data = [(f"l{k}", "ok", "src", f"{k} {line}"[:40] + "...") for k in range(6)] + [("longer", "ok", "src", f"{line} {line}.")] + [("trails", "ok", "src", f"{line}..."), ("nothing", "ok", "src", "the old radio was...")]
    judged = truncation.truncated(spark.createDataFrame(data, "sample_id string, status string, dataset_id string, text string"), spark.createDataFrame([("trails", f"{line}...")], "sample_id string, text string"))
    assert {r.sample_id for r in judged.where("cut").collect()} == {f"l{k}" for k in range(6)}


def test_long_words_take_linear_time(spark):
    import time

    word, began = "ab" * 50_000, time.perf_counter()
    truncation.count_words([word + " x"])
    keys = truncation.Keys([""], [word])
    keys.of(np.zeros(len(word) - 1, np.int64), np.arange(1, len(word)))
    truncation.last_words(word)
    assert time.perf_counter() - began < 1


def test_stated_splits(spark):
    cases = [
        ('{"original_split_group": "dev"}', "evaluation"), ('{"original_split": "Train-360"}', "training"), ('{"upstream": {"split": "held_out"}}', "evaluation"), ('{"original_split": null, "upstream": {"wav_path": "wavs/test/0001.wav"}}', "evaluation"),
        ('{"upstream": {"wav_path": "wavs/train_s/1.wav", "take": "test take"}}', "training"), ('{"upstream": {"take": "eval of mic"}}', None), ('{"upstream": {"upstream_id"', None), ("", None), ("null", None), (None, None), ('{"original_split": "spk_test"}', "evaluation"), ("[1]", None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "m string")
    assert [r[0] for r in df.select(leakage.side_of(leakage.stated_split(F.col("m")))).collect()] == [c[1] for c in cases]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_segments_outnumber_edits():
    size = leakage._size_of(np.arange(6000))
    for t in [*range(leakage.MIN_DENSE, 1500), *range(1500, 6000, 37)]:
        for e in (t - t // 10, t, int(t / 0.9), int(t / 0.9) + 1):
            if abs(t - e) * leakage.CHARS_PER_EDIT <= max(t, e):
                assert t // size[t] > max(t, e) // leakage.CHARS_PER_EDIT


def test_sketches_bound_the_edits(spark):
    """Whatever is edited before or after a segment, the bound never exceeds the edits."""
    rng = random.Random(4)
    a = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz\u4e00\u4e01") for _ in range(rng.choice([60, 200, 900]))) for _ in range(80)]
    edits = [rng.randint(0, 40) for _ in a]
    b = [mutated(rng, x, k, "abcxyz") for x, k in zip(a, edits)]
    both = []
    for texts in (a, b):
        lines = leakage._Lines(texts)
        both.append(lines.sketches(np.arange(len(texts)), lines.end)[0].tolist())
    df = spark.createDataFrame([(x, y, len(p) - len(q), k) for x, y, p, q, k in zip(*both, a, b, edits)], "x long, y long, moved long, k int")
    found = df.select("k", (F.expr(leakage._apart("x", "y")) + F.abs("moved")).alias("bound"), F.expr(leakage._apart("x", "x")).alias("zero")).collect()
    assert all(r.bound <= 2 * r.k and r.zero == 0 for r in found) and sum(r.bound > 0 for r in found) > 60


def mutated(rng, text, edits, alphabet):
    chars = list(text)
    for _ in range(edits):
        k, kind = rng.randrange(len(chars)), rng.randrange(3)
        chars[k : k + 1] = [rng.choice(alphabet)] if kind == 0 else [] if kind == 1 else [chars[k], rng.choice(alphabet)]
    return "".join(chars)


def test_near_lines_against_brute_force(spark):
    rng = random.Random(9)
    alphabet = "abcdefghij"
    dense = [chr(0x4E00 + k) for k in range(40)]
    train, test = [], []
    for k in range(60):
        letters = dense if k % 3 == 0 else alphabet
        n = rng.choice([60, 63, 70, 71, 72, 75, 90]) if k % 3 == 0 else rng.choice([160, 165, 180, 240, 400])
        line = "".join(rng.choice(letters) for _ in range(n))
        train.append(line)
        test.append(mutated(rng, line, max(0, n // 10 + rng.choice([-8, -4, -1, 0, 0, 1])), letters))
    loops = "abcdefg" * 40
    long = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (1000, 1023, 1024, 1100, 2040, 2049)]  # around the borders of stretches
    train, test = sorted({*train, loops, *long}), sorted({*test, loops[3:], loops[:-20], *(mutated(rng, x, len(x) // 12, alphabet) for x in long)})
    t = spark.createDataFrame(list(enumerate(train)), "class_id long, line string")
    e = spark.createDataFrame(list(enumerate(test)), "class_id long, line string")
    got = {(r.t_line, r.e_line): r.edits for r in leakage.near_lines(t, e).collect()}
    want = {}
    for a in train:
        for b in test:
            if abs(len(a) - len(b)) * 10 <= max(len(a), len(b)) and set(a) & set(b):
                d = duckdb.execute("SELECT levenshtein(?, ?)", [a, b]).fetchone()[0] if a.isascii() and b.isascii() else distance(a, b)
                if d * 10 <= max(len(a), len(b)):
                    want[a, b] = d
    assert got == want and len(want) > 20


def test_overlaps(spark):
    line = "the quick brown fox jumps over the lazy dog and runs away from the old mill " * 4
    h = "ab" * 32
    train, test = '{"original_split": "train"}', '{"original_split": "test"}'
    data = [
        ("t1", "d", train, line, h), ("t1", "d", train, line, h), ("t2", "d", train, line.upper() + "!", None), ("e1", "x", test, line.replace("quick", "quiet"), None), ("e2", "x", test, "other text", f"SHA256:{h.upper()} "), ("e3", "x", test, None, "0" * 64), ("t3", "d", train, None, "0" * 64),
        ("n1", "d", None, line, h), ("n2", "d", "{broken", line, h), ("e4", "x", test, "short", None), ("t4", "d", train, "short", ""), ("e5", "x", test, "", ""),
    ]
    df = spark.createDataFrame(data, "sample_id string, dataset_id string, metadata_json string, text string, audio_sha256 string").withColumns({"side": F.lit("x"), "line": F.lit("y")})
    got = {(r.t_sample, r.e_sample, r.by_audio, r.by_line) for r in leakage.Leaks(df).pairs().collect()}
    assert got == {("t1", "e1", False, True), ("t2", "e1", False, True), ("t1", "e2", True, False)}
    counts = leakage.Leaks(df).counts().collect()
    assert [tuple(c) for c in counts] == [("test", "x", "d", 3, 1, 2)]
    assert leakage.Leaks(df.limit(0)).pairs().collect() == []


def test_dense_lines_of_any_block(spark):
    """Lines of zh, ja and ko count from 60 characters on in whatever block they are written, with digits and foreign names among them."""
    rng = random.Random(11)
    some = lambda first, last, n=80: "".join(chr(rng.randint(first, last)) for _ in range(n))
    near = [some(0x4E00, 0x9FFF), some(0x20000, 0x2A6DF), some(0x30000, 0x3134A), "".join(rng.choices("﨎﨏﨑﨓﨔﨟﨡﨣﨤﨧﨨﨩", k=80)), some(0x1100, 0x1112), some(0x31F0, 0x31FF), some(0x1B002, 0x1B11E), some(0x4E00, 0x9FFF, 60)]
    near += ["".join(f"{some(0x4E00, 0x9FFF, 1)}{rng.randint(10, 99)}" for _ in range(30)), " ".join(f"{some(0x4E00, 0x9FFF, 2)} tom" for _ in range(20)), some(97, 122, 160)]
    far = [some(97, 122, 159), some(0x400, 0x42F, 159), some(0x4E00, 0x9FFF, 59), some(48, 57, 150), some(97, 122, 140) + some(0x4E00, 0x9FFF, 8)]
    data = [(f"{side}{k}", "d", f'{{"original_split": "{side}"}}', text, None) for k, text in enumerate(near + far) for side in ("train", "test")]
    df = spark.createDataFrame(data, "sample_id string, dataset_id string, metadata_json string, text string, audio_sha256 string")
    assert {(r.t_sample, r.e_sample) for r in leakage.Leaks(df).pairs().collect()} == {(f"train{k}", f"test{k}") for k in range(len(near))}
    letters = {c for k in range(0x110000) if not 0xD800 <= k < 0xE000 for c in leakage.reduced(chr(k)) if c.isalpha()}
    assert [c for c in letters if script_of(c) in ("han", "kana", "hangul") and not leakage._DENSE.match(c)] == []
    assert not any(leakage._DENSE.match(c) for c in letters if script_of(c) in ("latin", "CYRILLIC", "GREEK", "ARABIC", "THAI", "TANGUT", "YI", "NUSHU", "KHITAN"))


def test_counts_equal_the_expanded_pairs(spark):
    """Hot hashes, hot lines, both together, and a sample that states both sides."""
    rng = random.Random(6)
    base = ["the quick brown fox jumps over the lazy dog and runs away from the old mill " * 3, "when did she lend you the blue notebook near the bakery after the storm " * 3]
    lines = [x.replace("the", w, k) for x in base for w in ("the", "thy") for k in (1, 3)] + ["short", None]
    hashes = ["ab" * 32, "cd" * 32, None, "ef" * 32]
    data = [(f"s{k}", f"d{k % 3}", f'{{"original_split": "{rng.choice(["train", "test", "dev", "none"])}"}}', lines[0] if k % 3 == 0 else rng.choice(lines), hashes[0] if k % 4 == 0 else rng.choice(hashes)) for k in range(120)]
    data += data[:30] + [(s, d, '{"original_split": "train"}', t, h) for s, d, _, t, h in data[:10]]
    leaks = leakage.Leaks(spark.createDataFrame(data, "sample_id string, dataset_id string, metadata_json string, text string, audio_sha256 string"))
    want = leaks.pairs().groupBy("e_split", "e_dataset", "t_dataset").agg(F.count(F.lit(1)), F.count_if("by_audio"), F.count_if("by_line"))
    assert sorted(map(tuple, leaks.counts().collect())) == sorted(map(tuple, want.collect())) != []


def test_survivors(spark):
    h = "cd" * 32
    cols = "sample_id string, dataset_id string, audio_sha256 string, text string, language string, speaker_id string, recording_id string, text_kind string, metadata_json string, converted_at timestamp, landed_at timestamp, group_key string"
    data = [
        ("a", "good", h, "x", None, "s", None, None, None, None, None, "g"), ("b", "poor", h.upper(), "y", "en", " ", None, None, "{}", None, None, "g"), ("b", "poor", h.upper(), "y", "en", " ", None, None, "{}", None, None, "g"), ("c", "none", f"sha256:{h}", None, None, None, None, None, None, None, None, "g"),
        ("d", "good", "ef" * 32, "x", None, None, None, None, None, None, None, "g"), ("d", "good", "ef" * 32, "x", None, None, None, None, None, None, None, "g"), ("e", "good", "0" * 64, "x", None, None, None, None, None, None, None, "g"), ("f", "good", "0" * 64, "x", None, None, None, None, None, None, None, "g"), ("i", "good", None, "x", None, None, None, None, None, None, None, "g"),
    ]
    datasets = spark.createDataFrame([("good", 1), ("poor", 5)], "dataset_id string, priority int")
    (r,) = survivors.sample_survivors(spark.createDataFrame(data, cols), datasets).collect()
    assert (r.group_key, r.sample_id, r.text, r.language, r.speaker_id, r.recording_id, r.metadata_json) == (h, "a", "x", "en", "s", None, "{}")
    ids = "short_id string, archive int, row_number long, semantic_hash string, priority short, error string, scanned_at int"
    rows = [("k", 1, 1, "h", 4, None, 1), ("k", 2, 1, "h", None, None, 1), ("k", 3, 1, "h", 0, "bad", 1), ("one", 1, 1, "h", 0, None, 1), ("one", 1, 1, "h", 0, None, 2), ("odd", 1, 1, "h", 0, None, 1), ("odd", 1, 2, "g", 0, None, 1), ("bad", 1, 1, "h", 0, "e", 1), ("bad", 2, 1, "h", 0, "e", 1), ("tie", 2, 1, "h", 1, " ", 1), ("tie", 1, 9, "h", 1, "", 1), ("tie", 1, 3, "h", 1, None, 1), (None, 1, 1, "h", 1, None, 1), (None, 1, 2, "h", 1, None, 1)]
    got = sorted(tuple(r) for r in survivors.candidate_survivors(spark.createDataFrame(rows, ids)).collect())
    assert got == [("k", 1, 1), ("tie", 1, 3)]
    assert survivors.candidate_survivors(spark.createDataFrame([], ids)).collect() == []


def test_survivors_carry_every_field(spark):
    h = "cd" * 32
    cols = "sample_id string, dataset_id string, source_key string, audio_sha256 string, text string, language string, speaker_id string, recording_id string, speaker_scope string, group_id string, parent_sample_id string, segment_start_frame long, segment_end_frame long, sample_rate int, num_frames long, text_variants array<string>, repetition double, converted_at timestamp"
    data = [
        ("a", "good", "ka", h, "x", "en", "s", None, "all", " ", None, 7, 9, None, 5, [], None, None), ("b", "poor", "kb", h, "y", None, " ", None, "one", "g", "p", 1, None, 16000, 4, ["v"], 0.5, None), ("b", "poor", "kb", h, "y", None, " ", None, "one", "g", "p", 1, None, 16000, 4, ["v"], 0.5, None), ("c", "none", "kc", h, None, None, None, None, None, "z", "q", 2, 3, None, None, None, 0.1, None),
    ]
    datasets = spark.createDataFrame([("good", 1), ("poor", 5)], "dataset_id string, priority int")
    (r,) = survivors.sample_survivors(spark.createDataFrame(data, cols), datasets).collect()
    assert (r.sample_id, r.dataset_id, r.source_key, r.speaker_id, r.speaker_scope, r.group_id) == ("a", "good", "ka", "s", "all", "g")
    assert (r.parent_sample_id, r.segment_start_frame, r.segment_end_frame, r.sample_rate, r.num_frames, r.text_variants, r.repetition) == ("q", 2, 3, 16000, 4, ["v"], 0.5)  # places and formats of one member
    ids = "short_id string, recording_id string, semantic_hash string, archive int, row_number long, carrier_type string, priority short, error string, language string, native_frames long, sample_rate int, scanned_at int"
    rows = [
        ("k", None, "h", 2, 1, "short", 1, None, " ", 10, 8, 5), ("k", "far", "h", 9, 1, "long", None, None, "fr", 30, 8, 9), ("k", None, None, 3, 1, "long", 2, "", "en", 20, 8, 1), ("k", "bad", "h", 1, 1, "short", 0, "e", "xx", 40, 8, 9), ("k", None, "h", 2, 1, "short", 1, None, " ", 10, 8, 3),
        ("l", None, "h", 1, 1, "short", 1, None, None, None, 8, 1), ("l", "last", "h", 2, 1, "short", 1, "e", None, 7, 16, 1), ("one", "r", "h", 1, 1, "short", 1, None, "en", 1, 8, 1),
    ]
    got = {r.group_key: r.asDict() for r in survivors.candidate_records(spark.createDataFrame(rows, ids)).collect()}
    assert sorted(got) == ["k", "l"]
    assert got["k"] == dict(group_key="k", archive=2, row_number=1, recording_id="far", semantic_hash="h", carrier_type="short", language="en", native_frames=10, sample_rate=8, priority=1, scanned_at=3)
    assert (got["l"]["recording_id"], got["l"]["language"], got["l"]["native_frames"], got["l"]["sample_rate"]) == ("last", None, 7, 16)
