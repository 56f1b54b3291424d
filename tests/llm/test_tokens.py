import base64
import os
import random

import numpy as np
import pytest

from corpusloom.llm import splitting, tokens
from corpusloom.llm.bpe import DEFAULT_DIR, encoder

tiktoken = pytest.importorskip("tiktoken")
if not os.path.isdir(DEFAULT_DIR):
    pytest.skip("no vocabularies here", allow_module_level=True)
# Fixed value: the published split pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ODD = ["", " ", "\n\n", "a", "don't we'll 's 'S x's's", "  two  blanks ", "a\n\n\n b\t\tc ", "<|endoftext|> text", "é́ ñ ß", "漢字、かな。", "😀👨‍👩‍👧 ok", "x" * 5000, "the " * 3000, "１２³ Ⅷ 5%", "\r\n\r\nx\r\n", "'", "''ll", "'re", "\u0085  z", "ａｂｃ　ｄ", "\x1c\x1f a"]


@pytest.fixture(scope="module")
def reference():
    with open(os.path.join(DEFAULT_DIR, "byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("reference", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz(n, seed=1):
    rng = random.Random(seed)
    alphabet = "abcdefgh ABC's't \n\t　éж中가あ12²’!?.<|>-_\U0001f600"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_ids_equal_the_reference_encoder(reference):
    texts = [*ODD, None, *fuzz(4000)]
    ids, offsets = encoder().encode(texts)
    for k, t in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == (reference.encode_ordinary(t) if t else []), repr(t)
    assert encoder().counts(texts).tolist() == np.diff(offsets).tolist()


def test_round_trip():
    texts = [*ODD, *fuzz(500, 2)]
    ids, offsets = encoder().encode(texts)
    assert [encoder().decode(ids[a:b]) for a, b in zip(offsets, offsets[1:])] == texts


def test_cache_limits_change_nothing(reference, monkeypatch):
    from corpusloom.llm import bpe

    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    e = bpe.ByteBpe(os.path.join(DEFAULT_DIR, "byte_bpe_50k.tiktoken"))
    for t in fuzz(60, 3):
        ids, _ = e.encode([t])
        assert ids.tolist() == reference.encode_ordinary(t)


def test_long_texts_are_cut_where_nothing_changes(reference, monkeypatch):
    from corpusloom.llm import bpe

    monkeypatch.setattr(bpe, "BLOCK", 64)
    rng = random.Random(8)
    for k in range(150):
        t = "".join(rng.choice(["a", "word", " ", "  ", "\n", "'s", "'", "中", "。", "1", "!", "é", ", "]) for _ in range(rng.randint(60, 600)))
        ids, offsets = encoder().encode(["x", t, "yy"])
        assert "".join(bpe.blocks(t)) == t and ids[offsets[1] : offsets[2]].tolist() == reference.encode_ordinary(t)
        (starts, sizes), = encoder().word_counts([t])
        assert starts[0] == 0 and sizes.sum() == offsets[2] - offsets[1]


def test_encode_corpus(spark, reference):
    data = [(k, t, "ids") for k, t in enumerate([*ODD, None])]
    df = spark.createDataFrame(data, "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(df, "doc_id", "text").collect()}
    assert got == {k: reference.encode_ordinary(t) if t else [] for k, t, _ in data}
    assert tokens.encode_corpus(df.limit(0), "doc_id", "text").collect() == []


def test_best_fit_keeps_copies_apart():
    rng = random.Random(4)
    items = [(rng.randint(0, 60), rng.choice([-1, *range(40)]), rng.randint(0, 3)) for _ in range(800)]
    at = tokens.pack_group(items, 100)
    filled, seen = {}, set()
    for (size, cluster, _), number in zip(items, at):
        filled[number] = filled.get(number, 0) + size
        assert cluster < 0 or (number, cluster) not in seen
        seen.add((number, cluster))
    assert max(filled.values()) <= 100
    strict = tokens.pack_group([(10, -1, 0)] * 5, 100, source_exclusive=True)
    assert len(set(strict)) == 5 and len(set(tokens.pack_group([(10, -1, 0)] * 5, 100))) == 1


@pytest.mark.parametrize("n", [10, 61, 101, 1000])
def test_all_equally_tight_containers_are_judged(n):
    """An item joins the one container that its source isn't in, however many are as tight."""
    items = [(60, k, 0) for k in range(n - 1)] + [(60, n, 1)] + [(30, 2 * n, 0)]
    at = tokens.pack_group(items, 100)
    assert len(set(at[:n])) == n and at[n] == at[n - 1]


def test_pack(spark):
    rng = random.Random(6)
    data = [(k, " ".join(rng.choice(["word", "other", "thing"]) for _ in range(rng.randint(1, 400))), rng.choice("ab"), "n") for k in range(300)]
    data += [(1000, None, "a", "n"), (1001, "", "a", "n"), (1002, "long " * 5000, "b", "n"), (1003, "same copy", "a", "n"), (1004, "same copy", "b", "n"), (1005, "x", None, "n")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, n_tokens string")
    rows = tokens.pack(df, "doc_id", "text", "source").collect()
    sizes = dict(zip([d[0] for d in data], encoder().counts([d[1] for d in data]).tolist()))
    parts, room = {}, {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append((r.part, r.start_token, r.n_tokens))
        room[r.container_id] = room.get(r.container_id, 0) + r.n_tokens
    assert set(parts) == set(sizes) and max(room.values()) <= 2048
    for name, found in parts.items():
        assert sum(p[2] for p in found) == sizes[name] and len(found) == max(1, -(-sizes[name] // 2048))
        assert all(b[1] == a[1] + a[2] for a, b in zip(sorted(found), sorted(found)[1:]))
    assert len(room) <= 1.03 * sum(sizes.values()) / 2048 + 2
    where = {r.doc_id: r.container_id for r in rows}
    assert where[1003] != where[1004]
    again = {(r.doc_id, r.part): r.container_id for r in tokens.pack(df.repartition(5), "doc_id", "text", "source").collect()}
    assert again == {(r.doc_id, r.part): r.container_id for r in rows}
    assert tokens.pack(df.limit(0), "doc_id", "text", "source").collect() == []


def check_pieces(text, found, limit, overlap):
    e, new = encoder(), 0
    for no, (a, b, _, fresh) in enumerate(found):
        assert a <= fresh == new < b and int(e.counts([text[a:b]])[0]) <= limit
        assert int(e.counts([text[a:fresh]])[0]) <= overlap if a < fresh else True
        assert no or a == 0
        new = b
    assert new == len(text)


@pytest.mark.parametrize("limit,overlap", [(50, 8), (16, 0), (200, 64)])
def test_pieces_cover_the_text(limit, overlap):
    rng = random.Random(limit)
    e = encoder()
    texts = ["x" * 3000, "中文" * 700, "word " * 900, "漢字。" * 400, "\n\n".join("A sentence here. Another one! " * rng.randint(1, 9) for _ in range(20)), "# One\n\ntext\n\n## Two\n\n" + "more text, " * 300, "\r\n" * 500 + "end", "😀" * 300]
    texts += ["".join(rng.choice(["a", " ", "\n", ". ", "中", "。", "word", "\n\n", "é", "'s", ","]) for _ in range(2500)) for _ in range(10)]
    for text in texts:
        (starts, sizes), = e.word_counts([text])
        found = splitting._Text(text, starts, sizes, e, overlap).pieces(limit, overlap)
        check_pieces(text, found, limit, overlap)


def test_pieces_end_at_natural_boundaries():
    e = encoder()
    text = "\n\n".join(f"Paragraph {k} has a few words. It has two sentences." for k in range(40))
    (starts, sizes), = e.word_counts([text])
    found = splitting._Text(text, starts, sizes, e).pieces(60, 0)
    assert all(splitting.LEVELS[level] == "paragraph" for _, b, level, _ in found if b < len(text))


def test_split_oversized(spark):
    long = "One sentence of several words. " * 400
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "short", "c"), (4, long, "c"), (5, "中" * 2000, "c"), (6, "a " * 1025, "c")], "doc_id long, text string, piece_no string")
    rows = splitting.split_oversized(df, "doc_id", "text").collect()
    assert {r.doc_id for r in rows} == {k for k, t in ((4, long), (5, "中" * 2000), (6, "a " * 1025)) if encoder().counts([t])[0] > 1024}
    for k in {r.doc_id for r in rows}:
        mine = sorted((r for r in rows if r.doc_id == k), key=lambda r: r.piece_no)
        assert [r.piece_no for r in mine] == list(range(1, len(mine) + 1)) and all(r.n_tokens <= 1024 for r in mine) and mine[-1].ends_at == "end"
        assert "".join(r.text[r.overlap_chars :] for r in mine) == {4: long, 5: "中" * 2000, 6: "a " * 1025}[k]
    assert splitting.split_oversized(df.limit(0), "doc_id", "text").collect() == []


def test_pieces_of_a_run_without_boundaries_overlap():
    e = encoder()
    for text in ("中文字" * 500, "x" * 4000, "Start of it. " + "漢" * 900 + " and an end."):
        (starts, sizes), = e.word_counts([text])
        found = splitting._Text(text, starts, sizes, e, 16).pieces(100, 16)
        check_pieces(text, found, 100, 16)
        assert sum(a < new for a, _, _, new in found[1:]) >= len(found) - 2


def test_borders_take_linear_time():
    import time

    e = encoder()
    for text in ("\n" * 100_000 + "x", "." * 100_000 + "x", "\r\n \t" * 30_000, "!" * 50_000 + '"' * 50_000):
        began = time.perf_counter()
        splitting.sections(text)
        for pattern in splitting.BORDERS[1:]:
            for _ in pattern.finditer(text):
                pass
        assert time.perf_counter() - began < 1
    assert splitting.sections("a\n\n# One\n\n 2. Two\n# no\n\nthree") == [3, 10]
