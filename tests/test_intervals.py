import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import speakers
from corpusloom.operators.intervals import periods, periods_and_gaps
from corpusloom.operators.joins import interval_overlaps

SCHEMA = "k string, who string, a long, b long, period_start string, __slice int"


def brute(rows):
    out = {}
    for k, w, a, b, *_ in rows:
        if a is not None and b is not None and 0 <= a < b:
            out.setdefault((k, w), []).append((a, b))
    found = set()
    for key, spans in out.items():
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        found |= {(*key, "period", a, b) for a, b in merged}
        found |= {(*key, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])}
    return found


@pytest.mark.parametrize("width", [7, 64, 1 << 22])
def test_periods_and_gaps_against_brute_force(spark, width):
    rng = random.Random(width)
    rows = []
    for _ in range(500):
        a = rng.choice([None, -3, *range(0, 300)])
        b = None if rng.random() < 0.05 else (a or 0) + rng.choice([-2, 0, 1, 2, 5, 40, 150])
        rows.append((rng.choice(["x", "y", "hot", "hot", "hot", None]), rng.choice(["1", "2", None]), a, b, "clash", 1))
    rows += rows[:40]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in periods_and_gaps(df, ["k", "who"], "a", "b", width).collect()}
    assert got == brute(rows)


def test_empty_and_invalid_intervals_have_no_periods(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periods_and_gaps(empty, ["k"], "a", "b").collect() == []
    bad = spark.createDataFrame([("x", "1", 5, 5, "", 0), ("x", "1", 9, 2, "", 0), ("x", "1", None, 2, "", 0), ("x", "1", -1, 2, "", 0)], SCHEMA)
    assert periods(bad, ["k"], "a", "b").collect() == []


def test_very_long_timelines(spark):
    df = spark.createDataFrame([("x", "1", 0, 1 << 40, "", 0), ("x", "1", 1 << 40, (1 << 40) + 5, "", 0), ("x", "1", (1 << 41), (1 << 41) + 1, "", 0)], SCHEMA)
    assert sorted(map(tuple, periods_and_gaps(df, ["k"], "a", "b").collect())) == [("x", "gap", (1 << 40) + 5, 1 << 41), ("x", "period", 0, (1 << 40) + 5), ("x", "period", 1 << 41, (1 << 41) + 1)]


def test_overlaps_of_different_owners(spark):
    rng = random.Random(5)
    rows = [("r", rng.choice("abc"), s, s + rng.randint(1, 30), "", 0) for s in (rng.randint(0, 200) for _ in range(60))]
    got = sorted((r[1], r[2]) for r in interval_overlaps(spark.createDataFrame(rows, SCHEMA), ["k"], "who", "a", "b", width=16).collect())
    active = [len({w for _, w, a, b, *_ in rows if a <= t < b}) >= 2 for t in range(300)]
    want, t = [], 0
    while t < 300:
        if active[t]:
            start = t
            while active[t]:
                t += 1
            want.append((start, t))
        t += 1
    assert got == want


TURNS = "turns array<struct<speaker string, start_sample long, end_sample long, text string>>, frames long"


def test_structure_of_turns(spark):
    turns = [("S1", 0, 500, ""), ("S2", 400, 950, ""), ("S1", 900, 1000, "")]
    df = spark.createDataFrame([(turns, 1000), ([], 1000), (None, 1000)], TURNS)
    a, b, c = df.select(speakers.structure(F.col("turns"), F.col("frames")).alias("m")).select("m.*").collect()
    assert (a.speaker_count, a.turn_union_samples, a.overlap_samples, a.overlap_ratio) == (2, 1000, 150, 0.15)
    assert [(o.start, o.end) for o in a.overlaps] == [(400, 500), (900, 950)]
    assert a.dominant_speaker_ratio == 0.6
    assert (b.speaker_count, b.turn_union_samples, b.dominant_speaker_ratio) == (0, 0, None)
    assert c.turn_union_samples is None


def test_parse_reply(spark):
    good = '{"segments":[{"start":4.0,"end":9.5,"text":"[S02] b"},{"start":0,"end":5.0,"text":"[S01] a"}]}'
    bodies = [good, "no json", '{"segments":[{"start":0,"end":1,"text":"no label"}]}', '{"segments":[{"start":2,"end":1,"text":"[S01]"}]}', '{"segments":[{"start":0,"end":99,"text":"[S01]"}]}', '{"segments":[{"start":0,"end":2,"text":"[S01]"}]}', '{"segments":[]}', None]
    df = spark.createDataFrame([(b, 100, 1000) for b in bodies], "body string, rate int, frames long")
    rows = df.select(speakers.parse_reply(F.col("body"), F.col("rate"), F.col("frames"), 1.0, 3.0, 0.3).alias("p")).select("p.*").collect()
    assert [r.error_code for r in rows] == [None, "model_invalid_output", "model_invalid_output", "model_invalid_output", "model_invalid_output", "output_truncated", None, "model_invalid_output"]
    assert [(t.speaker, t.start_sample, t.end_sample, t.text.strip()) for t in rows[0].turns] == [("S01", 0, 500, "a"), ("S02", 400, 950, "b")]
