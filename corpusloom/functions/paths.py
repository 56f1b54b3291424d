"""What a file's path says: speaker, style and corpus of a clip, by rules held as data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the path of a clip names its speaker, by subset.  Parts count from 0.
SPEAKER_PARTS = {"genshin": [3, 4], "starrail": [3, 4], "ears": [3], "l2": [3], "kespeech": [4], "voxceleb": [6], "WHSP": [4]}
SPEAKER_NAME_WORDS = {"childmandarin": 1, "debatts": 2}
CORPUS_PARTS = {"Emotion_Speech_Dataset": ("ESD", 3), "RAVDESS": ("RAVDESS", 3)}


def _part(path: Column, k: int) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(k + 1))


def _name(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-1))


def speaker_of(subset: Column, path: Column) -> Column:
    """Speaker key of a clip, or null where its path names none."""
    out = F.lit(None).cast("string")
    rule = lambda name, key: F.when(subset == name, key)
    found = [rule(n, F.concat_ws(":", F.lit(n), *[_part(path, k) for k in parts])) for n, parts in SPEAKER_PARTS.items()]
    found += [rule(n, F.concat(F.lit(n + ":"), F.array_join(F.slice(F.split(_name(path), "_"), 1, k), "_"))) for n, k in SPEAKER_NAME_WORDS.items()]
    pair = F.split(_part(path, 5), "-")
    side = F.when(F.contains(_name(path), F.lit("_channel1_")), pair[0]).when(F.contains(_name(path), F.lit("_channel")), F.try_element_at(pair, F.lit(2))).otherwise(_part(path, 5))
    found.append(rule("expresso", F.concat(F.lit("expresso:"), side)))
    corpus = _part(path, 2)
    inner = F.coalesce(
        *[F.when(corpus == c, F.concat(F.lit(name + ":"), _part(path, k))) for c, (name, k) in CORPUS_PARTS.items()],
        F.when(corpus == "CREMA-D", F.concat(F.lit("CREMA-D:"), F.split(_name(path), "_")[0])),
        F.when(corpus == "EMNS", "EMNS:single"),
        F.when(corpus == "IEMOCAP", F.concat(F.lit("IEMOCAP:"), _part(path, 3), F.lit("-"), F.substring(F.regexp_extract(_name(path), r"_([^_]*)$", 1), 1, 1))),
    )
    found.append(rule("emotion", inner))
    return F.coalesce(*found, out)


def recording_style(subset: Column, path: Column) -> Column:
    """Style that a clip's path says was asked for; null for subsets whose paths say nothing."""
    words = F.split(F.regexp_replace(_name(path), r"[.][^.]*$", ""), "_")
    ears = F.when(words[0] == "emo", F.concat(F.lit("emotion: "), F.try_element_at(words, F.lit(2)))).otherwise(F.try_element_at(words, F.lit(-1)))
    folder = F.try_element_at(F.split(path, "/"), F.when(F.contains(path, F.lit("/read/")), -3).otherwise(-2))
    return F.when(subset == "ears", ears).when(subset == "expresso", folder)


def repaired(text: Column, repairs: dict[str, str]) -> Column:
    """struct(text, action) after literal replacements: keep, replace, or skip for blank texts."""
    out = text
    for wrong, right in repairs.items():
        out = F.replace(out, F.lit(wrong), F.lit(right))
    action = F.when(~F.coalesce(text.rlike(r"(?U)\S"), F.lit(False)), "skip").when(out == text, "keep").otherwise("replace")
    return F.struct(F.when(action != "skip", out).alias("text"), action.alias("action"))


def mentions(text: Column, terms: list[str]) -> Column:
    """Whether a text names any of the terms as a word, in any case; false for null."""
    literal = "|".join(r"\Q" + t.replace(r"\E", r"\E\\E\Q") + r"\E" for t in terms)
    return F.coalesce(text.rlike(rf"(?iu)(?<![\w])(?:{literal})(?![\w])"), F.lit(False)) if terms else F.lit(False)
