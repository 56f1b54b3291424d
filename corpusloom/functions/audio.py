"""Encoded audio in columns: WAV reading, waveform statistics, bandwidth and container sniffing.

Failure is a status row, never an exception, so one bad file doesn't stop a job.  Headers are
read of WAV, FLAC, MP3 and OGG; only PCM and float WAV are decoded, other containers give
`unsupported_container`.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First bytes of containers.
MAGIC = {"wav": b"RIFF", "flac": b"fLaC", "ogg": b"OggS", "caf": b"caff", "mp3_id3": b"ID3"}


def container(data: Column) -> Column:
    """Container of a binary value by its first bytes; null for null, `unknown` for others."""
    found = F.when(data.isNull(), None)
    for name, magic in MAGIC.items():
        found = found.when(F.substring(data, 1, len(magic)) == F.lit(magic), name)
    found = found.when(F.substring(data, 5, 4) == F.lit(b"ftyp"), "mp4")
    sync = F.conv(F.hex(F.substring(data, 1, 2)), 16, 10).cast("int")
    return found.when(sync.bitwiseAND(F.lit(0xFFE0)) == 0xFFE0, "mp3").otherwise("unknown")


class BadAudio(ValueError):
    """The bytes are no audio that can be read here."""


def wav_chunks(raw: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(name, offset, size) of the chunks of a RIFF file."""
    if raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
        raise BadAudio("unsupported_container")
    at = 12
    while at + 8 <= len(raw):
        name, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        yield name, at + 8, min(size, len(raw) - at - 8)
        at += 8 + size + size % 2


def wav_header(raw: bytes) -> tuple[int, int, int]:
    form = size = None
    for name, at, n in wav_chunks(raw):
        if name == b"fmt " and n >= 16:
            form = struct.unpack_from("<HHIIHH", raw, at)
        elif name == b"data":
            size = n
    if not form or size is None or not form[4]:
        raise BadAudio("missing_chunk")
    return form[2], form[1], size // form[4]


def flac_header(raw: bytes) -> tuple[int, int, int]:
    """From the stream information, which is always the first block; 0 frames stand for an unknown number."""
    if raw[:4] != b"fLaC" or len(raw) < 26 or raw[4] & 127:
        raise BadAudio("bad_header")
    packed = int.from_bytes(raw[18:26])
    if not packed & (1 << 36) - 1:
        raise BadAudio("unknown_length")
    return packed >> 44, (packed >> 41 & 7) + 1, packed & (1 << 36) - 1


# Bit rates (kbit/s) by version and layer, and sample rates of version 1.
MP3_BIT_RATES = {
    (1, 1): [32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448], (1, 2): [32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384], (1, 3): [32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320],
    (2, 1): [32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256], (2, 2): [8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160], (2, 3): [8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
}
MP3_RATES = [44100, 48000, 32000]


def _mp3_frame(raw: bytes, at: int) -> tuple[int, int, int, int] | None:
    """(rate, channels, samples, size in bytes) of the frame at a place, or None."""
    if at + 4 > len(raw) or raw[at] != 0xFF or raw[at + 1] & 0xE0 != 0xE0:
        return None
    kind, layer, rate_no, bits_no = raw[at + 1] >> 3 & 3, 4 - (raw[at + 1] >> 1 & 3), raw[at + 2] >> 2 & 3, raw[at + 2] >> 4
    if kind == 1 or layer == 4 or rate_no == 3 or bits_no in (0, 15):
        return None
    rate = MP3_RATES[rate_no] >> {3: 0, 2: 1, 0: 2}[kind]
    bits = MP3_BIT_RATES[1 if kind == 3 else 2, layer][bits_no - 1] * 1000
    samples = 384 if layer == 1 else 576 if layer == 3 and kind != 3 else 1152
    padding = raw[at + 2] >> 1 & 1
    size = (12 * bits // rate + padding) * 4 if layer == 1 else samples // 8 * bits // rate + padding
    return rate, 1 if raw[at + 3] >> 6 == 3 else 2, samples, size


def mp3_header(raw: bytes) -> tuple[int, int, int]:
    """By walking the frames; an information frame is no audio, and the delay and padding that it names are left out."""
    at = 10 + sum((raw[6 + k] & 127) << 7 * (3 - k) for k in range(4)) if raw[:3] == b"ID3" and len(raw) > 10 else 0
    while at < len(raw) and not ((first := _mp3_frame(raw, at)) and (at + first[3] >= len(raw) or _mp3_frame(raw, at + first[3]))):
        at += 1
    if at >= len(raw):
        raise BadAudio("bad_header")
    rate, channels, samples, size = first
    total = 0
    mark = max(raw.find(b"Xing", at, at + min(size, 64)), raw.find(b"Info", at, at + min(size, 64)))
    if mark >= 0:
        tag = mark + 8 + sum(n for bit, n in enumerate((4, 4, 100, 4)) if raw[mark + 7] >> bit & 1)
        if raw[tag : tag + 4] in (b"LAME", b"Lavf", b"Lavc") and tag + 24 <= len(raw):
            total -= sum(divmod(int.from_bytes(raw[tag + 21 : tag + 24]), 1 << 12))
        at += size
    while (frame := _mp3_frame(raw, at)) and at + frame[3] <= len(raw):
        total += frame[2]
        at += frame[3]
    return rate, channels, max(0, total)


def ogg_header(raw: bytes) -> tuple[int, int, int]:
    """Vorbis and Opus: the first packet names the format, the last page the number of samples."""
    begin = 27 + raw[26] if len(raw) > 27 else 0
    first, last = raw[begin : begin + 32], raw.rfind(b"OggS")
    if not begin or last + 14 > len(raw):
        raise BadAudio("bad_header")
    frames = struct.unpack_from("<q", raw, last + 6)[0]
    if first[:7] == b"\x01vorbis":
        return struct.unpack_from("<I", first, 12)[0], first[11], frames
    if first[:8] == b"OpusHead":
        return 48000, first[9], frames - struct.unpack_from("<H", first, 10)[0]
    raise BadAudio("unsupported_encoding")


def header(raw: bytes) -> tuple[int, int, int]:
    """(sample rate, channels, frames) of an encoded file, without decoding it."""
    try:
        read = wav_header if raw[:4] == b"RIFF" else flac_header if raw[:4] == b"fLaC" else ogg_header if raw[:4] == b"OggS" else mp3_header if raw[:3] == b"ID3" or _mp3_frame(raw, 0) else None
        if read is None:
            raise BadAudio("unsupported_container")
        return read(raw)
    except (struct.error, IndexError):
        raise BadAudio("bad_header") from None


def read_wav(raw: bytes) -> tuple[np.ndarray, int]:
    """(mono float wave, rate) of a WAV file; channels are averaged."""
    form = wave = None
    for name, at, size in wav_chunks(raw):
        if name == b"fmt " and size >= 16:
            form = struct.unpack_from("<HHIIHH", raw, at)
        elif name == b"data":
            wave = raw[at : at + size]
    if form is None or wave is None:
        raise BadAudio("missing_chunk")
    kind, channels, rate, _, _, bits = form
    if not channels or not rate:
        raise BadAudio("bad_header")
    usable = len(wave) // (channels * bits // 8 or 1) * (channels * bits // 8)
    if (kind, bits) == (3, 32):
        values = np.frombuffer(wave[:usable], "<f4").astype(np.float64)
    elif kind in (1, 0xFFFE) and bits == 16:
        values = np.frombuffer(wave[:usable], "<i2") / 32768.0
    elif kind in (1, 0xFFFE) and bits == 8:
        values = (np.frombuffer(wave[:usable], np.uint8) - 128.0) / 128.0
    elif kind in (1, 0xFFFE) and bits == 24:
        parts = np.frombuffer(wave[:usable], np.uint8).reshape(-1, 3).astype(np.int32)
        values = (((parts[:, 0] | parts[:, 1] << 8 | parts[:, 2] << 16) << 8) >> 8) / 8388608.0
    else:
        raise BadAudio("unsupported_encoding")
    if not len(values):
        raise BadAudio("empty")
    if not np.isfinite(values).all():
        raise BadAudio("not_finite")
    return values.reshape(-1, channels).mean(1), rate


def embedded_caf(raw: bytes) -> int | None:
    """Offset of a CAF file that sits inside the data of a WAV file, if any."""
    for name, at, size in wav_chunks(raw):
        if name == b"data" and raw[at : at + 4] == b"caff":
            return at
    return None


def mask_runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def lower_quantile(values: np.ndarray, q: float) -> float:
    return float(np.sort(values)[int(np.floor(q * (len(values) - 1)))])


def wave_statistics(wave: np.ndarray, rate: int, window_seconds: float = 0.02, quiet: float = 0.01) -> dict:
    """Peak, RMS, offset, clipping, longest zero run, silence at the edges and inside, and lower quantiles of window energy."""
    width = max(1, round(rate * window_seconds))
    edges = np.arange(0, len(wave), width)
    sizes = np.minimum(edges + width, len(wave)) - edges
    level = np.sqrt(np.add.reduceat(wave * wave, edges) / sizes)
    low = level < quiet
    runs = mask_runs(low)
    lead = runs[0] if runs and runs[0][0] == 0 else None
    trail = runs[-1] if runs and runs[-1][1] == len(low) and runs[-1] != lead else None
    inner = [b - a for a, b in runs if (a, b) not in (lead, trail)]
    length = lambda r: float(sizes[r[0] : r[1]].sum() / rate) if r else 0.0
    zeros = max((b - a for a, b in mask_runs(wave == 0)), default=0)
    return {
        "n_frames": len(wave), "peak": float(np.abs(wave).max()), "rms": float(np.sqrt(np.mean(wave * wave))), "dc_offset": float(wave.mean()),
        "clipped_share": float(np.mean(np.abs(wave) >= 0.999)), "longest_zero_run": int(zeros), "lead_silence": length(lead), "trail_silence": length(trail),
        "longest_inner_quiet": float(max(inner, default=0) * width / rate), "level_p05": lower_quantile(level, 0.05), "level_p50": lower_quantile(level, 0.5), "level_p95": lower_quantile(level, 0.95),
    }


def bandwidth(wave: np.ndarray, rate: int, segment: int = 2048, drop_db: float = 40.0) -> float:
    """Highest frequency whose averaged power lies within so many decibels of the peak (Welch's method, Hann window)."""
    size = min(segment, len(wave))
    window = np.hanning(size) if size > 1 else np.ones(size)
    starts = np.arange(0, max(1, len(wave) - size + 1), max(1, size // 2))
    power = np.zeros(size // 2 + 1)
    for a in starts:
        power += np.abs(np.fft.rfft((wave[a : a + size] - wave[a : a + size].mean()) * window)) ** 2
    if not power.max() > 0:
        return 0.0
    loud = np.flatnonzero(10 * np.log10(power / power.max() + 1e-30) >= -drop_db)
    return float(loud[-1] * rate / size)


STATISTICS = "n_frames bigint, peak double, rms double, dc_offset double, clipped_share double, longest_zero_run bigint, lead_silence double, trail_silence double, longest_inner_quiet double, level_p05 double, level_p50 double, level_p95 double"


def audio_statistics(df: DataFrame, key: str, data: str) -> DataFrame:
    """(key, status, error_code, sample_rate, statistics…, bandwidth_hz) of a binary column of encoded audio."""
    names = [p.split()[0] for p in STATISTICS.split(", ")]
    columns = [key, "status", "error_code", "sample_rate", *names, "bandwidth_hz"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, raw in zip(batch[key], batch[data]):
                try:
                    if raw is None:
                        raise BadAudio("missing_audio")
                    wave, rate = read_wav(bytes(raw))
                    found = wave_statistics(wave, rate)
                    rows.append((name, "ok", None, rate, *[found[n] for n in names], bandwidth(wave, rate)))
                except BadAudio as e:
                    rows.append((name, "failed", str(e), *[None] * (len(columns) - 3)))
            yield pd.DataFrame(rows, columns=columns)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, data).mapInPandas(run, f"`{key}` {kind}, status string, error_code string, sample_rate int, {STATISTICS}, bandwidth_hz double")
