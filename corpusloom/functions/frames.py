"""Frame arithmetic, array checks and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    return F.floor(F.try_divide(a.cast("decimal(38,0)"), b.cast("decimal(38,0)"))).cast("long")


def ceil_div(a: Column, b: Column | int) -> Column:
    """Integer ceiling of a / b, exact for all longs; null for b = 0."""
    b = F.lit(b) if isinstance(b, int) else b
    return _div(a + b - 1, b)


def resampled_length(frames: Column, rate: Column, to_rate: int) -> Column:
    """Length after resampling, rounded up."""
    return _div(frames * to_rate + rate - 1, rate)


def codec_frames(input_frames: Column, hop: int = 1920) -> Column:
    return _div(input_frames + (hop - 1), F.lit(hop))


def resampled_float(frames: Column, rate: Column, to_rate: int = 24000) -> Column:
    """Resampled length as single-precision arithmetic has it."""
    scaled = (frames.cast("float") * F.lit(float(to_rate)).cast("float") / rate.cast("float")).cast("float")
    return F.ceil(scaled.cast("double")).cast("long")


def within_tolerance(difference: Column, rate: Column, seconds: float = 0.02) -> Column:
    """|difference| of at most two frames or so many seconds."""
    return F.abs(difference) <= F.greatest(F.lit(2), F.ceil(rate * seconds).cast("int"))


def batch_frames(length: Column, bucket: int = 48000, longest: int = 2_880_000) -> Column:
    """Length padded to its bucket; null if not positive or too long for a batch."""
    return F.when((length > 0) & (length <= longest), _div(length + (bucket - 1), F.lit(bucket)) * bucket)


def batch_size(padded: Column, budget: int = 11_520_000, most: int = 64) -> Column:
    """Largest power of two of samples that fit the budget."""
    fit = F.greatest(F.lit(1), F.least(F.lit(most), _div(F.lit(budget), padded)))
    return F.pow(F.lit(2), F.floor(F.log2(fit.cast("double")))).cast("int")


def all_finite(c: Column) -> Column:
    """Every element of an array is there and a finite number."""
    inf = float("inf")
    return F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (x != inf) & (x != -inf))


def valid_vector(c: Column, size: int) -> Column:
    """An array of the right size, finite and not all zero; false for null."""
    norm = F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.coalesce((F.size(c) == size) & all_finite(c) & (norm > 0), F.lit(False))


def valid_codes(codes: Column, frames: Column, books: int, size: int) -> Column:
    """A matrix of frames x books whose entries lie in [0, size)."""
    rows = F.forall(codes, lambda r: (F.size(r) == books) & F.forall(r, lambda x: (x >= 0) & (x < size)))
    return F.coalesce((F.size(codes) == frames) & rows, F.lit(False))


def equivalent(a: Column, b: Column, atol: float = 0.0, rtol: float = 0.0) -> Column:
    """Arrays of one length whose elements differ by at most atol + rtol * |a|."""
    close = F.forall(F.zip_with(a, b, lambda x, y: F.abs(y - x) <= atol + rtol * F.abs(x)), lambda ok: F.coalesce(ok, F.lit(False)))
    return F.coalesce((F.size(a) == F.size(b)) & close, F.lit(False))


def lower_percentile(values: Column, q: float) -> Column:
    """Element at floor(q * (n - 1)) of the sorted values; null for none."""
    at = F.floor(F.lit(q) * (F.size(values) - 1)) + 1
    return F.when(F.size(values) > 0, F.try_element_at(F.sort_array(values), F.greatest(at, F.lit(1)).cast("int")))


def utc_time(c: Column) -> Column:
    """Instant of an ISO 8601 time that names its offset; null for any other string."""
    return F.when(c.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"), F.try_to_timestamp(c))


def run_stamp(c: Column, offset: str = "+08:00") -> Column:
    """Stamp of a run in local time."""
    return F.date_format(F.from_utc_timestamp(c, offset), "yyyyMMdd'T'HHmmss")


def json_score(metadata: Column, path: str) -> Column:
    """struct(score, status, error_code): a number at a path; booleans and text are invalid, nothing is skipped."""
    parsed = F.try_parse_json(metadata)
    found = F.try_variant_get(parsed, path, "variant")
    kind = F.schema_of_variant(found)
    number = F.try_variant_get(parsed, path, "double")
    numeric = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & number.isNotNull() & ~F.isnan(number)
    row = lambda s, status, code: F.struct(s.cast("double").alias("score"), F.lit(status).alias("status"), F.lit(code).cast("string").alias("error_code"))
    none = F.lit(None)
    return (
        F.when(F.coalesce(F.trim(metadata), F.lit("")) == "", row(none, "skipped", "missing_score"))
        .when(parsed.isNull(), row(none, "failed", "invalid_json"))
        .when(found.isNull() | (kind == "VOID"), row(none, "skipped", "missing_score"))
        .when(numeric, row(number, "ok", None))
        .otherwise(row(none, "failed", "invalid_score"))
    )


def run_problem(run_id: Column, finished_at: Column) -> Column:
    """What is wrong with a run's times: its id begins with the Beijing time of its start, and it ends later, with that offset written; null if nothing."""
    began = F.try_to_timestamp(F.concat(F.regexp_extract(run_id, r"^(\d{8}T\d{6})", 1), F.lit("+0800")), F.lit("yyyyMMdd'T'HHmmssZ"))
    ended = F.when(finished_at.rlike(r"([+-]\d\d:\d\d|Z)$"), finished_at.try_cast("timestamp"))
    return F.when(began.isNull(), "unreadable_run_id").when(ended.isNull(), "unreadable_time").when(ended < began, "finished_before_start").when(~finished_at.endswith("+08:00"), "other_offset")
