"""Timestamps of media time and of clock time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(seconds: Column) -> Column:
    """Seconds as whole microseconds, so that comparisons don't hang on float representation."""
    return F.round(seconds * 1_000_000).cast("long")


def format_timestamp(seconds: Column, fmt: str = "HH:MM:SS") -> Column:
    """Hours, minutes and seconds, cut to whole seconds or rounded to milliseconds."""
    h, m = F.floor(seconds / 3600).cast("int"), F.floor(F.pmod(seconds, F.lit(3600.0)) / 60).cast("int")
    rest = F.pmod(seconds, F.lit(60.0))
    if fmt == "HH:MM:SS.mmm":
        return F.format_string("%02d:%02d:%06.3f", h, m, rest)
    return F.format_string("%02d:%02d:%02d", h, m, F.floor(rest).cast("int"))


def format_srt(seconds: Column) -> Column:
    """Hours, minutes, seconds and cut milliseconds after a comma."""
    ms = F.floor(F.pmod(seconds, F.lit(1.0)) * 1000).cast("int")
    return F.concat(format_timestamp(seconds), F.format_string(",%03d", ms))


def absolute(file_start: Column, seconds: Column) -> Column:
    """A recorder's local clock time, cut to milliseconds."""
    at = F.date_trunc("millisecond", F.timestamp_micros(F.unix_micros(file_start.cast("timestamp")) + micros(seconds)))
    return at.cast("timestamp_ntz")


def iso_ms(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def file_speaker(speaker: Column, file_index: Column) -> Column:
    """A speaker's name made unique over the files of an interview."""
    return F.replace(speaker, F.lit("SPEAKER_"), F.concat(F.lit("SPEAKER_F"), file_index.cast("string"), F.lit("_")))


def three_decimals(seconds: Column) -> Column:
    """Seconds with three decimals, rounded by their exact binary value and halves to the even digit, as ``%.3f`` of C and Python does.

    Java's formatter rounds the shortest decimal text instead, halves up. For less than a thousand million seconds.
    """
    x = F.abs(seconds)
    whole = F.floor(x)
    # thousandths in units of 2^-52, and what is finer, which only values below one have
    scaled = (x - whole) * float(1 << 52)
    finer = (scaled - F.floor(scaled)) * 1000
    milli = F.floor(scaled) * F.lit(1000) + F.floor(finer)
    low, rest = F.shiftright(milli, 52), milli.bitwiseAND(F.lit((1 << 52) - 1))
    half = F.lit(1 << 51)
    up = (rest > half) | ((rest == half) & ((finer > F.floor(finer)) | (low % 2 == 1)))
    total = whole * 1000 + low + up.cast("long")
    return F.concat(F.when(seconds < 0, "-").otherwise(""), F.floor(total / 1000).cast("string"), F.lit("."), F.lpad((total % 1000).cast("string"), 3, "0"))
