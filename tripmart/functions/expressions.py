"""Column expressions whose meaning differs from the nearest Spark built-in.

All of them are built-in functions only, and none depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: characters after which a new word starts. The apostrophe is not among them.
WORD_BREAK = r"""(?<=[\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>])"""


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ns_to_ntz(ns: Column) -> Column:
    """Epoch nanoseconds to a zone-less timestamp (microsecond precision)."""
    micros = F.call_function("div", ns.cast("bigint"), F.lit(1000))
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def as_ntz(name: str, kind: T.DataType) -> Column:
    """Column ``name`` as zone-less timestamp, whichever way (``kind``) the raw layer holds it.

    Numbers are epoch nanoseconds; zoned timestamps are taken as their UTC reading.
    """
    if isinstance(kind, T.NumericType):
        return ns_to_ntz(F.col(name))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(name), _epoch())
    return F.col(name).cast("timestamp_ntz")


def _epoch_units(name: str, kind: T.DataType, seconds: int) -> str:
    """Whole units of ``seconds`` since the epoch, rounded down, in integer arithmetic.

    ``div`` truncates, so four centuries are added before it and taken off after it. The
    column is named once only: a filter on the result copies the expression.
    """
    micros = f"cast({name} AS bigint) div 1000"
    if isinstance(kind, T.TimestampType):
        micros = f"unix_micros({name})"
    unit = seconds * 1_000_000
    shift = 400 * 366 * 86_400 // seconds
    return f"(({micros}) + {shift * unit}L) div {unit}L - {shift}L"


def as_date(name: str, kind: T.DataType) -> Column:
    """Date of a raw time column; far cheaper on numbers than by way of a timestamp."""
    if isinstance(kind, T.TimestampNTZType | T.DateType | T.StringType):
        return F.to_date(F.col(name).cast("timestamp_ntz"))
    return F.expr(f"date_from_unix_date(cast({_epoch_units(name, kind, 86400)} AS int))")


def as_epoch_minute(name: str, kind: T.DataType) -> Column:
    """Minutes since the epoch of a raw time column, as BIGINT."""
    if isinstance(kind, T.TimestampNTZType | T.DateType | T.StringType):
        return epoch_minute(F.col(name).cast("timestamp_ntz"))
    return F.expr(_epoch_units(name, kind, 60))


def round_to_int(name: str, kind: T.DataType) -> Column:
    """Column ``name`` cast to int, rounded half away from zero; Spark's own cast truncates."""
    if isinstance(kind, T.IntegralType):
        return F.expr(f"cast({name} AS int)")
    return F.expr(f"cast(round(cast({name} AS double)) AS int)")


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def epoch_minute(ts: Column) -> Column:
    """Minutes since the epoch of a zone-less timestamp, as BIGINT."""
    return F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + minute_of_day(ts)


def minute_diff(start: Column, end: Column) -> Column:
    """Number of minute boundaries between two timestamps, as BIGINT.

    10:00:59 to 10:01:01 is 1 here, and 0 under ``timestampdiff``.
    """
    return epoch_minute(end) - epoch_minute(start)


def iso_weekday(ts: Column) -> Column:
    """1 = Monday … 7 = Sunday, of a date or timestamp."""
    return F.weekday(ts) + 1


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def initcap_words(text: Column) -> Column:
    """Title case in which punctuation starts a new word (``n/a`` becomes ``N/A``)."""
    words = F.split(F.lower(text), WORD_BREAK)
    return F.array_join(F.transform(words, F.initcap), "")


def speed_mph(distance: Column, minutes: Column) -> Column:
    """Miles per hour in double precision; NULL unless the duration is positive."""
    return F.try_divide(distance * F.lit(60.0), F.when(minutes > 0, minutes))


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL unless ``whole`` is positive."""
    return F.try_divide(part, F.when(whole > 0, whole)) * 100
