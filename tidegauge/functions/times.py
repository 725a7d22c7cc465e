"""Dates and times. Stored timestamps carry no zone and are read as UTC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions import as_col

# --- fixed values: date formats ---------------------------------------------
ISO_DATE_TEXT = "^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
LONG_DATE = "MMMM dd, yyyy"
SHORT_DATE = "MMM dd"
TOKEN_TEXT = "{date_short} {time}"
SATURDAY = 5  # Monday is 0

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def from_epoch_micros(micros: str | Column) -> Column:
    """Microseconds since 1970 as a zone-less UTC timestamp, in any session zone."""
    seconds = as_col(micros).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    step = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.expr(_EPOCH) + step


def to_epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a zone-less UTC timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), as_col(ts))


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a zone-less UTC timestamp."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), as_col(ts))


def parse_date(text: str | Column) -> Column:
    """Year-month-day text as a date, null for anything else."""
    text = as_col(text)
    return F.when(text.rlike(ISO_DATE_TEXT), F.try_to_date(text, "y-M-d"))


def iso_text(ts: str | Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss UTC` of a zone-less timestamp."""
    ts = as_col(ts)
    day = ts.cast("date").cast("string")
    clock = [F.lpad(part(ts).cast("string"), 2, "0") for part in (F.hour, F.minute)]
    second = F.lpad(F.floor(F.extract(F.lit("SECOND"), ts)).cast("string"), 2, "0")
    return F.concat(day, F.lit(" "), F.concat_ws(":", *clock, second), F.lit(" UTC"))


def date_token(ts: str | Column) -> Column:
    """Chat date mark-up: epoch, display pattern and a fallback text."""
    return F.concat(
        F.lit("<!date^"),
        epoch_seconds(ts).cast("string"),
        F.lit(f"^{TOKEN_TEXT}|"),
        iso_text(ts),
        F.lit(">"),
    )


def long_date(day: str | Column) -> Column:
    return F.date_format(as_col(day), LONG_DATE)


def short_date(day: str | Column) -> Column:
    return F.date_format(as_col(day), SHORT_DATE)


def is_saturday(day: str | Column) -> Column:
    return F.weekday(as_col(day)) == SATURDAY


def in_trailing_days(ts: str | Column, as_of: str | Column, days: int) -> Column:
    """True from midnight `days` days before `as_of` on."""
    return as_col(ts) >= F.date_sub(as_col(as_of), days).cast("timestamp_ntz")


@dataclass(frozen=True)
class Band:
    start: Column
    end: Column
    label_at: Column


def weekend_band(day: str | Column) -> Band:
    """The shaded band around the weekend that starts on the given Saturday."""
    midnight = as_col(day).cast("date").cast("timestamp_ntz")

    def shifted(hours: int) -> Column:
        return F.when(is_saturday(day), midnight + F.make_dt_interval(hours=F.lit(hours)))

    return Band(start=shifted(-12), end=shifted(36), label_at=shifted(12))


def seconds_of_day(ts: str | Column) -> Column:
    """Seconds since midnight, with the fraction."""
    ts = as_col(ts)
    seconds = F.extract(F.lit("SECOND"), ts).cast("double")
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + seconds


def axis_labels(start: str | Column, end: str | Column, count: str | Column) -> Column:
    """`count` evenly spaced MM:SS labels from start to end (seconds), as an array."""
    start, end, count = as_col(start), as_col(end), as_col(count)
    step = (end - start) / F.when(count > 1, count - 1).otherwise(1)

    def label(i: Column) -> Column:
        at = start + i * step
        minutes = F.floor(at / 60).cast("int")
        seconds = F.floor(at - F.floor(at / 60) * 60).cast("int")
        return F.format_string("%02d:%02d", minutes, seconds)

    return F.transform(F.sequence(F.lit(0), count - 1), label)
