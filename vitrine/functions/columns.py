"""Column-level helpers (all built-in expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine import constants as C


def pct(num: Column | str, den: Column | str, default: float) -> Column:
    """``den > 0 ? round(num / den * 100, 2) : default``."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, F.round(num / den * 100, 2)).otherwise(F.lit(float(default)))


def epoch_ms_to_ts(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def ts_to_epoch_ms(ts: Column | str) -> Column:
    """Epoch ms of a TIMESTAMP or TIMESTAMP_NTZ (NTZ is read as UTC)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def iso_utc(ms: Column | str) -> Column:
    """Epoch ms -> ISO-8601 UTC text as Python's ``datetime.isoformat()``
    prints it: seconds, then ``.ffffff`` only when the fraction is non-zero,
    then ``+00:00`` (F5)."""
    ms = _col(ms)
    frac = F.pmod(ms, F.lit(1000))
    base = F.date_format(epoch_ms_to_ts(ms), "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.when(frac == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(frac.cast("string"), 3, "0"), F.lit("000")))
    return F.concat(base, micros, F.lit("+00:00"))


def utc_date(ms: Column | str) -> Column:
    """UTC calendar date of an epoch-ms value, as ``yyyy-MM-dd`` text."""
    return F.date_format(epoch_ms_to_ts(ms), "yyyy-MM-dd")


def date_parts(ts: Column) -> list[Column]:
    """``year``/``month``/``day`` partition values, zero padded."""
    return [F.date_format(ts, "yyyy").alias("year"),
            F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day")]


def reverse_ts(ms: Column | str) -> Column:
    """Newest-first sort key: ``9999999999999 - t`` padded to 13 digits (O1)."""
    return F.lpad((F.lit(C.REVERSE_TS_BASE) - _col(ms)).cast("string"), 13, "0")


def row_key(*parts: Column | str) -> Column:
    """``A#B#C`` key composition (F4).  A NULL part stays visible, so keys that differ in it never meet."""
    return F.concat_ws("#", *[F.coalesce(_col(p).cast("string"), F.lit(C.NULL_KEY_PART)) for p in parts])


def non_blank(line: Column | str) -> Column:
    """``trim(line) != ''``."""
    return F.length(F.trim(_col(line))) > 0


def run_date(dt: str | None = None) -> str:
    """The run's ``dt``: the given value, else today's UTC date.
    Call it once a run and hand the value on: every table then carries the same."""
    if dt:
        return dt
    from datetime import datetime, timezone
    return datetime.now(timezone.utc).strftime("%Y-%m-%d")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
