"""Text-to-value parsing as native Column expressions (no Python UDFs).

Packet fields travel as text.  Under ANSI a bad ``CAST`` fails the whole
query, so every parse here is a ``try_*`` form: bad input becomes NULL and
the row can be routed to quarantine instead of killing a stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_int(x: ColumnOrName) -> Column:
    """Plain base-10 text to INT; anything else (or overflow) is NULL."""
    return _c(x).try_cast("int")


# Digits allowed after each base prefix.  Fixed values.
_BASES = {"0x": (16, "0123456789abcdef"), "0o": (8, "01234567"), "0b": (2, "01")}
_DEC_DIGITS = "0123456789"


def _only(digits: Column, allowed: str) -> Column:
    """Non-empty and made only of ``allowed`` characters (no regex)."""
    return (F.length(digits) > 0) & (F.length(F.translate(digits, allowed, "")) == 0)


def let(value: Column, body) -> Column:
    """Evaluate ``body(v)`` with ``v`` bound to ``value`` once.

    Catalyst copies a sub-expression into every place that uses it (and a
    filter pushed below a projection copies the projection again), so a
    parse that reads its input ten times grows the generated code tenfold per
    level.  A one-element ``transform`` binds the input to a lambda variable
    instead."""
    return F.get(F.transform(F.array(value), body), 0)


def prefixed_int(x: ColumnOrName) -> Column:
    """Integer text with an optional base prefix, like a base-0 integer parse.

    ``"172"`` -> 172, ``"0x1f"`` -> 31, ``"0o17"`` -> 15, ``"0b101"`` -> 5,
    ``"1_000"`` -> 1000, ``"007"`` / ``"abc"`` / NULL -> NULL.  Surrounding
    blanks are ignored; values outside INT range are NULL.

    Canonical decimal text (what the integer prints back as) is handled by
    compiled expressions; only other text reaches :func:`_prefixed_int_slow`,
    bound once through :func:`let`.
    """
    s = F.trim(_c(x))
    fast = s.try_cast("int")
    canonical = fast.isNotNull() & (fast.cast("string") == s)
    return F.when(canonical, fast).otherwise(let(s, _prefixed_int_slow))


def _prefixed_int_slow(s: Column) -> Column:
    """Sign, underscores, leading-zero and base-prefix forms, with plain string
    functions only."""
    neg = s.startswith("-")
    sign = F.when(neg, F.lit("-")).otherwise(F.lit(""))
    body = F.lower(F.when(neg | s.startswith("+"), F.substring(s, 2, 1 << 20)).otherwise(s))

    def from_body(b: Column) -> Column:
        underscores_ok = ~b.contains("__") & ~b.endswith("_") & ~b.startswith("_")
        dec = F.replace(b, F.lit("_"), F.lit(""))
        all_zero = _only(dec, "0")
        dec_ok = _only(dec, _DEC_DIGITS) & (~dec.startswith("0") | all_zero)
        prefix = F.substring(b, 1, 2)
        digits = F.replace(F.substring(b, 3, 1 << 20), F.lit("_"), F.lit(""))
        based = None
        for pfx, (base, allowed) in _BASES.items():
            val = F.when((prefix == pfx) & _only(digits, allowed), F.conv(digits, base, 10))
            based = val if based is None else F.coalesce(based, val)
        text = F.when(dec_ok, F.when(all_zero, F.lit("0")).otherwise(dec)).otherwise(based)
        return F.when(underscores_ok, text)

    return F.concat(sign, let(body, from_body)).try_cast("int")


def layer_int(layer: ColumnOrName, field: str) -> Column:
    """A numeric feature from a protocol layer: an absent layer counts as 0,
    a present layer with a missing or unparsable field gives NULL."""
    lay = _c(layer)
    return F.when(lay.isNull(), F.lit(0)).otherwise(prefixed_int(lay.getField(field)))


def epoch_ms_text_to_time(x: ColumnOrName) -> Column:
    """Epoch-millisecond text -> TIMESTAMP (sub-second part kept); bad text -> NULL."""
    return F.timestamp_millis(_c(x).try_cast("bigint"))


def format_epoch_ms(x: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch-millisecond text -> formatted time in the session zone, to the second."""
    secs = F.floor(_c(x).try_cast("bigint") / F.lit(1000))
    return F.date_format(F.timestamp_seconds(secs), fmt)


def iso_nanos_to_time(x: ColumnOrName) -> Column:
    """ISO-8601 text such as ``2024-06-19T17:52:47.871967020Z`` -> TIMESTAMP.

    The zone suffix is honoured (not treated as a literal ``Z``); nanoseconds
    truncate to microseconds.
    """
    s = _c(x)
    # Keep at most 6 fractional digits so the cast accepts it.
    trimmed = F.regexp_replace(s, r"(\.[0-9]{6})[0-9]+", "$1")
    return trimmed.try_cast("timestamp")


# tshark's text date, e.g. "Feb  1 2020 03:19:45.377844893 " (day padded with a
# blank) or "Feb 11 2020 03:19:45.377844893 ".  Fixed values.
TSHARK_PATTERNS = ("MMM  d yyyy HH:mm:ss.SSSSSS", "MMM d yyyy HH:mm:ss.SSSSSS")


def tshark_time(x: ColumnOrName) -> Column:
    """tshark text date (one or two digit day, nanoseconds, trailing blank) -> TIMESTAMP."""
    s = F.regexp_replace(F.rtrim(_c(x)), r"(\.[0-9]{6})[0-9]+$", "$1")
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in TSHARK_PATTERNS])


def epoch_seconds(x: ColumnOrName) -> Column:
    """TIMESTAMP -> epoch seconds (BIGINT)."""
    return F.unix_timestamp(_c(x))


def fill_zero(x: ColumnOrName) -> Column:
    return F.coalesce(_c(x), F.lit(0))
