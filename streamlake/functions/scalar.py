"""Scalar column functions.

All of them return Column expressions, so they stay inside whole-stage
codegen and are usable from SQL through the same built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- money -----
def money(c, scale: int = 2) -> Column:
    """Exact decimal view of a currency column stored as double."""
    return col_(c).cast(f"decimal(15,{scale})")


def exact_sum(c, digits: int = 4) -> Column:
    """Order-independent sum: add exact decimals, return a double.

    Floating sums differ with the order of partial aggregates; a decimal
    sum gives the same value on every cluster layout.
    """
    return F.sum(col_(c).cast(f"decimal(18,{digits})")).cast("double")


def exact_avg(c) -> Column:
    """Order-independent average: exact decimal sum over the count."""
    return exact_sum(c) / F.count(col_(c))


def revenue(price="l_extendedprice", discount="l_discount") -> Column:
    """``price * (1 - discount)`` computed exactly (decimal(?,4))."""
    return money(price) * (F.lit(1) - money(discount))


# ---------------------------------------------------------------- strings ---
def substr(c, pos: int, length: int) -> Column:
    """1-based SQL SUBSTRING."""
    return F.substring(col_(c), pos, length)


def prefix_text(prefix: str, c) -> Column:
    """``"prefix" + value`` string formatting."""
    return F.concat(F.lit(prefix), col_(c).cast("string"))


def to_date_str(c, fmt: str = "yyyy-MM-dd") -> Column:
    """parse a date string."""
    return F.to_date(col_(c), fmt)


def ten_minute_bucket(ts) -> Column:
    """``SUBSTR(DATE_FORMAT(ts,'HH:mm'),1,4) || '0'`` (10-minute label)."""
    return F.concat(F.substring(F.date_format(col_(ts), "HH:mm"), 1, 4), F.lit("0"))


# ---------------------------------------------------------------- time ------
def epoch_millis_to_ts(c) -> Column:
    """epoch milliseconds (long) -> TIMESTAMP."""
    return F.timestamp_millis(col_(c))


def epoch_seconds_to_ts(c) -> Column:
    return F.timestamp_seconds(col_(c))


def format_ts_millis(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` text."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSS")


def time_diff_ms(a, b) -> Column:
    """``b - a`` in whole milliseconds (floor of the exact difference,
    like a duration's millisecond count)."""
    d = F.unix_micros(col_(b).cast("timestamp")) - F.unix_micros(col_(a).cast("timestamp"))
    return F.floor(d / 1000).cast("long")


def ts_to_string(c) -> Column:
    """Timestamp text with the fraction trimmed to its significant digits
    (at least one digit is kept, as ``java.sql.Timestamp.toString``)."""
    full = F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"(\.\d)(\d*?)0+$", "$1$2")


# ---------------------------------------------------------------- numbers ---
def in_box(lon, lat, lon_min: float, lon_max: float, lat_min: float,
           lat_max: float) -> Column:
    """Point inside a bounding box, bounds inclusive.

    Works for double, float and numeric-string inputs (the three overloads)
    because every input is cast to double first.
    """
    x = col_(lon).cast("double")
    y = col_(lat).cast("double")
    return x.between(lon_min, lon_max) & y.between(lat_min, lat_max)


# ---------------------------------------------------------------- address ---
def int_to_ip(c) -> Column:
    """32-bit integer address -> dotted quad (unsigned byte order)."""
    v = col_(c).cast("long")
    parts = [F.shiftrightunsigned(v, s).bitwiseAND(F.lit(255)).cast("string")
             for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *parts)


# ---------------------------------------------------------------- json ------
