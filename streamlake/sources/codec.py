"""Binary event codec as column expressions.

Layout: 8 bytes, little-endian int32 source address then little-endian
int32 event-type ordinal.  Encoding and decoding stay JVM-side (hex
string shuffling), no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event types in ordinal order.
EVENT_TYPES = ["a", "b", "c", "d", "e", "f", "g"]


def _le_hex(v: Column) -> Column:
    h = F.lpad(F.hex(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
    return F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))


def _from_le_hex(h: Column) -> Column:
    be = F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))
    u = F.conv(be, 16, 10).cast("long")
    return F.when(u >= 2 ** 31, u - 2 ** 32).otherwise(u).cast("int")


def encode_event(address, event_type) -> Column:
    """(address int, type letter) -> 8-byte binary."""
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    ordinal = F.array_position(types, event_type) - 1
    return F.unhex(F.concat(_le_hex(address), _le_hex(ordinal)))


def decode_address(b) -> Column:
    """Source address from the first 4 bytes."""
    return _from_le_hex(F.substring(F.hex(b), 1, 8))


def decode_type(b) -> Column:
    """Event-type letter from bytes 5-8."""
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    return F.element_at(types, _from_le_hex(F.substring(F.hex(b), 9, 8)) + 1)
