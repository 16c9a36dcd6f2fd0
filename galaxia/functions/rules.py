"""Column rules (C1-C17) and row predicates.

Every rule is a ``Column -> Column`` function built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; the same function serves the full load
and the incremental batches, so the two paths cannot drift apart.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the cleaning rules (they must equal the reference's).
UNKNOWN = "unknown"              # default for city, category, order status
UNKNOWN_STATE = "UN"             # default for a state code that is not 2 characters
NOT_DEFINED = "Not Defined"      # default payment type
ZIP_WIDTH = 5                    # zip prefixes are left-padded with '0' to 5 characters
ID_LENGTH = 32                   # customer ids must have exactly 32 characters
CITY_MIN_LENGTH = 3              # shorter customer city names become 'unknown'
MIN_EVENT_TIME = "2016-01-01 00:00:00"   # earliest valid purchase / creation / shipping time


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal with microseconds, independent of the session
    time zone."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


# ---------------------------------------------------------------- C1 - C17
def clean_key(c: ColumnOrName) -> Column:
    """Trim then lower-case an id.  Blank stays '' (F2 removes it)."""
    return F.lower(F.trim(_c(c)))


def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text, '' -> NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def collapse_spaces(c: ColumnOrName) -> Column:
    """C4: every run of blanks becomes one blank."""
    return F.regexp_replace(_c(c), " +", " ")


def clean_city(c: ColumnOrName, min_len: int = 0) -> Column:
    """C2 + C4 + C5 (+ C7 when ``min_len``): lower, trimmed, one blank between
    words; missing, blank or too short -> 'unknown'."""
    t = collapse_spaces(F.lower(F.trim(_c(c))))
    bad = t.isNull() | (t == F.lit(""))
    if min_len:
        bad = bad | (F.length(t) < min_len)
    return F.when(bad, F.lit(UNKNOWN)).otherwise(t)


def clean_category(c: ColumnOrName) -> Column:
    """C2 + C5 for category names and status: lower, trimmed, default 'unknown'."""
    return F.coalesce(F.nullif(F.lower(F.trim(_c(c))), F.lit("")), F.lit(UNKNOWN))


def state_code(c: ColumnOrName) -> Column:
    """A 2-character code, upper-cased; anything else -> 'UN'."""
    t = F.trim(_c(c))
    return F.when(F.length(t) == 2, F.upper(t)).otherwise(F.lit(UNKNOWN_STATE))


def zip5(c: ColumnOrName) -> Column:
    """NULL -> 0, to text, left-padded to 5; longer values stay whole, so that no
    two zip codes become one (the reference keeps their left 5)."""
    z = F.coalesce(_c(c), F.lit(0)).cast("string")
    return F.when(F.length(z) < ZIP_WIDTH, F.lpad(z, ZIP_WIDTH, "0")).otherwise(z)


def nonpositive_to_null(c: ColumnOrName) -> Column:
    """C11: zero or negative measures are unknown."""
    c = _c(c)
    return F.when(c > 0, c)


def floor_at(c: ColumnOrName, v) -> Column:
    """NULL or below ``v`` -> ``v``."""
    c = _c(c)
    return F.when(c.isNull() | (c < F.lit(v)), F.lit(v)).otherwise(c)


def impute(c: ColumnOrName, value: Column) -> Column:
    """NULL -> the given (median) value."""
    return F.coalesce(_c(c), value)


def payment_type(c: ColumnOrName) -> Column:
    """C2 + C5 (D11): lower-case, then default 'Not Defined'."""
    return F.coalesce(F.nullif(F.lower(F.trim(_c(c))), F.lit("")), F.lit(NOT_DEFINED))


def to_money(c: ColumnOrName) -> Column:
    """Float -> decimal(18,2) (half-up)."""
    return _c(c).try_cast("decimal(18,2)")


# ---------------------------------------------------------------- ids on the move
def pack_id(c: ColumnOrName) -> Column:
    """An id as bytes for shuffles and intermediate files: 32 lower-case hex digits take
    17 bytes.  Any other text follows its place among the hex ids, so the bytes are
    different for different texts and sort as the texts do."""
    c = _c(c)
    # the rare texts are mapped in an array, which keeps their long rule out of the
    # generated code of the common case
    other = F.get(F.transform(F.array(c), _pack_other), F.lit(0))
    return F.coalesce(F.concat(_hex_bytes(c), F.lit(bytearray(b"\1"))), F.when(c.isNotNull(), other))


def _hex_bytes(c: Column) -> Column:
    """The bytes of 32 lower-case hex digits, NULL for any other text."""
    return F.unhex(F.when((F.length(c) == 32) & (F.lower(c) == c), c))


def _pack_other(c: Column) -> Column:
    head = F.regexp_extract(c, "^[0-9a-f]{0,32}", 0)
    after = F.substring(c.substr(F.length(head) + 1, F.lit(1)), 1, 1)
    fill = lambda text, digit: F.unhex(F.rpad(text, 32, digit))
    other = (F.when((after > "f") | (F.length(head) == 32) & (after != ""), F.concat(fill(head, "f"), F.lit(bytearray(b"\2"))))
              .when(after > "9", F.concat(fill(F.concat(head, F.lit("9")), "f"), F.lit(bytearray(b"\2"))))
              .otherwise(F.concat(fill(head, "0"), F.lit(bytearray(b"\0")))))
    return F.concat(other, c.cast("binary"))


def unpack_id(c: ColumnOrName) -> Column:
    """The text of :func:`pack_id`."""
    c = _c(c)
    return (F.when(F.substring(c, 17, 1) == F.lit(bytearray(b"\1")), F.lower(F.hex(F.substring(c, 1, 16))))
             .otherwise(F.substring(c, 18, 1 << 30).cast("string")))


def pack_key(c: ColumnOrName) -> Column:
    """An id as bytes for joins, where only equality counts: 16 bytes of 32 lower-case
    hex digits; any other text keeps its bytes behind 17 zeros, so none has 16."""
    c = _c(c)
    return F.coalesce(_hex_bytes(c), F.concat(F.lit(bytearray(17)), c.cast("binary")))


def unpack_key(c: ColumnOrName) -> Column:
    """The text of :func:`pack_key`."""
    c = _c(c)
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(F.substring(c, 18, 1 << 30).cast("string"))


# ---------------------------------------------------------------- F1 - F9
def not_blank(*cols: ColumnOrName) -> Column:
    """F1 + F2: every column is present and not blank after trimming."""
    return reduce(lambda a, b: a & b,
                  [F.nullif(F.trim(_c(c)), F.lit("")).isNotNull() for c in cols])


def not_null(*cols: ColumnOrName) -> Column:
    """F1."""
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols])


def has_length(c: ColumnOrName, n: int = ID_LENGTH) -> Column:
    """F3."""
    return F.length(_c(c)) == n


def in_time_range(c: ColumnOrName, lo, hi, keep_null: bool = False) -> Column:
    """``lo <= c <= hi``; a NULL passes only with ``keep_null``."""
    c = _c(c)
    ok = (c >= ts_lit(lo)) & (c <= ts_lit(hi))
    return (c.isNull() | ok) if keep_null else F.coalesce(ok, F.lit(False))


def in_range_or_null(c: ColumnOrName, lo, hi) -> Column:
    """``lo <= c <= hi`` or NULL."""
    c = _c(c)
    return c.isNull() | c.between(lo, hi)


def at_least(c: ColumnOrName, v, keep_null: bool = False) -> Column:
    """``c >= v`` (NULL dropped unless ``keep_null``)."""
    c = _c(c)
    return (c.isNull() | (c >= v)) if keep_null else F.coalesce(c >= v, F.lit(False))


def before_any(base: ColumnOrName, later: Iterable[ColumnOrName]) -> Column:
    """True when any of the ``later`` events happened before ``base``;
    comparisons with NULL count as fine."""
    base = _c(base)
    return reduce(lambda a, b: a | b,
                  [F.coalesce(_c(x) < base, F.lit(False)) for x in later])
