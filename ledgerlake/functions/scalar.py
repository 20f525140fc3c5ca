"""F*: scalar functions as built-in Column expressions (no Python UDFs).

All of these stay JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units and the thresholds of the text size format
# (below 10240 bytes print bytes; each larger unit is chosen while the
# half-unit count stays below 20479, then rounded half up).
SIZE_UNITS = ["kB", "MB", "GB", "TB", "PB"]
BYTES_LIMIT = 10240
HALF_UNIT_LIMIT = 20479


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def size_pretty(b) -> Column:
    """human readable size of a byte count (``8192 bytes``, ``40 kB``, ``65 MB``)."""
    b = _c(b).cast("long")
    expr = F.when(b.isNull(), F.lit(None).cast("string"))
    expr = expr.when(F.abs(b) < BYTES_LIMIT, F.concat(b.cast("string"), F.lit(" bytes")))
    shift = 9
    for i, unit in enumerate(SIZE_UNITS):
        half = F.shiftright(b, shift)
        rounded = F.shiftright(half + F.lit(1), 1)
        if i < len(SIZE_UNITS) - 1:
            expr = expr.when(F.abs(half) < HALF_UNIT_LIMIT,
                             F.concat(rounded.cast("string"), F.lit(" " + unit)))
        else:
            expr = expr.otherwise(F.concat(rounded.cast("string"), F.lit(" " + unit)))
        shift += 10
    return expr


def size_pretty_sql(x: str) -> str:
    """The same ladder as SQL text (used by oracle queries and SQL views)."""
    parts = [f"WHEN ({x}) IS NULL THEN NULL",
             f"WHEN abs({x}) < {BYTES_LIMIT} THEN CAST({x} AS VARCHAR) || ' bytes'"]
    shift = 9
    for i, unit in enumerate(SIZE_UNITS):
        val = f"CAST(((({x}) >> {shift}) + 1) >> 1 AS VARCHAR) || ' {unit}'"
        if i < len(SIZE_UNITS) - 1:
            parts.append(f"WHEN abs(({x}) >> {shift}) < {HALF_UNIT_LIMIT} THEN {val}")
        else:
            parts.append(f"ELSE {val}")
        shift += 10
    return "(CASE " + " ".join(parts) + " END)"


def rate_pretty(bytes_per_s) -> Column:
    """F16: ``1373 kB/s``."""
    return F.concat(size_pretty(bytes_per_s), F.lit("/s"))


def lsn_to_long(lsn) -> Column:
    """log position text ``hi/lo`` (hex) to a byte offset."""
    parts = F.split(_c(lsn), "/")
    hi = F.conv(parts.getItem(0), 16, 10).cast("long")
    lo = F.conv(parts.getItem(1), 16, 10).cast("long")
    return F.shiftleft(hi, 32) + lo


def long_to_lsn(x) -> Column:
    """Inverse of ``lsn_to_long``: upper-case hex without padding."""
    x = _c(x).cast("long")
    return F.concat(F.upper(F.hex(F.shiftright(x, 32))), F.lit("/"),
                    F.upper(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))))


def coalesce_text(c, default: str, fmt: str | None = "yyyy-MM-dd HH:mm:ss") -> Column:
    """``COALESCE(col::text, 'default')``; timestamps use an explicit format."""
    c = _c(c)
    txt = F.date_format(c, fmt) if fmt else c.cast("string")
    return F.coalesce(txt, F.lit(default))


def idiv(a, b) -> Column:
    """Integer division ``a div b`` for a >= 0, b > 0, exact: the remainder is
    removed first, so the decimal quotient is integral before the cast."""
    a, b = _c(a).cast("decimal(38,0)"), _c(b).cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("long")


def ratio_pct(part, whole) -> Column:
    """F8: ``trunc(100 * part / (whole + 1))::float`` with integer division first."""
    return idiv(F.lit(100) * _c(part), _c(whole) + F.lit(1)).cast("double")


def day(ts, zone: str | None = None) -> Column:
    """``date_trunc('day', ts)`` as a date, in an explicit zone for zoned timestamps."""
    ts = _c(ts)
    if zone:
        ts = F.from_utc_timestamp(ts.cast("timestamp"), zone)
    return F.to_date(ts)


_NEEDS_QUOTES = r'(^$)|[\s,()"\\]'


def row_text(*cols) -> Column:
    """whole-row text ``(v1,v2,...)``; NULL prints as nothing, values with
    blanks, commas, parentheses, quotes or backslashes are double-quoted."""
    out = []
    for c in cols:
        v = _c(c).cast("string")
        esc = F.regexp_replace(F.regexp_replace(v, r"\\", r"\\\\"), '"', '""')
        quoted = F.when(v.rlike(_NEEDS_QUOTES), F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(v)
        out.append(F.coalesce(quoted, F.lit("")))
    return F.concat(F.lit("("), F.concat_ws(",", *out), F.lit(")"))


def md5_text(c) -> Column:
    """F4."""
    return F.md5(_c(c).cast("string"))


def trim_bpchar(c) -> Column:
    """bpchar values compare ignoring trailing blanks: strip them on load."""
    return F.rtrim(_c(c))
