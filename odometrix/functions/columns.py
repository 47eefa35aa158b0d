"""Scalar column helpers.

All of them return built-in Spark expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# The text layouts the raw writers use.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def make_label(*cols: ColumnOrName, sep: str = " ") -> Column:
    """``CONCAT(a, sep, b, ...)``: NULL as soon as any part is NULL.

    ``concat_ws`` would silently skip NULL parts; the label must not.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)


def trunc_int(c: ColumnOrName) -> Column:
    """``CAST(x AS INT)``: truncates toward zero (7.9 -> 7, -7.9 -> -7)."""
    return _col(c).cast("int")


def nan_to_null(c: ColumnOrName) -> Column:
    """Turn a floating NaN into NULL so that it neither poisons a mean nor
    compares greater than every number."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def flag_is_set(df: DataFrame, name: str) -> Column:
    """True where a 0/1 flag column is set, whatever its type.

    Numbers compare with 1, booleans are themselves, strings accept
    ``'1'`` and ``'true'`` (any case, surrounding blanks ignored).
    A NULL flag is never set.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c == 1, F.lit(False))
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true"), F.lit(False))


def parse_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text to timestamp; malformed text gives NULL instead of failing the job."""
    c = _col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def parse_date(c: ColumnOrName, fmt: str = DATE_FORMAT) -> Column:
    """Text to date; malformed text gives NULL."""
    return F.try_to_date(_col(c), fmt) if hasattr(F, "try_to_date") else F.to_date(_col(c), fmt)


def as_timestamp(df: DataFrame, name: str) -> Column:
    """``TO_TIMESTAMP(col)`` for text columns; timestamp columns pass through
    unchanged (a ``timestamp_ntz`` stays NTZ)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return parse_timestamp(name)
    if isinstance(dtype, T.DateType):
        return F.col(name).cast("timestamp")
    return F.col(name)


def truncate_time(df: DataFrame, name: str, unit: str) -> Column:
    """Truncate a timestamp (or timestamp text) to ``hour``, ``day``,
    ``week``, ``month`` or ``year``, keeping its type.

    A ``timestamp_ntz`` is truncated on its wall-clock fields, with no time
    zone involved, so the result is the same in every session zone (a
    round trip through a zoned timestamp would move wall-clock hours that do
    not exist in a DST zone). Zoned timestamps use ``date_trunc`` in the
    session zone.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        c = F.col(name)
        if unit == "hour":
            return F.make_timestamp_ntz(
                F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0)
            )
        if unit == "day":
            return F.to_date(c).cast("timestamp_ntz")
        return F.trunc(F.to_date(c), unit).cast("timestamp_ntz")
    return F.date_trunc(unit, as_timestamp(df, name))


def hour_of(df: DataFrame, name: str) -> Column:
    """Truncate a timestamp (or timestamp text) to the hour, keeping its type."""
    return truncate_time(df, name, "hour")


def shift_time(c: ColumnOrName, *, weeks: int = 0, days: int = 0, hours: int = 0) -> Column:
    """Timestamp plus whole weeks, days and hours (a ``timestamp_ntz`` stays NTZ)."""
    return _col(c) + F.make_dt_interval(days=F.lit(weeks * 7 + days), hours=F.lit(hours))


def shift_date(c: ColumnOrName, *, weeks: int = 0, days: int = 0) -> Column:
    """Date plus whole weeks and days."""
    return F.date_add(_col(c), weeks * 7 + days)


def format_id(prefix: str, n: ColumnOrName, width: int = 5) -> Column:
    """Zero-padded identifiers such as ``V00001`` or ``D_00001``."""
    return F.format_string(f"{prefix}%0{width}d", _col(n))


def timestamp_text(c: ColumnOrName, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Timestamp or date to text in the raw writers' layout."""
    return F.date_format(_col(c), fmt)


def round_half_even(c: ColumnOrName, scale: int = 0) -> Column:
    """Python's ``round``: half to even (``round(85000, -4) == 80000``)."""
    return F.bround(_col(c), scale)


def clamp_min(c: ColumnOrName, floor: float = 0.0) -> Column:
    """``max(x, floor)``; a NULL input stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation that is NULL, not an error or NaN, for a constant
    column or a single row: ``covar_pop / (stddev_pop(x) * stddev_pop(y))``
    guarded by both standard deviations being positive."""
    x, y = nan_to_null(x), nan_to_null(y)
    both = F.when(x.isNotNull() & y.isNotNull(), F.lit(True))
    xs, ys = F.when(both, x), F.when(both, y)
    sx, sy = F.stddev_pop(xs), F.stddev_pop(ys)
    return F.when((sx > 0) & (sy > 0), F.covar_pop(xs, ys) / (sx * sy))

