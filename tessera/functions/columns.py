"""Column-level building blocks.

All of these return Spark ``Column`` expressions built from
``pyspark.sql.functions``: they stay JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

_NUMERIC_FLOATS = (T.DoubleType, T.FloatType)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_string(df: DataFrame, name: str) -> bool:
    return isinstance(dtype_of(df, name), T.StringType)


def clean_id(df: DataFrame, name: str) -> Column:
    """Trim string identifiers (spaces only, as Spark ``trim``); keep typed ids."""
    c = F.col(name)
    return F.trim(c) if is_string(df, name) else c


def clean_upper(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.upper(F.trim(c)) if is_string(df, name) else c.cast("string")


def clean_lower(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.lower(F.trim(c)) if is_string(df, name) else c.cast("string")


def clean_text(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.trim(c) if is_string(df, name) else c.cast("string")


def to_int(df: DataFrame, name: str, target: str = "int") -> Column:
    """Typed integer; a malformed string becomes NULL (counted by DQ rules)."""
    c = F.col(name)
    if is_string(df, name):
        return F.trim(c).try_cast(target)
    return c.cast(target)


def to_double(df: DataFrame, name: str) -> Column:
    return to_int(df, name, "double")


def cents(c: Column) -> Column:
    """Round a floating amount to integer cents (HALF_UP on the binary value).

    ``round(x * 100)`` gives the same result in Spark and in SQL engines that
    round half away from zero; a direct double->decimal cast does not
    (Spark casts through the shortest decimal string, e.g. 1.005 -> 1.01).
    """
    return F.round(c * F.lit(100.0)).cast("long")


def money_from_cents(c: Column) -> Column:
    """Integer cents as decimal(18,2). Multiplying by an exact decimal 0.01 is
    exact and much cheaper than a decimal division per row."""
    return (c.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast(MONEY)


def to_money(df: DataFrame, name: str) -> Column:
    """Exact money as decimal(18,2) from string, float or decimal input."""
    dt = dtype_of(df, name)
    c = F.col(name)
    if isinstance(dt, T.StringType):
        return F.trim(c).try_cast(MONEY)
    if isinstance(dt, _NUMERIC_FLOATS):
        return money_from_cents(cents(c))
    return c.cast(MONEY)


def to_ts(df: DataFrame, name: str) -> Column:
    """Wall-clock timestamp from string (NULL on bad input, no session zone involved) or typed values as they are."""
    dt = dtype_of(df, name)
    c = F.col(name)
    if isinstance(dt, T.StringType):
        return F.trim(c).try_cast("timestamp_ntz")
    if isinstance(dt, T.DateType):
        return c.cast("timestamp_ntz")
    return c


def date_key(c: Column) -> Column:
    """yyyyMMdd integer key of a date/timestamp, by arithmetic (no formatting)."""
    d = F.to_date(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def surrogate_key(c: Column) -> Column:
    """Deterministic 64-bit key; NULL natural key -> NULL (xxhash64(NULL) is 42)."""
    return F.when(c.isNotNull(), F.xxhash64(c))


def is_late(delivered: Column, estimate: Column) -> Column:
    """One named lateness predicate: strictly after the estimate."""
    return delivered > estimate


def rounded_ratio(numer: Column, denom: Column, scale: int = 100) -> Column:
    """round(scale * numer / denom, 2) computed exactly on integers.

    HALF_UP (away from zero) on the exact rational value: basis points are
    ``(2*100*scale*|a| + b) div (2*b)``, the sign restored afterwards. Gives the
    same value in every engine, unlike rounding a floating quotient. NULL when
    the denominator is NULL or 0 (instead of a DIVIDE_BY_ZERO error).
    """
    a = numer.cast("decimal(38,0)")
    b = denom.cast("decimal(38,0)")
    x = F.abs(a) * F.lit(200 * scale) + b
    y = b * 2
    # exact integer division on decimals: (x - x mod y) / y has no remainder
    basis = ((x - x % y) / y).cast("long")
    signed = F.when(a < 0, -basis).otherwise(basis)
    return F.when(b > 0, signed / F.lit(100.0))


def pct(numer: Column, denom: Column) -> Column:
    """Percentage rounded to 2 decimals: round(100 * a / b, 2)."""
    return rounded_ratio(numer, denom, 100)


def ratio2(numer: Column, denom: Column) -> Column:
    """Ratio rounded to 2 decimals: round(a / b, 2)."""
    return rounded_ratio(numer, denom, 1)


def money_double(c: Column) -> Column:
    """Decimal money as DOUBLE for reports (exact decimal -> nearest double)."""
    return c.cast("double")
