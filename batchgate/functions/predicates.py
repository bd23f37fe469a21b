"""Row predicates used by the rules, the audit and the valid/invalid split.

Every builder returns a ``Column`` that is TRUE exactly when the row *fails*,
and never NULL: three-valued logic is folded with an explicit NOT NULL guard
and ``coalesce(.., false)``, so predicates can be OR-ed per row and counted
with ``count_if`` in one aggregate.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_
from typing import Any, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a value is "numeric only" when it is one or more ASCII digits.
# \z (end of input) rather than $, which in Java also matches before a final
# line break and would let "12\n" pass.
DIGITS_ONLY = r"^[0-9]+\z"

# A plain decimal number, as a range rule reads it from text.
NUMBER_ONLY = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def is_null(c: str | Column) -> Column:
    return _col(c).isNull()


def not_null(c: str | Column) -> Column:
    return _col(c).isNotNull()


def any_null(cols: Iterable[str | Column]) -> Column:
    """TRUE when any of the columns is NULL (FALSE for an empty list)."""
    preds = [_col(c).isNull() for c in cols]
    return reduce(or_, preds) if preds else F.lit(False)


def any_true(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(or_, preds) if preds else F.lit(False)


def _bound(b: Any) -> Column:
    """A bound as a literal; whole numbers beyond a bigint as decimals."""
    return F.lit(Decimal(b) if isinstance(b, int) and not isinstance(b, bool) and abs(b) >= 2 ** 63 else b)


def _bounded(value: Column, lo: Any, hi: Any) -> Column | None:
    parts = []
    if lo is not None:
        parts.append(value < (lo if isinstance(lo, Column) else _bound(lo)))
    if hi is not None:
        parts.append(value > (hi if isinstance(hi, Column) else _bound(hi)))
    return reduce(or_, parts) if parts else None


def length_outside(c: str | Column, lo: int | None, hi: int | None,
                   dtype: T.DataType | None = None) -> Column:
    """Non-NULL values whose character length is below ``lo`` or above ``hi``.

    No bound at all matches nothing.
    """
    col = _col(c)
    text = col if dtype is None or isinstance(dtype, (T.StringType, T.BinaryType)) else col.cast("string")
    cond = _bounded(F.length(text), lo, hi)
    if cond is None:
        return F.lit(False)
    return null_safe(col.isNotNull() & cond)


def not_digits(c: str | Column) -> Column:
    """Non-NULL values that, as text, are not all ASCII digits ('' fails)."""
    col = _col(c)
    return null_safe(col.isNotNull() & ~col.cast("string").rlike(DIGITS_ONLY))


def not_in(c: str | Column, values: Iterable[Any]) -> Column:
    """Non-NULL values outside the allowed list; NULLs in the list are ignored."""
    col = _col(c)
    allowed = [v for v in values if v is not None]
    if not allowed:
        return col.isNotNull()
    return null_safe(col.isNotNull() & ~col.isin(allowed))


def outside_range(c: str | Column, lo: Any, hi: Any, dtype: T.DataType | None = None) -> Column:
    """Non-NULL values below ``lo`` or above ``hi`` (bounds inclusive).

    A text column compared with numeric bounds must hold a plain decimal number
    (sign, digits, point, exponent); any other text ('5d', 'NaN') fails. Numbers
    are compared exactly as DECIMAL(38, 18); those beyond its 20 integer digits
    as doubles, where no such bound is near.
    """
    col = _col(c)
    numeric_bounds = all(isinstance(b, (int, float, Decimal)) for b in (lo, hi) if b is not None)
    if isinstance(dtype, T.StringType) and numeric_bounds:
        bounds = [None if b is None else Decimal(str(b)) for b in (lo, hi)]
        loose = _bounded(col.try_cast("double"), lo, hi)
        if loose is None:
            return F.lit(False)
        exact_ok = all(b is None or (b.is_finite() and abs(b) < 10 ** 20) for b in bounds)
        value = col.try_cast("decimal(38,18)")
        exact = _bounded(value, *[None if b is None else F.lit(b).cast("decimal(38,18)") for b in bounds]) if exact_ok else loose
        cond = F.when(value.isNotNull(), exact).otherwise(loose) if exact_ok else loose
        return null_safe(col.isNotNull() & (~col.rlike(NUMBER_ONLY) | cond))
    if dtype is not None and not isinstance(dtype, _NUMERIC + (T.StringType,)):
        lo = None if lo is None else F.lit(lo).cast(dtype)
        hi = None if hi is None else F.lit(hi).cast(dtype)
        parts = [p for p in ((col < lo) if lo is not None else None,
                             (col > hi) if hi is not None else None) if p is not None]
        if not parts:
            return F.lit(False)
        return null_safe(col.isNotNull() & reduce(or_, parts))
    cond = _bounded(col, lo, hi)
    if cond is None:
        return F.lit(False)
    return null_safe(col.isNotNull() & cond)


def check_violated(expression: str | Column) -> Column:
    """Rows for which a CHECK-style condition is FALSE (NULL passes)."""
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return null_safe(~cond)
