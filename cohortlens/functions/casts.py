"""Casts that never fail: what cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import types as T


def lenient(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast ``col`` of type ``source`` to ``target`` without ANSI errors.

    Integers pass through double, so ``'3.0'`` gives 3 and ``'3.7'`` is cut
    toward zero; NaN, out-of-range values and text give NULL.
    """
    if source == target:
        return col
    if isinstance(source, T.NullType):
        return col.cast(target)
    if isinstance(target, T.IntegerType) and not isinstance(source, T.IntegralType):
        return col.try_cast("double").try_cast("int")
    return col.try_cast(target)
