"""Recoding and labelling of coded answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def binary_flag(source: str, yes: int, no: int) -> Column:
    """Three-valued recode: ``yes`` → 1, ``no`` → 0, any other code → NULL."""
    code = F.col(source)
    return F.when(code == yes, F.lit(1)).when(code == no, F.lit(0))


def additive_score(flags: Sequence[str]) -> Column:
    """Sum of flags; NULL as soon as one flag is NULL."""
    return reduce(add, (F.col(name) for name in flags))


def code_label(code: Column, labels: Mapping[int, str]) -> Column:
    """Text of a code from a fixed dictionary; unknown codes give NULL.

    The dictionary becomes a literal in the plan, so no join is needed.
    """
    first, *others = labels.items()
    text = F.when(code == first[0], F.lit(first[1]))
    for value, label in others:
        text = text.when(code == value, F.lit(label))
    return text
