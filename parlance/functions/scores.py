"""Edit distances and error rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions.distances import list_edits, text_edits
from parlance.functions.text import tokens

#: Cells of the table of distances up to which the built-in distance is the faster one.
CELLS = 1 << 18


def char_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance in code points: built in for short texts, bit-parallel rows for long ones."""
    long = F.length(a).cast("long") * F.length(b) > CELLS
    return F.when(long, text_edits(F.when(long, a), F.when(long, b)).cast("int")).otherwise(F.levenshtein(F.when(~long, a), F.when(~long, b)))


def word_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over white-space separated words."""
    return list_edits(tokens(a), tokens(b))


def _rate(distance: Column, size: Column, empty: Column, rule: str) -> Column:
    if rule == "floor":
        return distance / F.greatest(size, F.lit(1))
    return F.when(size == 0, F.when(empty, 0.0).otherwise(1.0)).otherwise(distance / size)


def cer(pred: Column, ref: Column, rule: str = "floor") -> Column:
    """Character error rate. rule: ``floor`` divides by one at least; ``unit`` gives 0 or 1 for an empty reference."""
    return _rate(char_distance(pred, ref), F.length(ref), F.length(pred) == 0, rule)


def wer(pred: Column, ref: Column, rule: str = "floor") -> Column:
    return _rate(word_distance(pred, ref), F.size(tokens(ref)), F.size(tokens(pred)) == 0, rule)


def pct(value: Column, digits: int = 1) -> Column:
    """A share as rounded per cent. Rounds halves up, as SQL does, where a binary float would go to even."""
    return F.round(value * 100, digits)


def pct_even(value: Column, digits: int = 1) -> Column:
    """A share as per cent, rounded by the binary value's own digits, exact halves to even.

    How far the value is above the half between two results is summed over powers of two, the largest first; every
    one of these sums is exact in a double.
    """
    x = value * 100
    low = F.floor(x * 10**digits)
    above = -(2 * low + 1).cast("double")
    for bit in range((2 * 10**digits).bit_length() - 1, -1, -1):
        if 2 * 10**digits >> bit & 1:
            above = above + x * float(1 << bit)
    up = (above > 0) | ((above == 0) & (low % 2 == 1))
    return (low + up.cast("long")) / 10**digits
