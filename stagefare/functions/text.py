"""Lists written as text: ``['A']``, ``['NaN', 70]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a list of exactly one single-quoted element.
SINGLE_ITEM = r"\['([^']+)'\]"

# What a cast of text to int reads: a sign, digits, and a fraction that it cuts.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_list_item(col: Column | str, mode: str = "strict_single") -> Column:
    """Text of a one-element list.

    ``strict_single`` gives ``''`` for every other list (several elements, none,
    double quotes) and null for null. ``first`` takes the first quoted element
    of any list, whichever quote it uses, and ``''`` if there is none.
    """
    c = _col(col)
    if mode == "strict_single":
        return F.regexp_extract(c, SINGLE_ITEM, 1)
    if mode == "first":
        single = F.regexp_extract(c, r"^\s*\[\s*'([^']+)'", 1)
        double = F.regexp_extract(c, r'^\s*\[\s*"([^"]+)"', 1)
        return F.when(single != "", single).otherwise(double)
    raise ValueError(f"unknown mode {mode!r}")


def to_int(col: Column | str) -> Column:
    """Text to int; ``7.0`` gives 7, anything unreadable or out of range null.

    Only a sign, digits and a fraction are read: ``1e3``, ``70d`` and ``0x1p3`` are no ints. Read as
    a double, which holds every int exactly: a failed ``try_cast`` costs far more than one that
    succeeds, and counts often stand as ``7.0``. Columns that are numbers already are cast.
    """
    c = _col(col)
    plain = c.cast("string").rlike(PLAIN_NUMBER) | (F.typeof(c) != "string")
    return F.when(plain, c.try_cast("double")).try_cast("int")


def first_number_in_list(col: Column | str) -> Column:
    """First element of a list that is neither ``NaN`` nor blank, as an int.

    The element keeps its quotes, so ``['70']`` is null while ``['NaN', 70]`` is 70.
    """
    items = F.split(F.translate(_col(col), "[]", ""), ",")
    usable = F.filter(items, lambda v: ~F.trim(F.translate(v, "'", "")).isin("NaN", ""))
    return to_int(F.try_element_at(usable, F.lit(1)))


def strip_list_marks(col: Column | str) -> Column:
    """List text without brackets and single quotes: ``['A', 'B']`` to ``A, B``."""
    return F.translate(_col(col), "[]'", "")
