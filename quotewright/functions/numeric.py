"""Rounding, as SQL text for ``expr`` and ``selectExpr``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round2_sql(value: str) -> str:
    """Half-up to 2 decimals after snapping to 8, so exact half cents are stable.

    Summation order changes the last bits of a double; the snap keeps those bits
    from deciding which way a half cent goes.  Plain arithmetic stays small in
    generated code, where a decimal per value would not; adding 0 clears ``-0``.
    From 9e7 on a double has fewer than 8 decimals, so there is nothing to snap, and
    Spark's own rounding has no ceiling (NaN and infinity stay as they are).
    """
    snapped = f"signum({value}) * floor((rint(abs({value}) * 1e8D) + 500000D) / 1000000D) / 100D + 0D"
    return f"if(abs({value}) < 9e7D, {snapped}, round({value}, 2))"


def round2(value: str) -> Column:
    return F.expr(round2_sql(value))


def round2_decimal(value: str) -> Column:
    """Half-up to 2 decimals of the value's decimal with 8 places, as an SQL engine casts it.

    That decimal is the double nearest to the value times 1e8, so from 9e7 on a half cent may lie on
    either side of it, where ``round2`` goes by the value's own digits.  Cents are split off by an exact
    remainder.  From 4.5e13 on doubles are as coarse as cents, and the value stays as it is.
    """
    scaled = f"abs({value}) * 1e8D"
    rest = f"({scaled} % 1000000D) / 1000000D"
    large = f"signum({value}) * (rint({scaled} / 1000000D - {rest}) + if({rest} >= 0.5D, 1D, 0D)) / 100D"
    return F.expr(f"if(abs({value}) < 9e7D, {round2_sql(value)}, if(abs({value}) < 4.5e13D, {large}, {value}))")
