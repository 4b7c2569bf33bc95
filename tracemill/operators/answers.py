"""Comparison of final answers as numbers, where both are written as one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracemill.functions.text import let

_NUMBER = r"[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)"
#: The forms of a number that are understood.
PLAIN = f"^{_NUMBER}$"
PERCENT = rf"^({_NUMBER})\\?%$"
SLASHED = f"^({_NUMBER})/({_NUMBER})$"
FRACTION = rf"^([-+]?)\\[dt]?frac\{{({_NUMBER})\}}\{{({_NUMBER})\}}$"
ROOT = r"^([-+]?)(" + r"[0-9]*" + r")\\sqrt\{([0-9]+)\}$"


def bare(c: Column) -> Column:
    """Without spaces, dollar signs, a box around it, and commas between groups of three digits."""
    text = F.regexp_replace(F.regexp_replace(c, r"[ \t\n\x0B\f\r$]", ""), r"^\\boxed\{(.*)\}$", "$1")
    return F.when(text.rlike(r"^[-+]?[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?$"), F.replace(text, F.lit(","), F.lit(""))).otherwise(text)


def number(c: Column) -> Column:
    """The value of an integer, decimal, percentage, fraction or multiple of a root; null for anything else."""

    def part(x: Column, pattern: str, i: int) -> Column:
        return F.regexp_extract(x, pattern, i).try_cast("double")

    def sign(x: Column, pattern: str) -> Column:
        return F.when(F.regexp_extract(x, pattern, 1) == "-", -1.0).otherwise(1.0)

    def of(x: Column) -> Column:
        return (
            F.when(x.rlike(PLAIN), x.try_cast("double"))
            .when(x.rlike(PERCENT), part(x, PERCENT, 1) / 100.0)
            .when(x.rlike(SLASHED), F.try_divide(part(x, SLASHED, 1), part(x, SLASHED, 2)))
            .when(x.rlike(FRACTION), sign(x, FRACTION) * F.try_divide(part(x, FRACTION, 2), part(x, FRACTION, 3)))
            .when(x.rlike(ROOT), sign(x, ROOT) * F.coalesce(part(x, ROOT, 2), F.lit(1.0)) * F.sqrt(part(x, ROOT, 3)))
        )

    return let(bare(c), of)


def same_number(left: Column, right: Column) -> Column:
    """Whether both are numbers of the same value, up to rounding; false otherwise."""
    equal = lambda a, b: F.abs(a - b) <= F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    return F.coalesce(let(number(left), lambda a: let(number(right), lambda b: equal(a, b))), F.lit(False))
