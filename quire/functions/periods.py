"""Period expressions: pairs of signed years, BCE negative, either side possibly open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import vocab
from quire.functions.text import SPACE, let, strip

YEAR = r"[+-]?[0-9]+(?:_[0-9]+)*"


def whole_number(text: Column) -> Column:
    """Integer written in a form field, null when it is not one."""
    return bare_number(strip(text))


def bare_number(bare: Column) -> Column:
    """:func:`whole_number` of a text without space at its ends."""
    digits = F.when(bare.rlike(f"^{YEAR}\\z"), F.replace(bare, F.lit("_"), F.lit("")))
    return digits.try_cast("int")


SPAN = f"^(-?[0-9]+)(?:{SPACE}*[–-]{SPACE}*(-?[0-9]+))?\\z"


def bare_years(bare: Column) -> tuple[Column, Column]:
    """Start and end of a period written in a text without space at its ends."""
    start, end = F.regexp_extract(bare, SPAN, 1), F.regexp_extract(bare, SPAN, 2)
    return start.try_cast("int"), F.when(end == "", start).otherwise(end).try_cast("int")


def parse_period(text: Column) -> Column:
    """``a-b``, ``a–b`` or ``a`` as ``struct<start, end>``; anything else gives nulls."""
    def years(bare: Column) -> Column:
        start, end = bare_years(bare)
        return F.struct(start.alias("start"), end.alias("end"))

    return let(strip(text), years)


def period_label(start: Column, end: Column) -> Column:
    """Readable period: BCE years spelled out, ``?`` for an open side, null for no period."""
    def year(y: Column) -> Column:
        text = F.when(y < 0, F.concat((-y).cast("string"), F.lit(" BCE"))).otherwise(
            y.cast("string")
        )
        return F.coalesce(text, F.lit("?"))

    left, right = year(start), year(end)
    both = F.when(left == right, left).otherwise(F.concat(left, F.lit("–"), right))
    return F.when(start.isNotNull() | end.isNotNull(), both)


def overlaps(start: Column, end: Column, low: int | None, high: int | None) -> Column:
    """Does the period touch [low, high]? A missing side takes the other; no period is false."""
    first, last = F.coalesce(start, end), F.coalesce(end, start)
    test = first.isNotNull()
    if high is not None:
        test = test & (first <= high)
    if low is not None:
        test = test & (last >= low)
    return F.coalesce(test, F.lit(False))


def heat(count: Column, peak: Column) -> Column:
    """Cell intensity between 0 and 1."""
    share = F.pow(count / peak, F.lit(vocab.HEAT_EXPONENT))
    return F.when(count == 0, F.lit(0.0)).otherwise(share)
