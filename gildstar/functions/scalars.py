"""Scalar building blocks: money, ratios, bands, ranges, merges (M*, S*, P10)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str
MONEY = "decimal(18,6)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents_to_money(cents: ColumnOrName) -> Column:
    """M1: integer cents to currency units."""
    return (_col(cents).cast("decimal(18,0)") / F.lit(100)).cast(MONEY)


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """M2: NULL when the denominator is 0 or either side is NULL."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def pct_change(current: ColumnOrName, previous: ColumnOrName) -> Column:
    """M3: percent change, NULL when the previous value is NULL or 0."""
    delta = (_col(current) - _col(previous)).cast("double")
    return F.try_divide(delta, _col(previous).cast("double")) * F.lit(100.0)


def midpoint(low: ColumnOrName, high: ColumnOrName) -> Column:
    """M4: middle of two bounds, NULL unless both are present."""
    return (_col(low) + _col(high)) / F.lit(2)


def try_number(text: ColumnOrName) -> Column:
    """M5: text to whole number (half-up), NULL when it is not a number."""
    return _col(text).try_cast("decimal(38,0)").try_cast("bigint")


def parse_range(text: ColumnOrName, separator: str = " .. ") -> tuple[Column, Column]:
    """``"10,000 .. 20,000"`` -> (10000, 20000); a missing part gives NULL."""

    def part(n: int) -> Column:
        piece = F.split_part(_col(text), F.lit(separator), F.lit(n))
        return try_number(F.replace(piece, F.lit(","), F.lit("")))

    return part(1), part(2)


def csv_element(text: ColumnOrName, n: int, separator: str = ",") -> Column:
    """S2+S3: n-th element of delimited text, trimmed; out of range gives ''."""
    return F.trim(F.split_part(_col(text), F.lit(separator), F.lit(n)))


def coalesce_priority(merges: Mapping[str, Sequence[ColumnOrName]]) -> list[Column]:
    """M8: for every output name the first non-NULL of its candidates."""
    return [F.coalesce(*[_col(c) for c in cols]).alias(name) for name, cols in merges.items()]


def band(value: ColumnOrName, thresholds: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first threshold with ``value >= threshold``.

    Thresholds come in descending order; NULL takes the last label.
    """
    return _chain([(_col(value) >= F.lit(t), label) for t, label in thresholds], otherwise)


def band_below(
    value: ColumnOrName,
    thresholds: Iterable[tuple[float, str]],
    otherwise: str,
    override: tuple[Column, str] | None = None,
) -> Column:
    """Label of the first threshold with ``value < threshold``.

    Thresholds ascend; ``override`` (condition, label) is tested before them.
    """
    arms = [override] if override else []
    arms += [(_col(value) < F.lit(t), label) for t, label in thresholds]
    return _chain(arms, otherwise)


def category(value: ColumnOrName, groups: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """Name of the group whose members include the value."""
    return _chain([(_col(value).isin(*members), name) for name, members in groups.items()], otherwise)


def count_true(*flags: ColumnOrName) -> Column:
    """Number of flags that are true; NULL counts as false."""
    ones = [F.coalesce(_col(f), F.lit(False)).cast("int") for f in flags]
    total = ones[0]
    for one in ones[1:]:
        total = total + one
    return total


def contains_text(value: ColumnOrName, part: str) -> Column:
    """P10: case-insensitive substring test that is false, not NULL, on NULL."""
    return F.coalesce(_col(value).ilike(f"%{part}%"), F.lit(False))


def _chain(arms: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    expr = None
    for condition, label in arms:
        expr = F.when(condition, label) if expr is None else expr.when(condition, label)
    return F.lit(otherwise) if expr is None else expr.otherwise(otherwise)
