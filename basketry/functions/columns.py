"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as whole ten-thousandths and decimal rests, so sums do not depend on row order.
UNITS = 1e4
_LARGEST = 9e14
# Digits after the point that a rest has. Amounts are decimals as they are written, so those with
# up to 17 digits are kept whole down to a hundred-thousandth, shorter ones below it.
REST_DIGITS = 22
_WIDE = f"DECIMAL(37,{REST_DIGITS})"
_REST = f"DECIMAL({REST_DIGITS},{REST_DIGITS})"
# 13 hex digits of a digest: 52 bits, which a double holds exactly
_DIGITS = 13
_DIGEST_RANGE = 4503599627370496.0

# The functions named *_sql take and give SQL text: a plan of long expressions is
# built much faster from text than from single Column calls.


def _nearest_units(amount: str) -> str:
    return f"CAST(sign({amount}) AS BIGINT) * floor(abs({amount}) * {UNITS}D + 0.5D)"


def units_sql(amount: str) -> str:
    """A money amount as the nearest whole number of ten-thousandths, halves away from zero.

    NaN, infinity and what does not fit a long raise an error.
    """
    return (f"CASE WHEN abs({amount}) <= {_LARGEST}D THEN {_nearest_units(amount)} "
            f"WHEN {amount} IS NOT NULL THEN raise_error(concat('not an amount: ', {amount})) END")


PARTS = ("units", "rest", "odd")


def parts_sql(amount: str) -> tuple[str, str, str]:
    """Units, rest and odd of an amount: it is units / 10000 + rest, or odd if it is no such number.

    The rest is a decimal, and NULL for amounts of whole ten-thousandths. Odd are NaN, infinity and
    amounts above 9e14; for these units and rest are NULL, for others odd is.
    """
    usual, units = f"abs({amount}) <= {_LARGEST}D", _nearest_units(amount)
    rest = f"CAST({amount} AS {_WIDE}) - {_decimal_units(units)}"
    return (f"CASE WHEN {usual} THEN {units} END",
            f"CASE WHEN {usual} AND ({units}) / {UNITS}D <> {amount} THEN CAST({rest} AS {_REST}) END",
            f"CASE WHEN NOT ({usual}) THEN {amount} END")


def _decimal_units(units: str) -> str:
    return f"CAST(CAST({units} AS DECIMAL(19,0)) * 0.0001BD AS {_WIDE})"


def total_sql(units: str, rest: str, odd: str) -> str:
    """The double nearest to sums of the three parts of amounts; odd amounts are added as doubles.

    NULL if there is no amount.
    """
    whole = f"{units} / {UNITS}D"
    exact = f"CAST({_decimal_units(f'coalesce({units}, 0)')} + CAST({rest} AS {_WIDE}) AS DOUBLE)"
    usual = f"CASE WHEN {rest} IS NULL THEN {whole} ELSE {exact} END"
    return f"CASE WHEN {odd} IS NULL THEN {usual} ELSE {odd} + coalesce({usual}, 0D) END"


def round_total(units: str, rest: str, odd: str, copies: str, rows: str, digits: int) -> Column:
    """(sum of amounts) · copies / rows, rounded half away from zero; units, rest and odd are the sums."""
    whole = f"nullif({rows}, 0)"
    mean = (f"CAST(round(({_decimal_units(f'coalesce({units}, 0)')} + CAST({rest} AS {_WIDE})) "
            f"* CAST({copies} AS DECIMAL(10,0)) / {whole}, {digits}) AS DOUBLE)")
    return (F.when(F.expr(f"{odd} IS NOT NULL"), F.expr(f"({total_sql(units, rest, odd)}) * {copies} / {whole}"))
            .when(F.expr(f"{rest} IS NOT NULL"), F.expr(mean))
            .otherwise(round_ratio(f"{units} * {copies}", f"{rows} * {int(UNITS)}", digits)))


def wide_sql(number: str) -> str:
    """An integer widened so that sums over a whole table cannot overflow."""
    return f"CAST({number} AS DECIMAL(25,0))"


def from_units(units: Column) -> Column:
    return units.cast("double") / UNITS


def round_ratio(numerator: str, denominator: str, digits: int) -> Column:
    """numerator/denominator rounded half away from zero, in whole numbers.

    The numerator is integer SQL, the denominator SQL for a non-negative integer;
    NULL where the denominator is 0.
    """
    scale = 10**digits
    num, den = f"({numerator})", f"nullif({denominator}, 0)"
    nearest = f"((abs({num}) * {2 * scale} + {den}) div ({den} * 2))"
    return F.expr(f"CAST(CASE WHEN {num} < 0 THEN -{nearest} ELSE {nearest} END AS DOUBLE) "
                  f"/ {float(scale)}D")


def hash_uniform(salt: str, key: Column) -> Column:
    """A number in [0, 1) that depends on the salt and the key only."""
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") / _DIGEST_RANGE


def clip01(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """A double quotient, NULL where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
