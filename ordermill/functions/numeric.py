"""Numeric column helpers: order-independent money sums and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money of up to four decimals is added up in whole ten-thousandths, so a total is the
# same whatever the partitioning and however often a task is retried.
TICKS_PER_UNIT = 10_000
_LOW_BITS = 20
LARGEST_TICKS = float(1 << 52)  # whole numbers below have a double of their own


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ticks(value: Column | str) -> Column:
    """A money amount as a whole number of ten-thousandths."""
    return F.rint(as_column(value) * TICKS_PER_UNIT).cast("bigint")


def from_ticks(total: Column | str) -> Column:
    return as_column(total).cast("double") / TICKS_PER_UNIT


def in_ticks(value: Column | str) -> Column:
    """True for amounts that are whole ten-thousandths, up to how a double can show them."""
    scaled = as_column(value).cast("double") * TICKS_PER_UNIT
    slack = F.greatest(F.abs(scaled) * 1e-15, F.lit(1e-9))
    return F.coalesce((F.abs(scaled) < LARGEST_TICKS) & (F.abs(scaled - F.rint(scaled)) <= slack), F.lit(False))


def _money_parts(value: Column | str) -> dict[str, Column]:
    """High and low bits of an amount in whole ten-thousandths, or the amount itself if it is none."""
    stored = as_column(value)
    exact = in_ticks(stored)
    amount = F.when(exact, ticks(F.when(exact, stored)))
    return {
        "high": F.shiftright(amount, _LOW_BITS),
        "low": amount.bitwiseAND((1 << _LOW_BITS) - 1),
        "rest": F.when(~exact, stored.cast("double")),
    }


MONEY_BEGUN = "struct<high:bigint,low:bigint,rest:double>"


def money_begun(value: Column | str) -> Column:
    """A total of some of the rows, from which ``money_sum`` goes on without loss."""
    return F.struct(*[F.sum(part).alias(name) for name, part in _money_parts(value).items()])


def money_sum(value: Column | str, begun: Column | str | None = None) -> Column:
    """Total as double; NULL when there is nothing to add.

    Where ``begun`` is given and not NULL, a row stands for the rows of that ``money_begun``.

    Amounts of at most four decimals are added up exactly, as whole
    ten-thousandths: high and low bits as two plain integers, several times
    faster than a wide decimal and too small to overflow even for a whole
    large table. All other amounts (more decimals, too large, not finite)
    are added up as they are stored, so nothing is rounded away.
    """
    parts = _money_parts(value)
    if begun is not None:
        parts = {name: F.coalesce(as_column(begun)[name], part) for name, part in parts.items()}
    high = F.sum(parts["high"]).cast("decimal(28,0)")
    low = F.sum(parts["low"]).cast("decimal(20,0)")
    whole = from_ticks(high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low)
    rest = F.sum(parts["rest"])
    return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)


def ratio(numerator: Column | str, denominator: Column | str, empty: float | None = 0.0) -> Column:
    """Quotient as double; ``empty`` when the denominator is zero or NULL."""
    quotient = F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )
    return quotient if empty is None else F.coalesce(quotient, F.lit(float(empty)))


def non_negative(value: Column | str) -> Column:
    return F.greatest(as_column(value).cast("double"), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)
