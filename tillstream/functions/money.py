"""Exact money arithmetic on integer cents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Up to here 2 * paid * amount + total fits a BIGINT; above it the decimal form is used.
_BIGINT_SAFE = 1_000_000_000


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def amount(cents_: Column) -> Column:
    return (cents_.cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def proportional(paid: Column, part: Column, total: Column) -> Column:
    """paid * part / total in cents, rounded half away from zero, so that a refund is the negative
    of the payment; 0 when the total is 0. Exact for |paid * part * 2| + |total| below 10**38; above
    ``_BIGINT_SAFE`` in decimals, whose quotient has to fit a BIGINT."""
    small = (F.greatest(F.abs(paid), F.abs(part), F.abs(total)) <= _BIGINT_SAFE)
    wide = [c.cast("decimal(19,0)") for c in (paid, part, total)]
    return (F.when(total == 0, F.lit(0).cast("bigint"))
             .when(small, _half_up(paid, part, total))
             .otherwise(_half_up(*wide)))


def _half_up(paid: Column, part: Column, total: Column) -> Column:
    whole = F.call_function("div", F.abs(2 * paid * part) + F.abs(total), F.abs(2 * total))
    return whole * F.signum(paid).cast("bigint") * F.signum(part).cast("bigint") * F.signum(
        total).cast("bigint")
