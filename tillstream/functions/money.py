"""Money: exact sums and means of two-decimal amounts that arrive as doubles.

A sum of doubles depends on the order of its parts, and on a cluster that order
changes with every run. Amounts with two decimals are therefore added as whole
cents. A group that holds anything else (more decimals, infinity, too large for
cents) falls back to the plain double aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Whole cents as bigint, to the nearest; NULL where they do not fit."""
    return F.rint(amount * 100).try_cast("bigint")


def exact_cents(amount: Column) -> Column:
    """Whole cents; NULL where the amount is not a whole number of them."""
    whole = cents(amount)
    return F.when(whole.cast("double") / 100 == amount, whole)


def money_parts(amount: Column, name: str) -> list[Column]:
    """The aggregates that ``exact_sum`` and ``exact_mean`` are made of.

    They are kept apart because an expression that names an aggregate five times
    makes Spark compute it five times next to a distinct count.
    """
    return [
        F.try_sum(exact_cents(amount)).alias(f"_{name}_cents"),
        F.count(exact_cents(amount)).alias(f"_{name}_exact"),
        F.sum(amount).alias(f"_{name}_sum"),
        F.count(amount).alias(f"_{name}_n"),
    ]


def _cents_sum(name: str) -> Column:
    return F.when(F.col(f"_{name}_exact") == F.col(f"_{name}_n"), F.col(f"_{name}_cents"))


def exact_sum(name: str) -> Column:
    """Sum to two decimals, from ``money_parts``."""
    return F.coalesce(_cents_sum(name).cast("double") / 100, F.round(f"_{name}_sum", 2))


def exact_mean(name: str) -> Column:
    """Mean to two decimals, half a cent rounding away from zero."""
    total, n = _cents_sum(name), F.col(f"_{name}_n")
    size = F.abs(total)
    up = F.when((size % n) * 2 >= n, 1).otherwise(0)
    mean = F.signum(total) * (F.call_function("div", size, n) + up) / 100
    plain = F.round(F.col(f"_{name}_sum") / n, 2)
    return F.when(n > 0, F.coalesce(mean, plain))


def money_text(amount: Column, sign: str = "") -> Column:
    """``1234.5`` → ``1,234.50``, with a currency sign in front."""
    return F.concat(F.lit(sign), F.format_number(amount, 2))
