"""Exact money aggregation.

Money is DOUBLE in the data model, but a DOUBLE sum depends on the order
rows arrive in, which differs between runs, partitionings and engines. Each
amount is cast to DECIMAL(28,6) before summing, so totals are the same on one
core or a thousand executors; the total is cast back to DOUBLE. Six decimals
hold any currency's smallest unit; digits beyond them round half up.

An amount that does not fit (NaN, infinite, 1e22 or more) is not lost and
fails no job: such amounts are summed as DOUBLE beside the exact ones and
added at the end, so one NaN makes its group's total NaN, as a plain SUM would.
Partial sums carry both parts, so pre-aggregating (per customer, per merchant)
and then summing the partials gives the same total as one flat sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(amount: str | Column) -> Column:
    """The amount as exact DECIMAL, NULL if it does not fit."""
    return _col(amount).try_cast(MONEY)


def beyond(amount: str | Column) -> Column:
    """The amount as DOUBLE if it does not fit the exact type, else NULL."""
    a = _col(amount)
    return F.when(a.isNotNull() & exact(a).isNull(), a.cast("double"))


def partial_sums(amount: str | Column, name: str) -> list[Column]:
    """Aggregates ``name`` and ``name_beyond``: both parts of a sum, to be added up later."""
    return [F.sum(exact(amount)).alias(name), F.sum(beyond(amount)).alias(f"{name}_beyond")]


def _total(fits: Column, rest: Column) -> Column:
    return F.when(rest.isNull(), fits.cast("double")).otherwise(
        F.coalesce(fits.cast("double"), F.lit(0.0)) + rest)


def sum_of_partials(name: str) -> Column:
    """The total over ``partial_sums(..., name)`` rows, as DOUBLE."""
    return _total(F.sum(name), F.sum(f"{name}_beyond"))


def exact_sum(amount: str | Column) -> Column:
    """SUM(amount) as DOUBLE, independent of row order."""
    return _total(F.sum(exact(amount)), F.sum(beyond(amount)))


def exact_avg(amount: str | Column) -> Column:
    """AVG(amount): exact total over the count of non-NULL amounts."""
    return F.try_divide(exact_sum(amount), F.count(_col(amount)))
