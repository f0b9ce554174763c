"""Validation: required-column filter, typed parsing, one row per key.

``keep_first`` is the dedupe: the first row of a ``row_number`` window. Spark
puts a group limit under the shuffle of such a window, so every input task
sends at most one row of a key and a key holding a third of all rows is
reduced before it meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.contracts import Contract, Sort

_RANK = "__rank"


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is NULL (one conjunction)."""
    cond = None
    for name in columns:
        term = F.col(name).isNotNull()
        cond = term if cond is None else cond & term
    return df if cond is None else df.filter(cond)


def parse_column(df: DataFrame, name: str, target: str) -> Column:
    """``name`` as ``target`` type; unparsable text becomes NULL, never an error."""
    source = df.schema[name].dataType.simpleString()
    if source == target:
        return F.col(name)
    if target == "timestamp" and source == "string":
        # text without a zone is in the session's, which the library fixes to UTC
        return F.try_to_timestamp(name)
    return F.col(name).try_cast(target)


def _ordering(s: Sort) -> Column:
    c = F.col(s.column)
    if s.descending:
        return c.desc_nulls_last() if s.nulls_go_last else c.desc_nulls_first()
    return c.asc_nulls_last() if s.nulls_go_last else c.asc_nulls_first()


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Sort]) -> DataFrame:
    """One row per key: the first under ``order``. Columns and their order are kept."""
    keys = [key] if isinstance(key, str) else list(key)
    first = Window.partitionBy(*keys).orderBy(*([_ordering(s) for s in order] or [F.lit(1)]))
    return df.withColumn(_RANK, F.row_number().over(first)).where(F.col(_RANK) == 1).drop(_RANK)


def validate(raw: DataFrame, contract: Contract, batch_date: str,
             order: Sequence[Sort] | None = None, stamp: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Validated dataset: required filter, parse, one row per key, batch columns.

    The NOT NULL test runs on the raw values before parsing and before the
    dedupe, as the feed does; a value that does not parse passes the test
    and turns into NULL. ``order`` defaults to the contract's total order and
    may name extra raw columns as further tie-breaks; ``keep`` names those that stay.
    """
    checked = require_not_null(raw, contract.required)
    extras = [c for c in raw.columns if c not in contract.names]
    typed = checked.select(*[parse_column(checked, c, t).alias(c) for c, t in contract.columns],
                           *extras)
    one = keep_first(typed, contract.key, order or contract.total_order)
    out = one.select(*contract.names, *keep).withColumn("batch_date", F.lit(batch_date))
    if stamp:
        out = out.withColumn("validated_at", F.current_timestamp())
    return out


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (a partial aggregate)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
