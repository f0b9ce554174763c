"""Keyed upsert as DataFrame algebra.

MERGE with "matched -> replace every column, not matched -> insert" and no
delete branch: the target rows whose key is not in the source, plus all source
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateSourceKey(ValueError):
    """The upsert source holds two rows for one key (MERGE would be ambiguous)."""


def upsert(target: DataFrame, source: DataFrame, key: str, matched: DataFrame | None = None) -> DataFrame:
    """Target rows not matched by a source key, plus every source row.

    ``matched`` gives the source keys that occur in the target where they are
    known already. NULL keys never match, so a source row with a NULL key is
    inserted. The source's keys must not repeat.
    """
    keys = (source if matched is None else matched).select(key).filter(F.col(key).isNotNull())
    return target.join(keys, key, "left_anti").unionByName(source.select(*target.columns))
