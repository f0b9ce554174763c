"""The tables as objects of the session's catalog, so SQL names them ``database.table``.

A full-refresh table becomes an external table over its live folder. The fact
becomes a partitioned external table whose partitions lie where their last
commits wrote them, under a view with the fact's own columns; partition filters
prune it like any other table. Both can be registered as of a time, for SQL
that looks back. What is registered shows the table at that moment: register
again after a load. No data is copied, and dropping a database deletes none.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.contracts import FACT_COLUMNS
from .tables import FactTable, ReplaceTable

#: The partitioned table under the fact's view has the view's name and this ending.
FILES = "_files"
_AT_ONCE = 200


def _name(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")


def put_table(spark: SparkSession, database: str, name: str, table: ReplaceTable, at=None) -> bool:
    """``database.name`` over the table's copy as of ``at``; False, and no such table, if it has none."""
    full = f"{_name(database)}.{_name(name)}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    try:
        folder, schema = table.live(at)
    except LookupError:
        return False
    spark.catalog.createTable(full, path=folder, source="parquet", schema=schema)
    return True


def put_fact(spark: SparkSession, database: str, name: str, fact: FactTable, at=None) -> bool:
    """``database.name`` over the fact's rows as of ``at``; empty before the first commit, False if there is none at all."""
    full, files = f"{_name(database)}.{_name(name)}", f"{_name(database)}.{_name(name + FILES)}"
    spark.sql(f"DROP VIEW IF EXISTS {full}")
    spark.sql(f"DROP TABLE IF EXISTS {files}")
    if not fact.exists():
        return False
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in fact.stored)
    spark.sql(f"CREATE TABLE {files} ({columns}, part STRING) USING parquet PARTITIONED BY (part) "
              f"LOCATION {_text(fact.data)}")
    live = sorted(fact.live(at).items())
    for i in range(0, len(live), _AT_ONCE):
        places = " ".join(f"PARTITION (part = {_text(part)}) LOCATION {_text(path)}" for part, path in live[i:i + _AT_ONCE])
        spark.sql(f"ALTER TABLE {files} ADD {places}")
    spark.sql(f"CREATE VIEW {full} AS SELECT {', '.join(map(_name, FACT_COLUMNS))} FROM {files}")
    return True
