"""Placement of rows on shards by a permutation-filled look-up table.

Each shard has an order of preference over the slots of a table of prime size
(an offset and a step from the hash of its name). Shards take turns, each
claiming the first slot of its order that is still free, until the table is
full: slot counts differ by one at most, and when a shard is added or removed
most slots keep their owner. A key hashes to a slot, so placement is one look-up
in a broadcast table of at most ``MAX_SLOTS`` rows, without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SLOTS = 1 << 20


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int) -> list[int]:
    """For every slot the index of its shard; ``size`` is a prime of at least ``len(shards)``."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be given and differ")
    if not len(shards) <= size <= MAX_SLOTS or size < 2 or any(size % p == 0 for p in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size must be a prime between the number of shards and {MAX_SLOTS}")
    at = [_number("offset:" + s) % size for s in shards]
    step = [_number("step:" + s) % (size - 1) + 1 for s in shards]
    owner, free = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            owner[at[i]] = i
            free -= 1
            if not free:
                return owner


def slot_of(keys: list[Column], size: int) -> Column:
    """The slot of a key: 60 bits of the md5 of its parts as text; a null part is told from an empty one."""
    parts = [F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("-")) for k in keys]
    head = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts).cast("binary")), 1, 15), 16, 10)
    return F.pmod(head.cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key_cols: list[str], shards: list[str], size: int = 65537, slot_col: str = "slot",
          shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard name of each row's key; all rows and columns are kept.

    Null keys are one key like any other; equal keys share a shard. A column of
    ``df`` that is called ``slot_col`` or ``shard_col`` must be renamed first,
    which is checked.
    """
    clash = {slot_col.lower(), shard_col.lower()} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; name others")
    owner = lookup_table(shards, size)
    table = df.sparkSession.createDataFrame(
        [(i, shards[s]) for i, s in enumerate(owner)], f"`{slot_col}` int, `{shard_col}` string")
    slotted = df.withColumn(slot_col, slot_of([F.col(k) for k in key_cols], size))
    return slotted.join(F.broadcast(table), slot_col).select(*df.columns, slot_col, shard_col)


def write_shards(df: DataFrame, key_cols: list[str], shards: list[str], path: str, size: int = 65537) -> None:
    """Write ``df`` as Parquet with a folder for each shard; a shard's rows are spread over as many files as AQE wants."""
    place(df, key_cols, shards, size).drop("slot").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def oracle_sql(shards: list[str], size: int) -> str:
    """DuckDB SQL of ``place`` on the doc_id of documents; the filled table is given as a list."""
    owners = ", ".join(map(str, lookup_table(shards, size)))
    names = ", ".join(f"'{s}'" for s in shards)
    return f"""
WITH slots AS (SELECT doc_id, (('0x' || substr(md5(coalesce('=' || doc_id::VARCHAR, '-')), 1, 15))::BIGINT % {size})::INT
               AS slot FROM documents)
SELECT doc_id, slot, ([{names}])[([{owners}])[slot + 1] + 1] AS shard FROM slots
"""
