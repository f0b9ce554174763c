"""Helpers shared by the corpus operators: lineage cuts, Arrow access, text rules.

``cut`` writes a table to the shared folder named by ``spark.checkpoint.dir``
and reads it back, so a step survives lost executors and is computed once.
Text rules work on UTF-8 bytes: ``bytes.lower`` folds A-Z only and
``bytes.split`` splits at space and \\t..\\r only, which is the word rule
``[^\\x20\\x09-\\x0D]+`` of the operators.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import fresh_dir

WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new shared folder and return the stored table."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark) -> None:
    """Make this package importable in the Python workers (once a context) and keep Arrow batches small.

    A batch of texts is bounded by bytes, so long documents don't fill a worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlens_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "ledgerlens.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._ledgerlens_shipped = True


def raw(array: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null reads as empty."""
    return [x or b"" for x in array.cast(pa.large_binary()).to_pylist()]


def spans(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``limit`` in total (an item of more stands alone)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % n, F.lit(0))


def lowest(df: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` rows of the smallest ``by``, a column of uniform 64-bit hashes; ties go by all columns.

    The hash itself thins the rows to about ``n`` first, so that what is sorted
    in the end does not grow with the table.
    """
    reach = (1.2 * n + 1000) / max(1, df.count())
    if reach < 1:
        df = df.where(F.col(by) < int(reach * (1 << 64)) - (1 << 63))
    return df.orderBy(by, *[c for c in df.columns if c != by]).limit(n)


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
