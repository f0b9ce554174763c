"""Zone layout and file I/O: raw CSV, validated and staging Parquet.

Raw files land as ``raw/batch_date=D/<dataset>.csv``; validated data goes to
``validated/<dataset>/batch_date=D`` and curated data to
``staging/<name>/batch_date=D``. Leaf paths are read as leaves, so the
``batch_date`` column comes from the data, not from partition discovery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contracts import Contract

#: Rows of a landed part file, at most.
FILE_ROWS = 500_000
#: Gzip level of landed files: under half the time of the default level (SIX) for a twelfth more bytes.
GZIP_LEVEL = "FOUR"


class Zones:
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def raw_batch(self, batch_date: str) -> str:
        return f"{self.root}/raw/batch_date={batch_date}"

    def raw(self, dataset: str, batch_date: str) -> str:
        return f"{self.raw_batch(batch_date)}/{dataset}.csv"

    def validated(self, dataset: str, batch_date: str) -> str:
        return f"{self.root}/validated/{dataset}/batch_date={batch_date}"

    def staging(self, name: str, batch_date: str) -> str:
        return f"{self.root}/staging/{name}/batch_date={batch_date}"

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}"


def read_raw_csv(spark: SparkSession, path: str, contract: Contract,
                 extras: dict[str, str] | None = None) -> DataFrame:
    """A raw feed file: header row, every column as text.

    No type inference (it costs a pass over the file and turns a column with
    one bad value into text anyway): columns are matched by header name and
    parsed later. Empty fields read as NULL, spaces-only fields do not; a
    short row is NULL-padded. A file missing a contract column is an error, and
    so is a part file whose header differs from the first one's.
    ``extras`` keeps further columns (name -> type), e.g. tie-breaks.
    """
    df = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    wanted = contract.names + list(extras or {})
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing} of {contract.name}")
    return df.select(*contract.names,
                     *[F.col(c).try_cast(t).alias(c) for c, t in (extras or {}).items()])


def write_raw_csv(df: DataFrame, path: str, compression: str = "gzip", max_rows: int = FILE_ROWS) -> None:
    """A feed file as the generator writes it: header, one dataset per path.

    A compressed part is read by one task, so it holds at most ``max_rows`` rows (0: any number).
    """
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    (out.write.mode("overwrite").option("header", True).option("compression", compression)
     .option("zlib.compress.level", GZIP_LEVEL).option("maxRecordsPerFile", max_rows).csv(path))


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the Parquet data at ``path`` (never a path the plan reads)."""
    df.write.mode("overwrite").parquet(path)


def export_result(df: DataFrame, path: str) -> None:
    """A query result as CSV with a header at an output location (S15)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def require_schema(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Fail before writing when ``df`` lacks a column the table declares or has it in another type (S9)."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'}, "
             f"declared {f.dataType.simpleString()}" for f in schema if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"{table} does not match its declared columns: {'; '.join(wrong)}")
    return df
