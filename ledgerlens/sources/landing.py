"""What has landed for a batch: expected datasets present, and their row counts.

The arrival check of the feed, as data: every expected dataset left-joined
with the files listed under ``raw/batch_date=D`` and with their row counts.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import DATASETS


def batch_completeness(spark: SparkSession, batch_dir: str,
                       expected: tuple[str, ...] = DATASETS) -> DataFrame:
    """(dataset, file_present, row_count) for each expected dataset of a batch folder.

    A dataset is present if a file of it has landed, with rows or without; a
    folder that does not exist has none.
    """
    want = spark.createDataFrame([(d,) for d in expected], "dataset string")
    name = r"/([^/]+)\.csv(/[^/]*)?$"
    files = f"{batch_dir.rstrip('/')}/*.csv"
    try:
        # the listing alone: paths are read, contents are not
        landed = (spark.read.format("binaryFile").load(files)
                  .select(F.regexp_extract("path", name, 1).alias("dataset")).distinct())
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return want.select("dataset", F.lit(False).alias("file_present"),
                           F.lit(0).cast("long").alias("row_count"))
    # the column is never looked at: a row is a row whatever it holds
    rows = (spark.read.schema("line string").option("header", True).csv(files)
            .select(F.regexp_extract(F.col("_metadata.file_path"), name, 1).alias("dataset")))
    counts = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("row_count"))
    return (want.join(landed.withColumn("landed", F.lit(True)), "dataset", "left")
            .join(counts, "dataset", "left")
            .select("dataset", F.col("landed").isNotNull().alias("file_present"),
                    F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")))
