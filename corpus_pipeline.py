"""The corpus pipeline: documents through five operators, each stage stored and reread.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but
the last return the columns of ``documents``. A stage works on all rows of
``docs`` that the one before kept; null and empty texts, ties and repeated rows
are treated as the operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, classifier, decontaminate, line_dedup, near_dedup
from ledgerlens.llm.common import cut, documents, ship


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier scores under 0.5 go; it learns from labelled rows that are not held out."""
    ship(spark)
    model = classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classifier.keep_accepted(docs, model)


def fuzzy_line_dedup(spark, docs, sf_dir):
    """Lines that an earlier place has go; a document that loses all its lines stays with an empty rest."""
    ship(spark)
    kind = docs.schema["n_chars"].dataType
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(kind))


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays."""
    ship(spark)
    return near_dedup.drop_near_duplicates(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go; items too short to be evidence (``short_items``) count for nothing."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                                           least_chars=decontaminate.LEAST_CHARS)


def bpe_encoding(spark, docs, sf_dir):
    """Token ids of each document, with the digests of the ids and of the text decoded from them."""
    ship(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", fuzzy_line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

# Classifier scores, edit distances and tokenizer output are not SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, with a Parquet cut after each but the last."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
