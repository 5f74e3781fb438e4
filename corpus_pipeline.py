"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps with
the columns of its input; the last returns the encoded documents. What a stage
returns is written as Parquet in the shared folder and read back for the next,
so a lost executor costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, jaccard_join, line_dedup, quality_classifier, sentencepiece_fst
from tessera.llm.common import stored
from tessera.sources.tables import read_table

STAGES = [
    ("quality classifier", quality_classifier.pipeline_stage),
    ("line dedup", line_dedup.pipeline_stage),
    ("n-gram Jaccard join", jaccard_join.pipeline_stage),
    ("benchmark decontamination", decontaminate.pipeline_stage),
    ("SentencePiece encoding and decoding", sentencepiece_fst.pipeline_stage),
]

#: A trained classifier decides what the other stages see: no SQL tells the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
