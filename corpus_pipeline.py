"""The corpus pipeline: documents through five of the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from slotwise.llm.mixing import mixing_stage
from slotwise.llm.neardup import neardup_stage
from slotwise.llm.pieces import pieces_stage
from slotwise.llm.quality import quality_stage
from slotwise.llm.secrets import secrets_stage
from slotwise.session import ensure_checkpoint_dir

# (name, function(spark, docs, sf_dir)); each stage works on all its predecessor kept.
STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", neardup_stage),
    ("secret scan", secrets_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

# Alignment, the character network and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``.

    Each stage's result is written as Parquet to the folder the cluster shares
    (``spark.checkpoint.dir``) and reread, so a lost executor costs one stage at
    most and no stage is computed twice.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{k}")
            docs = spark.read.parquet(f"{base}/{k}")
    return docs
