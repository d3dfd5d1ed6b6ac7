"""From raw documents to sharded training data: each stage is one of the numbered operators.

A stage takes (spark, docs, sf_dir) and returns the rows it keeps; ``run`` writes each
stage's rows to the shared folder and reads them again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm import stages
from headway.llm.common import written

STAGES = [
    ("quality rules", stages.quality_rules),
    ("n-gram jaccard join", stages.near_duplicates),
    ("benchmark decontamination", stages.decontaminate),
    ("mixing sources", stages.mix_sources),
    ("sharding", stages.shard),
]

# The mix and the shards come from iterations that SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
