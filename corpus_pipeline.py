"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import queries as _q

STAGES = [
    ("language_id", _q.stage_language),
    ("jaccard_join", _q.stage_jaccard),
    ("decontamination", _q.stage_decontaminate),
    ("secret_scan", _q.stage_secrets),
    ("best_fit_packing", _q.stage_pack),
]

#: SQL expresses neither the trained language model nor the packing; the test compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, one after the other."""
    return _q.run_stages(STAGES, spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
