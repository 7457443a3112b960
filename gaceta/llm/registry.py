"""What the entry file registers for this subpackage and the pipeline made of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gaceta.llm import oracle, queries as registered


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return registered.queries() | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = corpus_pipeline.ORACLE_SQL
    return oracle.oracle_sql() | ({"pipeline": pipeline} if pipeline else {})
