"""Both steps in order; tables in Parquet are the only link between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..config import RunConfig
from .extract import extract_features
from .select import run_selection

STEPS = {1: extract_features, 2: run_selection}


def run_steps(spark: SparkSession, cfg: RunConfig, steps: Sequence[int] = (1, 2)) -> DataFrame | None:
    """Run the given steps in the given order; step 2 alone uses the embeddings stored before."""
    result = None
    for step in steps:
        if step not in STEPS:
            raise ValueError(f"unknown step {step}; must be one of {sorted(STEPS)}")
        result = STEPS[step](spark, cfg)
    return result
