"""Enforcement-notice analytics on Spark DataFrames.

Public entry points (each takes the caller's SparkSession):

- ``run_stages`` / ``refresh_stages``: bronze -> silver -> quality -> scores
  -> gold (-> serving store) as a batch job.
- ``incremental_refresh``: the same, incrementally, from newly landed files.
- Operators are plain functions in ``noticeflow.operators`` (DataFrame ->
  DataFrame) and ``noticeflow.functions`` (Column -> Column).
"""

from .plans.stages import build_gold, bronze_to_silver, refresh_stages, run_stages
from .streaming.incremental import incremental_refresh

__all__ = ["bronze_to_silver", "build_gold", "incremental_refresh", "refresh_stages", "run_stages"]
