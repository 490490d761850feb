"""riskloom: tabular risk scoring as lazy Spark DataFrame plans.

Sub-packages
------------
sources    typed / inferred / text CSV scans, store tables, request frames
sinks      append store, predictions CSV / JSON, display table
functions  scalar column expressions (parsing, rounding, verdicts, percent)
operators  cast projection, assembling, splitting, tree fit / predict, metrics
plans      end-to-end jobs (ingest, train, score), the lineitem and clinical
           fixtures, the query catalogue (plans.queries) and its SQL oracles
streaming  Structured Streaming scoring
"""

from riskloom.specs import DatasetSpec, VerdictRule, get_spec, select_job

__all__ = ["DatasetSpec", "VerdictRule", "get_spec", "select_job"]
