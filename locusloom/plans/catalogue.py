"""All queries by name, and the SQL that DuckDB must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import assign_plans, detail_plans, ends_plans, evidence_plans, filter_plans, interval_plans, merge_plans, ml_plans, model_plans, model_set_plans, region_plans, set_plans, text_plans, tree_plans

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for module in (assign_plans, detail_plans, ends_plans, interval_plans, evidence_plans, filter_plans, merge_plans, ml_plans, model_plans, model_set_plans, region_plans, set_plans, text_plans, tree_plans):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES
