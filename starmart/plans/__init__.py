"""Loads of a whole warehouse."""

from starmart.plans.changelog import apply_dimension_changes, apply_pipeline_changes, archive_facts, compact, fold_changes
from starmart.plans.incremental import incremental_load
from starmart.plans.initial import initial_load
from starmart.plans.monthly import refresh_monthly
from starmart.plans.options import LoadOptions

__all__ = [
    "LoadOptions",
    "apply_dimension_changes",
    "apply_pipeline_changes",
    "archive_facts",
    "compact",
    "fold_changes",
    "incremental_load",
    "initial_load",
    "refresh_monthly",
]
