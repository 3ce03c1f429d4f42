"""Named jobs."""

from __future__ import annotations

import importlib

MODULES = ("store_views", "store_basics", "store_cleaning", "store_problems", "survey", "energy_views", "energy", "energy_reports", "quality", "lab", "primitives", "streams", "incremental", "warehouse")


def all_jobs():
    from tidegrain.plans.registry import JOBS

    for m in MODULES:
        importlib.import_module(f"tidegrain.plans.{m}")
    return JOBS
