"""All registered queries; importing the plan modules fills the registry."""

from __future__ import annotations

import importlib

from millrace.plans.registry import ORACLES, QUERIES

MODULES = ("preparation", "recommend", "scoring", "supervised", "unsupervised")

for _name in MODULES:
    importlib.import_module(f"millrace.plans.{_name}")

__all__ = ["ORACLES", "QUERIES"]
