"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import importlib

MODULES = ["q_core", "q_clean", "q_scalar", "q_stats", "q_explain", "q_model", "q_ml", "q_sources"]


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"satlens.plans.{m}")
