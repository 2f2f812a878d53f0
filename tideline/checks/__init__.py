"""Queries that run the operators over the shared test tables."""

import importlib

MODULES = ["relational", "features", "modelling", "workload", "edges", "scale"]


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"tideline.checks.{name}")
