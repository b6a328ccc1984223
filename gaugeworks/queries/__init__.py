"""Registered queries: each operator and mart on the given tables."""

from importlib import import_module

MODULES = ["time_joins", "windows", "basics", "schemas", "reports", "stored", "marts_cost", "marts_spark", "marts_audit"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"gaugeworks.queries.{name}")
