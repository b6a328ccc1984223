"""Import the modules of all operators, so that their queries are registered."""

from __future__ import annotations

from importlib import import_module

from gaugeworks.llm.common import ORACLES, QUERIES

MODULES = [
    "url_filter",
    "sharding",
    "line_dedup",
    "quality_classifier",
    "simhash",
    "packing",
    "mixing",
    "multi_index",
    "quality_rules",
    "lm_scoring",
    "warc",
    "collocations",
    "spelling",
]

for _name in MODULES:
    import_module(f"gaugeworks.llm.{_name}")

__all__ = ["ORACLES", "QUERIES"]
