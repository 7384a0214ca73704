"""Registered queries, one module per area; importing the package fills the catalogue."""

from importlib import import_module

from lotwise.plans.registry import CATALOGUE

MODULES = ("sources", "generators", "scans", "joins", "aggregates", "subqueries", "windows", "scalars", "search", "vectors", "graphs", "functions", "changes", "quality", "marts", "streams")

for _name in MODULES:
    import_module(f"lotwise.plans.{_name}")
