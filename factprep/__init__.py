"""factprep: clean, deduplicate, enrich and verify large fact tables with PySpark."""

from factprep.contract import MOVES, TRIPS, FactContract, Role

__all__ = ["FactContract", "MOVES", "Role", "TRIPS"]
