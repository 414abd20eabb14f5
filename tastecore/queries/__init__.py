from tastecore.queries import files, learning, measures, tabular
from tastecore.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "files", "learning", "measures", "tabular"]
